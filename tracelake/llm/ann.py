"""Approximate nearest neighbours: inverted file, product-quantised residuals, exact reranking. Nearness is the inner product.

Fitting takes a bounded sample (at most about ``FIT_ROWS`` distinct vectors): k-means gives the coarse centroids, and k-means on the
residuals' parts gives the codebooks. Every distinct vector is indexed: in the list of its nearest centroid, with one code byte for
each part. A list of 2 * ``FINE`` vectors or more is cut in cells, about one for each ``FINE`` of its vectors (``MAX_FINE`` at most), by
k-means on a bounded sample of the list, in a task of its own; a shorter list is one cell. So cells grow in number and not in length until
there are ``FINE * MAX_FINE`` vectors a list.

A query visits the cells whose centroids have the largest inner products with it, among those of its best lists. How many lists and cells
that takes is measured: the exact k nearest of ``ASKED`` vectors are found by one scan of all vectors, and as many lists, then cells, are
visited as hold ``COVER`` of these. The numbers follow the data: a few where vectors cluster, most of them where they lie evenly on a
sphere. In a cell, tables of the inner products of the query's parts with the codewords give every vector an estimate (asymmetric distances),
and the ``RERANK`` best of each bin are scored exactly, in double precision.

Cells are dealt in bins of about ``CHUNK`` vectors: short ones share one, a long one has several. A bin's vectors are sent once for each
``BLOCK`` queries that visit it, and held while these stream past, so neither a long cell nor one that many queries visit lands in one
task, and no task holds more than a bin; a query leaves a bin with its k + 1 best. Equal vectors are one entry with its k + 1 smallest ids: more can't be among the k nearest, as ties go to the smaller id.
Equal queries search once.

Vectors that are null, zero, of another length than most, or that hold a null or non-finite component take no part, neither as queries
nor as candidates. Rows with equal ids and vectors count once. With fewer than k candidates all are returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tracelake.llm import _shared

FIT_ROWS = 20_000
PARTS, CODES = 16, 256
MAX_LISTS = 4096
#: Lists are cut in cells of about this many vectors, in so many at most; vectors of the sample to each centroid of a cell.
FINE, MAX_FINE, FINE_FIT = 1024, 1024, 8
#: Centroids of cells that a task holds at a time.
SHELF = 32_768
#: Share of the nearest vectors of ``ASKED`` ones that the visited lists must hold, and again the visited cells of these lists.
COVER, ASKED = 0.975, 200
RERANK = 512
CHUNK = 8_192
BLOCK = 65_536


def _kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centroids by Lloyd's rounds from a random start; empty ones move to the points that fit worst."""
    rng = np.random.default_rng(seed)
    if len(x) <= k:
        return np.concatenate([x, np.repeat(x[:1], k - len(x), axis=0)])
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        distance = (c * c).sum(1) - 2 * (x @ c.T)
        near = distance.argmin(1)
        count = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], c)
        empty = np.flatnonzero(count == 0)
        if len(empty):
            worst = np.argsort(-(distance.min(1) + (x * x).sum(1)))[: len(empty)]
            c[empty[: len(worst)]] = x[worst]
    return c


class Codebook:
    """Coarse centroids (lists, width) and codewords (parts, CODES, width / parts)."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.width = sample.shape[1]
        self.coarse = _kmeans(sample, lists, 1)
        self.edges = np.linspace(0, self.width, min(PARTS, self.width) + 1).astype(int)
        residual = sample - self.coarse[self.nearest(sample)]
        self.words = [_kmeans(residual[:, a:b], CODES, 2 + i) for i, (a, b) in enumerate(zip(self.edges, self.edges[1:]))]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return ((self.coarse**2).sum(1) - 2 * (x @ self.coarse.T)).argmin(1)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List and code bytes of each vector."""
        near = self.nearest(x)
        residual = x - self.coarse[near]
        codes = [((w * w).sum(1) - 2 * (residual[:, a:b] @ w.T)).argmin(1) for w, a, b in zip(self.words, self.edges, self.edges[1:])]
        return near, np.stack(codes, axis=1).astype(np.uint8)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Inner products of a query's parts with the codewords: (parts, CODES)."""
        return np.stack([w @ q[a:b] for w, a, b in zip(self.words, self.edges, self.edges[1:])])


def enough(ranks: np.ndarray) -> int:
    """How many of the best must be visited (ranks count from 0) to find ``COVER`` of what lies at these ranks."""
    needed = np.sort(ranks) + 1
    return int(needed[min(len(needed) - 1, int(np.ceil(COVER * len(needed))))]) if len(needed) else 1


def true_cells(indexed: DataFrame, uid: np.ndarray, q: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(place of a vector in ``q``, cell) for each of the exact k nearest of a bounded number of vectors: one scan of all, k rows a vector and task."""
    asked = indexed.sparkSession.sparkContext.broadcast((uid, q))

    def scan(batches):
        own, q = asked.value
        score, cell = np.full((len(q), k), -np.inf), np.zeros((len(q), k), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            here = q @ _matrix(batch.column(2), q.shape[1]).T
            here[own[:, None] == batch.column(0).to_numpy()[None, :]] = -np.inf
            score = np.concatenate([score, here], axis=1)
            cell = np.concatenate([cell, np.broadcast_to(batch.column(1).to_numpy(), here.shape)], axis=1)
            best = np.argpartition(-score, k - 1, axis=1)[:, :k]
            score, cell = np.take_along_axis(score, best, axis=1), np.take_along_axis(cell, best, axis=1)
        at, rank = np.nonzero(np.isfinite(score))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(cell[at, rank]), pa.array(score[at, rank])], names=["at", "cell", "score"])

    found = indexed.select("uid", "cell", "v").mapInArrow(scan, "at long, cell long, score double")
    near = found.withColumn("i", F.row_number().over(Window.partitionBy("at").orderBy(F.desc("score"), "cell"))).where(F.col("i") <= k)
    return [(r["at"], r["cell"]) for r in near.select("at", "cell").collect()]  # at most ASKED * k rows


def by_shelf(centroids: DataFrame, rows: DataFrame, pieces, work, schema: str) -> DataFrame:
    """``work(cells, their centroids, batch of (id, list, lists, v))`` over rows (shelf, id, list, lists, v). A shelf's rows are spread over ``pieces``
    (a column of shelf), each with a copy of its centroids (shelf, cell, v) in the order of cells, which is all a task holds."""
    null = F.lit(None)
    held = centroids.select("shelf", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"), F.lit(0).alias("kind"), F.col("cell").alias("id"), null.cast("long").alias("list"), null.cast("array<long>").alias("lists"), "v")
    dealt = rows.select("shelf", F.pmod(F.xxhash64("id"), pieces).cast("int").alias("piece"), F.lit(1).alias("kind"), "id", "list", "lists", "v")

    def run(batches):
        held, now, ready = [], None, None
        for batch in batches:
            if not len(batch):
                continue
            key = np.stack([batch.column(i).to_numpy() for i in range(3)])
            cuts = np.flatnonzero((np.diff(key, axis=1) != 0).any(axis=0)) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
                part, where = batch.slice(i, j - i), (key[0, i], key[1, i])
                if where != now:
                    held, now, ready = [], where, None
                if key[2, i] == 0:
                    held.append(part)
                    continue
                if ready is None:
                    t = pa.Table.from_batches(held).combine_chunks()
                    ready, held = (t["id"].to_numpy(), _matrix(t["v"].combine_chunks(), len(t["v"][0]))), []
                yield from work(*ready, part.select(["id", "list", "lists", "v"]))

    every = held.unionByName(dealt)
    return every.repartition("shelf", "piece").sortWithinPartitions("shelf", "piece", "kind", "list", "id").mapInArrow(run, schema)


def _spans(cells: np.ndarray, lists) -> list[tuple[int, int]]:
    """Where each list's cells begin and end in sorted cells."""
    lists = np.asarray(lists)
    return list(zip(np.searchsorted(cells, lists * MAX_FINE).tolist(), np.searchsorted(cells, (lists + 1) * MAX_FINE).tolist()))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the vectors that take part, v as array of doubles."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id is not null and v is not null")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.where(F.coalesce(fine, F.lit(False)))
    width = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("k")).orderBy(F.desc("k"), "n").first()
    return rows.where(F.size("v") == (width["n"] if width else 0))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _bin(rows: pa.Table, width: int):
    """A bin's vectors in the order of their cells: ids, cells, places of their code words in the tables, and the vectors."""
    uid, near = rows.column("id").to_numpy(), rows.column("cell").to_numpy()
    order = np.lexsort((uid, near))
    codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(len(uid), -1)[order].astype(np.int64)
    return uid[order], near[order], codes + np.arange(codes.shape[1]) * CODES, _matrix(rows.column("v").combine_chunks(), width)[order]


def _best(book: Codebook, index, asked: pa.RecordBatch, width: int, k: int, rerank: int, schema: pa.Schema):
    """The k + 1 nearest vectors of a bin for each query among those of the cells it visits."""
    uid, near, flat, v = index
    q = _matrix(asked.column("v"), width)
    out = []
    for query, x, visited in zip(asked.column("id").to_pylist(), q, asked.column("visited").to_pylist()):
        best = np.concatenate([np.arange(i, j) for i, j in zip(np.searchsorted(near, visited), np.searchsorted(near, visited, side="right"))])
        if len(best) > rerank:
            # residuals' products from the tables, and that of the list's centroid
            estimate = book.tables(x).reshape(-1)[flat[best]].sum(axis=1) + (book.coarse @ x)[near[best] // MAX_FINE]
            best = best[np.argpartition(-estimate, rerank)[:rerank]]
        score = v[best] @ x
        top = np.lexsort((uid[best], -score))[: k + 1]
        out.append((np.full(len(top), query), uid[best[top]], score[top]))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest of each row for which ``is_query`` (a condition on the column id) holds: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    _shared.tune(spark)
    rows = usable(vectors, id_col, vector_col)
    # at most k + 1 ids of a vector leave a task
    ranked = rows.distinct().withColumn("i", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("i") <= k + 1)
    entries = ranked.groupBy("v").agg(F.min("id").alias("uid"), F.sort_array(F.collect_list("id")).alias("ids"))
    entries = _shared.settle(entries, "vectors")
    n = entries.count()
    result = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], result)
    sample = entries.where(F.pmod(F.xxhash64("uid"), F.lit(1 << 30)) < int(min(1, FIT_ROWS / n) * (1 << 30)) + 1).select("uid", "v").toArrow()
    if not len(sample):
        sample = entries.limit(1).select("uid", "v").toArrow()
    width = len(sample["v"][0])
    matrix = _matrix(sample["v"].combine_chunks(), width)
    lists = int(np.clip(np.sqrt(n), 1, min(MAX_LISTS, max(1, len(matrix) // 8))))
    fitted = Codebook(matrix, lists)
    book = spark.sparkContext.broadcast(fitted)  # MAX_LISTS and CODES bound its size

    def index(batches):
        for batch in batches:
            if len(batch):
                near, codes = book.value.encode(_matrix(batch.column(1), width))
                yield pa.RecordBatch.from_arrays([pa.array(near), batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary()), batch.column(1)], names=["list", "uid", "code", "v"])

    indexed = _shared.settle(entries.select("uid", "v").mapInArrow(index, "list long, uid long, code binary, v array<double>"), "ivf")
    # one row a list: at most MAX_LISTS
    sizes = {r["list"]: r["n"] for r in indexed.groupBy("list").agg(F.count("*").alias("n")).collect()}
    cells = {i: int(np.clip(sizes.get(i, 0) // FINE, 1, MAX_FINE)) for i in range(lists)}
    cut = {i: c for i, c in cells.items() if c > 1}
    of_list = lambda values: F.element_at(F.array(*[F.lit(values[i]) for i in range(lists)]), F.col("list").cast("int") + 1)
    first_cell = F.col("list") * MAX_FINE
    indexed = indexed.withColumn("cell", first_cell)
    centroids = None
    if cut:
        share = of_list({i: min(1.0, FINE_FIT * cells[i] / max(1, sizes.get(i, 0))) if i in cut else 0.0 for i in range(lists)})
        some = indexed.where(F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(1 << 30)) < share * (1 << 30)).select("list", "v")

        def fit(table: pa.Table) -> pa.Table:
            number = table["list"][0].as_py()
            c = _kmeans(_matrix(table["v"].combine_chunks(), width), cut[number], number)
            c = np.unique(c, axis=0)  # a sample of few vectors repeats them
            return pa.table({"list": np.full(len(c), number), "cell": number * MAX_FINE + np.arange(len(c)), "v": pa.array(list(c), pa.list_(pa.float64()))})

        fine = _shared.settle(some.groupBy("list").applyInArrow(fit, "list long, cell long, v array<double>"), "centroids")
        # a list none of whose vectors were drawn stays whole; one row a list
        drawn = {r["list"] for r in fine.select("list").distinct().collect()}
        cut = {i: c for i, c in cut.items() if i in drawn}
        cells = {i: cut.get(i, 1) for i in range(lists)}
        shelf_of, total = {}, 0
        for i in range(lists):
            shelf_of[i], total = total // SHELF, total + cells[i]
        whole = spark.createDataFrame([(i, i * MAX_FINE, fitted.coarse[i].tolist()) for i in range(lists) if i not in cut], "list long, cell long, v array<double>")
        centroids = fine.unionByName(whole).select(of_list(shelf_of).alias("shelf"), "cell", "v")

        def assign(cell, c, part):
            x, number = _matrix(part.column("v"), width), part.column("list").to_numpy()
            its, (here, which) = np.empty(len(x), np.int64), np.unique(number, return_inverse=True)
            for i, (a, b) in enumerate(_spans(cell, here)):
                at = np.flatnonzero(which == i)
                its[at] = cell[a + ((c[a:b] ** 2).sum(1) - 2 * (x[at] @ c[a:b].T)).argmin(1)]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(its)], names=["id", "its"])

        filled = {}
        for i in cut:
            filled[shelf_of[i]] = filled.get(shelf_of[i], 0) + sizes[i]
        parts = F.element_at(F.array(*[F.lit(max(1, -(-filled.get(i, 0) // (4 * BLOCK)))) for i in range(shelf_of[lists - 1] + 1)]), F.col("shelf") + 1)
        long_ones = indexed.where(F.col("list").isin(list(cut))).select(of_list(shelf_of).alias("shelf"), F.col("uid").alias("id"), "list", F.lit(None).cast("array<long>").alias("lists"), "v")
        its = by_shelf(centroids, long_ones, parts, assign, "id long, its long")
        indexed = _shared.settle(indexed.join(its, F.col("uid") == F.col("id"), "left").withColumn("cell", F.coalesce("its", "cell")).drop("id", "its"), "cells")

    # neighbouring cells of a list lie in one bin; a list's bins are cut alike, by the fullest
    together = max(1, CHUNK // FINE)
    slot = F.floor((F.col("cell") - first_cell) / together)
    fullest = {r["list"]: r["n"] for r in indexed.groupBy("list", slot.alias("slot")).agg(F.count("*").alias("n")).groupBy("list").agg(F.max("n").alias("n")).collect()}
    bins, pieces, filled = {}, {}, 0
    used = 0
    for number in range(lists):
        size = fullest.get(number, 0)
        pieces[number] = max(1, -(-size // CHUNK))
        if number in cut:
            bins[number] = used + (filled > 0)
            used, filled = bins[number] + -(-cells[number] // together) * pieces[number], 0
            continue
        if filled + size > CHUNK and filled:
            used, filled = used + 1, 0
        bins[number] = used
        filled += size
        if pieces[number] > 1:
            used, filled = used + pieces[number], 0
    piece_of, bin_of = of_list(pieces), of_list(bins)
    stored = indexed.withColumn("bin", (bin_of + slot * piece_of + F.pmod(F.xxhash64("uid"), piece_of)).cast("int"))

    some = np.unique(np.linspace(0, len(matrix) - 1, min(ASKED, len(matrix))).astype(int))
    asked_uid, asked_v = sample["uid"].to_numpy()[some], matrix[some]
    targets = true_cells(indexed, asked_uid, asked_v, k)
    order = np.argsort(np.argsort(-(asked_v @ fitted.coarse.T), axis=1, kind="stable"), axis=1)
    probes = enough(np.array([order[a, c // MAX_FINE] for a, c in targets], int))

    def near_lists(batches):
        for batch in batches:
            if len(batch):
                best = np.argsort(-(_matrix(batch.column(1), width) @ book.value.coarse.T), axis=1, kind="stable")[:, :probes]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(best.astype(np.int64)), pa.list_(pa.int64()))], names=["id", "v", "lists"])

    def best_cells(asking: DataFrame, n: int, most: int | None) -> DataFrame:
        """(id, cell, rank from 1) of the cells in the visited lists of n queries (id, v), best first: all, or the first ``most``."""
        visited = asking.mapInArrow(near_lists, "id long, v array<double>, lists array<long>")
        shelves = F.array(*[F.lit(shelf_of[i]) for i in range(lists)])
        on_shelf = lambda x: F.element_at(shelves, x.cast("int") + 1)
        sent = visited.withColumn("shelf", F.explode(F.array_distinct(F.transform("lists", on_shelf))))
        sent = sent.select("shelf", "id", F.lit(None).cast("long").alias("list"), F.filter("lists", lambda x: on_shelf(x) == F.col("shelf")).alias("lists"), "v")

        def rank(cell, c, part):
            out = []
            for i, x, visited in zip(part.column("id").to_pylist(), _matrix(part.column("v"), width), part.column("lists").to_pylist()):
                at = np.concatenate([np.arange(a, b) for a, b in _spans(cell, visited)])
                score = c[at] @ x
                top = np.lexsort((at, -score))[:most]
                out.append((np.full(len(top), i), cell[at[top]], score[top]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["id", "cell", "score"])

        every = by_shelf(centroids, sent, F.lit(max(1, -(-n // CHUNK))), rank, "id long, cell long, score double")
        ranked = every.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "cell")))
        return ranked.select("id", "cell", "rank") if most is None else ranked.where(F.col("rank") <= most).select("id", "cell")

    most = probes
    if cut:
        trial = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked_v)], "id long, v array<double>")
        wanted = spark.createDataFrame(targets, "id long, cell long")  # ASKED * k rows
        most = enough(np.array([r["rank"] - 1 for r in best_cells(trial, len(asked_v), None).join(F.broadcast(wanted), ["id", "cell"]).select("rank").collect()], int))
    asked = rows.where(is_query).select("id", "v").distinct()
    asked = _shared.settle(asked.join(entries.select("v", "uid"), "v").select("id", "uid"), "asked")
    queries = asked.select("uid").distinct().join(entries.select("uid", "v"), "uid")

    if cut:
        chosen = best_cells(queries.select(F.col("uid").alias("id"), "v"), queries.count(), most).groupBy("id").agg(F.collect_list("cell").alias("cells"))
        aimed = queries.join(chosen, F.col("uid") == F.col("id")).select("uid", "v", "cells")
    else:
        aimed = queries.select("uid", "v").mapInArrow(near_lists, "id long, v array<double>, lists array<long>").select(F.col("id").alias("uid"), "v", F.transform("lists", lambda x: x * MAX_FINE).alias("cells"))

    def deal(batches):
        begin, many = (np.array([x[i] for i in range(lists)]) for x in (bins, pieces))
        for batch in batches:
            rows = []
            for i, visited in enumerate(batch.column(2).to_pylist()):
                visited = np.sort(np.array(visited, np.int64))
                number = visited // MAX_FINE
                first = begin[number] + visited % MAX_FINE // together * many[number]
                for start in np.unique(first).tolist():
                    at = first == start
                    here, cut_in = visited[at], many[number[at]]
                    rows += [(start + more, i, here[cut_in > more].tolist()) for more in range(cut_in.max())]
            if rows:
                at, which, visited = zip(*rows)
                which = pa.array(which)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column(0).take(which), batch.column(1).take(which), pa.array(visited, pa.list_(pa.int64()))], names=["bin", "query", "q", "visited"])

    visits = _shared.settle(aimed.mapInArrow(deal, "bin int, query long, q array<double>, visited array<long>"), "visits")
    blocks = visits.groupBy("bin").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    null = F.lit(None)
    copies = stored.join(blocks, "bin").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asking = visits.join(blocks, "bin").withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int"))
    rows = copies.select("bin", "block", F.lit(0).alias("kind"), F.col("uid").alias("id"), "cell", "code", "v", null.cast("array<long>").alias("visited")).unionByName(
        asking.select("bin", "block", F.lit(1).alias("kind"), F.col("query").alias("id"), null.cast("long").alias("cell"), null.cast("binary").alias("code"), F.col("q").alias("v"), "visited")
    )
    schema = pa.schema([("query", pa.int64()), ("uid", pa.int64()), ("score", pa.float64())])

    rerank = RERANK

    def search(batches):
        held, now, index = [], None, None
        for batch in batches:
            if not len(batch):
                continue
            where = batch.column(0).to_numpy().astype(np.int64) << 32 | batch.column(1).to_numpy()
            kind = batch.column(2).to_numpy()
            cuts = np.flatnonzero((np.diff(where) != 0) | (np.diff(kind) != 0)) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
                part = batch.slice(i, j - i)
                if where[i] != now:
                    held, now, index = [], where[i], None
                if kind[i] == 0:
                    held.append(part)
                    continue
                if index is None and not held:
                    continue  # no vector lies in these cells
                if index is None:
                    index, held = _bin(pa.Table.from_batches(held).combine_chunks(), width), []
                yield from _best(book.value, index, part, width, k, rerank, schema)

    found = rows.repartition("bin", "block").sortWithinPartitions("bin", "block", "kind").mapInArrow(search, "query long, uid long, score double")
    top = found.withColumn("i", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "uid"))).where(F.col("i") <= k + 1)
    # the ids of the k + 1 nearest entries, the best k + 1 of them: at most (k + 1)**2 a query before the cut
    listed = top.join(entries.select("uid", "ids"), "uid").groupBy("query").agg(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("s"), i.alias("i"))))).alias("near"))
    listed = listed.select(F.col("query").alias("uid"), F.slice(F.array_sort("near"), 1, k + 1).alias("near"))
    own = F.slice(F.filter("near", lambda x: x["i"] != F.col("id")), 1, k)
    out = asked.join(listed, "uid").select(F.col("id").alias("query_id"), F.posexplode(own).alias("rank", "x"))
    return out.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.i").alias("vec_id"), (-F.col("x.s")).alias("score"))


#: The exact search in DuckDB, to hold recall against; not the approximate result.
EXACT_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT * FROM (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s) WHERE rank <= 20
"""
