"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct shingles (``words`` consecutive words after lower-casing A-Z; words end at white space; a shorter
text is one shingle). Documents with equal sets form a class, and only classes take part. Independent trees branch the classes: a node
selects tokens of the minwise signature, ``branching`` of them in the mean, and each class goes on to the child of its token, for each
selection. A class so has slightly more than 1 / threshold children, and classes of similarity s share s times as many: pairs well below
the threshold die out from level to level, pairs above it live on. ``trees_for`` gives the trees that meet the target recall.

* First a node of at most ``SMALL`` classes gives the pairs of a maximum spanning tree by equal tokens. A larger one does so for each of
  its pieces, which all hold the node's leader, too: the class that shares most tokens with others.
* Confirmed links are contracted after each step: a class has its component as label, and pairs of one label are not looked at again. A
  node with one label ends.
* Small nodes are then compared exhaustively, by signatures: those of at most ``SMALL`` classes, and those with at most ``WORK`` pairs
  between a class outside the node's main label and any class, which are dealt in blocks. A pair that meets in several first-level nodes
  is taken in the first of them, and not again further down.
* Any other node branches again.

Pairs with fewer than ``agree_for`` of ``TOKENS`` equal tokens go (a pair at the threshold does so with probability ``MISS``), and so do
pairs of too unlike sizes or sketches: a set's sketch has the parity of its shingles in each of ``BUCKETS`` buckets, so two sketches differ
in at most as many buckets as their sets differ in shingles, and no link is lost. The others are confirmed on full sets: 100 * intersection >= percent * union. The sets are sent once to each node (or piece) that has pairs to
confirm, not once a pair, and within a node a pair that earlier links connect is not tested. No pair of equal sets is ever listed, and
every group that meets in a task has about 4 ``SMALL`` classes at most.

Null and empty texts have no shingles and link with nothing. A row with a null ``doc_id`` takes no part: its component is null and it is
kept. Rows with equal ``doc_id`` and equal sets are one class, and all are kept if one is; rows of one ``doc_id`` with different texts are
different classes. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm import _graph, _shared, _text

WORDS, PERCENT = 5, 75
#: A pair at the threshold meets in a small node with this probability if that node lies ``DEPTH`` levels deep; more if it is less deep.
RECALL, DEPTH = 0.999, 8
#: The branching is that of a pair this much below the threshold which neither dies out nor grows.
BELOW = 0.05
TOKENS = 64
BUCKETS = 1024
#: The probability that a pair at the threshold has too few equal tokens to be confirmed.
MISS = 1e-6
SMALL, WORK = 256, 1 << 21

#: Values by which rows are kept or left before a join moves them: as many longs at most are sent to all tasks.
KEPT = 1 << 21

_A = np.random.default_rng(5).integers(1, 2**63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Rows of signatures that a task handles at once.
_ROWS = 20_000


def branching(percent: int = PERCENT) -> float:
    """Children that a class has in the mean."""
    return 1 / max(percent / 100 - BELOW, 0.1)


def trees_for(recall: float, percent: int = PERCENT, depth: int = DEPTH) -> int:
    """Trees after which a pair at the threshold has met with this probability in a node ``depth`` levels deep. An error where the
    signature has too few tokens for their roots."""
    s, b, q = percent / 100, branching(percent), 0.0
    whole, part = int(b), b - int(b)
    for _ in range(depth):  # q: one tree misses the pair
        one = 1 - s + s * q
        q = one**whole * (1 - part + part * one)
    trees = math.ceil(math.log(1 - recall) / math.log(q)) if 0 < q < 1 and recall < 1 else 1 if q == 0 else math.inf
    if trees * b > TOKENS:
        raise ValueError(f"a recall of {recall} at {percent} % needs {trees} trees; {TOKENS} tokens give {int(TOKENS / b)}")
    return trees


def agree_for(percent: int = PERCENT) -> int:
    """The most equal tokens to ask for such that a pair at the threshold has fewer with probability ``MISS`` at most."""
    s, lost, agree = percent / 100, 0.0, 0
    while agree < TOKENS:
        lost += math.comb(TOKENS, agree) * s**agree * (1 - s) ** (TOKENS - agree)
        if lost > MISS:
            break
        agree += 1
    return agree


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct shingles."""
    data, offsets = _text.pack(texts)
    _, _, h, at = _text.words(_text.LOWER[data], offsets, _text.NOT_SPACE)
    all_grams = _text.grams(h, words)
    out = []
    for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
        if j - i >= words:
            out.append(np.unique(all_grams[i : j - words + 1]))
        elif j > i:
            out.append(_text.mix(np.array([(h[i:j] * _text.PLACES[32 : 32 + j - i]).sum() + np.uint64(j - i)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def pack_set(hashes: np.ndarray) -> bytes:
    """A set's sorted hashes, cut to 56 bits, as the byte planes of their differences: the upper planes are nearly all zero and compress away.
    Two of a set's hashes may become equal (with probability size^2 / 2^57); both stay, so sizes are those of the set."""
    cut = hashes >> np.uint64(8)
    return np.diff(cut, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_set(packed: np.ndarray) -> np.ndarray:
    """The hashes, of 56 bits, in order."""
    return np.cumsum(np.ascontiguousarray(packed.reshape(8, -1).T).view("<u8").reshape(-1), dtype=np.uint64)


def _set_hash(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit values of each set, which tell sets apart; zeros of an empty one."""
    size = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(size)
    c1, c2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
    if len(full):
        flat, start = np.concatenate(sets), (np.cumsum(size) - size)[full]
        c1[full] = np.add.reduceat(_text.mix(flat), start)
        c2[full] = np.add.reduceat(_text.mix(flat ^ np.uint64(0x5DEECE66D)), start)
    return c1.view(np.int64), c2.view(np.int64)


def signatures(docs: DataFrame, words: int = WORDS, selected: int = TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, th (hash of the text), n (set size), c1 and c2 (hash of the set), roots (those minwise tokens of 32 bits that
    the roots select) and sig (the low halves of all TOKENS ones, which is what moves with a class, then the sketch of parities)."""

    def task(batches):
        for batch in batches:
            sets = shingle_sets(batch.column(2), words)
            size = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(size)
            flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
            start = (np.cumsum(size) - size)[full]
            sig = np.zeros((len(sets), TOKENS), np.uint32)
            for k in range(TOKENS if len(full) else 0):
                sig[full, k] = np.minimum.reduceat(((flat * _A[k]) >> np.uint64(32)).astype(np.uint32), start)
            c1, c2 = _set_hash(sets)
            place = np.repeat(np.arange(len(sets)) * BUCKETS, size) + (_text.mix(flat) % np.uint64(BUCKETS)).astype(np.int64)
            odd = np.packbits(np.bincount(place, minlength=len(sets) * BUCKETS).reshape(-1, BUCKETS) & 1, axis=1)
            roots = [s.tobytes() for s in sig[:, :selected]]
            sketch = [s.tobytes() + o.tobytes() for s, o in zip(sig.astype(np.uint16), odd)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size), pa.array(c1), pa.array(c2), pa.array(roots, pa.binary()), pa.array(sketch, pa.binary())], names=["doc_id", "th", "n", "c1", "c2", "roots", "sig"])

    _shared.tune(docs.sparkSession)
    return _texts(docs, id_col, text_col).mapInArrow(task, "doc_id long, th long, n long, c1 long, c2 long, roots binary, sig binary")


def _only(df: DataFrame, wanted: DataFrame, *by: str) -> DataFrame:
    """The rows of ``df`` that may have one of ``wanted``'s values in the columns ``by``: rows that surely don't are not moved."""
    key = F.pmod(F.xxhash64(*by), F.lit(KEPT)).alias("kept")
    return df.withColumn("kept", key).join(F.broadcast(wanted.select(key).distinct()), "kept", "left_semi").drop("kept")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("t"))


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The tokens (rows, TOKENS) and the sketches (rows, BUCKETS / 64) of a column of signatures."""
    if not len(column):
        return np.zeros((0, TOKENS), np.uint16), np.zeros((0, BUCKETS // 64), np.uint64)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(len(column), -1)
    return np.ascontiguousarray(raw[:, : 2 * TOKENS]).view(np.uint16), np.ascontiguousarray(raw[:, 2 * TOKENS :]).view(np.uint64)


def can_link(n: np.ndarray, odd: np.ndarray, i, rows, percent: int) -> np.ndarray:
    """Whether sizes and sketches of row(s) ``i`` and of ``rows`` let their sets be similar enough."""
    total, least = n[rows] + n[i], np.minimum(n[rows], n[i])
    apart = np.bitwise_count(odd[rows] ^ odd[i]).sum(axis=1, dtype=np.int64)
    return ((100 + percent) * apart <= (100 - percent) * total) & (100 * least >= percent * (total - least))


def _groups(batches, rows: int = _ROWS):
    """Tables of about so many rows from batches in the order of their column key: no key is in two of them."""
    held, n = [], 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        n += len(batch)
        if n < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column("key").to_numpy()
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if cut:
            yield table.slice(0, cut)
        held, n = table.slice(cut).to_batches(), len(table) - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def roots_for(recall: float, percent: int) -> int:
    """Tokens that the roots of all trees select."""
    return round(trees_for(recall, percent) * branching(percent))


def _roots(classes: DataFrame, selected: int) -> DataFrame:
    """The first nodes (node, used, class, label): each root selects its own tokens."""
    def task(batches):
        for batch in batches:
            if not len(batch):
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(len(batch), -1)
            for k in range(selected):
                child = _text.mix(np.full(len(sig), 1000 + k, np.uint64) * _text.PLACES[1] + sig[:, k].astype(np.uint64) * _text.PLACES[2])
                used = np.full(len(sig), np.uint64(1) << np.uint64(k))
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(used.view(np.int64)), batch.column(0), batch.column(0)], names=["node", "used", "class", "label"])

    return classes.select("class", "roots").mapInArrow(task, "node long, used long, class long, label long")


def _children(node: np.ndarray, used: np.ndarray, sig: np.ndarray, percent: int):
    """For each selection of the nodes: the rows that have it, their child's id and the tokens used on its path (one bit each)."""
    b = branching(percent)
    taken = used.copy()
    for j in range(math.ceil(b)):
        rows = np.arange(len(node))
        if j + 1 > b:  # a share of the nodes selects one more token
            rows = rows[_text.mix(node + np.uint64(40_009)) < np.uint64((b - j) * 2.0**64)]
        free = (taken[rows, None] >> np.arange(TOKENS, dtype=np.uint64)) & np.uint64(1) == 0
        rows, free = rows[free.any(axis=1)], free[free.any(axis=1)]
        # the tokens not used yet, in a node's own order
        order = _text.mix((node[rows] + np.uint64(j * 7919 + 1))[:, None] * _text.PLACES[3] + np.arange(TOKENS, dtype=np.uint64) * _text.PLACES[4])
        pick = np.where(free, order, np.uint64(2**64 - 1)).argmin(axis=1)
        bit = np.uint64(1) << pick.astype(np.uint64)
        taken[rows] |= bit
        token = sig[rows, pick].astype(np.uint64)
        yield rows, _text.mix(node[rows] * _text.PLACES[0] + pick.astype(np.uint64) * _text.PLACES[1] + token * _text.PLACES[2]), used[rows] | bit


def _branch(members: DataFrame, percent: int) -> DataFrame:
    """Rows (node, used, class, label) of the children of rows (node, used, class, label, sig)."""

    def task(batches):
        for batch in batches:
            if not len(batch):
                continue
            node, used = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy().view(np.uint64)
            for rows, child, path in _children(node, used, _matrix(batch.column(4))[0], percent):
                rows = pa.array(rows)
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(path.view(np.int64)), batch.column(2).take(rows), batch.column(3).take(rows)], names=["node", "used", "class", "label"])

    return members.select("node", "used", "class", "label", "sig").mapInArrow(task, "node long, used long, class long, label long")


def spanning(sig: np.ndarray, label: np.ndarray, agree: int, fits) -> tuple[list[tuple[int, int, int]], bool]:
    """A maximum spanning tree of a group by equal tokens, as (row, row, equal tokens) without pairs of one label, those of too few equal
    tokens and those for which ``fits(row, rows)`` is false; and whether the group has more such pairs."""
    m = len(sig)
    done = np.zeros(m, bool)
    best, parent = np.full(m, -1), np.zeros(m, np.int64)
    k, tree, all_pairs = 0, [], 0
    for _ in range(m):
        done[k] = True
        equal = (sig == sig[k]).sum(axis=1)
        one = label == label[k]
        near = np.flatnonzero((equal >= agree) & ~one & ~done)
        if len(near):
            fit = fits(k, near)
            all_pairs += int(fit.sum())
            equal[near[~fit]] = agree - 1
        equal[one] = TOKENS + 1  # connected already
        better = equal > best
        best[better], parent[better] = equal[better], k
        k = int(np.where(done, -1, best).argmax())
        if not done[k] and agree <= best[k] <= TOKENS:
            tree.append((int(parent[k]), k, int(best[k])))
    return tree, all_pairs > len(tree)


def exhaustive(sig: np.ndarray, label: np.ndarray, side: np.ndarray, used: int, mask: np.ndarray, agree: int, fits) -> list[tuple[int, int, int]]:
    """The pairs of a group with different labels, enough equal tokens and ``fits(row, rows)``: those across its two sides, or all if it has one. ``mask`` has a
    bit for each root whose node compares the class exhaustively: pairs that meet there are left out, but for a group below the single root
    ``used`` itself and roots after it (0: a group further down)."""
    before = np.uint64((used - 1) % 2**64)
    first = np.flatnonzero(side == 0)
    other = np.flatnonzero(side == 1)
    within = not len(first) or not len(other)
    out = []
    for n, i in enumerate(first.tolist() if len(first) else other.tolist()):
        rows = (first if len(first) else other)[n + 1 :] if within else other
        rows = rows[label[rows] != label[i]]
        if not len(rows):
            continue
        same = sig[rows] == sig[i]
        equal = same.sum(axis=1)
        rows, same, equal = rows[equal >= agree], same[equal >= agree], equal[equal >= agree]
        if len(rows):
            met = np.packbits(same, axis=1, bitorder="little").view(np.uint64).reshape(-1) & mask[i] & before
            rows, equal = rows[met == 0], equal[met == 0]
            fit = fits(i, rows)
            out += [(i, int(k), int(n_equal)) for k, n_equal in zip(rows[fit], equal[fit])]
    return out


_PAIRS = pa.schema([("key", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("la", pa.int64()), ("lb", pa.int64()), ("agree", pa.int32())])


def _compare(groups: DataFrame, percent: int, whole: bool) -> DataFrame:
    """Candidates (key, a, b, la, lb, agree) in groups of rows (key, class, label, n, sig): those of spanning trees and a row with null
    classes for each group that has more; or all of them (``whole``; then rows have the columns side, used and mask, too)."""

    agree = agree_for(percent)

    def task(batches):
        for table in _groups(batches):
            key, cls, label, n = (table.column(c).to_numpy() for c in ("key", "class", "label", "n"))
            sig, odd = _matrix(table.column("sig").chunk(0))
            if whole:
                side, used, mask = (table.column(c).to_numpy() for c in ("side", "used", "mask"))
                mask = mask.view(np.uint64)
            edge = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
            ends = np.append(edge[1:], len(key))
            two = (ends - edge == 2) & (not whole)
            i = edge[two]
            equal = (sig[i] == sig[i + 1]).sum(axis=1)
            keep = (equal >= agree) & (label[i] != label[i + 1]) & can_link(n, odd, i, i + 1, percent)
            i = i[keep]
            out = [(key[i], cls[i], cls[i + 1], label[i], label[i + 1], equal[keep])]
            more = []
            for i, j in zip(edge[~two].tolist(), ends[~two].tolist()):
                if j - i > 1:
                    fits = lambda k, rows, n=n[i:j], odd=odd[i:j]: can_link(n, odd, k, rows, percent)
                    found, rest = (exhaustive(sig[i:j], label[i:j], side[i:j], int(used[i]), mask[i:j], agree, fits), False) if whole else spanning(sig[i:j], label[i:j], agree, fits)
                    if found:
                        x, y, equal = np.array(found, np.int64).T
                        out.append((key[i + x], cls[i + x], cls[i + y], label[i + x], label[i + y], equal))
                    if rest:
                        more.append(int(key[i]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int32 if k == 5 else np.int64)) for k, c in enumerate(zip(*out))], schema=_PAIRS)
            if more:
                yield pa.RecordBatch.from_arrays([pa.array(more, pa.int64()), *(pa.nulls(len(more), f.type) for f in list(_PAIRS)[1:])], schema=_PAIRS)

    names = ["key", "class", "label", "n", "sig", *(["side", "used", "mask"] if whole else [])]
    dealt = groups.select(*names).repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(task, "key long, a long, b long, la long, lb long, agree int")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between labels: of the pairs (key, a, b, la, lb, agree), each in one group, those whose full sets (class, shingles) are
    similar enough. A group's sets come once, before its pairs; these come with the most alike first, and those that links of the group
    connect already go untested."""

    def task(batches):
        now, sets, up = None, {}, {}

        def top(x):
            while up.get(x, x) != x:
                up[x] = x = up.get(up[x], up[x])
            return x

        for batch in batches:
            found = []
            for i, (key, a, b, la, lb) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(5)))):
                if key != now:
                    now, sets, up = key, {}, {}
                if b is None:
                    sets[a] = unpack_set(np.frombuffer(batch.column(6)[i].as_buffer(), np.uint8))
                    continue
                p, q = top(la), top(lb)
                if p == q:
                    continue
                x, y = sorted((sets[a], sets[b]), key=len)
                if 100 * len(x) < percent * len(y):
                    continue
                at = np.searchsorted(y, x)
                shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    up[p] = q
                    found.append((la, lb))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    needs = pairs.select("key", F.col("a").alias("class")).unionByName(pairs.select("key", F.col("b").alias("class"))).distinct()
    null = F.lit(None)
    rows = pairs.select("key", "a", "b", "la", "lb", (-F.col("agree")).alias("o"), null.cast("binary").alias("s")).unionByName(
        needs.join(_only(sets, needs, "class"), "class").select("key", F.col("class").alias("a"), *(null.cast("long").alias(c) for c in ("b", "la", "lb")), F.lit(-TOKENS - 1).alias("o"), F.col("shingles").alias("s"))
    )
    return rows.repartition("key").sortWithinPartitions("key", "o").mapInArrow(task, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(class, shingles) of the classes (class, doc_id, th, c1, c2) that are wanted; only the text of one of a class's documents is read."""

    def task(batches):
        for batch in batches:
            sets = shingle_sets(batch.column(3), words)
            c1, c2 = _set_hash(sets)
            own = (c1 == batch.column(1).to_numpy()) & (c2 == batch.column(2).to_numpy())
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array([pack_set(sets[i]) for i in at], pa.binary())], names=["class", "shingles"])

    texts = _only(_texts(docs, id_col, text_col).where("doc_id is not null"), wanted, "doc_id", "th")
    return wanted.select("class", "doc_id", "th", "c1", "c2").join(texts, ["doc_id", "th"]).select("class", "c1", "c2", "t").mapInArrow(task, "class long, shingles binary")


def _merge(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (class, root) after new links between labels."""
    roots = _graph.components(links)
    if labels is None:
        return roots.withColumnRenamed("node", "class")
    known = labels.join(roots.select(F.col("node").alias("root"), F.col("root").alias("new")), "root", "left").select("class", F.coalesce("new", "root").alias("root"))
    fresh = roots.withColumnRenamed("node", "class").join(labels.select("class"), "class", "left_anti")
    out = _shared.settle(known.unionByName(fresh), "labels")
    _shared.unsettle(roots, labels)
    return out


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows with a column class, with their label as it is now."""
    members = members.drop("label")
    if labels is None:
        return members.withColumn("label", F.col("class"))
    return members.join(labels, "class", "left").withColumn("label", F.coalesce("root", "class")).drop("root")


def _once(pairs: DataFrame) -> DataFrame:
    """Each pair once, in one of the groups that have it."""
    pairs = pairs.where("a is not null").select("key", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(F.col("a") < F.col("b"), F.col("la")).otherwise(F.col("lb")).alias("la"), F.when(F.col("a") < F.col("b"), F.col("lb")).otherwise(F.col("la")).alias("lb"), "agree")
    return pairs.groupBy("a", "b").agg(*(F.min(c).alias(c) for c in ("key", "la", "lb", "agree"))).select("key", "a", "b", "la", "lb", "agree")


def _pieces(large: DataFrame) -> DataFrame:
    """Rows (key, class, label) of pieces of large nodes, each with the node's leader."""
    weight = large.groupBy("class").agg(F.sum("size").alias("weight"))
    count = F.ceil(F.col("size") / (SMALL // 2)).cast("int")
    lead = large.join(weight, "class").groupBy("node").agg(F.max(F.struct("weight", "class", "label", "size")).alias("m")).select("node", "m.*")
    lead = lead.select("node", "class", "label", F.explode(F.sequence(F.lit(0), count - 1)).alias("piece"))
    dealt = large.select("node", "class", "label", F.pmod(F.xxhash64("class", "node"), count).cast("int").alias("piece"))
    return dealt.unionByName(lead).select(F.xxhash64("node", "piece").alias("key"), "class", "label").distinct()


def _blocks(nodes: DataFrame) -> DataFrame:
    """Rows (key, side) for the blocks of nodes (node, class, label, main, others, size) that compare classes outside the main label with
    all: these classes are dealt to the first chunks, the others to chunks behind them, and each first chunk meets itself and all later ones."""
    chunks = lambda n: F.greatest(F.lit(1), F.ceil(n / (2 * SMALL))).cast("int")
    rows = nodes.withColumns({"po": chunks(F.col("others")), "pm": chunks(F.col("size") - F.col("others"))})
    dealt = lambda n: F.pmod(F.xxhash64("class", "node"), F.col(n)).cast("int")
    rows = rows.withColumn("c", F.when(F.col("label") == F.col("main"), F.col("po") + dealt("pm")).otherwise(dealt("po")))
    block = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    behind = F.filter(F.sequence(F.lit(0), F.col("po") - 1), lambda i: i < F.col("c"))
    ahead = F.filter(F.sequence(F.lit(0), F.col("po") + F.col("pm") - 1), lambda j: (F.col("c") < F.col("po")) & (j >= F.col("c")))
    at = F.concat(F.transform(behind, lambda i: block(i, F.col("c"), 1)), F.transform(ahead, lambda j: block(F.col("c"), j, 0)))
    rows = rows.withColumn("at", F.explode(at))
    return rows.withColumns({"key": F.xxhash64("node", "at.i", "at.j"), "side": F.col("at.side")})


def similar_classes(docs: DataFrame, classes: DataFrame, percent: int = PERCENT, words: int = WORDS, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame | None:
    """(class, root) of all classes (class, doc_id, th, n, c1, c2, roots, sig) that have a link, root being the smallest class of the component;
    none if no class has one."""
    sigs = classes.select("class", "n", "sig")
    members, labels, sets, masks, below, level = _roots(classes, roots_for(recall, percent)), None, None, None, None, 0
    while True:
        sizes = members.groupBy("node").agg(F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("node", "size")
        nodes = _shared.settle(members.join(sizes, "node"), "nodes")
        if nodes.isEmpty():
            break
        small, large = nodes.where(F.col("size") <= SMALL), nodes.where(F.col("size") > SMALL)
        trees = small.select(F.col("node").alias("key"), "class", "label").unionByName(_pieces(large))
        found = _shared.settle(_compare(trees.join(sigs, "class"), percent, whole=False), "candidates")
        pairs = _shared.settle(_once(found), "pairs")
        if sets is None:
            # of the classes that have pairs, or that may have one in a node further down
            may = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).unionByName(large.select("class")).distinct()
            wanted = _shared.settle(classes.select("class", "doc_id", "th", "c1", "c2").join(may, "class", "left_semi"), "wanted")
            sets = _shared.settle(_sets(docs, wanted, words, id_col, text_col), "shingles")
            _shared.unsettle(wanted)
            if sets.count() != sets.select("class").distinct().count():  # equal rows of the table
                sets = _shared.settle(sets.dropDuplicates(["class"]), "shingles")
        labels = _linked(labels, pairs, sets, percent)
        # the nodes that are compared now: small ones that have more pairs, and blocks of larger ones
        counts = _labelled(large, labels).groupBy("node", "label").agg(F.count("*").alias("k"))
        counts = counts.groupBy("node").agg(F.max(F.struct("k", "label")).alias("m"), F.sum("k").alias("size")).select("node", F.col("m.label").alias("main"), (F.col("size") - F.col("m.k")).alias("others"))
        left = _shared.settle(_labelled(large.join(counts.where("others > 0"), "node"), labels), "large")
        last = (F.col("others") * F.col("size") <= WORK) | (F.bit_count("used") == TOKENS)
        few = left.where(last)
        if masks is None:
            compared = small.select("class", "used").unionByName(few.select("class", "used"))
            masks = _shared.settle(compared.groupBy("class").agg(F.bit_or("used").alias("mask")), "masks")
        more = _labelled(small.join(found.where("a is null").select(F.col("key").alias("node")), "node", "left_semi"), labels)
        names = ["key", "class", "label", "side", F.lit(0).alias("used") if level else "used", F.coalesce("mask", F.lit(0)).alias("mask"), "n", "sig"]
        now = _only(sigs, more.select("class").unionByName(few.select("class")), "class")
        known = lambda df: df.join(masks, "class", "left").join(now, "class")
        rest = known(more.withColumns({"key": F.col("node"), "side": F.lit(0)})).select(*names).unionByName(_blocks(known(few)).select(*names))
        more_pairs = _shared.settle(_once(_compare(rest, percent, whole=True)), "pairs")
        labels = _linked(labels, more_pairs, sets, percent)
        ended = left.where(~last).isEmpty()
        members = None if ended else _shared.settle(_labelled(_branch(left.where(~last).join(sigs, "class"), percent), labels), "members")
        if not ended and not level:  # further down are only classes of large nodes
            down = left.where(~last).select("class").distinct()
            sigs = below = _shared.settle(sigs.join(down, "class", "left_semi"), "signatures")
        _shared.unsettle(nodes, found, pairs, more_pairs, left)
        if ended:
            break
        level += 1
    for df in (sets, masks, below):
        if df is not None:
            _shared.unsettle(df)
    return labels


def _linked(labels: DataFrame | None, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Labels after the links among these pairs."""
    if pairs.isEmpty():
        return labels
    links = _shared.settle(_confirm(pairs, sets, percent), "links")
    out = labels if links.isEmpty() else _merge(labels, links)
    _shared.unsettle(links)
    return out


def near_duplicates(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id it is connected with, itself included), kept."""
    rows = _shared.settle(signatures(docs, words, roots_for(recall, percent), id_col, text_col), "signatures")
    part = rows.where("n > 0 and doc_id is not null")
    classes = part.groupBy("n", "c1", "c2").agg(F.min(F.struct("doc_id", "th")).alias("d"), F.min(F.struct("roots", "sig")).alias("s")).select(F.xxhash64("n", "c1", "c2").alias("class"), "d.doc_id", "d.th", "n", "c1", "c2", "s.roots", "s.sig")
    classes = _shared.settle(classes, "classes")
    roots = similar_classes(docs, classes, percent, words, recall, id_col, text_col)
    known = classes.select("class", F.col("doc_id").alias("component_id"))
    if roots is not None:
        lowest = known.join(roots, "class").groupBy("root").agg(F.min("component_id").alias("lowest"))
        linked = roots.join(lowest, "root").select("class", "lowest")
        known = known.join(linked, "class", "left").select("class", F.coalesce("lowest", "component_id").alias("component_id"))
    taking = rows.select("doc_id", "n", F.when(F.col("n") > 0, F.xxhash64("n", "c1", "c2")).alias("class"))
    out = taking.join(known, "class", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


#: The same result in DuckDB, from all pairs that share a shingle; components by a recursive closure.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS t FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(t) >= 5 THEN list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i+4], ' ')) WHEN len(t) > 0 THEN [array_to_string(t, ' ')] ELSE [] END) AS s FROM w),
c AS (SELECT list_sort(s) AS s, len(s) AS n, min(doc_id) AS rep FROM g WHERE len(s) > 0 GROUP BY 1, 2),
m AS (SELECT g.doc_id, c.rep FROM g JOIN c ON list_sort(g.s) = c.s),
u AS (SELECT rep, n, unnest(s) AS x FROM c),
p AS (SELECT a.rep AS a, b.rep AS b, count(*) AS k, any_value(a.n) AS na, any_value(b.n) AS nb FROM u a JOIN u b ON a.x = b.x AND a.rep < b.rep GROUP BY 1, 2),
e AS (SELECT a, b FROM p WHERE 100 * k >= 75 * (na + nb - k)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(node, seen) AS (SELECT rep, rep FROM c UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a),
k AS (SELECT node, min(seen) AS lowest FROM r GROUP BY 1)
SELECT g.doc_id, CAST(len(g.s) AS BIGINT) AS n_shingles, coalesce(k.lowest, g.doc_id) AS component_id, g.doc_id = coalesce(k.lowest, g.doc_id) AS kept
FROM g LEFT JOIN m ON g.doc_id = m.doc_id LEFT JOIN k ON m.rep = k.node
"""
