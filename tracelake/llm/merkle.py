"""A Merkle manifest of a dataset: a content-addressed graph of digests with a proof for every row.

Each document is a leaf, the hash of its fields. Per language the leaves ascend by doc_id, and every ``ARITY`` consecutive nodes become one
until one is left; the languages' nodes become the root in the same way. The manifest is a table of records (digest, children), cut into
*segments* of up to ``LEVELS`` levels: a segment has ``ARITY ** LEVELS`` consecutive leaves at most, so one task builds it, and its root is a
leaf of the segment above. A million leaves of a language make two storeys of segments, a thousand million three.

A proof is found by descent: a request carries the rank of its leaf, and the rank's digits say which child to take from the root on; the
children that are not taken are the proof. Requests of one segment share the way from the root to it, so that way is found once and kept with
the segment's root, and no request travels through the storeys by itself. The ways' segments, joined from the root down, are read in
reverse: a proof begins at the leaf.

Rows are told apart by their fields: equal doc_ids ascend by their leaves, and rows that are equal throughout have equal leaves. Null ids
come first and are never tampered with. Null and empty texts are different leaves. An empty table has no rows and no root. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm import _shared

ARITY, LEVELS = 2, 10
SEGMENT = ARITY**LEVELS
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

ORACLE_SQL = """
WITH RECURSIVE c AS (SELECT *, CAST(doc_id % 1000000000000 AS VARCHAR) AS t FROM documents),
b AS (SELECT *, doc_id IS NOT NULL AND (4294967295 - list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(t) + 1), lambda i: CAST(ascii(substr(t, CAST(i AS INT), 1)) AS BIGINT))),
  lambda crc, x: list_reduce([xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END))) % 7 = 0 AS bad FROM c),
f AS (SELECT doc_id, lang, bad, n_chars, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
  CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS body FROM b),
l AS (SELECT doc_id, lang, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END || body) AS leaf,
  sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars + CAST(bad AS INT) AS VARCHAR)) || ':' || (n_chars + CAST(bad AS INT)) END || body) AS seen FROM f),
r AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM l),
a(g, lv, pos, digest, n) AS (SELECT g, 0, pos, leaf, n FROM r UNION ALL SELECT g, lv + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM a WHERE n > 1 GROUP BY g, lv, pos // 2, n),
s AS (SELECT g, digest, count(*) OVER () AS m FROM a WHERE n = 1),
t(lv, pos, digest, n) AS (SELECT 0, g, digest, m FROM s UNION ALL SELECT lv + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY lv, pos // 2, n),
u(doc_id, leaf, g, lv, pos, n, digest, proof) AS (SELECT doc_id, leaf, g, 0, pos, n, seen, '' FROM r
  UNION ALL SELECT u.doc_id, u.leaf, u.g, u.lv + 1, u.pos // 2, (u.n + 1) // 2, sha256(CASE WHEN u.pos % 2 = 1 THEN a.digest || u.digest ELSE u.digest || coalesce(a.digest, '') END), u.proof || coalesce(a.digest, '')
  FROM u LEFT JOIN a ON a.g = u.g AND a.lv = u.lv AND a.pos = xor(u.pos, 1) WHERE u.n > 1),
v(doc_id, leaf, g, lv, pos, n, digest, proof) AS (SELECT u.doc_id, u.leaf, u.g, 0, u.g, s.m, u.digest, u.proof FROM u JOIN s ON s.g = u.g WHERE u.n = 1
  UNION ALL SELECT v.doc_id, v.leaf, v.g, v.lv + 1, v.pos // 2, (v.n + 1) // 2, sha256(CASE WHEN v.pos % 2 = 1 THEN t.digest || v.digest ELSE v.digest || coalesce(t.digest, '') END), v.proof || coalesce(t.digest, '')
  FROM v LEFT JOIN t ON t.lv = v.lv AND t.pos = xor(v.pos, 1) WHERE v.n > 1)
SELECT v.doc_id, v.leaf, s.digest AS subroot, t.digest AS root, sha256(v.proof) AS proof_sha256, v.digest AS folded_root, v.digest = t.digest AS verified
FROM v JOIN s ON s.g = v.g CROSS JOIN (SELECT digest FROM t WHERE n = 1) t WHERE v.n = 1
"""


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(n_chars: Column | str = "n_chars") -> Column:
    """The hash of a row's fields."""

    def field(c) -> Column:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[field(n_chars if c == "n_chars" else c) for c in FIELDS]), 256)


def ranked(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Adds rank, the place (from 0) among the rows of a key by ``order``, nulls first, and n, the key's rows; keys are not null. The rows are
    written in ranges of (key, order), and a row of totals a range and key says what stands before: no key has to fit into one task."""
    by = [F.col(c).asc_nulls_first() for c in [key, *order]]
    # equal rows may be many: they are dealt, too, and any order of them is right
    ranges = df.withColumn("spread", F.monotonically_increasing_id()).repartitionByRange(*by, "spread")
    rows = _shared.settle(ranges.drop("spread").withColumn("part", F.spark_partition_id()), name)
    totals = rows.groupBy("part", key).agg(F.count("*").alias("size"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    totals = totals.select("part", key, F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"), F.sum("size").over(Window.partitionBy(key)).alias("n"))
    inside = Window.partitionBy("part", key).orderBy(*by)
    return rows.join(totals, ["part", key]).withColumn("rank", F.col("base") + F.row_number().over(inside) - 1).drop("part", "base")


_RECORD = "tree long, segment long, root string, digest string, children array<string>"


def _segments(nodes: DataFrame) -> DataFrame:
    """Records of the segments over nodes (tree, rank, n, digest), n being the tree's nodes: (tree, segment, root of the segment, digest,
    children). A segment of a tree that has more of them rises ``LEVELS`` levels, however few its nodes; a tree's only one ends at one node.
    A node that is its tree's only one has a record without children."""

    def build(table: pa.Table) -> pa.Table:
        place = table.column("rank").to_numpy().argsort(kind="stable")
        digests = table.column("digest").to_pylist()
        level = [digests[i] for i in place]
        more = table.column("n")[0].as_py() > SEGMENT
        records: dict[str, list[str]] = {}
        height = 0
        while len(level) > 1 or (more and height < LEVELS):
            runs = [level[i : i + ARITY] for i in range(0, len(level), ARITY)]
            level = [_digest(r) for r in runs]
            records.update(zip(level, runs))
            height += 1
        records = records or {level[0]: []}
        k = len(records)
        same = [table.column(c)[0].as_py() for c in ("tree", "segment")]
        return pa.table([pa.array([same[0]] * k, pa.int64()), pa.array([same[1]] * k, pa.int64()), pa.array([level[0]] * k), pa.array(list(records)), pa.array(list(records.values()), pa.list_(pa.string()))], names=["tree", "segment", "root", "digest", "children"])

    parts = nodes.select("tree", F.floor(F.col("rank") / SEGMENT).cast("long").alias("segment"), "rank", "n", "digest")
    return parts.groupBy("tree", "segment").applyInArrow(build, _RECORD)


def _storeys(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The records of all storeys of segments, from the leaves up; the last has one segment a tree. A tree that is finished earlier goes up
    as a single node. ``nodes`` has each tree's nodes, n of them."""
    out = []
    while True:
        records = _shared.settle(_segments(nodes), name)
        out.append(records)
        tops = records.groupBy("tree", "segment").agg(F.first("root").alias("digest"))
        sizes = tops.groupBy("tree").agg(F.count("*").alias("n"))
        if sizes.where("n > 1").isEmpty():
            return out
        nodes = tops.join(sizes, "tree").select("tree", F.col("segment").alias("rank"), "n", "digest")


def _tops(records: DataFrame) -> DataFrame:
    """The top of each tree, of the last storey's records."""
    return records.groupBy("tree").agg(F.first("root").alias("top"))


@dataclass
class Manifest:
    """``rows``: the dataset's rows in their place (doc_id, tree, rank, n, leaf, seen); ``storeys``: the languages' records from the leaves
    up; ``above``: those of the tree over the languages."""

    rows: DataFrame
    storeys: list[DataFrame]
    above: list[DataFrame]

    def drop(self) -> None:
        """Delete the manifest's tables."""
        _shared.unsettle(self.rows, *self.storeys, *self.above)


def build(docs: DataFrame, tampered: Column | None = None) -> Manifest:
    """The manifest of ``docs`` (the columns ``FIELDS``). ``seen`` is a row's leaf as a checker would see it: that of the row itself, or with
    n_chars one larger where ``tampered`` says so."""
    changed = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    of = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-"))  # in the languages' order, null first
    leaves = docs.select(F.col("doc_id").cast("long").alias("doc_id"), of.alias("of"), leaf().alias("leaf"), F.when(changed, leaf(F.col("n_chars") + 1)).alias("other"))
    leaves = ranked(leaves, "of", ["doc_id", "leaf"], "merkle-leaves")
    langs = ranked(leaves.select("of").distinct().withColumn("all", F.lit("-")), "all", ["of"], "merkle-langs").select("of", F.col("rank").alias("tree"))
    rows = leaves.join(langs, "of").select("doc_id", "tree", "rank", "n", "leaf", F.coalesce("other", "leaf").alias("seen"))
    rows = _shared.settle(rows, "merkle-rows")
    storeys = _storeys(rows.select("tree", "rank", "n", F.col("leaf").alias("digest")), "merkle-records")
    tops = _tops(storeys[-1]).select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), F.col("top").alias("digest"))
    above = _storeys(tops.join(tops.groupBy("tree").agg(F.count("*").alias("n")), "tree"), "merkle-records")
    return Manifest(rows, storeys, above)


def _descend(records: dict[str, list[str]], top: str, digits: list[int]) -> tuple[str, list[str]]:
    """From the top by the digits: the node below, and for each level the digit and the children that were not taken."""
    path = []
    for digit in digits:
        children = records[top]
        path.append(f"{digit}:" + "".join(children[:digit] + children[digit + 1 :]))
        top = children[digit]
    return top, path


def _height(records: dict[str, list[str]], top: str) -> int:
    """Levels below a segment's top: leftmost children, as long as there are records of them."""
    height = 0
    while records.get(top):
        top, height = records[top][0], height + 1
    return height


def _digits(rank: int, height: int) -> list[int]:
    """The rank's last digits in base ``ARITY``, the first one first."""
    return [rank // ARITY**k % ARITY for k in range(height - 1, -1, -1)]


def _ways(records: DataFrame, prefixes: DataFrame, requests: DataFrame, result: str, value) -> DataFrame:
    """For each request (tree, rank, ...) what ``value(request, subject, path)`` gives, path being the levels from the root to it: the way to
    its segment (``prefixes``: tree, segment, way) and the descent in it. A segment's records and requests meet in one task."""
    requests = requests.withColumn("segment", F.floor(F.col("rank") / SEGMENT).cast("long"))
    names = [c.split()[0] for c in result.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}[c.split()[1]] for c in result.split(", ")]
    schema = pa.schema(list(zip(names, kinds)))
    # the way stands once with a segment, in a row of its own
    known = records.select("tree", "segment", "root", "digest", "children", F.lit(None).cast("array<string>").alias("way"))
    ways = prefixes.select("tree", "segment", F.lit(None).cast("string").alias("root"), F.lit(None).cast("string").alias("digest"), F.lit(None).cast("array<string>").alias("children"), "way")

    def meet(asked: pa.Table, stored: pa.Table) -> pa.Table:
        of, way, top = {}, [], None
        for root, digest, children, path in zip(*(stored.column(c).to_pylist() for c in ("root", "digest", "children", "way"))):
            if path is not None:
                way = path
            else:
                of[digest], top = children, root
        height = _height(of, top) if top is not None else 0
        rows = []
        for request in asked.to_pylist():
            found, path = _descend(of, top, _digits(request["rank"], height))
            rows.append(value(request, found, way + path))
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], schema=schema)

    by = ("tree", "segment")
    return requests.groupBy(*by).cogroup(known.unionByName(ways).groupBy(*by)).applyInArrow(meet, result)


def fold(digest: str, path: list[str]) -> str:
    """The root that a digest and the children that were not taken give, from the leaf up."""
    for level in reversed(path):
        digit, _, others = level.partition(":")
        at = 64 * int(digit)
        digest = _digest([others[:at], digest, others[at:]])
    return digest


def prove(manifest: Manifest) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof (digests, the leaf's level first), folded (what ``seen`` and the proof give) and verified."""
    none = F.array().cast("array<string>")

    def step(request, found, path):
        return request["tree"], request["rank"], path

    # down the tree over the languages, then down the storeys: each storey's requests are the segments of the one below
    way = "tree long, rank long, way array<string>"
    prefixes = manifest.above[-1].select("tree", "segment").distinct().withColumn("way", none)
    for at, records in reversed(list(enumerate(manifest.above))):
        below = manifest.above[at - 1].select("tree", F.col("segment").alias("rank")).distinct() if at else _tops(manifest.storeys[-1]).select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"))
        found = _ways(records, prefixes, below, way, step)
        prefixes = found.select("tree", F.col("rank").alias("segment"), "way")
    prefixes = prefixes.select(F.col("segment").alias("tree"), F.lit(0).cast("long").alias("segment"), "way")
    for at in range(len(manifest.storeys) - 1, 0, -1):
        below = manifest.storeys[at - 1].select("tree", F.col("segment").alias("rank")).distinct()
        prefixes = _ways(manifest.storeys[at], prefixes, below, way, step).select("tree", F.col("rank").alias("segment"), "way")

    tops = _tops(manifest.storeys[-1])
    root = _tops(manifest.above[-1]).select(F.col("top").alias("root"))
    subjects = manifest.rows.join(tops.withColumnRenamed("top", "subroot"), "tree").join(F.broadcast(root))  # one row

    def told(request, found, path):
        if found != request["leaf"]:
            raise RuntimeError("a record of the manifest is missing")
        folded = fold(request["seen"], path)
        return request["doc_id"], request["leaf"], request["subroot"], request["root"], [x.partition(":")[2] for x in reversed(path)], folded, folded == request["root"]

    return _ways(manifest.storeys[0], prefixes, subjects, "doc_id long, leaf string, subroot string, root string, proof array<string>, folded string, verified boolean", told)


def proofs(docs: DataFrame) -> DataFrame:
    """The digest columns of the query's contract."""
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")), F.lit(7)) == 0
    out = prove(build(docs, tampered))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(F.concat_ws("", "proof"), 256).alias("proof_sha256"), F.col("folded").alias("folded_root"), "verified")
