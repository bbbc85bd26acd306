"""Line dedup by a suffix array over line-id sequences, with DataFrame operations only.

A document is the sequence of its lines (text split at ``\\n``). Distributed prefix doubling ranks the suffixes: round k ranks every
position by its first 2**k lines, from the pairs of ranks of the two halves; pairs are sorted by range over the cluster, so a rank is the
place of the pair in the global order. Positions whose prefix occurs only once are alone in their interval: no longer prefix of theirs
can repeat, and they take no part in later rounds; doubling ends when no prefix repeats.

The positions that share their first n lines form a longest-common-prefix interval; its first position (in the order of documents and
lines) is the copy that stays, the others have an *earlier copy* of n lines. A maximal repeated run of n lines is the union of the blocks
of 2**k <= n lines that begin at its start and end at its end, and both have an earlier copy too; so the blocks with an earlier copy
cover what the maximal runs cover. Deleted is each line in a run that has an earlier copy and at least ``min_words`` words. (A line has
its number of spaces + 1 as words, so at least one: a block of ``min_words`` lines is long enough by itself, and for fewer lines every
length is tried, not only powers of two. That makes the rule exact.)

Documents are ordered by ``doc_id`` (null first), then by a hash of the text. Rows with equal id and text are one document: each gets the
same result. Null texts stay null, with no lines; an empty text is one empty line. Other columns are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm import _shared

MIN_WORDS = 5


def _at() -> Column:
    """A position in the order of documents and lines."""
    return F.struct("d", "t", "p")


def _same(a: str, b: str) -> Column:
    """The two sides are lines of one document."""
    return F.col(f"{a}.d").eqNullSafe(F.col(f"{b}.d")) & (F.col(f"{a}.t") == F.col(f"{b}.t"))


def _ranked(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rank and first position of each combination of ``by`` that occurs more than once: rows of by, first, r."""
    groups = rows.groupBy(*by).agg(F.count("*").alias("n"), F.min(_at()).alias("first")).where("n > 1").drop("n")
    # the id grows with the partition and with the row in it: after a sort by range it is an order-preserving rank
    return groups.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("r", F.monotonically_increasing_id())


def _earlier() -> Column:
    return (F.col("first") < _at()).alias("earlier")


def _longer(front: DataFrame, back: DataFrame, shift: int) -> DataFrame:
    """The positions whose block in ``front`` and whose block ``shift`` lines on, in ``back``, make a longer block that repeats."""
    front, back = front.select("d", "t", "p", "r").alias("a"), back.select("d", "t", "p", "r").alias("b")
    both = front.join(back, _same("a", "b") & (F.col("b.p") == F.col("a.p") + shift)).select("a.d", "a.t", "a.p", F.col("a.r").alias("r1"), F.col("b.r").alias("r2"))
    ranked = _ranked(both, ["r1", "r2"])
    return _shared.settle(both.join(ranked, ["r1", "r2"]).select("d", "t", "p", "r", _earlier()), "suffixes")


def suffix_ranks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[DataFrame]:
    """The rounds: for k = 0, 1, ... the positions (d, t, p) whose first 2**k lines repeat, their rank r among such prefixes, and whether
    an earlier position has the same prefix. The first round also has the line's number of words w."""
    line = F.col("line")
    lines = docs.select(F.col(id_col).alias("d"), F.xxhash64(text_col).alias("t"), F.posexplode(F.split(text_col, "\n", -1)).alias("p", "line")).select(
        "d", "t", "p", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"), (F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1).alias("w")
    )
    lines = _shared.settle(lines, "lines")
    first = lines.join(_ranked(lines, ["h1", "h2"]), ["h1", "h2"]).select("d", "t", "p", "w", "r", _earlier()).dropDuplicates(["d", "t", "p"])
    rounds = [_shared.settle(first, "suffixes")]
    while not rounds[-1].isEmpty():
        rounds.append(_longer(rounds[-1], rounds[-1], 1 << (len(rounds) - 1)))
    return rounds[:-1] or rounds


def deleted_lines(rounds: list[DataFrame], min_words: int = MIN_WORDS) -> DataFrame:
    """The lines to delete (d, t, p)."""
    mine = Window.partitionBy("d", "t").orderBy("p")
    before = mine.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = _shared.settle(rounds[0].select("d", "t", "p", "w", F.sum("w").over(before).alias("through")), "line-words")
    blocks = []
    for n in sorted({*range(1, min_words + 1), *(1 << k for k in range(len(rounds)))}):
        k = n.bit_length() - 1
        if k >= len(rounds):
            break
        block = rounds[k] if n == 1 << k else _longer(rounds[k], rounds[k], n - (1 << k))
        block = block.where("earlier").select("d", "t", "p", (F.col("p") + n).alias("end"))
        if n < min_words:  # the block's words: through its last line, less those before its first
            first, last = lines.alias("f"), lines.select("d", "t", "p", "through").alias("l")
            words = F.col("l.through") - F.col("f.through") + F.col("f.w")
            block = (
                block.alias("a").join(first, _same("a", "f") & (F.col("a.p") == F.col("f.p"))).join(last, _same("a", "l") & (F.col("l.p") == F.col("a.end") - 1)).where(words >= min_words).select("a.d", "a.t", "a.p", "a.end")
            )
        blocks.append(block)
    ends = reduce(DataFrame.unionByName, blocks).groupBy("d", "t", "p").agg(F.max("end").alias("end"))
    reach = lines.select("d", "t", "p").alias("a").join(ends.alias("b"), _same("a", "b") & (F.col("a.p") == F.col("b.p")), "left").select("a.d", "a.t", "a.p", "b.end")
    return reach.withColumn("reach", F.max("end").over(before)).where("reach > p").select("d", "t", "p")


def deleted_spans(deleted: DataFrame) -> DataFrame:
    """Per document with deleted lines: (d, t, spans), spans being sorted structs of the first and the last line of each stretch."""
    island = F.col("p") - F.row_number().over(Window.partitionBy("d", "t").orderBy("p"))
    stretches = deleted.withColumn("island", island).groupBy("d", "t", "island").agg(F.min("p").alias("first"), F.max("p").alias("last"))
    return stretches.groupBy("d", "t").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the deleted lines cut from their texts, and n_lines and n_removed added (columns of these names are
    replaced). Documents without deletions keep their texts byte for byte; a text whose lines all go is empty."""
    docs = docs.drop("n_lines", "n_removed")
    spans = deleted_spans(deleted_lines(suffix_ranks(docs, id_col, text_col), min_words)).withColumnRenamed("spans", "__spans")
    joined = docs.join(spans, docs[id_col].eqNullSafe(spans["d"]) & (F.xxhash64(docs[text_col]) == spans["t"]), "left")
    kept = F.filter(F.split(text_col, "\n", -1), lambda x, i: ~F.exists("__spans", lambda s: (s["first"] <= i) & (i <= s["last"])))
    removed = F.aggregate("__spans", F.lit(0), lambda n, s: n + s["last"] - s["first"] + 1)
    return joined.select(
        *[F.when(F.col("__spans").isNull(), F.col(c)).otherwise(F.array_join(kept, "\n")).alias(c) if c == text_col else docs[c] for c in docs.columns],
        F.coalesce(F.size(F.split(text_col, "\n", -1)), F.lit(0)).alias("n_lines"),
        F.coalesce(removed, F.lit(0)).alias("n_removed"),
    )


#: The same rule in DuckDB: lines that match along one diagonal of a pair of documents form the runs.
ORACLE_SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS p FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, p, line, length(line) - length(replace(line, ' ', '')) + 1 AS n FROM l),
m AS (SELECT b.doc_id, b.p, b.n, a.doc_id AS da, b.p - a.p AS diag FROM w a JOIN w b ON a.line = b.line AND (a.doc_id < b.doc_id OR (a.doc_id = b.doc_id AND a.p < b.p))),
i AS (SELECT *, p - row_number() OVER (PARTITION BY doc_id, da, diag ORDER BY p) AS g FROM m),
r AS (SELECT doc_id, p, sum(n) OVER (PARTITION BY doc_id, da, diag, g) AS words FROM i),
x AS (SELECT DISTINCT doc_id, p FROM r WHERE words >= 5),
k AS (SELECT w.doc_id, coalesce(string_agg(w.line, chr(10) ORDER BY w.p) FILTER (x.p IS NULL), '') AS text, count(*) AS n_lines, count(x.p) AS n_removed
      FROM w LEFT JOIN x ON w.doc_id = x.doc_id AND w.p = x.p GROUP BY w.doc_id)
SELECT d.doc_id, k.text, CAST(coalesce(k.n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(k.n_removed, 0) AS INTEGER) AS n_removed
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id
"""
