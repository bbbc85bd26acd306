"""Traces too long for one task: the window operators as a segmented scan.

A trace is cut in chunks of ``chunk_rows`` places. What a chunk needs of the others is little: its neighbours' edges, how many frames were
numbered before it, which frame of each level is open where it begins, and for each level open at its end the first later opcode that is not
deeper. Chunks are summarised side by side, the summaries (a row a chunk, at most a row a chunk and level) are scanned by windows over chunks,
and the chunks are finished side by side with what the scan gives them. All windows over opcodes are partitioned by chunk, so a trace runs in
as many tasks as it has chunks; the columns are those of ``frames`` and ``resources``, for well-formed traces.

The next opcode of a frame is the first later one that is not deeper, if that is of the same depth; at it the address of a created contract
lies on the stack; and the frame that an opcode opens has the next number. So one look ahead serves gas, memory and created addresses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions import call_target, format_address, is_call_or_create, is_precompile
from tracelake.operators import resources as rs
from tracelake.operators.frames import KEY, immediate_return

#: Places of a chunk.
CHUNK_ROWS = 65_536


def _edges(df: DataFrame, key: list[str]) -> DataFrame:
    """A row a chunk: the row before it and the row behind it, and what holds for the whole trace."""
    create = F.col("op").isin("CREATE", "CREATE2")
    each = df.groupBy(*key, "chunk").agg(
        F.min_by(F.struct("depth", "gas_used"), "idx").alias("first"), F.max_by(F.struct("level", "op", "call_to_address"), "idx").alias("last"), F.max(F.coalesce("mem_size", F.lit(0))).alias("size"),
        F.min(F.when(create, F.struct("idx", F.col("call_to_address").isNotNull().alias("traced")))).alias("create"), F.max("level").alias("deepest"),
    )
    w, whole = Window.partitionBy(*key).orderBy("chunk"), Window.partitionBy(*key)
    begin = F.first("first").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return each.select(
        *key, "chunk", F.lag("last").over(w).alias("prev"), F.lead("first").over(w)["depth"].alias("depth_behind"), (F.coalesce(begin["gas_used"], F.lit(0)) > 0).alias("traced"), (F.max("size").over(whole) > 0).alias("has_memory"),
        F.coalesce(F.min("create").over(whole)["traced"], F.lit(False)).alias("traced_create"), F.max("deepest").over(whole).alias("deepest"),
    )


def _open_frames(chunks: DataFrame, entries: DataFrame, key: list[str]) -> DataFrame:
    """(key, chunk, open): the frames of levels 2, 3, ... that are open where the chunk begins."""
    asked = chunks.where("level_before > 1").select(*key, "chunk", F.explode(F.sequence(F.lit(2), "level_before")).alias("level"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("frame"))
    opened = entries.join(chunks.select(*key, "chunk", "base"), [*key, "chunk"]).select(*key, "chunk", "level", F.lit(1).alias("kind"), (F.col("base") + F.col("entry")).alias("frame"))
    so_far = Window.partitionBy(*key, "level").orderBy("chunk", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = asked.unionByName(opened).withColumn("frame", F.last("frame", ignorenulls=True).over(so_far)).where("kind = 0")
    return known.groupBy(*key, "chunk").agg(F.transform(F.array_sort(F.collect_list(F.struct("level", "frame"))), lambda x: x["frame"]).alias("open"))


def _later_rows(chunks: DataFrame, key: list[str]) -> DataFrame:
    """(key, chunk, later): for levels 1, 2, ... up to that of the chunk's last row, the first row of later chunks that is not deeper."""
    levels = chunks.withColumn("level", F.explode(F.sequence(F.lit(1), "deepest")))
    found = levels.select(*key, "chunk", "level", "last_level", F.get(F.filter("minima", lambda x: x["level"] <= F.col("level")), F.lit(0)).alias("row"))
    behind = Window.partitionBy(*key, "level").orderBy("chunk").rowsBetween(1, Window.unboundedFollowing)
    found = found.withColumn("row", F.first("row", ignorenulls=True).over(behind)).where("level <= last_level")
    return found.groupBy(*key, "chunk").agg(F.transform(F.array_sort(F.collect_list(F.struct("level", "row"))), lambda x: x["row"]).alias("later"))


def annotated(traces: DataFrame, settle, key: list[str] = KEY, precompile_frames: bool = False, created: bool = True, chunk_rows: int = CHUNK_ROWS, use_tracer_create_address: bool = False, resolve_targets: bool = False) -> DataFrame:
    """``traces`` (as ``frames.normal`` gives them) with all columns of ``plans.traces.annotated``. ``settle(df, name)`` writes a table and reads
    it back: the rows are used more than once, and a lost executor costs a new read."""
    names = [c for c in traces.columns if c != "gas_used"]
    df = traces.withColumns({"chunk": F.floor(F.col("idx") / chunk_rows).cast("long"), "level": F.greatest(F.col("depth"), F.lit(1)), "target": call_target(F.col("op"), F.col("call_to_address"), F.col("s2"))})
    edges = _edges(df, key)

    # every row, by its neighbours
    t = Window.partitionBy(*key, "chunk").orderBy("idx")
    so_far = t.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.join(edges, [*key, "chunk"]).withColumn("begins", F.lag("idx").over(t).isNull())
    across = lambda c, carried: F.when(F.col("begins"), carried).otherwise(F.lag(c).over(t))
    df = df.withColumns({
        "before": F.coalesce(across("level", F.col("prev.level")), F.lit(1)), "next_depth": F.coalesce(F.lead("depth").over(t), "depth_behind"), "call_type": across("op", F.col("prev.op")), "tracer_target": across("call_to_address", F.col("prev.call_to_address")),
        "words_before": F.when(F.col("has_memory"), rs.words(F.coalesce("mem_size", F.lit(0)))).otherwise(0).cast("long"), "least": F.min("level").over(t.rowsBetween(Window.unboundedPreceding, -1)),
    })
    synthetic = immediate_return(F.col("op"), F.col("target"), F.col("depth"), F.col("next_depth"))
    if not precompile_frames:
        synthetic = synthetic & ~F.coalesce(is_precompile(F.col("target")), F.lit(False))
    df = df.withColumns({"synthetic": synthetic, "entry": F.col("level") > F.col("before"), "minimum": F.coalesce(F.col("level") < F.col("least"), F.lit(True))}).drop("prev", "depth_behind", "least")
    df = df.withColumn("issued", F.sum(F.col("entry").cast("long") + F.col("synthetic").cast("long")).over(so_far))
    df = settle(df, "segments")

    # the scan over chunks
    look = F.struct("level", "gas", "words_before", "s1")
    record = F.struct("idx", look.alias("row"))
    minima = F.transform(F.array_sort(F.collect_list(F.when(F.col("minimum"), record))), lambda x: x["row"])
    chunks = df.groupBy(*key, "chunk").agg(F.max("issued").alias("n"), F.max_by("level", "idx").alias("last_level"), F.min_by("before", "idx").alias("level_before"), F.max("deepest").alias("deepest"), minima.alias("minima"))
    chunks = chunks.withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy(*key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    chunks = settle(chunks, "segment-summaries")
    entries = df.where("entry").groupBy(*key, "chunk", "level").agg(F.max(F.col("issued") - F.col("synthetic").cast("long")).alias("entry"))
    carried = chunks.select(*key, "chunk", "base").join(_open_frames(chunks, entries, key), [*key, "chunk"], "left").join(_later_rows(chunks, key), [*key, "chunk"], "left")

    # every row, by what its chunk was given
    df = df.join(carried, [*key, "chunk"])
    open_at = lambda level: F.coalesce(F.get("open", (level - 2).cast("int")), F.lit(0).cast("long"))
    number = F.col("base") + F.col("issued")
    df = df.withColumns({"entry_id": F.when(F.col("entry"), number - F.col("synthetic").cast("long")), "synthetic_id": F.when(F.col("synthetic"), number)})
    at_level = Window.partitionBy(*key, "chunk", "level").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("frame_id", F.coalesce(F.last("entry_id", ignorenulls=True).over(at_level), open_at(F.col("level"))))
    df = df.withColumn("parent_at_entry", F.when(F.col("entry"), F.when(F.col("begins"), open_at(F.col("before"))).otherwise(F.lag("frame_id").over(t))))
    # an opcode at which the depth falls stands once more in each level that it leaves, as in frames.with_created
    left = F.when(F.col("begins"), 0).otherwise(F.greatest(F.col("before") - F.col("level"), F.lit(0)))
    df = df.withColumn("up", F.explode(F.sequence(F.lit(0), left)))
    df = df.withColumn("after", F.lead(look).over(Window.partitionBy(*key, "chunk", F.col("level") + F.col("up")).orderBy("idx"))).where("up = 0")
    df = df.withColumn("after", F.coalesce("after", F.get("later", F.col("level") - 1)))
    same = F.col("after.level") == F.col("level")
    computed = F.when(same & (F.col("after.gas") <= F.col("gas")), F.col("gas") - F.col("after.gas")).otherwise(F.col("gas_cost"))
    after_words = F.coalesce(F.when(same, F.col("after.words_before")), F.greatest(F.col("words_before"), rs.returned_words(F.col("op"), F.col("s1"), F.col("s2"))))
    df = df.withColumns({
        "gas_used": F.when(F.col("traced"), F.coalesce("gas_used", F.lit(0))).otherwise(computed), "words_after": F.when(F.col("has_memory"), after_words).otherwise(0).cast("long"),
        "opens": F.when(is_call_or_create(F.col("op")) & (F.col("next_depth") > F.col("depth")), number + 1),
    })
    if created:
        traced = F.col("call_to_address") if use_tracer_create_address else F.lit(None)
        address = F.when(F.col("traced_create"), traced).otherwise(format_address(F.col("after.s1")))
        df = df.withColumn("target", F.when(F.col("op").isin("CREATE", "CREATE2"), address).otherwise(F.col("target")))
    df = df.withColumn("mem_exp", rs.expansion_gas(F.col("words_before"), F.col("words_after")))
    kept = [*names, "gas_used", "target", "next_depth", "synthetic", "entry", "call_type", "tracer_target", "synthetic_id", "frame_id", "parent_at_entry", "words_before", "words_after", "mem_exp", "opens"]
    df = settle(df.select(*kept), "segments")

    if resolve_targets:
        # a row a frame on either side
        callers = df.where("opens is not null").select(*key, F.col("opens").alias("frame_id"), F.col("target").alias("caller_target"))
        entered = df.where("entry").join(callers, [*key, "frame_id"], "left").withColumn("tracer_target", F.coalesce("tracer_target", "caller_target"))
        df = df.where("not entry").unionByName(entered.drop("caller_target"))

    # gas of the frames that opcodes opened
    spent = df.groupBy(*key, F.col("frame_id").alias("opens")).agg(F.sum("gas_used").alias("inner"))
    own = F.greatest(F.col("gas_used") - F.coalesce("inner", F.lit(0)), F.lit(0).cast("long"))
    opening = df.where("opens is not null").join(spent, [*key, "opens"], "left").withColumn("gas_self", own).drop("inner")
    rest = df.where("opens is null").withColumn("gas_self", F.greatest(F.col("gas_used"), F.lit(0).cast("long")))
    return rs.with_precompile_split(rs.with_cold(rest.unionByName(opening).drop("opens")))


def malformed(traces: DataFrame, key: list[str] = KEY, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The keys of traces whose depths no window can number (see ``frames.with_malformed``), by chunks."""
    df = traces.select(*key, "idx", "depth", F.floor(F.col("idx") / chunk_rows).cast("long").alias("chunk"))
    each = df.groupBy(*key, "chunk").agg(F.min_by("depth", "idx").alias("first"), F.max_by("depth", "idx").alias("last"))
    w = Window.partitionBy(*key).orderBy("chunk")
    edges = each.select(*key, "chunk", F.lag("last").over(w).alias("prev"), F.lag("chunk").over(w).isNull().alias("start"))
    t = Window.partitionBy(*key, "chunk").orderBy("idx")
    df = df.join(edges, [*key, "chunk"]).withColumn("before", F.when(F.lag("idx").over(t).isNull(), F.when(F.col("start"), 0).otherwise(F.col("prev"))).otherwise(F.lag("depth").over(t)))
    odd = (F.col("depth") - F.col("before") > 1) | (F.col("depth") < 1)
    return df.where(F.coalesce(odd, F.lit(True))).select(*key).distinct()
