"""Call frames and gas of traces, as window functions.

A trace table has the key columns of a transaction, the place ``idx`` and one row an opcode. All windows have the key as the first part
of their partitioning, so one exchange by the key serves the whole chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions import call_target, format_address, is_call, is_call_or_create, is_precompile

KEY = ["meta_network_name", "block_number", "transaction_hash"]
#: Columns that a source may leave out, with their types; they are filled with null.
OPTIONAL = {
    "gas_used": "long", "refund": "long", "error": "string", "return_data": "string", "call_to_address": "string", "mem_size": "long",
    "call_transfers_value": "boolean", "ext_code_copy_size": "long", "s1": "string", "s2": "string", "s3": "string", "s4": "string",
}


def in_trace(key: list[str]):
    return Window.partitionBy(*key).orderBy("idx")


def in_frame(key: list[str]):
    return Window.partitionBy(*key, "frame_id").orderBy("idx")


def normal(traces: DataFrame) -> DataFrame:
    """The trace with every optional column, gas costs repaired (a cost above the remaining gas is a producer's underflow)."""
    missing = {c: F.lit(None).cast(t) for c, t in OPTIONAL.items() if c not in traces.columns}
    return traces.withColumns(missing).withColumn("gas_cost", F.least(F.col("gas_cost"), F.col("gas")).cast("long"))


def immediate_return(op: Column, target: Column, depth: Column, next_depth: Column) -> Column:
    """A call with a target after which the trace goes on at the same depth; the last opcode is none."""
    return F.coalesce(is_call(op) & target.isNotNull() & (next_depth == depth), F.lit(False))


def with_frames(traces: DataFrame, key: list[str] = KEY, precompile_frames: bool = False) -> DataFrame:
    """Adds target, next_depth, synthetic, entry, frame_id, synthetic_id and parent_at_entry, call_type and tracer_target at entries.

    Frames are numbered depth first from 0; a call that returns at once takes a number for a synthetic frame (calls of precompiles only
    if ``precompile_frames``). For well-formed traces; see ``malformed``.
    """
    t = in_trace(key)
    level = F.greatest(F.col("depth"), F.lit(1))
    df = traces.withColumns({"target": call_target(F.col("op"), F.col("call_to_address"), F.col("s2")), "next_depth": F.lead("depth").over(t), "level": level})
    synthetic = immediate_return(F.col("op"), F.col("target"), F.col("depth"), F.col("next_depth"))
    if not precompile_frames:
        synthetic = synthetic & ~F.coalesce(is_precompile(F.col("target")), F.lit(False))
    df = df.withColumns({"synthetic": synthetic, "entry": F.col("level") > F.coalesce(F.lag("level").over(t), F.lit(1)), "call_type": F.lag("op").over(t), "tracer_target": F.lag("call_to_address").over(t)})
    so_far = t.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("issued", F.sum(F.col("entry").cast("long") + F.col("synthetic").cast("long")).over(so_far))
    df = df.withColumns({"entry_id": F.when(F.col("entry"), F.col("issued") - F.col("synthetic").cast("long")), "synthetic_id": F.when(F.col("synthetic"), F.col("issued"))})
    at_level = Window.partitionBy(*key, "level").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("frame_id", F.coalesce(F.last("entry_id", ignorenulls=True).over(at_level), F.lit(0).cast("long")))
    return df.withColumn("parent_at_entry", F.when(F.col("entry"), F.lag("frame_id").over(t))).drop("level", "issued", "entry_id")


def with_gas(frames: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Replaces gas_used (the tracer's, if its first is positive; else from the next opcode of the frame) and adds gas_self (without the
    gas of the frame that the opcode opened)."""
    t, f = in_trace(key), in_frame(key)
    later = F.lead("gas").over(f)
    computed = F.when(later <= F.col("gas"), F.col("gas") - later).otherwise(F.col("gas_cost"))
    traced = F.coalesce(F.first("gas_used").over(t.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(0)) > 0
    df = frames.withColumns({"gas_used": F.when(traced, F.coalesce(F.col("gas_used"), F.lit(0))).otherwise(computed)})
    df = df.withColumn("frame_gas", F.sum("gas_used").over(Window.partitionBy(*key, "frame_id")))
    inner = F.when(is_call_or_create(F.col("op")) & (F.col("next_depth") > F.col("depth")), F.lead("frame_gas").over(t)).otherwise(F.lit(0))
    return df.withColumn("gas_self", F.greatest(F.col("gas_used") - inner, F.lit(0).cast("long"))).drop("frame_gas")


def with_created(frames: DataFrame, key: list[str] = KEY, use_tracer_create_address: bool = False) -> DataFrame:
    """Replaces target for creates: the top of the stack at the first later opcode that is not deeper. In a trace whose first create has the
    tracer's address they are left null, as the tables have always had it; with ``use_tracer_create_address`` they are the tracer's.

    An opcode at which the depth falls closes one frame of each level that it leaves, and stands once more in each of these for the time of
    one window: in its own level, the row after a create is then the one asked for. Levels left are never more than frames opened."""
    create = F.col("op").isin("CREATE", "CREATE2")
    first = F.min_by(F.col("call_to_address").isNotNull(), F.when(create, F.col("idx"))).over(Window.partitionBy(*key))
    level = F.greatest(F.col("depth"), F.lit(1))
    before = F.coalesce(F.lag(level).over(in_trace(key)), F.lit(1))
    df = frames.withColumns({"traced_create": F.coalesce(first, F.lit(False)), "left": F.greatest(before - level, F.lit(0))})
    df = df.withColumn("up", F.explode(F.sequence(F.lit(0), F.col("left"))))
    df = df.withColumn("after", F.lead("s1").over(Window.partitionBy(*key, level + F.col("up")).orderBy("idx"))).where("up = 0")
    created = F.when(F.col("traced_create"), F.col("call_to_address") if use_tracer_create_address else F.lit(None)).otherwise(format_address(F.col("after")))
    return df.withColumn("target", F.when(create, created).otherwise(F.col("target"))).drop("traced_create", "left", "up", "after")


def with_resolved_targets(frames: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Fills tracer_target at entries, where the tracer had none, with the target of the opcode before: a call's operand, a create's address."""
    return frames.withColumn("tracer_target", F.coalesce("tracer_target", F.when(F.col("entry"), F.lag("target").over(in_trace(key)))))


def with_begins(traces: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Adds begins: whether a row is its trace's first."""
    return traces.withColumn("begins", F.lag("idx").over(in_trace(key)).isNull())


def frame_table(frames: DataFrame, key: list[str] = KEY) -> DataFrame:
    """One row a frame: key, frame_id, parent_id (null for the root) and level, from entries, synthetic rows and each trace's first row.
    ``begins`` tells the last, if the rows have it already."""
    row = lambda frame, parent, level: F.struct(frame.cast("long").alias("frame_id"), parent.cast("long").alias("parent_id"), level.cast("long").alias("level"))
    of = F.array_compact(
        F.array(
            F.when(F.col("begins"), row(F.lit(0), F.lit(None), F.lit(1))),
            F.when(F.col("entry"), row(F.col("frame_id"), F.col("parent_at_entry"), F.col("depth"))),
            F.when(F.col("synthetic"), row(F.col("synthetic_id"), F.col("frame_id"), F.col("depth") + 1)),
        )
    )
    frames = frames if "begins" in frames.columns else with_begins(frames, key)
    return frames.select(*key, F.explode(of).alias("x")).select(*key, "x.*")


def frame_paths(table: DataFrame, key: list[str] = KEY) -> DataFrame:
    """key, frame_id and path (ids from the root to the frame) of frames (key, frame_id, parent_id, level). A transaction's frames are
    numbered from 0 without gaps, so the list of their parents tells each path's next step up; a path has at most ``level`` of them."""
    frames = table.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("frame_id", "parent_id", "level"))).alias("f")).withColumn("parents", F.transform("f", lambda x: x["parent_id"]))

    def path(x):
        up = lambda p: F.element_at("parents", (p[0] + 1).cast("int"))
        climb = lambda p, _: F.when(up(p).isNull(), p).otherwise(F.concat(F.array(up(p)), p))
        return F.aggregate(F.sequence(F.lit(1), F.greatest(x["level"], F.lit(1)).cast("int")), F.array(x["frame_id"]), climb)

    return frames.select(*key, F.explode(F.transform("f", lambda x: F.struct(x["frame_id"].alias("frame_id"), path(x).alias("path")))).alias("x")).select(*key, "x.*")


def with_malformed(traces: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Adds malformed: whether the trace doesn't begin at depth 1, falls below it or rises by more than one, so that windows can't number
    its frames."""
    t = in_trace(key)
    jump = F.col("depth") - F.coalesce(F.lag("depth").over(t), F.lit(0))
    odd = (jump > 1) | (F.col("depth") < 1) | (F.lag("depth").over(t).isNull() & (F.col("depth") != 1))
    df = traces.withColumn("odd", F.coalesce(odd, F.lit(True)))
    return df.withColumn("malformed", F.max("odd").over(Window.partitionBy(*key))).drop("odd")
