"""Malformed traces: the same columns as the window operators, for depths that jump or begin elsewhere than at 1.

Their frames depend on which frames are open: a native fold (``aggregate`` over a transaction's opcodes in order) keeps the stack of open
frames in its accumulator. What looks at other opcodes of a trace - gas, memory, created addresses, gas of inner frames - is found by windows
by depth, as for other traces, in a form that holds whatever the depths are. Nothing leaves the JVM. A transaction's frames are folded in one
task; only malformed ones come here. A missing depth is that of the opcode before (1 at the beginning).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions import CALLS, CREATES, call_target, is_precompile
from tracelake.operators.frames import KEY, immediate_return, in_trace
from tracelake.operators.resources import words

#: Opcodes that are folded at a time: results of a step are appended to a list, and lists are copied when they grow.
STEP = 64
_STACK = "array<struct<level: int, id: bigint>>"
_OUT = "array<struct<idx: bigint, frame_id: bigint, entry: boolean, parent_at_entry: bigint, synthetic_id: bigint>>"


def _struct(**fields: Column) -> Column:
    return F.named_struct(*[x for k, v in fields.items() for x in (F.lit(k), v)])


def _with(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _step(state: Column, x: Column) -> Column:
    """The fold's next state after opcode x (idx, level, synthetic): open frames, the next number, and what was found of the opcodes."""
    top = F.element_at(state["stack"], -1)
    entry = x["level"] > top["level"]
    opened = F.concat(state["stack"], F.array(_struct(level=x["level"], id=state["next"])))
    stack = F.when(entry, opened).otherwise(F.filter(state["stack"], lambda s: s["level"] <= x["level"]))
    now = _struct(stack=stack, next=state["next"] + entry.cast("bigint"), entry=entry, parent=F.when(entry, top["id"]))

    def found(n: Column) -> Column:
        row = _struct(idx=x["idx"], frame_id=F.element_at(n["stack"], -1)["id"], entry=n["entry"], parent_at_entry=n["parent"], synthetic_id=F.when(x["synthetic"], n["next"]))
        return _struct(stack=n["stack"], next=n["next"] + x["synthetic"].cast("bigint"), out=F.concat(state["out"], F.array(row)))

    return _with(now, found)


def _frames(rows: Column) -> Column:
    """Of a transaction's opcodes (idx, level, synthetic) in order: idx, frame_id, entry, parent_at_entry, synthetic_id."""
    none = F.array().cast(_OUT)
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / STEP).cast("int")), lambda k: F.slice(rows, k * STEP + 1, F.lit(STEP)))
    begin = _struct(stack=F.array(_struct(level=F.lit(1), id=F.lit(0).cast("bigint"))).cast(_STACK), next=F.lit(1).cast("bigint"), outs=F.array().cast(f"array<{_OUT}>"))

    def part(state: Column, xs: Column) -> Column:
        inner = F.aggregate(xs, _struct(stack=state["stack"], next=state["next"], out=none), _step)
        return _with(inner, lambda s: _struct(stack=s["stack"], next=s["next"], outs=F.concat(state["outs"], F.array(s["out"]))))

    return F.flatten(F.aggregate(parts, begin, part)["outs"])


def _inner_gas(df: DataFrame, key: list[str]) -> DataFrame:
    """(key, idx, inner): gas of the opcodes one level down before the next opcode that isn't deeper. An opcode stands in each level from its
    own up to the one below the next opcode; the last one that stands in the level above another is that one's owner."""
    up_to = F.greatest(F.col("depth"), F.coalesce(F.col("next_depth") - 1, F.col("depth")))
    stands = df.select(*key, "idx", F.explode(F.sequence("depth", up_to)).alias("level"), F.struct("idx", "depth").alias("of"), F.lit(0).cast("long").alias("gas"))
    asks = df.select(*key, "idx", (F.col("depth") - 1).alias("level"), F.lit(None).cast("struct<idx: bigint, depth: int>").alias("of"), F.col("gas_used").alias("gas"))
    so_far = Window.partitionBy(*key, "level").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = stands.unionByName(asks).withColumn("owner", F.last("of", ignorenulls=True).over(so_far)).where("of is null and owner.depth = level")
    return owned.groupBy(*key, F.col("owner.idx").alias("idx")).agg(F.sum("gas").alias("inner"))


def with_frames_and_gas(traces: DataFrame, key: list[str] = KEY, precompile_frames: bool = False) -> DataFrame:
    """Traces with the columns of ``frames.with_frames`` and ``frames.with_gas``, next_words (memory words at the frame's next opcode) and
    created_top (the top of the stack at the next opcode that isn't deeper)."""
    t = in_trace(key)
    so_far = t.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = traces.withColumns({"target": call_target(F.col("op"), F.col("call_to_address"), F.col("s2")), "depth": F.coalesce(F.last("depth", ignorenulls=True).over(so_far), F.lit(1)).cast("int")})
    df = df.withColumns({"next_depth": F.lead("depth").over(t), "call_type": F.lag("op").over(t), "tracer_target": F.lag("call_to_address").over(t), "before": F.lag("depth").over(t)})
    synthetic = immediate_return(F.col("op"), F.col("target"), F.col("depth"), F.col("next_depth"))
    if not precompile_frames:
        synthetic = synthetic & ~F.coalesce(is_precompile(F.col("target")), F.lit(False))
    df = df.withColumn("synthetic", synthetic)

    # the next opcode that isn't deeper: an opcode at which the depth falls stands in each level that it leaves
    look = F.struct("depth", "gas", "mem_size", "s1")
    df = df.withColumn("up", F.explode(F.sequence(F.lit(0), F.greatest(F.coalesce(F.col("before") - F.col("depth"), F.lit(0)), F.lit(0)))))
    df = df.withColumn("after", F.lead(look).over(Window.partitionBy(*key, F.col("depth") + F.col("up")).orderBy("idx"))).where("up = 0").drop("up", "before")
    same = F.col("after.depth") == F.col("depth")
    traced = F.coalesce(F.first("gas_used").over(t.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(0)) > 0
    computed = F.when(same & (F.col("after.gas") <= F.col("gas")), F.col("gas") - F.col("after.gas")).otherwise(F.col("gas_cost"))
    df = df.withColumns({
        "gas_used": F.when(traced, F.coalesce("gas_used", F.lit(0))).otherwise(computed), "next_words": F.when(same, words(F.coalesce("after.mem_size", F.lit(0)))), "created_top": F.col("after.s1"),
    }).drop("after")

    order = F.array_sort(F.collect_list(F.struct(F.col("idx").cast("long").alias("idx"), F.greatest("depth", F.lit(1)).alias("level"), "synthetic")))
    frames = df.groupBy(*key).agg(order.alias("rows")).select(*key, F.explode(_frames(F.col("rows"))).alias("x")).select(*key, "x.*")
    df = df.join(frames, [*key, "idx"]).join(_inner_gas(df, key), [*key, "idx"], "left")
    own = F.when(F.col("op").isin(CALLS + CREATES), F.greatest(F.col("gas_used") - F.coalesce("inner", F.lit(0)), F.lit(0).cast("long"))).otherwise(F.col("gas_used"))
    return df.withColumn("gas_self", own.cast("long")).drop("inner")
