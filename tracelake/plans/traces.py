"""From flat traces to the opcode table (one row an opcode) and the frame table (one row a frame and one a frame and opcode).

Input: ``traces`` (see operators.frames.normal) and ``transactions`` with the same key and transaction_index, to_address, trace_gas (gas of
the receipt, after refunds), trace_failed and trace_return_value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions import format_address, has_error
from tracelake.operators import frames as fr
from tracelake.operators import resources as rs
from tracelake.operators import segmented as sg
from tracelake.operators import sequential as sq
from tracelake.plans.store import dealt, settle

KEY = fr.KEY
CALL_TYPES = ["CALL", "CALLCODE", "DELEGATECALL", "STATICCALL", "CREATE", "CREATE2"]


def annotated(traces: DataFrame, key: list[str] = KEY, precompile_frames: bool = False, fallback: bool = True, created: bool = True, longest: int | None = None, chunk_rows: int = sg.CHUNK_ROWS, use_tracer_create_address: bool = False, resolve_targets: bool = False) -> DataFrame:
    """Traces with frames, gas, memory, cold access and the precompile split, and the addresses that creates made, if ``created``. One
    exchange by the key serves all of it. A first pass over keys, places and depths asks whether any trace is malformed (``fallback`` off:
    the source is known to be well formed); only then is the input split, and those transactions take the sequential way.

    A trace is one task, unless ``longest`` is given: traces with more opcodes are cut in chunks of ``chunk_rows`` places, which are finished
    side by side (``operators.segmented``). That takes one more pass, over the keys alone.

    ``use_tracer_create_address``: see ``operators.frames.with_created``. ``resolve_targets``: tracer_target, which only a tracer's address
    fills otherwise, is that of the opcode before the frame - a call's operand, the address that a create made."""
    created = created or resolve_targets
    options = {"use_tracer_create_address": use_tracer_create_address, "resolve_targets": resolve_targets}
    df = fr.normal(traces)
    if longest is not None:
        giants = df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > longest).select(*key)
        if not giants.isEmpty():
            odd = sg.malformed(df.join(giants, key, "left_semi"), key, chunk_rows) if fallback else None
            whole = giants if odd is None else giants.join(odd, key, "left_anti")
            rows = sg.annotated(df.join(whole, key, "left_semi"), settle, key, precompile_frames, created, chunk_rows, **options)
            return annotated(traces.join(whole, key, "left_anti"), key, precompile_frames, fallback, created, **options).unionByName(rows)
    regular = lambda rows: _finish(fr.with_gas(fr.with_frames(rows, key, precompile_frames), key), key, created, **options)
    if not fallback or fr.with_malformed(df.select(*key, "idx", "depth"), key).where("malformed").isEmpty():
        return regular(df)
    df = fr.with_malformed(df, key)
    odd = sq.with_frames_and_gas(df.where("malformed").drop("malformed"), key, precompile_frames)
    return regular(df.where(~F.col("malformed")).drop("malformed")).unionByName(_finish_sequential(odd, key, created, **options))


def _finish(df: DataFrame, key: list[str], created: bool, use_tracer_create_address: bool, resolve_targets: bool) -> DataFrame:
    if created:
        df = fr.with_created(df, key, use_tracer_create_address)
    if resolve_targets:
        df = fr.with_resolved_targets(df, key)
    return rs.with_precompile_split(rs.with_cold(rs.with_memory(df, key)))


def _finish_sequential(df: DataFrame, key: list[str], created: bool, use_tracer_create_address: bool, resolve_targets: bool) -> DataFrame:
    """The same columns for rows whose neighbours in the frame were found in order."""
    size = F.coalesce(F.col("mem_size"), F.lit(0))
    known = F.max(size).over(Window.partitionBy(*key)) > 0
    create = F.col("op").isin("CREATE", "CREATE2")
    df = df.withColumns({"has_memory": known, "words_before": F.when(known, rs.words(size)).otherwise(0).cast("long")})
    if created:
        traced = F.coalesce(F.min_by(F.col("call_to_address").isNotNull(), F.when(create, F.col("idx"))).over(Window.partitionBy(*key)), F.lit(False))
        address = F.when(traced, F.col("call_to_address") if use_tracer_create_address else F.lit(None)).otherwise(format_address(F.col("created_top")))
        df = df.withColumn("target", F.when(create, address).otherwise(F.col("target")))
    if resolve_targets:
        df = fr.with_resolved_targets(df, key)
    after = F.coalesce(F.col("next_words"), F.greatest(F.col("words_before"), rs.returned_words(F.col("op"), F.col("s1"), F.col("s2"))))
    df = df.withColumn("words_after", F.when(F.col("has_memory"), after).otherwise(0).cast("long")).withColumn("mem_exp", rs.expansion_gas(F.col("words_before"), F.col("words_after")))
    return rs.with_precompile_split(rs.with_cold(df)).drop("has_memory", "next_words", "created_top")


#: Columns of annotated traces that the opcode table is made of.
OPCODE = "idx op gas gas_cost gas_used gas_self depth return_data refund error target frame_id entry synthetic synthetic_id parent_at_entry".split()


def with_paths(df: DataFrame, key: list[str] = KEY, about: DataFrame | None = None) -> DataFrame:
    """Adds path for every row, and the columns of ``about`` (a row a transaction; rows of others go). The rows are written once, the frames
    are found from them, and joined to them. All exchanges are dealt by rows, and the wide rows go through one."""
    df = settle(fr.with_begins(df, key), "annotated")
    n = df.count() if about is None else max(df.count(), about.count())
    paths = fr.frame_paths(dealt(fr.frame_table(df, key), *key, rows=n), key)
    if about is not None:
        paths = paths.join(dealt(about, *key, rows=n), key)
    by = [*key, "frame_id"]
    return dealt(df.drop("begins"), *by, rows=n).join(dealt(paths, *by, rows=n), by)


def opcode_table(traces: DataFrame, transactions: DataFrame, key: list[str] = KEY, fallback: bool = True, longest: int | None = None, use_tracer_create_address: bool = False) -> DataFrame:
    """One row an opcode, and one (operation '') for each call of a plain account that returns at once; traces without opcodes give none.
    call_to_address of creates in traces with the tracer's addresses is null, or with ``use_tracer_create_address`` the tracer's."""
    # memory, cold access and precompile gas are not asked for, so they are not computed
    about = transactions.select(*key, "transaction_index", F.col("trace_gas").alias("transaction_gas"), F.col("trace_failed").alias("transaction_failed"), F.nullif(F.nullif("trace_return_value", F.lit("")), F.lit("0x")).alias("transaction_return_value"))
    df = with_paths(annotated(traces, key, False, fallback, longest=longest, use_tracer_create_address=use_tracer_create_address).select(*key, *OPCODE), key, about)
    real = F.struct(
        F.col("op").alias("operation"), "gas", "gas_cost", "gas_used", "gas_self", F.col("depth").cast("long").alias("depth"), "return_data", "refund", "error", F.col("frame_id").alias("call_frame_id"), F.col("path").alias("call_frame_path")
    )
    zero = F.lit(0).cast("long")
    null = F.lit(None)
    made = F.struct(
        F.lit("").alias("operation"), zero.alias("gas"), zero.alias("gas_cost"), zero.alias("gas_used"), zero.alias("gas_self"), (F.col("depth") + 1).cast("long").alias("depth"), null.cast("string").alias("return_data"),
        null.cast("long").alias("refund"), F.col("error"), F.col("synthetic_id").alias("call_frame_id"), F.concat("path", F.array("synthetic_id")).alias("call_frame_path"),
    )
    rows = df.withColumn("r", F.explode(F.when(F.col("synthetic"), F.array(real, made)).otherwise(F.array(real))))
    return rows.select(*key, F.col("idx").alias("index"), "r.*", F.col("target").alias("call_to_address"), *about.columns[len(key) :])


def frame_rows(df: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Real and synthetic rows with the order ``seq`` in which the machine went through them: one row of the trace gives one or two."""
    zero, null = F.lit(0).cast("long"), F.lit(None)
    entry = lambda c: F.when(F.col("entry"), F.col(c))
    each = {
        "frame_id": ("frame_id", "synthetic_id"), "seq": (F.col("idx") * 2, F.col("idx") * 2 + 1), "op": ("op", F.lit("")), "gas": ("gas", zero), "used": ("gas_used", "precompile_gas"), "self": ("own_gas", "precompile_gas"),
        "err": (has_error(F.col("error")).cast("long"), zero), "refund": ("refund", null.cast("long")), "depth": (F.col("depth").cast("long"), (F.col("depth") + 1).cast("long")), "words_before": ("words_before", zero), "words_after": ("words_after", zero),
        "mem_exp": ("mem_exp", zero), "cold": ("cold", zero), "call_type": (entry("call_type"), "op"), "call_target": (entry("tracer_target"), "target"), "parent": (entry("parent_at_entry"), "frame_id"),
    }
    row = lambda k: F.struct(*((F.col(v[k]) if isinstance(v[k], str) else v[k]).alias(c) for c, v in each.items()))
    return df.select(*key, F.explode(F.when(F.col("synthetic"), F.array(row(0), row(1))).otherwise(F.array(row(0)))).alias("r")).select(*key, "r.*")


SUMS = {
    "memory_words_sum_before": "words_before",
    "memory_words_sum_after": "words_after",
    "memory_words_sq_sum_before": "words_before * words_before",
    "memory_words_sq_sum_after": "words_after * words_after",
    "memory_expansion_gas": "mem_exp",
    "cold_access_count": "cold",
}


def _sums():
    return [F.sum(F.expr(e)).cast("long").alias(c) for c, e in SUMS.items()]


def frame_opcodes(rows: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Per frame and opcode ('' for a synthetic frame's row): counts, gas, errors, depths (1 is the top) and resource sums, and what a
    frame's summary needs of its first and last rows."""
    return rows.groupBy(*key, "frame_id", F.col("op").alias("operation")).agg(
        F.count("*").alias("opcode_count"), F.sum("err").alias("error_count"), F.sum("self").alias("gas"), F.sum("used").alias("gas_cumulative"), F.min("depth").alias("min_depth"), F.max("depth").alias("max_depth"), *_sums(),
        F.min(F.struct("seq", "gas", "depth")).alias("first"), F.max(F.struct("seq", "gas", "used")).alias("last"), F.max(F.coalesce("refund", F.lit(0))).alias("refund"), F.max("call_type").alias("call_type"), F.max("call_target").alias("call_target"), F.max("parent").alias("parent"),
    )


STATS = ["opcode_count", "error_count", "gas", "gas_cumulative", "min_depth", "max_depth", *SUMS]


def opcode_stats(opcodes: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Per frame and opcode: counts, gas, errors, depths (1 is the top) and resource sums."""
    return opcodes.where("operation <> ''").select(*key, "frame_id", "operation", *STATS)


def frame_summaries(opcodes: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Per frame: what its opcodes say, gas_cumulative (what it and the frames below it used), and the list of its ``opcode_stats``."""
    df = opcodes.groupBy(*key, "frame_id").agg(
        F.sum(F.when(F.col("operation") != "", F.col("opcode_count")).otherwise(0)).alias("opcode_count"), F.sum("error_count").alias("error_count"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.max("refund").alias("max_refund"), F.max("call_type").alias("entry_type"), F.max("call_target").alias("entry_target"), F.max("parent").alias("parent_call_frame_id"), *(F.sum(c).cast("long").alias(c) for c in SUMS),
        F.collect_list(F.when(F.col("operation") != "", F.struct("operation", *STATS))).alias("opcodes"),
    )
    spent = F.when(F.col("first.gas") >= F.col("last.gas"), F.col("first.gas") - F.col("last.gas")).otherwise(0)
    df = df.withColumns({"first_gas": F.col("first.gas"), "last_gas": F.col("last.gas"), "last_used": F.col("last.used"), "first_depth": F.col("first.depth")})
    return df.withColumn("gas_cumulative", (spent + F.col("last_used")).cast("long")).drop("first", "last")


def frame_parents(opcodes: DataFrame, key: list[str] = KEY) -> DataFrame:
    """One row a frame, as ``operators.frames.frame_paths`` asks for it."""
    return opcodes.groupBy(*key, "frame_id").agg(F.max("parent").alias("parent_id"), F.min(F.struct("first.seq", "first.depth"))["depth"].alias("level"))


def with_own_gas(frames: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Adds gas: gas_cumulative without that of the direct children. For one window each frame stands once more at its parent, so that this
    needs no exchange behind one by the key."""
    row = lambda at, own, inner: F.struct(F.col(at).alias("at"), F.lit(own).alias("own"), inner.cast("long").alias("inner"))
    places = F.array(row("frame_id", True, F.lit(None)), row("parent_call_frame_id", False, F.col("gas_cumulative")))
    df = frames.withColumn("place", F.explode(F.when(F.col("parent_call_frame_id").isNull(), F.slice(places, 1, 1)).otherwise(places)))
    df = df.withColumn("inner", F.sum("place.inner").over(Window.partitionBy(*key, F.col("place.at")))).where("place.own")
    return df.withColumn("gas", F.greatest(F.col("gas_cumulative") - F.coalesce("inner", F.lit(0)), F.lit(0).cast("long"))).drop("inner", "place")


def intrinsic_gas(cumulative, refund, receipt):
    """Gas charged before execution; null if none. A refund of a quarter of the receipt or more was capped."""
    quarter = F.floor(receipt.cast("decimal(20,0)") / 4)
    charged = F.when(refund >= quarter, F.floor(receipt.cast("decimal(20,0)") * 5 / 4).cast("long") - cumulative).otherwise(receipt + refund - cumulative)
    return F.when((receipt > 0) & (charged > 0), charged).cast("long")


def call_type(op):
    return F.when(op.isin(CALL_TYPES), op).otherwise("UNKNOWN")


def frame_agg_table(traces: DataFrame, transactions: DataFrame, key: list[str] = KEY, fallback: bool = True, longest: int | None = None, resolve_targets: bool = False) -> DataFrame:
    """One summary row (operation '') a frame and one row a frame and opcode; transactions without opcodes give one summary row.
    target_address of a frame that an opcode opened is the tracer's, else null, or with ``resolve_targets`` what its operand or the created
    address says."""
    rows = annotated(traces, key, True, fallback, created=False, longest=longest, resolve_targets=resolve_targets)
    by_opcode = settle(frame_opcodes(frame_rows(rows, key), key), "frame-opcodes")
    n = max(by_opcode.count(), transactions.count())
    at = lambda df, *more: dealt(df, *key, *more, rows=n)
    paths = fr.frame_paths(frame_parents(at(by_opcode), key), key)
    frames = with_own_gas(frame_summaries(at(by_opcode), key), key).join(at(transactions.select(*key, "transaction_index", "to_address", "trace_gas", "trace_failed")), key)
    frames = at(frames, "frame_id").join(at(paths.withColumnRenamed("path", "call_frame_path"), "frame_id"), [*key, "frame_id"])
    root = F.col("frame_id") == 0
    errors = F.when(root & F.col("trace_failed") & (F.col("error_count") == 0), 1).otherwise(F.col("error_count"))
    refund = F.when(F.col("errors") > 0, 0).otherwise(F.col("max_refund")).cast("long")
    frames = frames.withColumn("errors", errors).withColumns({
        "refund": F.when(root, refund).otherwise(0).cast("long"),
        "depth": F.when(root, 0).otherwise(F.col("first_depth") - 1).cast("long"),
        "target_address": F.when(root, F.col("to_address")).otherwise(F.col("entry_target")),
        "call_type": F.when(root, "").otherwise(call_type(F.col("entry_type"))),
        "intrinsic_gas": F.when(root, intrinsic_gas(F.col("gas_cumulative"), refund, F.col("trace_gas"))),
    })
    about = ["frame_id", "parent_call_frame_id", "call_frame_path", "depth", "target_address", "call_type"]
    zero = F.lit(0).cast("long")
    summary = F.struct(
        F.lit("").alias("operation"), "opcode_count", F.col("errors").cast("long").alias("error_count"), "gas", "gas_cumulative", F.col("depth").alias("min_depth"), F.col("depth").alias("max_depth"), F.col("refund").alias("gas_refund"), "intrinsic_gas", *SUMS
    )
    stats = lambda x: F.struct(
        x["operation"].alias("operation"), x["opcode_count"].alias("opcode_count"), x["error_count"].cast("long").alias("error_count"), *(x[c].alias(c) for c in ("gas", "gas_cumulative", "min_depth", "max_depth")), zero.alias("gas_refund"), F.lit(None).cast("long").alias("intrinsic_gas"), *(x[c].alias(c) for c in SUMS)
    )
    out = frames.select(*key, *about, "transaction_index", F.explode(F.concat(F.array(summary), F.transform("opcodes", stats))).alias("r")).select(*key, *about, "r.*", "transaction_index")
    idle = simple_transfers(at(by_opcode.select(*key)), transactions, key)
    return out.unionByName(idle).withColumnRenamed("frame_id", "call_frame_id")


def simple_transfers(traces: DataFrame, transactions: DataFrame, key: list[str] = KEY) -> DataFrame:
    """The single frame of each transaction that ``traces``, any table of all opcodes' keys, has no row of: all its gas is intrinsic."""
    zero = F.lit(0).cast("long")
    idle = transactions.join(traces.select(*key), key, "left_anti")
    return idle.select(
        *key, zero.alias("frame_id"), F.lit(None).cast("long").alias("parent_call_frame_id"), F.array(zero).alias("call_frame_path"), zero.alias("depth"), F.col("to_address").alias("target_address"), F.lit("").alias("call_type"),
        F.lit("").alias("operation"), zero.alias("opcode_count"), F.col("trace_failed").cast("long").alias("error_count"), zero.alias("gas"), zero.alias("gas_cumulative"), zero.alias("min_depth"), zero.alias("max_depth"), zero.alias("gas_refund"),
        F.col("trace_gas").cast("long").alias("intrinsic_gas"), *[zero.alias(c) for c in SUMS], "transaction_index",
    )


def resource_gas(frame_agg: DataFrame, by: list[str]) -> DataFrame:
    """Gas of the opcodes by ``by``, split into memory expansion, cold access and the rest (compute)."""
    each = F.when(F.col("operation") == "SLOAD", 2000).when(F.col("operation") == "SSTORE", 2100).otherwise(2500)
    df = frame_agg.where("operation <> ''").withColumn("cold_gas", F.col("cold_access_count") * each)
    df = df.groupBy(*by).agg(F.sum("gas").alias("gas"), F.sum("memory_expansion_gas").alias("memory_gas"), F.sum("cold_gas").alias("cold_gas"))
    return df.withColumn("compute_gas", F.col("gas") - F.col("memory_gas") - F.col("cold_gas"))
