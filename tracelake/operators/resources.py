"""Memory words, memory expansion gas, cold access and the split of precompile gas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions import CALLS, call_has_value, extcodecopy_size, is_precompile, parse_hex_u64
from tracelake.operators.frames import KEY, immediate_return, in_frame

U32 = 4294967295
# fixed values: gas of the machine's rules
WARM, COLD_ACCOUNT, TWO_COLD, VALUE, NEW_ACCOUNT, COPY_WORD = 100, 2600, 5200, 9000, 25000, 3
COLD_SSTORE, COLD_SELFDESTRUCT = [22100, 5000, 2200], [7600, 32600]


def words(size: Column) -> Column:
    """32-byte words of a size; sizes are 32-bit, and their sum with 31 wraps."""
    return F.floor(((size.cast("long") + 31) % (U32 + 1)) / 32).cast("long")


def expansion_gas(before: Column, after: Column) -> Column:
    """Gas for growing memory from ``before`` to ``after`` words: 3 a word and the square over 512, each term an integer."""

    def cost(w: Column) -> Column:
        return 3 * w + F.floor((w * w).cast("decimal(38,0)") / 512).cast("long")

    return F.when(after > before, cost(after) - cost(before)).otherwise(F.lit(0)).cast("long")


def returned_words(op: Column, offset: Column, size: Column) -> Column:
    """Words of memory that RETURN and REVERT reach with their operands; null for others. Sums beyond 32 bits are clamped to the largest size."""
    end = parse_hex_u64(offset) + parse_hex_u64(size)
    end = F.when(end > U32, F.lit(U32)).otherwise(end).cast("long")
    return F.when(op.isin("RETURN", "REVERT") & size.isNotNull() & (end > 0), words(end))


def with_memory(frames: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Adds words_before, words_after and mem_exp; all 0 if the trace has no memory sizes."""
    whole = Window.partitionBy(*key)
    size = F.coalesce(F.col("mem_size"), F.lit(0))
    known = F.max(size).over(whole) > 0
    df = frames.withColumns({"has_memory": known, "words_before": F.when(known, words(size)).otherwise(F.lit(0)).cast("long")})
    last = F.greatest(F.col("words_before"), returned_words(F.col("op"), F.col("s1"), F.col("s2")))
    df = df.withColumn("words_after", F.when(F.col("has_memory"), F.coalesce(F.lead("words_before").over(in_frame(key)), last)).otherwise(F.lit(0)).cast("long"))
    return df.withColumn("mem_exp", expansion_gas(F.col("words_before"), F.col("words_after"))).drop("has_memory")


def _less(a: Column, b: Column) -> Column:
    return F.greatest(a - b, F.lit(0).cast("long"))


def cold_access(op: Column, gas_cost: Column, gas_self: Column, mem_exp: Column, tracer: Column, value: Column, copy_size: Column) -> Column:
    """Cold accesses of an opcode, 0 to 2. ``value``: whether a call transfers value; ``copy_size``: bytes that EXTCODECOPY copies."""
    rest = _less(gas_self, mem_exp)
    sent = _less(rest, F.lit(VALUE))
    sent = F.when(sent > TWO_COLD, _less(sent, F.lit(NEW_ACCOUNT))).otherwise(sent)
    call = F.when(op.isin("CALL", "CALLCODE") & value, sent).otherwise(rest)
    calls = F.when(F.coalesce(is_precompile(tracer), F.lit(False)), 0).when(call >= TWO_COLD, 2).when(call >= COLD_ACCOUNT, 1).otherwise(0)
    copy = _less(rest, F.floor((copy_size + 31) / 32).cast("long") * COPY_WORD)
    return (
        F.when(op.isin("SLOAD", "BALANCE", "EXTCODESIZE", "EXTCODEHASH"), (gas_cost > WARM).cast("int"))
        .when(op == "SSTORE", gas_cost.isin(COLD_SSTORE).cast("int"))
        .when(op == "SELFDESTRUCT", gas_cost.isin(COLD_SELFDESTRUCT).cast("int"))
        .when(op == "EXTCODECOPY", (copy >= COLD_ACCOUNT).cast("int"))
        .when(op.isin(CALLS), calls)
        .otherwise(0)
        .cast("long")
    )


def with_cold(frames: DataFrame) -> DataFrame:
    """Adds cold; needs gas_self and mem_exp."""
    value = call_has_value(F.col("call_transfers_value"), F.col("s3"))
    size = extcodecopy_size(F.col("ext_code_copy_size"), F.col("s4"))
    return frames.withColumn("cold", cold_access(F.col("op"), F.col("gas_cost"), F.col("gas_self"), F.col("mem_exp"), F.col("call_to_address"), value, size))


def with_precompile_split(frames: DataFrame) -> DataFrame:
    """Adds precompile_gas and own_gas: a call of a precompile keeps its overhead (100 and memory), the rest is the precompile's."""
    at_once = immediate_return(F.col("op"), F.col("target"), F.col("depth"), F.col("next_depth"))
    overhead = F.col("mem_exp") + WARM
    split = at_once & F.coalesce(is_precompile(F.col("target")), F.lit(False)) & (F.col("gas_self") > overhead)
    return frames.withColumns({"precompile_gas": F.when(split, F.col("gas_self") - overhead).otherwise(F.lit(0)).cast("long"), "own_gas": F.when(split, overhead).otherwise(F.col("gas_self")).cast("long")})
