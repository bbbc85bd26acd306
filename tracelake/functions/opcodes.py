"""Predicates and operands of opcodes. Operand k of the stack is the column ``s<k>`` (1 is the top); absent operands are null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracelake.functions.hexes import format_address, is_hex_zero, parse_hex_u32

# fixed values: opcode names and the addresses of precompiled contracts (1 to 17, and 256)
CALLS = ["CALL", "CALLCODE", "DELEGATECALL", "STATICCALL"]
CREATES = ["CREATE", "CREATE2"]
PRECOMPILES = [f"0x{n:040x}" for n in [*range(1, 18), 256]]


def is_call(op: Column) -> Column:
    return op.isin(CALLS)


def is_call_or_create(op: Column) -> Column:
    return op.isin(CALLS + CREATES)


def is_precompile(address: Column) -> Column:
    return F.lower(format_address(address)).isin(PRECOMPILES)


def has_error(error: Column) -> Column:
    return F.coalesce(error != "", F.lit(False))


def call_target(op: Column, tracer: Column, s2: Column) -> Column:
    """Target of a call: the tracer's, else the second operand; null for other opcodes without a tracer's address."""
    return F.coalesce(tracer, F.when(is_call(op), format_address(s2)))


def call_has_value(flag: Column, s3: Column) -> Column:
    """Whether a call transfers value: the tracer's flag, else a third operand that isn't zero."""
    return F.coalesce(flag, F.lit(False)) | F.coalesce(~is_hex_zero(s3), F.lit(False))


def extcodecopy_size(size: Column, s4: Column) -> Column:
    """Bytes that EXTCODECOPY copies: the tracer's number if positive, else the fourth operand, else 0."""
    return F.when(size > 0, size.cast("long")).otherwise(F.coalesce(parse_hex_u32(s4), F.lit(0)))
