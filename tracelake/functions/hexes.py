"""Hex quantities and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

U32_MAX = 4294967295


def _digits(c: Column) -> Column:
    """The digits without prefix and leading zeros."""
    return F.regexp_replace(c, "^(0x)?0*", "")


def _number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("decimal(20,0)")


def parse_hex_u64(c: Column) -> Column:
    """Unsigned 64-bit value; empty, malformed or too large gives 0, null gives null."""
    digits = _digits(c)
    fits = F.regexp_like(digits, F.lit("^[0-9a-fA-F]{1,16}$"))
    return F.when(c.isNull(), None).when(fits, _number(F.when(fits, digits))).otherwise(F.lit(0).cast("decimal(20,0)"))


def parse_hex_u32(c: Column) -> Column:
    """Unsigned 32-bit value; empty gives 0, malformed or too large gives the largest value, null gives null."""
    digits = _digits(c)
    fits = F.regexp_like(digits, F.lit("^[0-9a-fA-F]{1,8}$"))
    empty = F.regexp_replace(c, "^0x", "") == ""
    zero = F.regexp_like(c, F.lit("^(0x)?0+$"))
    value = F.when(empty | zero, F.lit(0)).when(fits, _number(F.when(fits, digits)).cast("long")).otherwise(F.lit(U32_MAX))
    return F.when(c.isNull(), None).otherwise(value).cast("long")


def is_hex_zero(c: Column) -> Column:
    """Whether the word is empty or all zeros."""
    return F.regexp_like(c, F.lit("^(0x)?0*$"))


def format_address(c: Column) -> Column:
    """A stack word or short number as a 20-byte address; the case of its digits stays."""
    return F.concat(F.lit("0x"), F.lpad(F.right(F.regexp_replace(c, "^0x", ""), F.lit(40)), 40, "0"))


def return_data_hex(c: Column) -> Column:
    """Base64 return data as lower-case hex without prefix."""
    return F.lower(F.hex(F.unbase64(c)))
