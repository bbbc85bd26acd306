"""Prices and calldata of transactions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracelake.functions import u128

U128 = "decimal(38,0)"


def parse_u128(c: Column, nullable: bool = False) -> Column:
    """Decimal string as number; empty or malformed gives 0, and so does null unless ``nullable``. What 38 digits can't hold is null; ``u128``
    holds it exactly."""
    return u128.to_decimal(u128.parse(c, nullable))


def effective_gas_price(kind: Column, gas_price: Column, base_fee: Column, tip_cap: Column, fee_cap: Column) -> Column:
    """What a unit of gas costs: the price of types 0 and 1 and of blocks without base fee (0 if absent), else min(base + tip, cap)."""
    plain = F.coalesce(gas_price.cast(U128), F.lit(0).cast(U128))
    offered = F.coalesce(tip_cap.cast(U128), F.lit(0).cast(U128)) + base_fee.cast(U128)
    capped = F.least(offered, fee_cap.cast(U128))
    return F.when((kind <= 1) | base_fee.isNull(), plain).otherwise(capped).cast(U128)


def calldata_stats(data: Column) -> dict[str, Column]:
    """Bytes of binary calldata: total, zero and non-zero; null data has none."""
    total = F.coalesce(F.octet_length(data), F.lit(0)).cast("long")
    pairs = F.regexp_replace(F.hex(data), "(..)", "$1 ")
    zeros = F.coalesce(F.regexp_count(pairs, F.lit("00 ")), F.lit(0)).cast("long")
    return {"n_input_bytes": total, "n_input_zero_bytes": zeros, "n_input_nonzero_bytes": total - zeros}
