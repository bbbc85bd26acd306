"""Exact unsigned 128-bit numbers. Spark's widest decimal has 38 digits, 2^128 - 1 has 39: a number is a struct of two limbs in base 10^19,
``hi`` and ``lo``, which compare, take ``least`` and sort as the numbers do. All expressions are native and never raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TYPE = "struct<hi: decimal(20,0), lo: decimal(19,0)>"
#: The limbs of 2^128 - 1.
MOST_HI, MOST_LO = divmod(2**128 - 1, 10**19)
_HI, _LO, _WIDE = "decimal(20,0)", "decimal(19,0)", "decimal(38,0)"
_BASE = str(10**19)


def _limbs(hi: Column, lo: Column) -> Column:
    return F.named_struct(F.lit("hi"), hi.cast(_HI), F.lit("lo"), lo.cast(_LO))


def _with(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def most() -> Column:
    """2^128 - 1."""
    return _limbs(F.lit(str(MOST_HI)), F.lit(str(MOST_LO)))


def from_decimal(c: Column) -> Column:
    """The number of decimal digits; null if it is none or above 2^128 - 1."""
    digits = F.regexp_replace(c, "^0+(?=[0-9])", "")
    fits = F.regexp_like(c, F.lit("^[0-9]+$")) & (F.length(digits) <= 39)
    padded = F.lpad(F.when(fits, digits), 39, "0")
    value = _limbs(F.substring(padded, 1, 20), F.substring(padded, 21, 19))
    return F.when(fits & (value <= most()), value)


def from_number(c: Column) -> Column:
    """The number of a column of integers or decimals without a fraction; null if it is negative."""
    return from_decimal(c.cast(_WIDE).cast("string"))


#: 2^96, 2^64 and 2^32 as limbs: what the parts of 32 bits are multiplied by.
_POWERS = [divmod(2**k, 10**19) for k in (96, 64, 32)]


def _of_parts(parts: Column) -> Column:
    """The number of four parts of 32 bits. No sum comes near 38 digits."""
    term = lambda i, p: parts[i] * F.lit(str(p)).cast(_LO)
    sums = F.named_struct(
        F.lit("hi"), (term(0, _POWERS[0][0]) + term(1, _POWERS[1][0])).cast(_WIDE),
        F.lit("lo"), (term(0, _POWERS[0][1]) + term(1, _POWERS[1][1]) + term(2, _POWERS[2][1]) + parts[3]).cast(_WIDE),
    )
    base = F.lit(_BASE).cast(_HI)
    split = lambda x: F.named_struct(F.lit("hi"), x["hi"], F.lit("lo"), x["lo"], F.lit("more"), F.call_function("div", x["lo"], base))
    return _with(_with(sums, split), lambda x: _limbs(x["hi"] + x["more"], x["lo"] - x["more"].cast(_HI) * base))


def from_hex(c: Column) -> Column:
    """The number of hex digits, with or without 0x; empty is 0; null if it is malformed or above 2^128 - 1."""

    def value(digits: Column) -> Column:
        fits = F.regexp_like(digits, F.lit("^[0-9a-fA-F]{0,32}$"))
        number = lambda x: F.conv(x, 16, 10)
        # 15 digits are below 10^19: the lower limb has them all, as most quantities are
        short = _limbs(F.lit(0), number(F.lpad(digits, 15, "0")))
        parts = _with(F.lpad(digits, 32, "0"), lambda p: F.array(*[number(F.substring(p, i, 8)).cast("decimal(10,0)") for i in (1, 9, 17, 25)]))
        return F.when(fits, F.when(F.length(digits) <= 15, short).otherwise(_with(parts, _of_parts)))

    return _with(F.regexp_replace(c, "^(0x)?0*", ""), value)


def add(a: Column, b: Column) -> Column:
    """a + b, with the carry; null if it is above 2^128 - 1."""
    low = a["lo"].cast(_WIDE) + b["lo"].cast(_WIDE)
    carry = (low >= F.lit(_BASE).cast(_HI)).cast("int")
    value = F.named_struct(F.lit("hi"), a["hi"].cast(_WIDE) + b["hi"].cast(_WIDE) + carry, F.lit("lo"), low - carry * F.lit(_BASE).cast(_HI))
    # hi may have 21 digits here
    highest = F.lit(str(MOST_HI)).cast(_WIDE)
    return _with(value, lambda n: F.when((n["hi"] < highest) | ((n["hi"] == highest) & (n["lo"] <= F.lit(str(MOST_LO)).cast(_LO))), _limbs(n["hi"], n["lo"])))


def to_string(n: Column) -> Column:
    """Decimal digits."""
    digits = _with(n, lambda x: F.concat(x["hi"].cast("string"), F.lpad(x["lo"].cast("string"), 19, "0")))
    return F.regexp_replace(digits, "^0+(?=[0-9])", "")


def to_decimal(n: Column) -> Column:
    """As decimal(38,0); null if it has 39 digits."""
    return to_string(n).try_cast(_WIDE)


def parse(c: Column, nullable: bool = False) -> Column:
    """A decimal string as the tables take it: empty or malformed gives 0, and so does null unless ``nullable``. Above 2^128 - 1 gives null: a
    number that doesn't fit is never taken for another."""
    malformed = ~F.coalesce(F.regexp_like(c, F.lit("^[0-9]+$")), F.lit(False))
    value = F.when(malformed, _limbs(F.lit(0), F.lit(0))).otherwise(from_decimal(c))
    return F.when(c.isNotNull(), value) if nullable else value


def effective_gas_price(kind: Column, gas_price: Column, base_fee: Column, tip_cap: Column, fee_cap: Column) -> Column:
    """As ``prices.effective_gas_price``, of and in exact numbers."""
    zero = _limbs(F.lit(0), F.lit(0))
    offered = add(F.coalesce(tip_cap, zero), base_fee)
    # an offer above all numbers is above the cap
    capped = F.when(fee_cap.isNull(), offered).when(offered.isNull(), fee_cap).otherwise(F.least(offered, fee_cap))
    return F.when((kind <= 1) | base_fee.isNull(), F.coalesce(gas_price, zero)).otherwise(capped)
