"""Scalar column functions, all native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _code_units(s: Column) -> Column:
    """UTF-16 code units: a character beyond the basic plane counts as two."""
    chars = F.filter(F.split(s, ""), lambda c: c != "")

    def units(c: Column) -> Column:
        point = F.ascii(c).cast("long")
        over = point - 0x10000
        pair = F.array(F.lit(0xD800) + F.floor(over / 1024), F.lit(0xDC00) + over % 1024)
        return F.when(point > 0xFFFF, pair).otherwise(F.array(point))

    return F.flatten(F.transform(chars, units))


def polynomial_hash(s: Column, factor: int) -> Column:
    """sum(unit * factor^k) modulo 2^32, unsigned, as the 32-bit fold gives it."""
    return F.aggregate(
        _code_units(s), F.lit(0).cast("long"),
        lambda acc, unit: F.pmod(acc * factor + unit, F.lit(1 << 32)),
    )


def signed32(value: Column) -> Column:
    wrapped = F.pmod(value, F.lit(1 << 32))
    return F.when(wrapped >= 1 << 31, wrapped - (1 << 32)).otherwise(wrapped)


def hash_code(s: Column, factor: int) -> Column:
    """String hash (multiplier 31) times ``factor`` minus 10000, in 32-bit arithmetic."""
    return signed32(polynomial_hash(s, 31) * factor - 10000)


def bitmap_offset(s: Column, seed: int = 61, bits: int = 1 << 29) -> Column:
    """Position of ``s`` in a bitmap of ``bits`` (a power of two)."""
    return polynomial_hash(s, seed).bitwiseAND(F.lit(bits - 1))


def day_of_millis(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd")


def minute_second(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "mm:ss")


def floor_to(value: Column, bucket: int) -> Column:
    return value - F.pmod(value, F.lit(bucket))


def web_log_time(s: Column) -> Column:
    return F.try_to_timestamp(s, F.lit("dd/MM/yyyy:HH:mm:ss"))


def absolute_difference(a: Column, b: Column) -> Column:
    return F.abs(a - b)


def prefix_name(name: Column, prefix: str = "Name: ") -> Column:
    return F.concat(F.lit(prefix), name)


def integer_mean(value: Column) -> Column:
    """Mean of whole numbers, truncated; nulls do not count."""
    total, n = F.sum(value.cast("long")), F.count(value)
    return F.when(n > 0, F.call_function("div", total, n))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))
