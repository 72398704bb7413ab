"""Column functions over intensities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from umbra.functions.text import col


def finite(c: Column | str) -> Column:
    """Not-a-number and infinities as missing."""
    v = col(c).cast("double")
    # Not-a-number compares as larger than infinity.
    return F.when(F.abs(v) < F.lit(float("inf")), v)


def to_number(c: Column | str) -> Column:
    """Text as a double; anything unreadable is missing."""
    return finite(F.trim(col(c)).try_cast("double"))


def zero_as_missing(c: Column | str, enabled: bool = True) -> Column:
    v = finite(c)
    return F.when(v != 0, v) if enabled else v


def log2(c: Column | str) -> Column:
    """log2 of a positive value, otherwise missing."""
    return F.when(col(c) > 0, F.log2(col(c)))


def delog2(c: Column | str) -> Column:
    return F.pow(F.lit(2.0), col(c).cast("double"))


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, missing when b is missing or zero."""
    d = col(b).cast("double")
    return col(a) / F.when(d != 0, d)


def percent(n: Column | str, d: Column | str, digits: int = 1) -> Column:
    return F.round(F.lit(100.0) * col(n) / F.nullif(col(d), F.lit(0)), digits)


def all_true(c: Column) -> Column:
    """Aggregate: at least one row and every row true."""
    return F.coalesce((F.count("*") > 0) & F.every(F.coalesce(c, F.lit(False))), F.lit(False))
