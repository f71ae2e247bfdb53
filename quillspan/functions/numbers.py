"""Clamps, back-offs, jitter, rounding, and the percentiles of small groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(x: Column, low, high) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def backoff(attempt: Column, base: float = 2.0, factor: float = 2.0, most: float = 60.0) -> Column:
    return F.least(F.lit(base) * F.pow(F.lit(factor), attempt), F.lit(most))


def jitter(position: Column) -> Column:
    """0.9 to 1.1, by multiplicative hashing of the position; reduced first, so that no product overflows."""
    # Fixed value: the multiplier of multiplicative hashing, modulo 1000.
    return F.lit(0.9) + F.lit(0.2) * F.pmod(F.pmod(position, F.lit(1000)) * F.lit(2654435761 % 1000), F.lit(1000)) / F.lit(1000.0)


def nearest_rank(values: Column, p: float) -> Column:
    """Of an array: the value at round(p / 100 * (n - 1)), half to even, in order; 0 for an empty one."""
    s = F.array_sort(values)
    at = F.bround(F.lit(p / 100.0) * (F.size(s) - 1)).cast("int") + 1
    return F.when(F.size(s) > 0, F.element_at(s, at)).otherwise(F.lit(0.0))


def floor_rank(values: Column, share: float, default: float) -> Column:
    """Of an array: the value at floor(share * n), in order; the default for an empty one. Not the same as nearest_rank."""
    s = F.array_sort(values)
    at = F.least(F.floor(F.lit(share) * F.size(s)).cast("int") + 1, F.size(s))
    return F.when(F.size(s) > 0, F.element_at(s, at)).otherwise(F.lit(default))


def fraction(part: Column, whole: Column, digits: int = 6) -> Column:
    """part / whole rounded half to even; 0 if whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.bround(part / F.when(whole != 0, whole), digits))


def ceil_div(a: Column, b: int) -> Column:
    """Integer division, rounded up."""
    return div(a + F.lit(b - 1), b)


def div(a: Column, b: int) -> Column:
    """Integer division, rounded down. A multiple of b is divided, so rounding gives the whole quotient (below 2^51)."""
    return F.round((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("long")
