"""Missing-value, finiteness and tolerance expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def nan_to_null(col: Column) -> Column:
    """NaN means missing everywhere; NULL is the only marker used past ingest."""
    return F.nanvl(col, F.lit(None).cast("double"))


def is_finite(col: Column) -> Column:
    """True for ordinary numbers, false for NaN and both infinities, NULL for NULL."""
    return F.abs(col) < F.lit(INFINITY)


def is_infinite(col: Column) -> Column:
    return F.abs(nan_to_null(col)) == F.lit(INFINITY)


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` that is NULL when the denominator is 0 or missing."""
    return num / F.nullif(den, F.lit(0.0))


def is_close(a: Column, b: Column, rtol: float, atol: float) -> Column:
    """Tolerance test relative to ``b``; a missing side is never close.

    Infinities are close only to themselves, so they go through equality.
    """
    within = F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)
    both_finite = is_finite(a) & is_finite(b)
    comparable = ~(F.isnan(a) | F.isnan(b))
    return F.coalesce(comparable & ((a == b) | (both_finite & within)), F.lit(False))


# Moves exact ties (x.xxxxxx5) off the rounding edge, where the last bit of a sum would decide.
TIE_BREAK = 1e-10


def tidy(col: Column, digits: int = 6) -> Column:
    """Rounded value without NaN or negative zero, for stable comparisons."""
    return F.round(nan_to_null(col) + F.lit(TIE_BREAK), digits) + F.lit(0.0)
