"""Aggregate expressions with deterministic results.

Sums of doubles depend on the order rows meet in a shuffle.  The measures
here are sums of values that are already rounded to a fixed number of
decimals, so they are summed exactly as decimals and only the final value is
turned back into a double.  Result: the same number on every run and every
cluster layout, and equal to an independent SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def count_if(cond: Column) -> Column:
    """count(when(cond, True)): rows where cond is true (NULL counts as false)."""
    return F.count(F.when(cond, F.lit(True)))


def exact_sum(col: Column | str, scale: int, precision: int = 18) -> Column:
    """Order-independent sum of values carrying ``scale`` decimals (decimal)."""
    return F.sum(_c(col).cast(f"decimal({precision},{scale})"))


def exact_avg_rounded(col: Column | str, in_scale: int, out_scale: int) -> Column:
    """round(avg(col), out_scale) computed exactly; NULL for no non-NULL values.

    ``sum(decimal) / count`` keeps at least 12 decimals for any count below
    10^10, so the single HALF_UP rounding is exact (``avg(decimal)`` keeps only
    ``in_scale + 4`` decimals and would round twice).
    """
    c = _c(col)
    total = F.sum(c.cast(f"decimal(18,{in_scale})"))
    n = F.count(c)
    return F.round(F.try_divide(total, n), out_scale).cast("double")


def mode_of(value: Column | str, weight: Column | str) -> Column:
    """Value with the largest weight; ties go to the largest value (NULL lowest).

    Deterministic replacement of ``max_by(value, weight)`` whose tie-break is
    unspecified.
    """
    return F.max_by(_c(value), F.struct(_c(weight), _c(value)))
