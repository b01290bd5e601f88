"""HALF_UP rounding for report measures, exact where the values allow it.

``ROUND(AVG(double), n)`` depends on the summation order of the doubles, so
two engines (or two runs with a different partitioning) can round an exact
half differently.  Measures of values below ``EXACT_BELOW`` are therefore
computed in DECIMAL: readings carry at most a few decimals, DECIMAL(18, 6)
holds them exactly, and the average / percentage is exact before the HALF_UP
rounding.  A group with a larger value is computed in DOUBLE, as plain
arithmetic would.  The result is returned as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VALUE_DECIMAL = "decimal(18,6)"
EXACT_BELOW = 1e12


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact(c: Column) -> Column:
    """The value as DECIMAL; NULL from ``EXACT_BELOW`` on."""
    return c.try_cast(VALUE_DECIMAL)


def round_half_up(c: Column | str, scale: int) -> Column:
    """ROUND(x, scale) HALF_UP on the decimal value of x, as DOUBLE."""
    c = _col(c)
    return F.when(F.abs(c) < EXACT_BELOW, F.round(exact(c), scale).cast("double")).otherwise(F.round(c, scale))


def avg_half_up(c: Column | str, scale: int) -> Column:
    """Aggregate: ROUND(AVG(x), scale), computed in DECIMAL where all values allow it."""
    c = _col(c)
    return F.when(F.max(F.abs(c)) < EXACT_BELOW, F.round(F.avg(exact(c)), scale).cast("double")).otherwise(F.round(F.avg(c), scale))


def pct_half_up(part: Column | str, total: Column | str, scale: int = 2) -> Column:
    """ROUND(part * 100 / total, scale), exact; NULL when total is 0 or NULL."""
    p = _col(part).cast("decimal(20,0)")
    t = _col(total).cast("decimal(20,0)")
    return F.round(F.try_divide(p * F.lit(100), t), scale).cast("double")
