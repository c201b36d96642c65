"""Numeric expressions with SQL-style (half away from zero) rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stagewise.functions._util import col_of

# Doubles are snapped to this decimal before rounding, so that values whose
# binary form sits a hair below a half (1.005 -> 1.00499999...) still round the
# way a NUMERIC column would.  38 digits leave room for very large sums.
_SNAP = "decimal(38,6)"


def round_half_up(c, n: int = 0) -> Column:
    """``round(x::numeric, n)`` of the SQL dialect: half away from zero, double
    out.  Values beyond 32 digits (and NaN) have no fraction to round and pass
    unchanged."""
    x = col_of(c)
    return F.coalesce(F.round(x.try_cast(_SNAP), n).cast("double"), x.cast("double"))


def pct(num, den, n: int = 1) -> Column:
    """``round(100.0 * num / den, n)``; NULL (not an error) when ``den`` is 0."""
    ratio = F.try_divide(F.lit(100.0) * col_of(num).cast("double"), col_of(den).cast("double"))
    return round_half_up(ratio, n)


def as_money(c) -> Column:
    """Money as an exact ``decimal(18,2)`` (sums stay exact)."""
    return col_of(c).cast("decimal(18,2)")


def scale_unit(max_abs: Column, threshold: float = 1_000_000.0) -> Column:
    """Divisor for axis labels: 1e6 when the largest magnitude reaches a million."""
    return F.when(max_abs >= threshold, F.lit(threshold)).otherwise(F.lit(1.0))
