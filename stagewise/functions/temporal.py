"""Timestamp / interval expressions (work on TIMESTAMP and TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stagewise.functions._util import col_of

_MICROS_PER_HOUR = 3_600_000_000.0


def hours_between(start, end) -> Column:
    """``EXTRACT(EPOCH FROM end - start) / 3600`` as a double (negative if reversed)."""
    micros = F.timestamp_diff("MICROSECOND", col_of(start), col_of(end))
    return micros.cast("double") / F.lit(_MICROS_PER_HOUR)


def month_label(ts) -> Column:
    """``to_char(date_trunc('month', ts), 'YYYY-MM')``."""
    return F.date_format(col_of(ts), "yyyy-MM")


def day(ts) -> Column:
    """``ts::date``."""
    return F.to_date(col_of(ts))


def month_series(first, last) -> Column:
    """``generate_series(first, last)`` as an array; empty when ``last < first``
    (a bare ``sequence`` would count downwards instead)."""
    a, b = col_of(first).cast("int"), col_of(last).cast("int")
    return F.when(b >= a, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
