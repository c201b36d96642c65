"""Presentation-ready chart frames (V1); drawing itself is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.functions.numeric import scale_unit


def chart_frame(df: DataFrame, x: str, y: str, series: str | None = None, kind: str = "line",
                check_empty: bool = False) -> DataFrame:
    """Check that the columns exist (the error lists the available ones), scale
    y to millions when its largest magnitude reaches a million, and order the
    points: lines by (series, x); bars keep the caller's order.  Columns:
    x, series, y (scaled), unit."""
    missing = [c for c in (x, y, series) if c is not None and c not in df.columns]
    if missing:
        raise ValueError(f"no column {missing[0]!r} in the result; available: {', '.join(df.columns)}")
    if check_empty and df.isEmpty():
        raise ValueError("the query returned no rows; nothing to draw")
    div = scale_unit(df.agg(F.max(F.abs(F.col(y).cast("double")))).scalar())     # the largest magnitude, a subquery
    out = df.select(
        F.col(x).alias("x"),
        (F.col(series).cast("string") if series else F.lit("")).alias("series"),
        (F.col(y).cast("double") / div).alias("y"),
        F.when(div > 1, F.lit("mln")).otherwise(F.lit("")).alias("unit"))
    return out.orderBy("series", "x") if kind == "line" else out
