"""Reconciliation of two datasets (Q12): as bags, by key, or row by row in order.

Columns are matched by position (names ignored).  Whole numbers and decimals
are compared exactly; where either side is a floating-point number both are
rounded to ``ndp`` decimals; everything else is compared as trimmed text, also
where only one side is a number.  NULL equals NULL.

``reconcile`` ignores row order (a distributed frame has none of its own).  Each
distinct row is counted per side in one aggregation, equal copies combined in
the map tasks; there is no join, so a crowded key never becomes one join task.
``reconcile_ordered`` numbers the rows of each side by a stated order and
compares the rows of equal number.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.functions.numeric import round_half_up
from stagewise.operators.ordered import row_index


def _compared(left: DataFrame, right: DataFrame, ndp: int) -> tuple[list[Column], list[Column]]:
    """Both sides' columns as c0, c1, … of types that compare."""
    sides: tuple[list, list] = ([], [])
    for i, (a, b) in enumerate(zip(left.schema.fields, right.schema.fields)):
        kinds = (a.dataType, b.dataType)
        if all(isinstance(k, T.IntegralType) for k in kinds):
            make = lambda c: c.cast("long")
        elif all(isinstance(k, (T.IntegralType, T.DecimalType)) for k in kinds):
            scale = max(k.scale if isinstance(k, T.DecimalType) else 0 for k in kinds)
            make = lambda c, s=scale: c.cast(T.DecimalType(38, s))
        elif all(isinstance(k, T.NumericType) for k in kinds):
            make = lambda c: round_half_up(c.cast("double"), ndp)
        else:
            make = lambda c: F.trim(c.cast("string"))
        for side, field in zip(sides, (a, b)):
            side.append(make(F.col(f"`{field.name}`")).alias(f"c{i}"))
    return sides


def reconcile(left: DataFrame, right: DataFrame, keys: list[int] | None = None,
              ndp: int = 3) -> DataFrame:
    """Differences between ``left`` and ``right`` (empty DataFrame = they match).

    Without ``keys``: each distinct row present more often on one side, once,
    with ``side`` ('left_only' / 'right_only') and ``copies`` (how many more).

    With ``keys`` (column positions): one row per key whose rows differ, with
    ``side`` ('left_only' / 'right_only': the other side has no row of the key;
    'differs'), the rows of the key on each side, how many of them have no
    equal on the other side, and ``diff_columns``: the differing positions
    where the key stands once on both sides, '*' where it repeats.

    Unequal numbers of columns are a difference in themselves: one row with
    ``side`` 'shape'."""
    spark = left.sparkSession
    if len(left.columns) != len(right.columns):
        return spark.createDataFrame([("shape", f"{len(left.columns)} and {len(right.columns)} columns")],
                                     "side string, diff_columns string")
    own, other = _compared(left, right, ndp)
    a, b = left.select(*own), right.select(*other)
    names = a.columns
    counted = (a.withColumn("_l", F.lit(1)).withColumn("_r", F.lit(0))
               .unionByName(b.withColumn("_l", F.lit(0)).withColumn("_r", F.lit(1)))
               .groupBy(*names).agg(F.sum("_l").alias("_nl"), F.sum("_r").alias("_nr")))
    if not keys:
        side = F.when(F.col("_nl") > F.col("_nr"), "left_only").otherwise("right_only")
        return (counted.where(F.col("_nl") != F.col("_nr"))
                .select(*names, side.alias("side"), F.abs(F.col("_nl") - F.col("_nr")).alias("copies")))
    kcols = [names[i] for i in keys]
    vals = [c for c in names if c not in kcols]
    row = F.struct(*[F.col(c) for c in vals]) if vals else F.struct(F.lit(1).alias("_"))
    extra = lambda x, y: F.sum(F.greatest(F.col(x) - F.col(y), F.lit(0)))
    per_key = counted.groupBy(*kcols).agg(
        F.sum("_nl").alias("left_rows"), F.sum("_nr").alias("right_rows"),
        extra("_nl", "_nr").alias("left_extra"), extra("_nr", "_nl").alias("right_extra"),
        F.max(F.when(F.col("_nl") > F.col("_nr"), row)).alias("_L"),
        F.max(F.when(F.col("_nr") > F.col("_nl"), row)).alias("_R")
    ).where((F.col("left_extra") > 0) | (F.col("right_extra") > 0))
    each = F.array_compact(F.array(*[F.when(~F.col(f"_L.{c}").eqNullSafe(F.col(f"_R.{c}")), F.lit(c))
                                     for c in vals])) if vals else F.array().cast("array<string>")
    side = (F.when(F.col("right_rows") == 0, "left_only").when(F.col("left_rows") == 0, "right_only")
            .otherwise("differs"))
    columns = (F.when((F.col("left_rows") == 0) | (F.col("right_rows") == 0), "")
               .when((F.col("left_rows") == 1) & (F.col("right_rows") == 1), F.array_join(each, ",")).otherwise("*"))
    return per_key.select(*kcols, side.alias("side"), columns.alias("diff_columns"),
                          "left_rows", "right_rows", "left_extra", "right_extra")


def reconcile_ordered(left: DataFrame, right: DataFrame, left_order: Sequence[str | Column],
                      right_order: Sequence[str | Column] | None = None, ndp: int = 3) -> DataFrame:
    """The rows that differ when both sides are read in order: ``row_index``
    (0-based), ``side`` ('left_only' / 'right_only' past the shorter side's end,
    else 'differs'), ``diff_columns`` (the differing positions) and both sides'
    values as text, ``l0``, ``r0``, ….  No row: the sides are equal in order.

    An order is a list of columns (names: ascending, NULLs last; or any sort
    expressions over that side), an ordinal column if there is one.  Rows that tie in it are ordered by their compared values, so ties of equal
    rows don't count as moved.  Without ``right_order`` the left one's is used.

    Numbering is distributed (``ordered.row_index``) and the numbers are unique,
    so the full join meets neither crowded keys nor one task."""
    if len(left.columns) != len(right.columns):
        return reconcile(left, right)
    names = [f"c{i}" for i in range(len(left.columns))]

    def numbered(df: DataFrame, compared: list[Column], order: Sequence[str | Column], name: str) -> DataFrame:
        by = [F.col(f"`{c}`").asc_nulls_last() if isinstance(c, str) else c for c in order]
        ties = [F.col(f"{name}.{c}").asc_nulls_last() for c in names]
        return row_index(df.withColumn(name, F.struct(*compared)), [*by, *ties]).select("row_index", name)

    own, other = _compared(left, right, ndp)
    a = numbered(left, own, left_order, "_l")
    b = numbered(right, other, right_order or left_order, "_r")
    each = F.array_compact(F.array(*[F.when(~F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")), F.lit(c)) for c in names]))
    side = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").otherwise("differs")
    return (a.join(b, "row_index", "full").where(~F.col("_l").eqNullSafe(F.col("_r")))
            .select("row_index", side.alias("side"), F.when(side == "differs", F.array_join(each, ",")).otherwise("").alias("diff_columns"),
                    *[F.col(f"{s}.{c}").cast("string").alias(f"{s[1]}{c[1:]}") for c in names for s in ("_l", "_r")]))


def first_differences(diff: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` differing rows of ``reconcile_ordered`` (a top-k)."""
    return diff.orderBy("row_index").limit(n)


def reconcile_verdict(diff: DataFrame) -> bool:
    """True when ``reconcile`` found no difference (one cheap action)."""
    return diff.isEmpty()
