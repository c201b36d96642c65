"""Exact, linearly interpolated quantiles per group, for groups of any size.

Spark's ``percentile`` merges all distinct values of a group in one task.
Here values are counted first (one row per group and distinct value, combined
in the map tasks; ties are one row), and a target rank is then found by radix
selection on the 64 bits of the values, without ever gathering a group:

1. a value's sign, exponent and mantissa make an integer that sorts as the value
   does; its upper 22 bits are the cell, and running counts over a group's cells
   tell which one holds the rank;
2. the values of that cell fall into 2^21 cells by the next 21 bits, whatever
   their distribution, and running counts again tell the cell;
3. the last 21 bits tell the value.

So a running count reads at most 2^22 rows per group (one per cell), and every
step narrows by a fixed number of bits.  Nothing is sampled, capped or switched
by size, and nothing is written: the counted values are one exchange that all
steps read (NULL is a cell of its own with no weight, so that no step filters
the input differently).  Group columns may be NULL (a group of its own), a group
without values has NULL quantiles, NaN counts as the greatest value, and a frame
without group columns always gives one row.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHIFTS = (42, 21, 0)          # bits below the cells of each step
_NULL = -2**63                # no value has these bits
_INF, _NAN = 0x7FF << 52, 0xFFF << 51


# Aggregates over counted values (``_x`` with multiplicity ``_n``), for ``extra``.
def n_rows() -> Column:
    return F.coalesce(F.sum("_n"), F.lit(0))


def n_values() -> Column:
    return F.coalesce(F.sum(F.when(F.col("_x").isNotNull(), F.col("_n"))), F.lit(0))


def mean() -> Column:
    return F.try_divide(F.sum(F.col("_x") * F.col("_n")), F.sum(F.when(F.col("_x").isNotNull(), F.col("_n"))))


def maximum() -> Column:
    return F.max("_x")


def ordered_bits(x: Column) -> Column:
    """A long that sorts as the double ``x`` does: its magnitude is the IEEE
    pattern (exponent above mantissa), its sign that of ``x``.  Never NULL."""
    size = F.abs(x)
    near = F.floor(F.log2(size)).cast("double")          # off by one next to powers of two
    power = F.pow(F.lit(2.0), near)
    exponent = F.greatest(near + F.when(size >= 2 * power, 1).when(size < power, -1).otherwise(0), F.lit(-1022.0))
    mantissa = size / F.pow(F.lit(2.0), exponent)         # exact; below 1 for subnormal values
    finite = (exponent.cast("long") + 1022) * F.lit(2**52) + (mantissa * F.lit(2.0**52)).cast("long")
    magnitude = (F.when(F.isnan(x), F.lit(_NAN)).when(size == float("inf"), F.lit(_INF))
                 .when(size == 0, F.lit(0)).otherwise(finite))
    return F.coalesce(F.when(x < 0, -magnitude).otherwise(magnitude), F.lit(_NULL))


def counted(df: DataFrame, keys: Sequence[str], x: str) -> DataFrame:
    """``_k`` (the keys as one struct: NULL keys are equal inside it), ``_x`` and
    its multiplicity ``_n``.  Frames counted alike share one exchange."""
    group = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("_"))
    return (df.select(group.alias("_k"), F.col(x).cast("double").alias("_x"))
            .groupBy("_k", "_x").agg(F.count(F.lit(1)).alias("_n")))


def _positions(qs: dict[str, float]) -> list[Column]:
    return [(F.col("_total") - 1).cast("double") * F.lit(float(p)) for p in qs.values()]


def _located(cells: DataFrame, by: Sequence[str], cell: str) -> DataFrame:
    """Of cells with ``_n``, those that hold the rank ``_r``, which becomes the rank inside."""
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy(cell).rowsBetween(Window.unboundedPreceding, 0))
    return (cells.withColumn("_upto", upto).where((F.col("_upto") > F.col("_r")) & (F.col("_upto") - F.col("_n") <= F.col("_r")))
            .withColumn("_r", F.col("_r") - (F.col("_upto") - F.col("_n"))).drop("_upto", "_n"))


def grouped_quantiles(df: DataFrame, keys: Sequence[str], x: str, qs: dict[str, float],
                      extra: Sequence[Column] = ()) -> DataFrame:
    """One row per group: ``keys``, the ``extra`` aggregates (see above) and one
    unrounded column per quantile in ``qs`` (name → probability)."""
    keys = list(keys)
    table = counted(df, keys, x)
    values = table.withColumn("_b", ordered_bits(F.col("_x")))
    first, second, last = SHIFTS
    # every quantile needs the ranks below and above its position
    ranks = F.array_distinct(F.array(*[f(p) for p in _positions(qs) for f in (F.floor, F.ceil)]))
    weight = F.when(F.col("_c") > F.lit(_NULL >> first), F.col("_n")).otherwise(0)
    order = Window.partitionBy("_k").orderBy("_c").rowsBetween(Window.unboundedPreceding, 0)
    low = F.col("_upto") - F.col("_n")
    located = (values.groupBy("_k", F.shiftright("_b", first).alias("_c")).agg(F.sum("_n").alias("_n"))
               .withColumn("_n", weight)
               .withColumns({"_upto": F.sum("_n").over(order), "_total": F.sum("_n").over(Window.partitionBy("_k"))})
               .withColumn("_rank", F.explode(F.filter(ranks, lambda r: (low <= r) & (r < F.col("_upto")))))
               .select("_k", "_total", "_rank", "_c", (F.col("_rank") - low).alias("_r")))
    inside = (values.select("_k", F.shiftright("_b", first).alias("_c"), F.shiftright("_b", second).alias("_d"), "_n")
              .join(located, ["_k", "_c"]).groupBy("_k", "_total", "_rank", "_r", "_d").agg(F.sum("_n").alias("_n")))
    located = _located(inside, ["_k", "_rank"], "_d")
    inside = (values.select("_k", F.shiftright("_b", second).alias("_d"), F.shiftright("_b", last).alias("_b"), "_x", "_n")
              .join(located, ["_k", "_d"]))
    found = _located(inside, ["_k", "_rank"], "_b")

    # interpolate between the two ranks
    at = lambda rank: F.max(F.when(F.col("_rank") == rank, F.col("_x")))
    wide = found.groupBy("_k", "_total").agg(*[at(f(p)).alias(f"_{side}{i}") for i, p in enumerate(_positions(qs))
                                               for side, f in (("a", F.floor), ("z", F.ceil))])
    value = lambda i, p: F.when(F.floor(p) == F.ceil(p), F.col(f"_a{i}")).otherwise(
        (F.ceil(p) - p) * F.col(f"_a{i}") + (p - F.floor(p)) * F.col(f"_z{i}"))
    wide = wide.select("_k", *[value(i, p).alias(n) for i, (n, p) in enumerate(zip(qs, _positions(qs)))])
    # the rows are counted and used, so that the groups come from the same counted values
    aggs = [*extra, n_rows().alias("_rows")]
    base = (table.groupBy("_k").agg(*aggs) if keys else
            table.agg(*aggs).withColumn("_k", F.struct(F.lit(0).alias("_")))).where("_rows >= 0")
    out = base.join(wide, "_k", "left").drop("_rows")
    return out.select(*[F.col(f"_k.{k}").alias(k) for k in keys], *[c for c in out.columns if c != "_k"])
