"""Row order over tasks: row numbers and running sums without a single-task window.

Rows are dealt to range partitions by their order, sorted inside, and written
once with the number of their partition (``session.materialize``): the ranges
come from a sample, so a second evaluation could cut elsewhere.  What stands
before a partition is then one number per partition (and key), which is summed
up and joined back.  A value or key of any weight is spread over as many
partitions as its rows fill.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewise.session import materialize


def _no_key() -> Column:
    return F.struct(F.lit(0).alias("_"))


def _ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` with ``_part`` (range partition) and ``_at`` (ascends in the order)."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(parts.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranged")


def row_index(df: DataFrame, order: Sequence[Column], name: str = "row_index") -> DataFrame:
    """``df`` with the 0-based place of every row in ``order``.  Rows that tie
    in all of it are dealt their places in no fixed order; a tie of any size is
    spread over partitions."""
    ranged = _ranged(df.withColumn("_tie", F.monotonically_increasing_id()), [*order, F.col("_tie")])
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    behind = Window.partitionBy("_k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = (sizes.withColumn("_k", _no_key())                # one row per partition
              .select("_part", "_first", F.coalesce(F.sum("_n").over(behind), F.lit(0)).alias("_before")))
    return (ranged.join(F.broadcast(before), "_part")
            .withColumn(name, F.col("_before") + F.col("_at") - F.col("_first"))
            .drop("_part", "_at", "_tie", "_before", "_first"))


def running_sums(df: DataFrame, order: str | Sequence[str], sums: dict[str, str],
                 keys: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys`` and distinct value of ``order`` with, for
    each ``column → name`` of ``sums``, the sum of the column over all rows of
    the key up to that value (``SUM() OVER (PARTITION BY … ORDER BY …)`` with its
    default RANGE frame: peers share the sum).  Ascending, NULLs last; NULL
    values are ignored, and a sum over none is NULL.

    Peers are summed in the map tasks first.  Sums inside a range partition and
    a key are a window of that partition's rows; before them stand one sum per
    partition of the key."""
    order, keys = [order] if isinstance(order, str) else list(order), list(keys)
    group = F.struct(*[F.col(k) for k in keys]) if keys else _no_key()
    peers = (df.select(group.alias("_k"), *order, *sums).groupBy("_k", *order)
             .agg(*[F.sum(c).alias(f"_s{i}") for i, c in enumerate(sums)]))
    ranged = _ranged(peers, [F.col("_k"), *[F.col(c).asc_nulls_last() for c in order]])
    inside = Window.partitionBy("_k", "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("_k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_k", "_part").agg(*[F.sum(f"_s{i}").alias(f"_t{i}") for i in range(len(sums))])
    parts = parts.select("_k", "_part", *[F.sum(f"_t{i}").over(before).alias(f"_b{i}") for i in range(len(sums))])
    summed = ranged.select("*", *[F.sum(f"_s{i}").over(inside).alias(f"_i{i}") for i in range(len(sums))])
    if not keys:
        parts = F.broadcast(parts)                       # one row per partition
    both = lambda a, b: F.coalesce(F.col(a) + F.col(b), a, b)
    return (summed.join(parts, ["_k", "_part"])
            .select(*[F.col(f"_k.{k}").alias(k) for k in keys], *order,
                    *[both(f"_b{i}", f"_i{i}").alias(n) for i, n in enumerate(sums.values())]))


def with_running_sum(df: DataFrame, order: str | Sequence[str], value: str, name: str,
                     keys: Sequence[str] = ()) -> DataFrame:
    """Every row of ``df`` with its running sum (RANGE frame, as
    ``running_sums``).  Rows are joined with their peers' sum; a crowded peer
    is left to Spark's skew splitting."""
    at = [*keys, *([order] if isinstance(order, str) else order)]
    found = running_sums(df, order, {value: "_sum"}, keys)
    found = found.select(F.struct(*[F.col(c) for c in at]).alias("_at"), F.col("_sum").alias(name))
    return df.withColumn("_at", F.struct(*[F.col(c) for c in at])).join(found, "_at").drop("_at")
