"""Generic relational building blocks shared by the composite operators."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.functions.numeric import pct

_UNORDERABLE = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def with_labels(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """present columns under display labels (any characters: spaces, ₽, %,
    Cyrillic).  DataFrame aliases need no quoting; in Spark SQL text such
    labels must be back-quoted."""
    return df.select(*[F.col(c).alias(labels.get(c, c)) for c in df.columns])


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def full_order(df: DataFrame, first: Sequence[Column], skip: Sequence[str] = ()) -> list[Column]:
    """``first`` followed by every other orderable column ascending, NULLs last —
    a total order, so "the first row" never depends on task scheduling."""
    rest = [F.col(f.name).asc_nulls_last() for f in df.schema.fields
            if f.name not in skip and not isinstance(f.dataType, _UNORDERABLE)]
    return list(first) + rest


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (``DISTINCT ON``).

    ``row_number() = 1`` is planned as a WindowGroupLimit that runs *before*
    the shuffle, so a key holding a third of all rows still sends only one row
    per map task across the network."""
    keys = _keys(key)
    w = Window.partitionBy(*keys).orderBy(*full_order(df, order, skip=keys))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def flag_repeats(df: DataFrame, key: str | Sequence[str], order: Sequence[Column],
                 name: str = "is_repeat", chunk: int = 1000) -> DataFrame:
    """Every row of a key except the first is flagged (pandas ``duplicated``).

    Equal rows are interchangeable, so rows are counted first (the one exchange
    of all rows, copies combined in the map tasks).  The first distinct row per
    key is limited in the tasks before its exchange, sent to the place of its
    equal (a crowded key's rows lie apart) and found there by a join that moves
    the counted rows no further; only its copies are numbered.  Rows with more than
    ``chunk`` copies are dealt over the tasks in chunks before they are written
    out again.  Columns must be comparable (no maps)."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")    # NULLs are equal inside a struct
    counted = df.select(row).groupBy("_row").agg(F.count(F.lit(1)).alias("_n"))
    # the count is used here too, so that both sides read one exchange
    firsts = first_per_key(counted.where("_n > 0").select("_row.*"), key, order).select(row, F.lit(True).alias("_first"))
    found = counted.join(firsts, "_row", "left")
    dealt = (found.where(F.col("_n") > chunk)
             .withColumn("_lo", F.explode(F.sequence(F.lit(1), F.col("_n"), F.lit(chunk))))
             .repartition("_row", "_lo").withColumn("_hi", F.least(F.col("_n"), F.col("_lo") + chunk - 1)))
    some = found.where(F.col("_n") <= chunk).withColumns({"_lo": F.lit(1).cast("long"), "_hi": F.col("_n")})
    copies = F.explode(F.sequence("_lo", "_hi"))
    return (some.unionByName(dealt).select("_row", "_first", copies.alias("_copy"))
            .select("_row.*", (F.col("_first").isNull() | (F.col("_copy") > 1)).alias(name)))


def with_share(grouped: DataFrame, count_col: str, out: str = "share_pct", n: int = 1) -> DataFrame:
    """``100 * x / sum(x) OVER ()`` without a single-partition window: the
    one-row total is an aggregate of the grouped frame, whose exchange both
    uses share."""
    total = grouped.agg(F.sum(count_col).alias("_total"))
    return (grouped.crossJoin(F.broadcast(total))                # one row
            .withColumn(out, pct(F.col(count_col), F.col("_total"), n)).drop("_total"))


def pivot_counts(df: DataFrame, row: str, col: str, values: dict[str, str]) -> DataFrame:
    """Cross-tab of counts with fixed columns (value → output name), 0 for
    empty cells.  Explicit values avoid an extra job to discover them."""
    p = df.groupBy(row).pivot(col, list(values)).agg(F.count(F.lit(1)))
    p = p.na.fill(0, subset=list(values))
    return p.select(row, *[F.col(f"`{v}`").alias(name) for v, name in values.items()])


def top_n(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    """Top-n by a measure, key as tie-break (TakeOrderedAndProject)."""
    return df.orderBy(F.col(measure).desc_nulls_last(), F.col(key).asc_nulls_last()).limit(n)


def top_n_with_ties(df: DataFrame, measure: str, n: int) -> DataFrame:
    """``rank() <= n`` without a global window: the n-th value comes from a
    top-n subquery, then a filter keeps every tied row."""
    first = df.select(measure).where(F.col(measure).isNotNull()).orderBy(F.col(measure).desc()).limit(n)
    return df.where(F.col(measure) >= first.agg(F.min(measure)).scalar())


def bucket(x, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """F8: half-open buckets ``[-inf,e1) [e1,e2) ... [ek,inf)`` → label."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    xc = x if isinstance(x, Column) else F.col(x)
    expr = None
    for e, lab in zip(edges, labels):
        expr = F.when(xc < e, lab) if expr is None else expr.when(xc < e, lab)
    return expr.otherwise(labels[-1])
