"""Catalog helpers: list, count, describe, preview, publish views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_tables(spark: SparkSession, base_only: bool = False) -> DataFrame:
    """Tables and views visible in the session, as a DataFrame; with
    ``base_only`` stored tables without any view."""
    rows = [(t.name, t.tableType, bool(t.isTemporary)) for t in spark.catalog.listTables()
            if not base_only or t.tableType in ("MANAGED", "EXTERNAL")]
    return spark.createDataFrame(rows, "name string, table_type string, is_temporary boolean")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table, ``UNION ALL`` of ``count(*)``."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def columns_of(df: DataFrame) -> DataFrame:
    """Column names and types in ordinal order."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column_name string, data_type string")


def preview(df: DataFrame, order_by: list[str | Column], cols: list[str], n: int = 5) -> DataFrame:
    """Deterministic preview — sort, project, first ``n`` (a top-k, not a sample)."""
    return df.orderBy(*order_by).select(*cols).limit(n)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Create-or-replace a named view; returns the view as a DataFrame."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def drop_view(spark: SparkSession, name: str) -> None:
    """Drop-if-exists."""
    spark.catalog.dropTempView(name)


def read_view(spark: SparkSession, name: str, *order: Column) -> DataFrame:
    """Read back a published view, ordered."""
    df = spark.table(name)
    return df.orderBy(*order) if order else df
