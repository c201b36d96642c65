"""Stored tables: created from the declared schemas, loaded strictly, counted
from their footers (S1, S3, S7)."""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.session import shared_path
from stagewise.sources.readers import read_declared_csv
from stagewise.sources.schemas import SCHEMAS, TABLE_COMMENTS


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """A database for tables and views; ``location`` defaults to a folder of the
    shared one (``spark.checkpoint.dir``), deleted when the session's JVM ends."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION {_text(location or shared_path(spark, name))}")
    return name


def create_declared_table(spark: SparkSession, table: str, database: str | None = None, replace: bool = False) -> str:
    """S3: an empty stored table with the declared columns, types and comment;
    an existing one is an error unless ``replace``."""
    name = f"{database}.{table}" if database else table
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SCHEMAS[table].fields)
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet COMMENT {_text(TABLE_COMMENTS[table])}")
    return name


@contextmanager
def _strict(spark: SparkSession):
    """Inserts that accept no lossy conversion."""
    key = "spark.sql.storeAssignmentPolicy"
    before = spark.conf.get(key)
    spark.conf.set(key, "STRICT")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def insert_strictly(df: DataFrame, name: str) -> DataFrame:
    """Append ``df`` to a stored table, columns matched by name; a column that is
    missing, unknown or of a type that might lose something fails the whole insert."""
    spark = df.sparkSession
    target = spark.table(name).columns
    if set(df.columns) != set(target):
        raise ValueError(f"{name} has the columns {target}, not {df.columns}")
    with _strict(spark):
        df.select(*[F.col(f"`{c}`") for c in target]).write.insertInto(name)
    return spark.table(name)


def load_declared_csv(spark: SparkSession, path: str, table: str, database: str | None = None, sep: str = ",") -> DataFrame:
    """A comma CSV with a header into its declared table.  A malformed row
    fails the load, and a failed load leaves the table as it was (the job
    commits its files as a whole)."""
    return insert_strictly(read_declared_csv(spark, path, table, sep), f"{database}.{table}" if database else table)


def table_comment(spark: SparkSession, name: str) -> str | None:
    """The comment of a stored table or view."""
    said = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Comment'").first()
    return said["data_type"] if said else None


def stored_row_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One row per stored Parquet table (name → path) with its number
    of rows, answered from the files' footers: the count is pushed into the
    source and no column is read.

    That needs Spark's second file source, which a session of its own switches
    on; the caller's session stays as it is.  (A table without any footer gives
    that source's count no row to add up, hence the 0.)"""
    own = spark.newSession()
    first = [x for x in own.conf.get("spark.sql.sources.useV1SourceList").split(",") if x != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(first))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    parts = [own.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), F.coalesce(F.nullif("n_rows", F.lit(-1)), F.lit(0)).alias("n_rows"))
             for name, path in paths.items()]
    return reduce(DataFrame.unionByName, parts)
