"""Sinks (S10)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True,
              mode: str = "errorifexists", bom: bool = False) -> None:
    """CSV with a chosen delimiter, header and minimal quoting, written in
    parallel, one file per partition; an existing target is an error unless
    ``mode`` says otherwise.  With ``bom`` every file begins with the
    UTF-8 byte order mark (it stands before the header, which is needed)."""
    if bom and not header:
        raise ValueError("a byte order mark needs a header")
    if bom:
        first = df.columns[0]
        df = df.withColumnRenamed(first, "\ufeff" + first)
    (df.write.mode(mode).option("header", header).option("sep", sep)
       .option("quoteAll", False).option("encoding", "UTF-8")
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "errorifexists") -> DataFrame:
    """Save ``df`` as a catalog table hash-bucketed (and sorted) by ``key``.

    Two tables bucketed by the same key into the same number of buckets join
    without any shuffle: each task reads matching buckets of both.  The table
    lands in the session's warehouse (``spark.sql.warehouse.dir``, shared
    storage on a cluster)."""
    (df.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return df.sparkSession.table(table)


def save_table(df: DataFrame, table: str, comment: str | None = None, mode: str = "errorifexists") -> DataFrame:
    """Save ``df`` as a catalog table with its comment (S3)."""
    df.write.mode(mode).saveAsTable(table)
    if comment:
        quoted = comment.replace("\\", "\\\\").replace("'", "\\'")
        df.sparkSession.sql(f"COMMENT ON TABLE {table} IS '{quoted}'")
    return df.sparkSession.table(table)
