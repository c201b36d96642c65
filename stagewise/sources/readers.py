"""Readers: declared CSV loads, raw text exports, numeric inference, SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.sources.schemas import with_comments


def read_declared_csv(spark: SparkSession, path: str, table: str | T.StructType,
                      sep: str = ",") -> DataFrame:
    """Comma CSV with a header into a declared schema.  An unquoted empty
    field is NULL; a malformed row fails the load instead of becoming NULLs."""
    schema = with_comments(table) if isinstance(table, str) else table
    return (spark.read.schema(schema)
            .option("header", True).option("sep", sep)
            .option("mode", "FAILFAST")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .csv(path))


def read_text_export(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """A spreadsheet export (';', UTF-8 with BOM, any header) as all-text
    columns.  Spark drops the BOM itself; nothing is inferred."""
    return (spark.read.option("header", True).option("sep", sep)
            .option("encoding", "UTF-8").option("inferSchema", False)
            .csv(path))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A whole table as a lazy DataFrame (``SELECT *``); never collected."""
    return spark.table(name)


def run_sql(spark: SparkSession, text: str) -> DataFrame | None:
    """Run query text; statements without a result set return ``None``."""
    df = spark.sql(text)
    return df if df.columns else None


# What counts as a number: sign, digits with an optional point, exponent, or
# a spelling of infinity or NaN; the cast alone also takes Java suffixes (12d).
NUMBER = r"(?i)\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|inf(inity)?|nan)\s*"


def to_number(column) -> Column:
    """The value as double, NULL where the text is not a number."""
    text = F.col(column) if isinstance(column, str) else column
    return F.when(text.rlike("^" + NUMBER + "$"), F.trim(text).try_cast("double"))


def infer_numeric(df: DataFrame) -> DataFrame:
    """A text column becomes double iff at least one value parses and no
    non-null value fails.  One aggregation pass (a job) decides for every column."""
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not text_cols:
        return df
    stats = df.agg(*[
        F.struct(F.count(F.col(c)).alias("n"), F.count(to_number(c)).alias("ok")).alias(c)
        for c in text_cols]).first()
    numeric = [c for c in text_cols if stats[c]["ok"] > 0 and stats[c]["ok"] == stats[c]["n"]]
    if not numeric:
        return df
    return df.withColumns({c: to_number(c) for c in numeric})
