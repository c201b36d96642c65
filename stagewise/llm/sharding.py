"""Operator 1: contiguous shards of near-equal byte size.

Documents are put in doc_id order by a range exchange.  Every partition adds
up its own sizes; the totals of the partitions (one row each) give every
partition its offset in the global byte order, and the shard of a document is
the equal target into which the middle of its byte range falls.

Only the narrow (key, size, checksum) rows are exchanged, never the texts.

Cases: a null text has size 1 (the separator); an empty table gives an empty
result; rows with equal or null keys are ordered by size and checksum, and
rows equal in these three as well are interchangeable; a document larger than a target takes
one shard and the shards it spans stay empty; extra columns of the input are
ignored, whatever their names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_text, documents, map_arrow, staged


def _prefix_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, rows, total = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        size = batch.column("size").to_numpy(zero_copy_only=False).astype(np.int64)
        before = total + np.cumsum(size) - size
        at = np.arange(rows, rows + len(size), dtype=np.int64)
        rows, total = rows + len(size), total + int(size.sum())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "size", "text_crc32")),
             pa.array(np.full(len(size), part, np.int32)), pa.array(at), pa.array(before)],
            names=["doc_id", "size", "text_crc32", "part", "at", "before"])


def shard(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text",
          partitions: int | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot (place in
    the shard, gapless from 0), first_byte (its global byte offset).

    Shard sizes differ by at most one document's size from the equal target."""
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"),
                         (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
                         crc32_text(text).cast("long").alias("text_crc32"))
    order = ["doc_id", "size", "text_crc32"]
    ordered = narrow.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    local = staged(map_arrow(ordered, _prefix_sums, "doc_id long, size long, text_crc32 long, "
                             "part int, at long, before long"), "shard-prefix")
    # one row per partition: its offset is the sum of those before it
    totals = (local.groupBy("part").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
              .orderBy("part").collect())
    offsets, rows, size = [], 0, 0
    for t in totals:
        offsets.append((t["part"], size, rows))
        size, rows = size + t["size"], rows + t["n"]
    offsets = spark.createDataFrame(offsets, "part int, first_size long, first_row long")
    whole = max(size, 1)
    placed = (local.join(F.broadcast(offsets), "part")   # as many rows as there are partitions
              .withColumn("first_byte", F.col("before") + F.col("first_size"))
              .withColumn("row", F.col("at") + F.col("first_row"))
              .withColumn("shard", F.least(F.lit(shards - 1), F.expr(
                  f"((2 * CAST(first_byte AS DECIMAL(30,0)) + size) * {shards}) div (2 * CAST({whole} AS DECIMAL(20,0)))"))
                  .cast("int")))
    # shards are contiguous: a shard's first row is the least of its partitions' first rows
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return (placed.join(F.broadcast(firsts), "shard")    # at most ``shards`` rows
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("row") - F.col("first")).alias("slot"), "first_byte"))


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "first_byte")
