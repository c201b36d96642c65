"""Operator 10: best-two-fit packing of token sequences.

Every document is encoded with an end id and cut into pieces only where it is
longer than a sequence.  Pieces are dealt at random (by a hash) to groups of
bounded expected size, and every group is packed on its own:

* greedy: a sequence opens with the longest piece left and takes the longest
  piece that fits its gap until none fits;
* best two: the shortest piece of the sequence is taken out if two pieces not
  yet packed fill the gap it leaves (gap plus its length) with more tokens
  than it did; the pair with the greatest sum is put in, the short piece goes
  back to the pool.  This repeats while it gains.

A group works on counts by length (at most ``length`` classes), so its memory
does not depend on how lengths repeat; each group leaves at most about one
part-filled sequence, against thousands of full ones.

Cases: a null or empty text is the end id alone (one piece of length 1); an
empty table gives an empty result; pieces of equal length are taken in
(doc_id, piece) order, those of repeated doc_ids in any; a null doc_id is kept; a full-length piece has a sequence of its own; extra columns of
the input are ignored."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, gathered, map_arrow, raw, shipped, staged, token_ids, vocabulary_path

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, length: int = 4096, end: int = 1, tokenizer: str | None = None,
           key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Documents as token pieces of at most ``length``: doc_id, piece, start,
    length, ids_crc32 and, if asked for, ids (little-endian uint32 bytes)."""
    path = tokenizer or vocabulary_path()
    if docs.schema[key].dataType.typeName() != "long":
        docs = docs.withColumn(key, F.col(key).cast("long"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_ids(path).of
        for block in gathered(batches, "text", 1024, 4 << 20):
            out: list[tuple] = []
            for doc, body in zip(block.column("doc_id").to_pylist(), raw(block.column("text"))):
                ids = encode(body, end)
                for piece, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at: at + 4 * length]
                    out.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part))
            cols = list(zip(*out))
            arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                      *(pa.array(c, pa.int64()) for c in cols[2:5])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays, names = [*arrays, pa.array(cols[5], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_arrow(narrow, cut, PIECE + (", ids binary" if with_ids else ""))


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin number, offset in the bin, and a count of bins, for pieces in the
    order given."""
    order = np.argsort(lengths, kind="stable")
    first = np.searchsorted(lengths[order], np.arange(capacity + 2))   # of each length in ``order``
    left = np.diff(first)                                              # pieces left by length
    used = np.zeros(capacity + 1, np.int64)
    sizes = [int(x) for x in np.flatnonzero(left)]                     # lengths that are left, ascending
    bins: list[list[int]] = []

    def take(size: int) -> None:
        left[size] -= 1
        if not left[size]:
            sizes.pop(bisect_right(sizes, size) - 1)

    def give(size: int) -> None:
        if not left[size]:
            sizes.insert(bisect_right(sizes, size), size)
        left[size] += 1

    while sizes:
        held, gap = [], capacity
        while sizes and sizes[0] <= gap:
            size = sizes[bisect_right(sizes, gap) - 1]
            take(size)
            held.append(size)
            gap -= size
        while gap and held and sizes:
            short = held[-1]                                   # greedy takes them in falling order
            pair = _best_pair(sizes, left, gap + short)
            if pair is None or sum(pair) <= short:
                break
            held.pop()
            give(short)
            for size in pair:
                take(size)
                held.append(size)
            held.sort(reverse=True)
            gap += short - sum(pair)
        bins.append(held)

    number, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for b, held in enumerate(bins):
        at = 0
        for size in held:
            i = order[first[size] + used[size]]
            used[size] += 1
            number[i], offset[i] = b, at
            at += size
    return number, offset, np.int64(len(bins))


def _best_pair(sizes: list[int], left: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two lengths left with the greatest sum that fits ``room``."""
    n = bisect_right(sizes, room)
    if not n:
        return None
    a = np.asarray(sizes[:n])
    j = np.searchsorted(a, room - a, side="right") - 1         # the longest partner of each
    own = (j == np.arange(n)) & (left[a] < 2)                  # a single piece is no pair
    j = np.where(own, j - 1, j)
    total = np.where(j >= 0, a + a[np.maximum(j, 0)], -1)
    best = int(total.argmax())
    return None if total[best] < 0 else (int(a[best]), int(a[j[best]]))


def pack(parts: DataFrame, length: int = 4096, group_rows: int = 20_000) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length, …).

    ``group_rows`` is the mean number of pieces packed together; the number of
    groups follows the number of pieces."""
    spark = parts.sparkSession
    shipped(spark)
    groups = max(1, -(-parts.count() // group_rows))
    schema = parts.schema

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece"], kind="stable").reset_index(drop=True)
        group = int(pdf["group"].iloc[0])
        number, offset, _ = best_two_fit(pdf["length"].to_numpy(np.int64), length)
        pdf["sequence_id"], pdf["offset"] = (group << 32) + number, offset
        return pdf.drop(columns="group")

    dealt = parts.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", *(
        ["ids_crc32"] if "ids_crc32" in parts.columns else [])), F.lit(groups)).cast("int"))
    return dealt.groupBy("group").applyInPandas(
        one, schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The training sequences of packed pieces that carry ids: sequence_id,
    ids (bytes, pieces in offset order), n_tokens, doc_ids, starts."""
    return (packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(
        F.struct("offset", "doc_id", "ids", "length"))).alias("held"))   # a sequence's pieces: bounded by its length
        .select("sequence_id", F.expr("aggregate(held, X'', (a, x) -> a || x.ids)").alias("ids"),
                F.expr("aggregate(held, 0L, (a, x) -> a + x.length)").alias("n_tokens"),
                F.expr("transform(held, x -> x.doc_id)").alias("doc_ids"),
                F.expr("transform(held, x -> x.offset)").alias("starts")))


def op10_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    parts = staged(pieces(documents(spark, sf_dir)), "pieces")
    return pack(parts).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
