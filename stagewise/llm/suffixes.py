"""Operator 7: repeated passages by a sparse suffix array over words.

Every run of ``min_words`` words has one kept suffix: the least hash of an
``anchor``-word run among the first ``window`` places (the first of equals).
The choice depends on the words alone, so equal runs keep the same one, and
``depth = min_words - window + 1`` words of the run follow it at least.  A kept
suffix stands for all neighbouring runs that keep it.  The suffixes are sorted
by a hash of their first ``depth`` words, with a range exchange whose keys
include the document, so a crowded beginning spreads over partitions; only
those that begin like the one before or after them stay (and the first and last
of a partition, whatever stands beside them).

The runs of the suffixes that stay are then compared whole: the least document
with each run is found by a min that combines in the map tasks, and every
other document's run is paired with it.  So a document is reported if and only
if a document of lesser id has ``min_words`` of its words in a row, whatever
else begins alike.  Runs on one diagonal of two documents that overlap or touch
are one passage; its words are compared by a second hash and it is extended
word by word to the left and to the right in both texts, by at most ``window +
anchor`` words.  (Where it goes on, either its runs do too, or an earlier
document has them and rows of their own.)

Equal texts are told apart first, by digest.  Positions, hashes and short
contexts of the passages' ends are exchanged; texts are exchanged twice, for
the runs and for the contexts.

Cases: null, empty and short texts have no suffix; documents with a null
doc_id have no place in the order and are left out; passages inside one
document are not reported; equal rows count as one document; an empty table
gives an empty result; extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, documents, gathered, map_arrow, raw, staged
from .runs import matched, runs_hash
from .substrings import _copies

SUFFIX = "doc_id long, words int, first int, runs int, k long"


def suffixes(docs: DataFrame, min_words: int, anchor: int, window: int) -> DataFrame:
    """The kept suffixes of (doc_id, text): the text's words, the place of the
    first run that keeps it, how many runs do, and a hash of its beginning."""
    depth = min_words - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for block in gathered(batches, most_rows=512, most_bytes=1 << 20):
            cols: list[list[np.ndarray]] = [[], [], [], [], []]
            for i, body in enumerate(raw(block.column("text"))):
                words = body.split()
                n = len(words) - min_words + 1
                if n < 1:
                    continue
                h = hashes.of(words)
                at = np.lib.stride_tricks.sliding_window_view(runs_hash(h, anchor), window)[:n].argmin(1) + np.arange(n)
                first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                for col, x in zip(cols, (np.full(len(first), i), np.full(len(first), len(h)), first, np.diff(np.append(first, n)),
                                         runs_hash(h, depth)[at[first]])):
                    col.append(x)
            if cols[0]:
                doc, size, first, runs, k = (np.concatenate(c) for c in cols)
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id").combine_chunks().take(pa.array(doc)),
                     *(pa.array(x.astype(np.int32)) for x in (size, first, runs)), pa.array(k.view(np.int64))],
                    names=["doc_id", "words", "first", "runs", "k"])

    return map_arrow(docs.select("doc_id", "text"), run, SUFFIX)


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted suffixes, those that begin like a neighbour, and the
    partition's first and last."""
    held = None                                             # the last suffix so far, and whether it stays
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column("k").to_numpy()
        same = np.append(held is None or held[0].column("k")[0].as_py() == k[0], k[1:] == k[:-1])
        if held is not None and (held[1] or same[0]):
            yield held[0].select(["doc_id", "first", "runs"])
        stays = same | np.append(same[1:], False)
        yield batch.slice(0, len(k) - 1).filter(pa.array(stays[:-1])).select(["doc_id", "first", "runs"])
        held = batch.slice(len(k) - 1), stays[-1]
    if held is not None:
        yield held[0].select(["doc_id", "first", "runs"])


def repeated_passages(docs: DataFrame, min_words: int = 50, anchor: int = 8, window: int = 24,
                      key: str = "doc_id", text: str = "text", partitions: int | None = None) -> DataFrame:
    """One row per passage of at least ``min_words`` words that a document
    shares with the least document that has ``min_words`` words of it: doc_id
    (the greater id), start, size (bytes of its UTF-8 text), words, first_word,
    other_doc_id, other_first_word, exact_copy (the whole text is equal)."""
    spark = docs.sparkSession
    if min_words - window + 1 < anchor:
        raise ValueError("min_words must be at least window + anchor - 1")
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id is not null")
    later = staged(_copies(texts), "suffix-copies").where("doc_id > first_doc_id").distinct()
    every = staged(suffixes(texts, min_words, anchor, window), "suffixes")
    kept = every.join(later.select("doc_id"), "doc_id", "left_anti").select("doc_id", "first", "runs", "k")
    order = ["k", "doc_id", "first"]
    stays = map_arrow(kept.repartitionByRange(partitions, *order).sortWithinPartitions(*order), _beside,
                      "doc_id long, first int, runs int")
    full = matched(stays, texts, min_words, window + anchor)
    whole = (every.where("first = 0").select("doc_id", F.col("words").cast("long").alias("words")).join(later, "doc_id")
             .select("doc_id", F.lit(0).cast("long").alias("start"), F.col("size").cast("long").alias("size"), "words",
                     F.lit(0).cast("long").alias("first_word"), F.col("first_doc_id").alias("other_doc_id"),
                     F.lit(0).cast("long").alias("other_first_word"), F.lit(True).alias("exact_copy")).distinct())
    return full.unionByName(whole)


def op7_sparse_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir))
