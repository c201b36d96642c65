"""Runs of words that documents share (operators 3 and 7).

The callers find where documents may have ``min_words`` words in a row with
another one; here those runs are compared whole, each with the least document
that has it, and joined to passages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _STEP, WordHashes, gathered, map_arrow, mixed, raw, staged


def runs_hash(h: np.ndarray, n: int) -> np.ndarray:
    """``windows_hash`` by doubling: the same values in some 2 log n steps."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out, done, block, size, factor = h[:0], 0, h, 1, int(_STEP)
    while True:
        if n & 1:
            out = out[: len(block) - done] * np.uint64(factor) + block[done:] if done else block
            done += size
        n >>= 1
        if not n:
            return mixed(out)
        block = block[:-size] * np.uint64(factor) + block[size:]
        factor, size = factor * factor % 2**64, 2 * size


def _runs(stays: DataFrame, texts: DataFrame, min_words: int) -> DataFrame:
    """(w, check, doc_id, pos, start, stop, turn, at, step, times) of every run of
    the ones that stay: a hash of its words' hashes and one of its words, its
    place in words and in bytes, the first place ``at`` of an equal run in the
    document, and how often that one returns: ``times`` places, ``step`` apart.
    ``turn`` numbers a run's own returns.  Only returns that overlap or touch
    count; they are what a text that repeats a few words is made of."""
    asked = stays.groupBy("doc_id").agg(F.collect_list(F.struct("first", "runs")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for block in gathered(batches, most_rows=256, most_bytes=1 << 20):
            lists = block.column("asked").combine_chunks()
            ends, flat = np.append(0, np.cumsum(lists.value_lengths().to_numpy())), lists.flatten()
            first, runs = (flat.field(c).to_numpy() for c in ("first", "runs"))
            cols: list[list[np.ndarray]] = [[] for _ in range(10)]
            for doc, body, a, b in zip(block.column("doc_id").to_pylist(), raw(block.column("text")), ends, ends[1:]):
                words = body.split()
                w = runs_hash(hashes.of(words), min_words)
                mark = np.zeros(len(w) + 1, np.int64)
                np.add.at(mark, first[a:b], 1)
                np.add.at(mark, first[a:b] + runs[a:b], -1)
                pos = np.flatnonzero(np.cumsum(mark[:-1]))
                _, of_first, same = np.unique(w[pos], return_index=True, return_inverse=True)
                joined, edges = b" ".join(words), np.append(0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1))
                check = [xxhash.xxh3_64_intdigest(joined[x:y])
                         for x, y in zip(edges[pos].tolist(), (edges[pos + min_words] - 1).tolist())]
                starts, stops = _word_places(body)
                for col, x in zip(cols, (w[pos].view(np.int64), np.array(check, np.uint64).view(np.int64),
                                         np.full(len(pos), doc, np.int64), pos, starts[pos], stops[pos + min_words - 1],
                                         *_returns(pos, same, len(of_first), min_words))):
                    col.append(x)
            w, check, doc, *places = (np.concatenate(c) for c in cols)
            yield pa.RecordBatch.from_arrays(
                [pa.array(w), pa.array(check), pa.array(doc), *(pa.array(x.astype(np.int32)) for x in places)],
                names=["w", "check", "doc_id", "pos", "start", "stop", "turn", "at", "step", "times"])

    return map_arrow(texts.join(asked, "doc_id").select("doc_id", "text", "asked"), run,
                     "w long, check long, doc_id long, pos int, start int, stop int, turn int, at int, step int, times int")


def _returns(pos: np.ndarray, same: np.ndarray, n: int, reach: int) -> tuple[np.ndarray, ...]:
    """turn, at, step and times of runs at the ascending places ``pos``, of
    which those with equal ``same`` (of ``n`` values) are equal."""
    if n == len(pos):
        return np.zeros(n, np.int64), pos, np.zeros(n, np.int64), np.ones(n, np.int64)
    order = np.argsort(same, kind="stable")
    group, place, i = same[order], pos[order], np.arange(len(pos))
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    gap = np.append(0, np.diff(place))
    fresh = gap > reach
    fresh[begin] = True
    turn = np.empty_like(pos)
    turn[order] = i - np.maximum.accumulate(np.where(fresh, i, 0))
    # the first place's returns: as long as the gap stays the first one
    second = np.minimum(begin + 1, len(pos) - 1)
    step = np.where(fresh[second], 0, gap[second])
    ends = fresh | (gap != step[group])
    ends[begin] = False
    size = np.diff(np.append(begin, len(pos)))
    times = np.minimum(size, np.minimum.reduceat(np.where(ends, i, len(pos)), begin) - begin)
    return turn, place[begin][same], step[same], times[same]


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _word_places(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The byte places where words start, and those after their ends."""
    within = ~_SPACE[np.frombuffer(b" " + body + b" ", np.uint8)]
    return np.flatnonzero(within[1:] & ~within[:-1]), np.flatnonzero(within[:-1] & ~within[1:])


def _contexts(needed: DataFrame, texts: DataFrame, reach: int) -> DataFrame:
    """For each distinct (doc_id, first, end): hashes and byte places of the words
    up to ``reach`` before ``first`` and after ``end``, and a hash of those between.
    However many documents share a place, it is asked for once."""
    asked = needed.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("first", "end")).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for block in gathered(batches, most_rows=64, most_bytes=1 << 20):
            found, inner, cols = [], [], {c: [] for c in ("left", "starts", "right", "ends")}
            for doc, body, asked in zip(block.column("doc_id").to_pylist(), raw(block.column("text")), block.column("asked")):
                words = body.split()
                h = hashes.of(words).view(np.int64)
                starts, ends = _word_places(body)
                places = asked.values
                for f, e in zip(places.field("first").to_pylist(), places.field("end").to_pylist()):
                    lo, hi = max(0, f - reach), min(len(words), e + reach)
                    found.append((doc, f, e))
                    inner.append(xxhash.xxh3_64_intdigest(b" ".join(words[f:e])) - 2**63)
                    for c, x in zip(cols, (h[lo:f][::-1], starts[lo:f + 1][::-1], h[e:hi], ends[e - 1:hi])):
                        cols[c].append(x)
                    if len(found) == 2048:                   # a document may be asked for many places
                        yield batch(found, inner, cols)
                        found, inner, cols = [], [], {c: [] for c in cols}
            if found:
                yield batch(found, inner, cols)

    def batch(found: list, inner: list, cols: dict) -> pa.RecordBatch:
        doc, first, end = zip(*found)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(first, pa.int32()), pa.array(end, pa.int32()), pa.array(inner, pa.int64()),
             *(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)]).astype(np.int32)),
                                        pa.array(np.concatenate(x))) for x in cols.values())],
            names=["doc_id", "first", "end", "inner", *cols])

    return map_arrow(texts.join(asked, "doc_id").select("doc_id", "text", "asked"), run,
                     "doc_id long, first int, end int, inner long, left array<long>, starts array<long>, right array<long>, ends array<long>")


def matched(stays: DataFrame, texts: DataFrame, min_words: int, reach: int) -> DataFrame:
    """Passages of ``min_words`` words at least from (doc_id, first, runs): the
    places where a document may share that many.  Each run goes to the least
    document that has it, and the returns of a run in turn to its returns there,
    so that words repeated over and over are few passages, not one for each
    return; passages are extended by at most ``reach`` words.  Runs are equal if
    both their hashes are; the texts themselves are read again only to extend."""
    runs = staged(_runs(stays, texts, min_words), "word-runs")
    # written, so that the join has an exchange of its own on both sides and Spark splits a crowded run
    least = staged(runs.groupBy("w", "check").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("greatest"),
                                         *(F.min_by(c, "doc_id").alias(f"{c}_a") for c in ("at", "step", "times")))
                   .where("a < greatest").drop("greatest"), "run-least")
    # runs of one pair on one diagonal that overlap or touch are one passage
    pos_a = F.col("at_a") + F.col("step_a") * (F.col("turn") % F.col("times_a"))
    sided = (runs.select("w", "check", "doc_id", "pos", "turn", "start", "stop").join(least, ["w", "check"]).where("doc_id > a")
             .select(F.col("doc_id").alias("b"), "a", "pos", "start", "stop", (F.col("pos") - pos_a).alias("shift")))
    line = Window.partitionBy("b", "a", "shift").orderBy("pos")
    spans = (sided.withColumn("new", (F.col("pos") > F.lag("pos").over(line) + min_words).cast("int"))
             .withColumn("run", F.sum(F.coalesce("new", F.lit(0))).over(line))
             .groupBy("b", "a", "shift", "run").agg(F.min("pos").alias("first"), (F.max("pos") + min_words).alias("end"),
                                               F.min("start").alias("start"), F.max("stop").alias("stop"))
             .withColumns({"first_a": (F.col("first") - F.col("shift")).cast("int"),
                           "end_a": (F.col("end") - F.col("shift")).cast("int")}))
    if not reach:
        return spans.select(F.col("b").alias("doc_id"), F.col("start").cast("long"), (F.col("stop") - F.col("start")).cast("long").alias("size"),
                            (F.col("end") - F.col("first")).cast("long").alias("words"), F.col("first").cast("long").alias("first_word"),
                            F.col("a").alias("other_doc_id"), F.col("first_a").cast("long").alias("other_first_word"),
                            F.lit(False).alias("exact_copy"))
    spans = staged(spans.drop("start", "stop"), "run-spans")
    sides = staged(_contexts(
        spans.select(F.col("b").alias("doc_id"), "first", "end")
        .unionByName(spans.select(F.col("a").alias("doc_id"), F.col("first_a").alias("first"), F.col("end_a").alias("end"))),
        texts, reach), "run-contexts")
    side = {c: sides.select(*(F.col(x).alias(f"{x}_of_{c}") for x in ("doc_id", "first", "end")),
                            *(F.col(x).alias(f"{x}_{c}") for x in ("inner", "left", "starts", "right", "ends")))
            for c in "ab"}
    at = {"a": ["a", "first_a", "end_a"], "b": ["b", "first", "end"]}
    same = {c: [F.col(x) == F.col(f"{y}_of_{c}") for x, y in zip(at[c], ("doc_id", "first", "end"))] for c in "ab"}

    def ext(x: str):                                         # words that agree from the start of both lists
        differs = F.expr(f"array_position(zip_with({x}_a, {x}_b, (p, q) -> p = q), false)")
        return F.when(differs > 0, differs - 1).otherwise(F.least(F.size(f"{x}_a"), F.size(f"{x}_b"))).cast("int")

    return (spans.join(side["b"], same["b"]).join(side["a"], same["a"]).where("inner_a = inner_b")
            .withColumn("l", ext("left")).withColumn("r", ext("right"))
            .withColumn("start", F.expr("starts_b[l]")).withColumn("size", F.expr("ends_b[r] - starts_b[l]"))
            .select(F.col("b").alias("doc_id"), F.col("start"), F.col("size"),
                    (F.col("end") - F.col("first") + F.col("l") + F.col("r")).cast("long").alias("words"),
                    (F.col("first") - F.col("l")).cast("long").alias("first_word"), F.col("a").alias("other_doc_id"),
                    (F.col("first") - F.col("l") - F.col("shift")).cast("long").alias("other_first_word"),
                    F.lit(False).alias("exact_copy"))
            .where(F.col("words") >= min_words).distinct())
