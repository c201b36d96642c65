"""Operator 3: repeated passages by content-defined chunking.

A gear hash rolls over the bytes of a text's words, joined by single spaces; at
the end of a word its low 16 bits depend on the last 16 bytes only.  A chunk
ends at the word end with the least hash of any ``RUN`` = 20 in a row, and at
``most`` bytes at the latest (between two characters).  These ends depend on
nothing but the words around them: of 50 equal words at most 8 have bytes
before them in their hash, the least of the next 20 ends a chunk in both texts,
the least of the last 20 does too, and all ends between are the same.  So the
chunk with the 30th of the 50 words is the same in both texts, always.

Chunks are compared by a 64-bit digest, which only chooses what is compared
further.  The runs of ``passage_words`` words whose 30th word stands in a chunk
of n words all hold the 30 - n words before it and, of 50, the 21 - n after it
(counted from its ends), so the digest is of the chunk with these words: where
a run is shared, it is the same in both texts, and some 40 words must agree
instead of a chunk's ten before runs are compared.  A chunk that holds no run's
30th word is not compared.  Where a chunk also stands in another document, its
runs are compared whole (see ``runs``): the first document that has the run keeps it,
and runs that overlap or touch are one passage.  So exactly the words in a run of
50 that an earlier document has are repeats.  A document's passages do not
overlap; the later one begins where the earlier one ends.

Equal texts are told apart first, by digest, so that a large group of copies
is compared once and its other members are one whole-text passage each, from
``min_words`` words on.  The chunk rows (digest, place; no text) are written
once; counting them combines in the map tasks, and only digests seen twice are
joined back, where Spark splits crowded digests.  These rows are written before
texts are exchanged, so that the two exchanges are not on disk together.

Cases: null, empty and shorter texts have no passage; documents with a null
doc_id have no place in the order and are left out; white space between words
does not count; equal rows, doc_ids included, count as one document; texts of
any length are chunked whole, and an empty table gives an empty result; extra
columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, gathered, map_arrow, mixed, raw, staged
from .runs import matched

WINDOW, RUN = 32, 20
# one random 32-bit number per byte; byte 255 (never in UTF-8) is zero and stands between texts
GEAR = np.append((mixed(np.arange(1, 256, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32), np.uint32(0))


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] = sum over j < 32 of GEAR[data[i - j]] << j, for every place."""
    h, span = GEAR[data], 1
    while span < WINDOW:                                  # the sum over 2*span bytes from two over span
        shifted = np.zeros_like(h)
        shifted[span:] = h[:-span] << np.uint32(span)
        h, span = h + shifted, 2 * span
    return h


# ASCII white space, and the byte that stands between texts
_AFTER_WORD = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32, 255])


def _least_ends(data: np.ndarray, run: int) -> np.ndarray:
    """Places of the word ends that have the least hash of some ``run`` word
    ends in a row of one text (the first of equals)."""
    after = _AFTER_WORD[data]
    ends = np.flatnonzero(after[1:] & ~after[:-1])
    keys = mixed((gear_hashes(data)[ends] & np.uint32(0xFFFF)).astype(np.uint64))
    if len(ends) < run:
        return ends[:0]
    text = np.cumsum(data == 255)[ends]                      # the same within a text only
    rows = np.lib.stride_tricks.sliding_window_view(keys, run)
    whole = np.flatnonzero(text[run - 1:] == text[:len(text) - run + 1])
    return ends[np.unique(rows.argmin(1)[whole] + whole)]


def chunk_ends(bodies: list[bytes], bits: int, least: int, most: int, run: int = 0) -> list[list[int]]:
    """The ends of each text's chunks: at word ends with ``bits`` zeros in their
    hash, or, with ``run``, with the least hash of any ``run`` in a row."""
    gap = b"\xff" * WINDOW
    data = np.frombuffer(gap.join([b"", *bodies, b""]), np.uint8)
    hits = 1 + (_least_ends(data, run) if run else
                np.flatnonzero((gear_hashes(data)[:-1] >> np.uint32(32 - bits) == 0) & _AFTER_WORD[data[1:]]))
    out, at = [], WINDOW
    for body in bodies:
        lo, hi = np.searchsorted(hits, [at + 1, at + len(body)])
        ends, last = [], 0

        def force(upto: int) -> None:
            nonlocal last
            while upto - last > most:
                last += most
                while body[last] & 0xC0 == 0x80:          # inside a character
                    last -= 1
                ends.append(last)

        for hit in (hits[lo:hi] - at).tolist():
            force(hit)
            if hit - last >= least:
                ends.append(hit)
                last = hit
        force(len(body))
        if last < len(body):
            ends.append(len(body))
        out.append(ends)
        at += len(body) + WINDOW
    return out


def chunks(docs: DataFrame, passage_words: int = 50, run_words: int = RUN, most: int = 512) -> DataFrame:
    """(doc_id, text) as chunks: doc_id, total (words of the text), place (of the
    first word that starts in it), first and runs (the first run of
    ``passage_words`` words whose word ``run_words`` + 10 starts in it, and how
    many do), digest of it and of the words around it that all these runs hold.
    Of chunks without runs only a text's first one is there.  Chunks in a row
    with the same digest are one with the runs of all, so that a few words
    repeated over and over are one row, not one for each return."""
    names = ["doc_id", "total", "place", "first", "runs", "digest"]
    before = run_words + 9                                   # words of a run before the one that stands in the chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in gathered(batches, most_rows=512, most_bytes=1 << 20):
            split = [body.split() for body in raw(block.column("text"))]
            bodies = [b" ".join(words) for words in split]
            doc, cols, digests = [], [[], [], [], []], []
            for i, (words, body, ends) in enumerate(zip(split, bodies, chunk_ends(bodies, 0, 0, most, run_words))):
                if not words:
                    continue
                starts = np.append(0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)[:-1])
                at = np.searchsorted(starts, [0, *ends])
                place, after = at[:-1], at[1:]               # the chunk's first word, and the one after its last
                first = np.maximum(place - before, 0)
                runs = np.maximum(np.minimum(after - before, len(words) - passage_words + 1) - first, 0) * (after > place)
                holds = np.flatnonzero((runs > 0) | (place == 0) & (after > 0))
                # none is cut off by the text's ends if the chunk has runs
                lo = np.maximum(np.minimum(place, after - before - 1), 0)[holds]
                hi = np.minimum(np.maximum(after, place - before + passage_words), len(words))[holds]
                edges = np.append(starts, len(body) + 1)
                own = np.array([xxhash.xxh3_64_intdigest(body[x:y])
                                for x, y in zip(edges[lo].tolist(), (edges[hi] - 1).tolist())], np.uint64)
                first, runs = first[holds], runs[holds]
                fresh = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (first[1:] != first[:-1] + runs[:-1])))
                doc.append(np.full(len(fresh), i))
                for col, x in zip(cols, (np.full(len(fresh), len(words)), place[holds][fresh], first[fresh],
                                         np.add.reduceat(runs, fresh))):
                    col.append(x)
                digests.append(own[fresh])
            if doc:
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id").combine_chunks().take(pa.array(np.concatenate(doc))),
                     *(pa.array(np.concatenate(x).astype(np.int32)) for x in cols),
                     pa.array(np.concatenate(digests).view(np.int64))], names=names)

    return map_arrow(docs.select("doc_id", "text"), run,
                     "doc_id long, total int, place int, first int, runs int, digest long")


def _copies(texts: DataFrame) -> DataFrame:
    """doc_id, first_doc_id (least id with an equal text), size and words of
    every non-empty text; the texts themselves are not exchanged."""
    named = texts.where(F.octet_length("text") > 0).select(
        "doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"),
        F.octet_length("text").alias("size"))
    firsts = named.groupBy("digest").agg(F.min("doc_id").alias("first_doc_id"), F.count("*").alias("n"))
    return named.join(firsts.where("n > 1"), "digest").select("doc_id", "first_doc_id", "size")


def repeated_passages(docs: DataFrame, min_words: int = 20, key: str = "doc_id", text: str = "text",
                      passage_words: int = 50) -> DataFrame:
    """One row per repeated passage: doc_id (the later document), start and
    size (bytes of its UTF-8 text), words, first_doc_id (a document that keeps
    it), exact_copy (the whole text equals that of first_doc_id)."""
    if passage_words < 2 * RUN + 10:                         # 8 words of foreign hashes and two runs
        raise ValueError(f"passages must have at least {2 * RUN + 10} words")
    texts = (docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
             .where("doc_id is not null"))
    copies = staged(_copies(texts), "copies")
    later = copies.where("doc_id > first_doc_id").select("doc_id", "first_doc_id", "size").distinct()
    # of a later copy only the first chunk, which has the text's number of words
    table = staged(chunks(texts, passage_words).join(later, "doc_id", "left").where("first_doc_id is null or place = 0"), "chunks")
    whole = (table.where(F.col("first_doc_id").isNotNull() & (F.col("total") >= min_words))
             .select("doc_id", F.lit(0).alias("start"), F.col("size").cast("int").alias("size"),
                     F.col("total").cast("long").alias("words"), "first_doc_id", F.lit(True).alias("exact_copy")).distinct())
    own = table.where("first_doc_id is null and runs > 0")
    # written, so that the join has an exchange of its own on both sides and Spark splits a crowded digest
    shared = staged(own.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("greatest"))
                    .where("least < greatest").select("digest"), "shared-digests")
    stays = staged(own.join(shared, "digest").select("doc_id", "first", "runs"), "shared-chunks")
    found = matched(stays, texts, passage_words, 0)
    # of overlapping passages the one that begins first stays whole
    before = (Window.partitionBy("doc_id").orderBy("first_word", F.desc("words"), "other_doc_id", "other_first_word")
              .rowsBetween(Window.unboundedPreceding, -1))
    end, end_word = F.col("start") + F.col("size"), F.col("first_word") + F.col("words")
    cut = (found.withColumn("to", F.max(end).over(before)).withColumn("to_word", F.max(end_word).over(before))
           .withColumn("at", F.greatest("start", "to")).withColumn("at_word", F.greatest("first_word", "to_word"))
           .where(end_word > F.col("at_word"))
           .select("doc_id", F.col("at").cast("int").alias("start"), (end - F.col("at")).cast("int").alias("size"),
                   (end_word - F.col("at_word")).alias("words"), F.col("other_doc_id").alias("first_doc_id"),
                   F.lit(False).alias("exact_copy")))
    return cut.unionByName(whole)


def without_passages(docs: DataFrame, passages: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the passages cut out of their texts; a document of which
    nothing but white space is left goes.  Other columns are kept; ``n_chars``,
    if there is one, is set to the new length of texts that changed."""
    spans = passages.groupBy(F.col("doc_id").alias("id")).agg(   # a text's passages do not overlap
        F.array_sort(F.collect_list(F.struct("start", "size"))).alias("spans"))
    # names are qualified: ``docs`` may have columns of any name
    joined = docs.alias("own").join(spans.alias("cut"), F.col(f"own.`{key}`") == F.col("cut.id"), "left")
    untouched, body = F.col("cut.spans").isNull(), F.col(f"own.`{text}`")
    # the bytes between one passage's end and the next one's start
    data = F.encode(body, "utf-8")
    none = F.struct(F.lit(0).alias("at"), F.lit(b"").alias("out"))
    kept = F.aggregate("cut.spans", none, lambda a, x: F.struct(
        (x["start"] + x["size"]).alias("at"), F.concat(a["out"], F.substring(data, a["at"] + 1, x["start"] - a["at"])).alias("out")),
        lambda a: F.concat(a["out"], F.substring(data, a["at"] + 1, F.octet_length(body))))
    cut = F.when(untouched, body).otherwise(F.decode(kept, "utf-8"))
    columns = {c: F.col(f"own.`{c}`") for c in docs.columns} | {text: cut}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(untouched, columns["n_chars"]).otherwise(F.length(cut)).cast(docs.schema["n_chars"].dataType)
    return (joined.where(untouched | (F.length(F.btrim(cut)) > 0))
            .select(*[columns[c].alias(c) for c in docs.columns]))


def op3_chunk_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir))
