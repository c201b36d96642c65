"""Operator 6: token ids on disk in a byte-aligned variable-length code.

Ids are replaced by their frequency rank (0 = most frequent, ties by id), so
that frequent ids take one byte.  A rank takes 1 to 4 bytes; the byte counts
stand apart from the data, as 2-bit codes, four to a control byte.  Decoding
looks each control byte up in numpy tables that hold the data positions of
its four values.

File layout (all integers little-endian):

    8 bytes   magic ``SWTOKEN1``
    3 x u64   documents, control bytes, data bytes
    i64[n]    doc_ids (ascending)         u64[n]  token counts
    control bytes, then data bytes; every document starts a control byte
    (its last group is filled up with zeros)

``ranks.bin`` beside the files holds the ids in rank order as u32.  A file's
name is new in every task attempt; the manifest lists those of the attempts
that succeeded, so a lost executor leaves no wrong file in the set.

Cases: a null or empty text is the end id alone; an empty table writes no
file and reads back empty; equal or null doc_ids (null is kept as -2^63)
follow each other; a very long document stands in one file, which is then as large as it
needs; extra columns are ignored."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, gathered, map_arrow, new_path, raw, staged, token_ids, vocabulary_path

MAGIC = b"SWTOKEN1"
NULL_ID = -(1 << 63)

# For a control byte: the bytes of its four values, their sum, and for each
# value and byte the place in the group's data (or the group's end: a zero).
_CODES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3
LENGTHS = (_CODES + 1).astype(np.int64)
TOTALS = LENGTHS.sum(1)
_STARTS = np.cumsum(LENGTHS, 1) - LENGTHS
PRESENT = np.arange(4)[None, None, :] < LENGTHS[:, :, None]
PLACES = np.where(PRESENT, _STARTS[:, :, None] + np.arange(4), 0).astype(np.int64)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes, data bytes and data bytes per control byte of uint32
    values whose count is a multiple of four."""
    values = np.ascontiguousarray(values, "<u4")
    codes = (values >= 1 << 8).astype(np.uint8) + (values >= 1 << 16) + (values >= 1 << 24)
    four = codes.reshape(-1, 4)
    control = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4)[None, :] <= codes[:, None]]
    return control, data, TOTALS[control]


def decode(control: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The uint32 values of control and data bytes."""
    base = np.cumsum(TOTALS[control]) - TOTALS[control]
    held = data[base[:, None, None] + PLACES[control]] * PRESENT[control]
    return held.astype(np.uint8).reshape(-1, 4).view("<u4").ravel()


_TOKENS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("seen", pa.binary())])


def _tokenised(docs: DataFrame, path: str, end: int, key: str, text: str) -> DataFrame:
    """doc_id, n and ids (in 16 bits where the vocabulary fits) of every text, and
    as each task's last row ``seen``, how often it has met each id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_ids(path)
        kind = "<u2" if max(tokens.size, end + 1) <= 1 << 16 else "<u4"
        total = np.zeros(max(tokens.size, end + 1), np.int64)
        for block in gathered(batches, "text", 1024, 4 << 20):
            ids = [np.frombuffer(tokens.of(body, end), "<u4") for body in raw(block.column("text"))]
            total += np.bincount(np.concatenate(ids), minlength=len(total))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").combine_chunks(), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([x.astype(kind).tobytes() for x in ids], pa.binary()), pa.nulls(len(ids), pa.binary())], schema=_TOKENS)
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([0], pa.int64()), pa.array([None], pa.binary()),
                                          pa.array([total.astype("<i8").tobytes()], pa.binary())], schema=_TOKENS)

    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_arrow(narrow, run, "doc_id long, n long, ids binary, seen binary")


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for body in batch.column("seen").to_pylist():
            total = np.frombuffer(body, "<i8") + (total if len(total) else 0)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())],
                                     names=["id", "n"])


def _coded(block: pa.Table, rank: np.ndarray) -> Iterator[tuple]:
    """(doc_id, n, control bytes, data bytes) of rows of tokens."""
    n = block.column("n").to_numpy()
    ids = [np.frombuffer(x, "<u2" if len(x) == 2 * k else "<u4") for x, k in zip(block.column("ids").to_pylist(), n)]
    groups = -(-n // 4)
    values = np.zeros(4 * groups.sum(), np.uint32)
    first = 4 * (np.cumsum(groups) - groups)
    values[np.repeat(first, n) + _runs(n)] = rank[np.concatenate(ids)]
    control, data, sizes = encode(values)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    g = np.concatenate([[0], np.cumsum(groups)])
    for doc, k, a, b in zip(block.column("doc_id").to_pylist(), n.tolist(), g, g[1:]):
        yield doc, k, control[a:b].tobytes(), data[ends[a]:ends[b]].tobytes()


def _runs(n: np.ndarray) -> np.ndarray:
    """0, 1, …, n[0]-1, 0, 1, …, n[1]-1, …"""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _filesystem(path: str):
    """A path in the shared folder as tasks see it: a mounted folder, or a store
    that pyarrow reaches by its address."""
    from pyarrow import fs
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _write(path: str, body: bytes) -> None:
    system, at = _filesystem(path)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(at) as out:
        out.write(body)


def pack_file(doc_ids: list, counts: list[int], controls: list[bytes], datas: list[bytes]) -> bytes:
    control, data = b"".join(controls), b"".join(datas)
    ids = [NULL_ID if d is None else d for d in doc_ids]
    return b"".join([MAGIC, np.array([len(ids), len(control), len(data)], "<u8").tobytes(),
                     np.array(ids, "<i8").tobytes(), np.array(counts, "<u8").tobytes(), control, data])


def read_file(body: bytes, ids: np.ndarray, block: int = 1 << 16) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, token ids) of a file, in its order; ``ids`` is the rank table."""
    if body[:8] != MAGIC:
        raise ValueError("not a token file")
    n, n_control, n_data = map(int, np.frombuffer(body, "<u8", 3, 8))
    keys = np.frombuffer(body, "<i8", n, 32)
    counts = np.frombuffer(body, "<u8", n, 32 + 8 * n).astype(np.int64)
    control = np.frombuffer(body, np.uint8, n_control, 32 + 16 * n)
    data = np.frombuffer(body, np.uint8, n_data, 32 + 16 * n + n_control)
    groups = -(-counts // 4)
    ends = np.cumsum(groups)
    at = byte = doc = 0
    while doc < n:                                    # whole documents of about ``block`` control bytes
        stop = max(doc + 1, int(np.searchsorted(ends, at + block, side="right")))
        part = control[at: ends[stop - 1]]
        size = int(TOTALS[part].sum())
        values = ids[decode(part, data[byte: byte + size])]
        begin = 4 * (ends[doc:stop] - groups[doc:stop] - at)
        for k in range(doc, stop):
            b = int(begin[k - doc])
            yield (None if keys[k] == NULL_ID else int(keys[k])), values[b: b + int(counts[k])]
        at, byte, doc = int(ends[stop - 1]), byte + size, stop


def write(docs: DataFrame, folder: str, end: int = 2, tokenizer: str | None = None, key: str = "doc_id",
          text: str = "text", file_tokens: int = 4 << 20, partitions: int | None = None) -> DataFrame:
    """Encode ``docs`` into files in ``folder`` and return the manifest: file,
    part, seq, n_docs, n_tokens, start (ids in all files before it)."""
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tokens = staged(_tokenised(docs, tokenizer or vocabulary_path(), end, key, text), "token-ids")
    seen = tokens.where("seen is not null").select("seen")       # one row per task
    counts = (map_arrow(seen, _histogram, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
              .orderBy(F.desc("n"), "id").toPandas())           # at most one row per vocabulary entry
    ids = counts["id"].to_numpy(np.uint32)
    rank = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    rank[ids] = np.arange(len(ids), dtype=np.uint32)
    _write(f"{folder}/ranks.bin", ids.astype("<u4").tobytes())
    shared = spark.sparkContext.broadcast(rank)                 # bounded by the vocabulary

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, n = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            name = f"part-{part:06d}-{seq:05d}-{uuid.uuid4().hex}.tok"
            _write(f"{folder}/files/{name}", pack_file(*map(list, zip(*held))))
            return pa.RecordBatch.from_pylist([{"file": name, "part": part, "seq": seq, "n_docs": len(held),
                                                "n_tokens": n}], schema=pa.schema(
                [("file", pa.string()), ("part", pa.int32()), ("seq", pa.int32()),
                 ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

        for block in gathered(batches, "ids", 4096, 4 << 20):
            for row in _coded(block, shared.value):
                held.append(row)
                n += row[1]
                if n >= file_tokens:
                    yield flush()
                    seq, held, n = seq + 1, [], 0
        if held:
            yield flush()

    # the ranges are sampled from the written ids and counts; coding stands behind the exchange
    rows = tokens.where("seen is null").select("doc_id", "n", "ids")
    ordered = rows.repartitionByRange(partitions, "doc_id", "n").sortWithinPartitions("doc_id", "n", "ids")
    manifest = staged(map_arrow(ordered, save, "file string, part int, seq int, n_docs long, n_tokens long"),
                      "token-manifest")
    # one row per file, put in order of (part, seq) for the running sum
    rows, start = [], 0
    for r in manifest.orderBy("part", "seq").collect():
        rows.append((*r, start))
        start += r["n_tokens"]
    return spark.createDataFrame(rows, "file string, part int, seq int, n_docs long, n_tokens long, start long")


def read(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens,
    ids_crc32, and ids (little-endian uint32 bytes)."""
    system, at = _filesystem(f"{folder}/ranks.bin")
    with system.open_input_stream(at) as source:
        shared = spark.sparkContext.broadcast(np.frombuffer(source.read(), "<u4"))   # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, first in zip(batch.column("content"), batch.column("start").to_pylist()):
                out, at = [], first
                for doc, ids in read_file(body.as_py(), shared.value):
                    blob = ids.astype("<u4").tobytes()
                    out.append((doc, at, len(ids), zlib.crc32(blob), blob))
                    at += len(ids)
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
    files = (spark.read.format("binaryFile").load(f"{folder}/files")
             .select("content", F.element_at(F.split("path", "/"), -1).alias("file"))
             .join(F.broadcast(manifest.select("file", "start")), "file")    # one small row per file
             .select("content", "start"))
    return map_arrow(files, run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def op6_token_files(spark, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "token-files")
    manifest = write(documents(spark, sf_dir), folder)
    return read(spark, folder, manifest).select("doc_id", "start", "n_tokens", "ids_crc32")
