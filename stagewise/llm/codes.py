"""Operator 13: vector codes by integer Walsh-Hadamard distances.

A component x counts as floor(4096 * x); a vector is cut into equal parts, and
each part position has a codebook of 16 entries, which starts as the parts of
the 16 least ids and is improved in rounds of assignment and floored means.

The distance of a part to the entries is found in the Walsh-Hadamard domain:
both are padded with zeros to a power of two, L, and transformed by integer
butterflies; the sum of squared differences of the transforms is L times the
squared distance.  The coefficients are taken in sequency order (by their number
of sign changes).  After the first ones the entry that is least so far gets its
full distance; entries whose partial sum exceeds it are out, as sums only
grow, and the others drop out as soon as theirs does.  All in 64-bit integers,
so ties go to the lower index exactly.

Every round is one Spark job over the staged integers: tasks send sums and
counts per part position, entry and component (bounded by the codebooks' size),
which are added up; the codebooks are the only thing that passes the driver.

Cases: rows whose vector is null or holds null or non-finite components are left
out; vectors shorter than the longest count as ending in zeros, as does a length
that is not a multiple of the parts; null ids are coded too and come last for
the first codebooks; rows of equal id are told apart by their vectors there;
fewer rows than entries give fewer entries; null labels form one group; an empty
table gives an empty result; extra columns are ignored.  Components whose
distances would not fit 64 bits (from 2^25 in the integers for parts of eight)
raise an error."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, staged
from .vectors import extent, floors, matrix, whole

FIRST = 2                      # coefficients summed before entries are eliminated


def walsh(x: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard transform of the last axis, zero-padded to a power
    of two, coefficients in sequency order."""
    size = 1 << max(0, x.shape[-1] - 1).bit_length()
    out = np.zeros((*x.shape[:-1], size), np.int64)
    out[..., :x.shape[-1]] = x
    span = 1
    while span < size:
        pairs = out.reshape(*x.shape[:-1], size // (2 * span), 2, span)
        out = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], -2).reshape(out.shape)
        span *= 2
    # coefficient i's pattern of signs is the parity of i & place
    signs = np.bitwise_count(np.arange(size)[:, None] & np.arange(size)[None]) & 1
    return out[..., np.argsort((signs[:, 1:] != signs[:, :-1]).sum(1), kind="stable")]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For (rows, d) parts the index of the nearest of (k, d) entries, the lower
    one of ties, and its squared distance."""
    t, c = walsh(parts), walsh(entries)
    size, first = t.shape[1], min(FIRST, t.shape[1])
    total = np.zeros((len(t), len(c)), np.int64)
    for j in range(first):
        total += (t[:, j, None] - c[None, :, j]) ** 2
    guess = total.argmin(1)
    bound = ((t - c[guess]) ** 2).sum(1)
    row, entry = np.nonzero(total <= bound[:, None])
    total = total[row, entry]
    for j in range(first, size):
        total += (t[row, j] - c[entry, j]) ** 2
        stays = total <= bound[row]
        row, entry, total = row[stays], entry[stays], total[stays]
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.empty(0, np.int64)
    least = np.minimum.reduceat(total, starts) if len(row) else total
    hit = np.flatnonzero(total == least[row])               # every row has one; rows and entries ascend
    hit = hit[np.append(True, row[hit][1:] != row[hit][:-1])] if len(hit) else hit
    return entry[hit], least // size


def _batches(batches: Iterator[pa.RecordBatch], dims: int, parts: int, size: int = 4096):
    for batch in batches:
        for lo in range(0, batch.num_rows, size):
            some = batch.slice(lo, size)
            yield some, matrix(some.column("q"), dims).reshape(some.num_rows, parts, dims // parts)


def _summed(rows: DataFrame, books: np.ndarray, dims: int) -> np.ndarray:
    """The codebooks after one round: floored means of the parts assigned."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for _, x in _batches(batches, dims, parts):
            for p in range(parts):
                at, _ = nearest(x[:, p], books[p])
                np.add.at(sums[p], at, x[:, p])
                counts[p] += np.bincount(at, minlength=entries)
        p, e, d = (v.ravel() for v in np.indices(books.shape))
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (p, e, d, sums.ravel(), np.repeat(counts.ravel(), width))],
                                         names=["part", "entry", "place", "total", "n"])

    out = books.copy()
    found = (map_arrow(rows.select("q"), run, "part long, entry long, place long, total long, n long")
             .groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
             .where("n > 0").collect())                     # one number per component of the codebooks
    for r in found:
        out[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return out


def encode(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
           key: str = "vec_id", vector: str = "embedding", label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every kept row, and the codebooks
    (part, entry, component)."""
    rows = staged(vectors.where(whole(vector)).select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), floors(vector, scale).alias("q")), "codes-rows")
    _, longest, most, _ = extent(rows)
    dims = max(1, -(-longest // parts)) * parts
    size = 1 << (dims // parts - 1).bit_length()
    if 4 * most * most * size**3 >= 2**62:
        raise ValueError("components are too large for distances in 64 bits")
    head = rows.orderBy(F.asc_nulls_last("vec_id"), "q").select("q").limit(entries).collect()
    start = np.array([r["q"] + [0] * (dims - len(r["q"])) for r in head], np.int64).reshape(len(head), parts, dims // parts)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    for _ in range(rounds if head else 0):
        books = _summed(rows, books, dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, x in _batches(batches, dims, parts):
            found = [nearest(x[:, p], books[p]) for p in range(parts)]
            code = np.stack([f[0] for f in found], 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [some.column("vec_id"), some.column("label"), pa.array([c.tobytes().hex() for c in code], pa.string()),
                 pa.array(sum(f[1] for f in found))], names=["vec_id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    return staged(map_arrow(rows, run, f"vec_id long, label {kind}, code string, error long"), "codes"), books


def op13_walsh_vector_codes(spark, sf_dir: str) -> DataFrame:
    codes, books = encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    sums = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return (codes.join(sums, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
