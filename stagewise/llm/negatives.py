"""Operator 12: hard negatives by exact scores from a residue number system.

A component x counts as floor(256 * x), a score is an integer inner product.
Both matrices are reduced modulo several primes below 1,024 to residues around
zero; products of 64 such residues add up to less than 2^24, so float32 matrix
products are exact.  Enough primes are taken for their product to exceed twice
the greatest squared length of all vectors, which bounds every score, and Chinese
remaindering gives the signed scores back.

The anchors are a stated query set (``vec_id`` divisible by 50) against all
rows, in blocks: rows and anchors are dealt to blocks of bounded size by a hash,
and each task multiplies one block of both.  The first pass keeps, per anchor
and block, the first positives; Spark merges them.  The second one keeps, per
anchor, positive and block, the first negatives inside the positive's window of
scores, and Spark merges them likewise (group limits before the exchange).  No
block sees a whole label, and nothing but one row of bounds reaches the driver.

Cases: rows with a null vec_id, null label, null vector or any null or
non-finite component take no part; shorter vectors count as ending in zeros;
of rows with equal vec_id each is a row of its own (an anchor's copy is another
row); ties go by vec_id; an anchor without another row of its label, or without
a negative in a window, has no row there; an empty table gives an empty result;
extra columns are ignored.  Vectors with a squared length of 2^56 or more (in
the integers) raise an error, since their scores would not fit the result."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shipped, staged
from .vectors import extent, floors, matrix, whole

AT_ONCE = 64                                    # residues summed up in float32
PRIMES = [p for p in range(1023, 500, -2) if all(p % d for d in range(3, 32, 2))]


def primes_for(bound: int) -> list[int]:
    """As many primes as tell all integers of -bound..bound apart."""
    count = 1
    while math.prod(PRIMES[:count]) <= 2 * bound + 1:
        count += 1
    return PRIMES[:count]


def _residues(x: np.ndarray, p: int) -> np.ndarray:
    half = p // 2
    return ((x + half) % p - half).astype(np.float32)


def residue_products(a: np.ndarray, b: np.ndarray, primes: list[int]) -> np.ndarray:
    """a @ b.T of integer matrices, exact if ``primes`` suffice for every entry."""
    found, size = np.zeros((len(a), len(b)), np.int64), 1
    for p in primes:
        x, y = _residues(a, p), _residues(b, p)
        r = np.zeros((len(a), len(b)), np.float32)
        for lo in range(0, a.shape[1], AT_ONCE):
            r = np.fmod(r + np.fmod(x[:, lo:lo + AT_ONCE] @ y[:, lo:lo + AT_ONCE].T, np.float32(p)), np.float32(p))
        # the next mixed-radix digit: found + size * digit has the residue r
        digit = (r.astype(np.int64) - found) % p * pow(size, -1, p) % p if size > 1 else r.astype(np.int64) % p
        found += size * digit
        size *= p
    found[found > size // 2] -= size
    return found


def _scores(anchors: pa.Table, rows: pa.Table, dims: int, primes: list[int]):
    """For each anchor its place and its scores against the rows, which come in
    the order of vec_id."""
    a, b = matrix(anchors.column("own_q"), dims), matrix(rows.column("q"), dims)
    for lo in range(0, len(a), 128):
        for i, s in enumerate(residue_products(a[lo:lo + 128], b, primes)):
            yield lo + i, s


def _sorted(rows: pa.Table) -> pa.Table:
    return rows.sort_by([("vec_id", "ascending"), ("row", "ascending")]).combine_chunks()


_FOUND = "anchor_row long, k int, row long, vec_id long, score long"


def _found(cols: list[tuple]) -> pa.Table:
    names, kinds = ("anchor_row", "k", "row", "vec_id", "score"), (np.int64, np.int32, np.int64, np.int64, np.int64)
    return pa.table({c: pa.array(np.concatenate([x[i] for x in cols]) if cols else np.empty(0), pa.from_numpy_dtype(kind))
                     for i, (c, kind) in enumerate(zip(names, kinds))})


def _met(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, row_block: int, anchor_block: int):
    """Both sides with the numbers r and a of the blocks they meet in."""
    of_rows, of_anchors = max(1, -(-n_rows // row_block)), max(1, -(-n_anchors // anchor_block))
    left = rows.withColumn("r", F.pmod(F.xxhash64("row"), F.lit(of_rows)).cast("int")).withColumn(
        "a", F.explode(F.sequence(F.lit(0), F.lit(of_anchors - 1))))
    right = anchors.withColumn("a", F.pmod(F.xxhash64("own"), F.lit(of_anchors)).cast("int")).withColumn(
        "r", F.explode(F.sequence(F.lit(0), F.lit(of_rows - 1))))
    return left.groupBy("r", "a").cogroup(right.groupBy("r", "a"))


def mine(vectors: DataFrame, anchors: str = "vec_id % 50 = 0", positives: int = 5, negatives: int = 3, low: int = 50,
         high: int = 95, scale: int = 256, key: str = "vec_id", vector: str = "embedding", label: str = "label",
         row_block: int = 8192, anchor_block: int = 1024) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    for each anchor and each of its first ``positives`` rows of the same label,
    the first ``negatives`` rows of other labels with a score of ``low`` to
    ``high`` percent of the positive's.  ``anchors`` is a condition on vec_id."""
    spark = vectors.sparkSession
    shipped(spark)
    rows = staged(vectors.where(whole(vector)).select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), floors(vector, scale).alias("q"))
        .where("vec_id is not null and label is not null").withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    asked = rows.where(anchors)
    n, dims, _, square = extent(rows)
    if square >= 2**56:
        raise ValueError("vectors are too long: a squared length of 2^56 or more")
    primes = primes_for(math.ceil(square * (1 + 1e-9)))
    n_asked = asked.count()

    def first_positives(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return _found([])
        rows, out = _sorted(rows), []
        row, ids, labels = (rows.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        own, own_label = (anchors.column(c).to_numpy() for c in ("own", "own_label"))
        for i, s in _scores(anchors, rows, dims, primes):
            at = np.flatnonzero((labels == own_label[i]) & (row != own[i]))
            at = at[np.argsort(-s[at], kind="stable")[:positives]]
            out.append((np.full(len(at), own[i]), np.zeros(len(at), np.int32), row[at], ids[at], s[at]))
        return _found(out)

    def first_negatives(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return _found([])
        rows, out = _sorted(rows), []
        row, ids, labels = (rows.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        own, own_label = (anchors.column(c).to_numpy() for c in ("own", "own_label"))
        windows = anchors.column("windows").to_pylist()
        for i, s in _scores(anchors, rows, dims, primes):
            spans = [(w["k"], -(-low * w["score"] // 100), high * w["score"] // 100) for w in windows[i]]
            at = np.flatnonzero((labels != own_label[i]) & (s >= min(x[1] for x in spans)) & (s <= max(x[2] for x in spans)))
            at = at[np.argsort(-s[at], kind="stable")]
            falling = -s[at]
            for k, least, most in spans:
                some = at[np.searchsorted(falling, -most):][:negatives]
                some = some[s[some] >= least]
                out.append((np.full(len(some), own[i]), np.full(len(some), k, np.int32), row[some], ids[some], s[some]))
        return _found(out)

    def merged(found: DataFrame, by: list[str], most: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id", "row")
        return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)

    queries = asked.select(F.col("row").alias("own"), F.col("label").alias("own_label"), F.col("q").alias("own_q"))
    met = _met(rows, queries, n, n_asked, row_block, anchor_block)
    near = staged(merged(met.applyInArrow(first_positives, _FOUND), ["anchor_row"], positives)
                  .select("anchor_row", F.col("place").alias("k"), F.col("vec_id").alias("positive_id"),
                          F.col("score").alias("positive_score")), "negatives-positives")
    windows = (near.groupBy(F.col("anchor_row").alias("own"))          # at most ``positives`` each
               .agg(F.collect_list(F.struct("k", F.col("positive_score").alias("score"))).alias("windows")))
    met = _met(rows, queries.join(windows, "own"), n, n_asked, row_block, anchor_block)
    hard = merged(met.applyInArrow(first_negatives, _FOUND), ["anchor_row", "k"], negatives)
    return (hard.select("anchor_row", "k", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"),
                        F.col("score").alias("negative_score")).join(near, ["anchor_row", "k"])
            .join(asked.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id")), "anchor_row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op12_residue_hard_negatives(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", shifted))
