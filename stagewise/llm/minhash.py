"""Operator 11: near duplicates by MinHash.

A document's set holds its distinct 4-word shingles; two documents link when
100 * |A & B| >= 80 * |A | B|, and a component keeps its least doc_id.

1. ``bands * rows`` universal hash functions (multiply-add modulo 2^64, top 32
   bits, on 32 bits of a shingle's hash) each give the least value over a set.
   Equal sets, told apart by a 128-bit digest, are one *node*.
2. The minima of one band make a key; nodes that share a key are candidates.
   A pair at the limit agrees in a minimum with probability 0.8, so with 48
   bands of 5 rows it shares no key with probability 5e-9, less if more alike.
3. In every key, all nodes are compared with one centre, the node with most
   company over all its keys.  Verified links form components (alternating
   large-star and small-star).  Keys whose nodes then lie in different
   components are *open*: their nodes are dealt to blocks, and each task
   compares two blocks, only across components, and reports a pair in the
   first band that it shares, if neither node is the key's centre.
4. A candidate pair is verified by its signatures: one byte of every minimum,
   and the pair goes if so few agree that a linked pair would do so with
   probability ``miss`` at most; it also goes if a bitmap of the sets proves
   that too many shingles are not shared (exact).  What is left is confirmed on
   the full sets (64-bit shingle hashes).

So links inside a component need no test, every other link is found but for a
chance of about 1e-8, and no link stands that the full sets don't confirm.
Rows grow with nodes * bands; a crowded key costs one row per node, and blocks
of an open one are compared by many tasks.

Cases: a text with 1 to 3 words has one shingle, its whole sequence; null and
blank texts have an empty set, are linked with nothing and have their own id as
component_id; equal rows are linked and all kept alike; equal doc_ids share a
row per text; a null doc_id takes the least id of its component and is kept if
no document in it has an id; very long texts are read whole; an empty table
gives an empty result; extra columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, documents, gathered, map_arrow, mixed, raw, shipped, staged, windows_hash
from .jaccard import components

BITS = 1024                  # of a set's bitmap
AT_ONCE = 32_768             # shingles hashed together; fits a core's cache


def shingles(words: list[bytes], hashes: WordHashes, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles."""
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    if len(h) < n:                                          # a sequence of its own length
        return windows_hash(h, len(h)) ^ mixed(np.array([len(h)], np.uint64))
    return np.unique(windows_hash(h, n))


def functions(count: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and summands of ``count`` universal hash functions."""
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 2**64, count, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**64, count, dtype=np.uint64))


def minima(sets: list[np.ndarray], factors: np.ndarray, summands: np.ndarray) -> np.ndarray:
    """The least value of every function over every (non-empty) set."""
    out = np.empty((len(sets), len(factors)), np.uint32)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    lo = 0
    while lo < len(sets):                                   # whole sets, about AT_ONCE shingles
        hi = max(lo + 1, int(np.searchsorted(np.cumsum(sizes[lo:]), AT_ONCE, "right")) + lo)
        x = np.concatenate(sets[lo:hi]) >> np.uint64(32)
        starts = np.append(0, np.cumsum(sizes[lo:hi])[:-1])
        v = np.empty_like(x)
        for i, (a, b) in enumerate(zip(factors, summands)):
            np.multiply(x, a, out=v)
            np.add(v, b, out=v)
            out[lo:hi, i] = np.minimum.reduceat(v, starts) >> np.uint64(32)
        lo = hi
    return out


def band_keys(least: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per set and band."""
    rows = least.shape[1] // bands
    odd, shift = functions(rows, seed=12)[0], functions(bands, seed=13)[1]
    held = (least.reshape(len(least), bands, rows).astype(np.uint64) + np.uint64(1)) * odd
    return mixed(held.sum(2, dtype=np.uint64) + shift)


def _bitmap(s: np.ndarray) -> bytes:
    bits = np.zeros(BITS, np.uint8)
    bits[(s % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def least_agreement(count: int, percent: int, miss: float) -> int:
    """The greatest c for which a linked pair agrees in fewer than c of
    ``count`` minima with probability ``miss`` at most."""
    p, below = percent / 100, 0.0
    if p >= 1:
        return count
    for c in range(count + 1):
        below += math.exp(math.lgamma(count + 1) - math.lgamma(c + 1) - math.lgamma(count - c + 1)
                          + c * math.log(p) + (count - c) * math.log1p(-p))
        if below > miss:
            return c
    return count


_SIGNED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("hi", pa.int64()),
                     ("lo", pa.int64()), ("keys", pa.list_(pa.int64())), ("sig", pa.binary()), ("bits", pa.binary())])


def signatures(texts: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """For each (row, doc_id, text) its set's size, digest, band keys, one byte
    of every minimum, and bitmap (null for empty sets)."""
    factors, summands = functions(bands * rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for block in gathered(batches, most_rows=512, most_bytes=2 << 20):
            sets = [shingles(body.lower().split(), hashes, words) for body in raw(block.column("text"))]
            full = np.flatnonzero([len(s) > 0 for s in sets])
            own = [sets[i] for i in full]
            least = minima(own, factors, summands)
            keys, sig = band_keys(least, bands).view(np.int64), (least & np.uint32(255)).astype(np.uint8)
            cols: dict[str, list] = {c: [None] * len(sets) for c in ("hi", "lo", "keys", "sig", "bits")}
            for at, i in enumerate(full):
                digest = xxhash.xxh3_128_intdigest(own[at].tobytes())
                cols["hi"][i], cols["lo"][i] = (digest >> 64) - 2**63, (digest & (2**64 - 1)) - 2**63
                cols["keys"][i], cols["sig"][i], cols["bits"][i] = keys[at], sig[at].tobytes(), _bitmap(own[at])
            yield pa.RecordBatch.from_arrays(
                [block.column("row").combine_chunks(), block.column("doc_id").combine_chunks(),
                 pa.array([len(s) for s in sets], pa.int64()),
                 *(pa.array(v, _SIGNED.field(c).type) for c, v in cols.items())], schema=_SIGNED)

    return map_arrow(texts, run, "row long, doc_id long, n_shingles long, hi long, lo long, keys array<long>, "
                     "sig binary, bits binary")


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """(node, n, set) of (row, text): the sorted hashes as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for block in gathered(batches, most_rows=512, most_bytes=2 << 20):
            sets = [shingles(body.lower().split(), hashes, words) for body in raw(block.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [block.column("row").combine_chunks(), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "n", "held"])

    return map_arrow(texts.select("row", "text"), run, "node long, n long, held binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose full sets link."""
    both = (pairs.join(sets.select(F.col("node").alias("x"), F.col("held").alias("sx")), "x")
            .join(sets.select(F.col("node").alias("y"), F.col("held").alias("sy")), "y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays = []
            for a, b in zip(batch.column("sx"), batch.column("sy")):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (a, b))
                if len(a) > len(b):
                    a, b = b, a
                common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
                stays.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["x", "y"]).filter(pa.array(stays, pa.bool_()))

    return map_arrow(both, run, "x long, y long")


def _alike(left: dict, right: dict, cutoff: int, percent: int) -> np.ndarray:
    """Which of all pairs of left and right rows pass the signature and the bound."""
    agree = (left["sig"][:, None] == right["sig"][None]).sum(2)
    lacks = np.bitwise_count(left["bits"][:, None] & ~right["bits"][None]).sum(2, dtype=np.int64)
    lacked = np.bitwise_count(~left["bits"][:, None] & right["bits"][None]).sum(2, dtype=np.int64)
    most = np.minimum(left["n"][:, None] - lacks, right["n"][None] - lacked)
    return (agree >= cutoff) & (100 * most >= percent * (left["n"][:, None] + right["n"][None] - most))


def _columns(table: pa.Table | pa.RecordBatch, end: str = "") -> dict:
    fixed = lambda c, kind: np.frombuffer(b"".join(table.column(c + end).to_pylist()), kind).reshape(table.num_rows, -1)
    return {"sig": fixed("sig", np.uint8), "bits": fixed("bits", np.uint64), "n": table.column("n" + end).to_numpy()}


def _signed_alike(pairs: DataFrame, nodes: DataFrame, cutoff: int, percent: int) -> DataFrame:
    """The pairs (x, y) that pass the signature and the bound."""
    side = {s: nodes.select(*(F.col(c).alias(f"{c}_{s}") for c in ("node", "n", "sig", "bits"))) for s in "xy"}
    both = (pairs.join(side["x"], pairs["x"] == F.col("node_x")).join(side["y"], F.col("y") == F.col("node_y"))
            .drop("node_x", "node_y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (_columns(batch, f"_{s}") for s in "xy")
            most = np.minimum(x["n"] - np.bitwise_count(x["bits"] & ~y["bits"]).sum(1, dtype=np.int64),
                              y["n"] - np.bitwise_count(y["bits"] & ~x["bits"]).sum(1, dtype=np.int64))
            stays = ((x["sig"] == y["sig"]).sum(1) >= cutoff) & (100 * most >= percent * (x["n"] + y["n"] - most))
            yield batch.select(["x", "y"]).filter(pa.array(stays))

    return map_arrow(both, run, "x long, y long")


def _open_pairs(members: DataFrame, bands: int, cutoff: int, percent: int, block: int, rows: int) -> DataFrame:
    """Pairs across components of (key, band, centre, size, node, root, n, sig,
    bits) in open keys.  A key's nodes are dealt to blocks, and a node meets
    every block of its key; ``deal`` gathers block pairs to groups of some ``rows``."""
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = (members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.hash("node"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")))
    total = members.agg(F.sum(blocks)).first()[0] or 0
    dealt = dealt.select(F.pmod(F.xxhash64("key", "i", "j"), F.lit(max(1, -(-total // rows)))).alias("deal"), "key", "i", "j",
                         "own", "band", "centre", "node", "root", "n", "sig", "bits")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        key, i, j, own, band, centre, node, root = (table.column(c).to_numpy() for c in (
            "key", "i", "j", "own", "band", "centre", "node", "root"))
        cols, out = _columns(table), []
        order = np.lexsort((own, j, i, key))
        cuts = np.flatnonzero((np.diff(key[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)) + 1
        for at in np.split(order, cuts):
            if len(at) < 2 or (root[at] == root[at[0]]).all():
                continue
            a, b = i[at[0]], j[at[0]]
            left, right = (at, at) if a == b else (at[own[at] == a], at[own[at] == b])
            for lo in range(0, len(left), 64):
                part = left[lo:lo + 64]
                across = root[part][:, None] != root[right][None]
                if a == b:
                    across &= node[part][:, None] < node[right][None]
                across &= (node[part] != centre[part])[:, None] & (node[right] != centre[right])[None]
                if not across.any():
                    continue
                l, r = ({c: v[rows_] for c, v in cols.items()} for rows_ in (part, right))
                x, y = np.nonzero(across & _alike(l, r, cutoff, percent))
                same = (l["sig"][x] == r["sig"][y]).reshape(len(x), bands, l["sig"].shape[1] // bands).all(2)
                first = same.argmax(1) == band[at[0]]
                out.append(np.stack([node[part[x[first]]], node[right[y[first]]]]))
        x, y = np.concatenate(out, 1) if out else np.empty((2, 0), np.int64)
        return pa.table({"x": pa.array(x), "y": pa.array(y)})

    shipped(members.sparkSession)
    return dealt.groupBy("deal").applyInArrow(run, "x long, y long")


def near_duplicates(docs: DataFrame, percent: int = 80, words: int = 4, bands: int = 48, rows: int = 5, miss: float = 1e-9,
                    block: int = 256, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    cutoff = least_agreement(bands * rows, percent, miss)
    texts = staged(docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc_id"),
                               F.col(text).cast("string").alias("text")), "minhash-texts")
    signed = staged(signatures(texts, words, bands, rows), "minhash-signed")
    named = signed.select("row", "doc_id", "n_shingles", "hi", "lo")
    firsts = staged(named.where("n_shingles > 0").groupBy("hi", "lo").agg(F.min("row").alias("node")), "minhash-nodes")
    nodes = signed.join(firsts.select(F.col("node").alias("row")), "row", "left_semi").withColumnsRenamed(
        {"row": "node", "n_shingles": "n"})

    # keys with two nodes or more
    index = staged(nodes.select("node", F.posexplode("keys").alias("band", "key")), "minhash-index")
    sizes = index.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = staged(index.join(sizes, "key"), "minhash-shared")
    company = staged(shared.groupBy("node").agg(F.sum("size").alias("company")), "minhash-company")
    active = staged(nodes.join(company.select("node"), "node", "left_semi").select("node", "n", "sig", "bits"), "minhash-active")
    sets = staged(_sets(texts.join(company.select(F.col("node").alias("row")), "row", "left_semi"), words), "minhash-sets")

    centres = (shared.join(company, "node").groupBy("key").agg(F.max(F.struct("company", "node")).alias("c"))
               .select("key", F.col("c.node").alias("centre")))
    ranked = staged(shared.join(centres, "key"), "minhash-ranked")
    stars = ranked.where("node != centre").select(F.col("node").alias("x"), F.col("centre").alias("y")).distinct()
    links = staged(_confirmed(staged(_signed_alike(stars, active, cutoff, percent), "minhash-stars"), sets, percent),
                   "minhash-links")
    roots = components(links)

    rooted = ranked.where("size > 2").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    still = (rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a != b").select("key"))
    members = staged(rooted.join(still, "key").join(active, "node"), "minhash-open")
    pairs = staged(_open_pairs(members, bands, cutoff, percent, block, 8192), "minhash-pairs")
    roots = components(links.unionByName(_confirmed(pairs, sets, percent)))

    whole = (named.join(firsts, ["hi", "lo"], "left").join(roots, "node", "left")
             .select("doc_id", "n_shingles", F.coalesce("root", "node").alias("root")))
    least = whole.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return (whole.join(least, "root", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def op11_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
