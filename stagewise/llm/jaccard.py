"""Operator 8: n-gram Jaccard self-join by token-combination prefixes.

A document's set holds its distinct 5-word shingles; two documents link when
100 * |A & B| >= 80 * |A | B|.  The result is one row per document with its
connected component, so copies need not be written as pairs.

1. Equal sets are one *node*.  Every block of documents reports the shingles
   that are frequent in it; those frequent over all are *heavy* (a list whose
   length is bounded by mean set size / share, so it may be broadcast).
2. All other shingles are counted exactly: blocks send them, sorted and packed,
   to buckets whose number follows the number of shingles.  No shingle held by
   more than a small share of the nodes goes through here, so no bucket grows
   with one shingle.  Only shingles with two or more nodes are sent back; a
   node whose set is not made of shared shingles to 80 % can have no link.
3. Shingles are ordered by count (heavy last).  Two linked sets A, B share at
   least k shingles within the first ``|A| - ceil(0.8 |A|) + k`` of each.  A
   node is indexed under every *rare* shingle of that prefix and, for the
   *frequent* ones, under their combinations of k = 2 where they are few
   (at most ``few``); a node with more of them is indexed under the single
   ones, and meets there also the nodes with few (these are indexed under both
   forms, but do not meet each other under single ones).  So every linked pair
   shares a key.
4. In every key the most central node (fewest unshared shingles) is compared
   first; verified links form components.  Keys whose nodes still lie in
   different components then compare all such nodes that a bound allows to
   link: a node's shared shingles set bits of a bitmap, and every bit that one
   node has and the other lacks is a shingle they do not share.  Every link
   between components is thus verified or excluded by its bound; links inside
   a component need no test.

Verification intersects the shared shingles of both sets (56-bit hashes).

Cases: a text with 1 to 4 words has one shingle, its whole sequence; null and
blank texts have an empty set and are linked with nothing (component_id is
their own id); equal rows are linked; equal doc_ids share a row per text; very
long texts are read whole; an empty table gives an empty result; extra columns
are ignored."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, documents, gathered, map_arrow, mixed, raw, shipped, staged, windows_hash

HEAVY = np.uint32(0xFFFFFFFF)
K = 2
SIGNATURE = 16        # 64-bit words of a node's bitmap


def shingle_set(words: list[bytes], hashes: WordHashes, n: int) -> np.ndarray:
    """Sorted distinct 56-bit hashes of the n-word shingles."""
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    if len(h) < n:                                          # a sequence of its own length
        h = windows_hash(h, len(h)) ^ mixed(np.array([len(h)], np.uint64))
    else:
        h = windows_hash(h, n)
    return np.unique(h >> np.uint64(8))


def _block_sets(block: pa.Table, hashes: WordHashes, n: int) -> list[np.ndarray]:
    return [shingle_set(body.lower().split(), hashes, n) for body in raw(block.column("text"))]


def _node(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _nodes(docs: DataFrame, n: int, share: float) -> DataFrame:
    """doc_id, n_shingles, node (null: empty set); on some rows also the
    shingles frequent in their block, with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for block in gathered(batches):
            sets = _block_sets(block, hashes, n)
            nodes = [_node(s) if len(s) else None for s in sets]
            own = {v: s for v, s in zip(nodes, sets) if v is not None}
            heavy: list = [None] * len(sets)
            if own:
                values, count = np.unique(np.concatenate(list(own.values())), return_counts=True)
                often = count >= max(8, share * len(own))
                heavy[0] = [{"h": int(h), "c": int(c), "of": len(own)}
                            for h, c in zip(values[often].view(np.int64), count[often])]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").combine_chunks(), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(nodes, pa.int64()), pa.array(heavy, pa.list_(pa.struct(
                     [("h", pa.int64()), ("c", pa.int64()), ("of", pa.int64())])))],
                names=["doc_id", "n_shingles", "node", "heavy"])

    return map_arrow(docs, run, "doc_id long, n_shingles long, node long, "
                     "heavy array<struct<h: long, c: long, of: long>>")


def _pack(h: np.ndarray) -> tuple[int, int, bytes]:
    """First value, bytes per step, and the steps of a sorted array."""
    steps = np.diff(h)
    width = 5 if not len(steps) or int(steps.max()) < 1 << 40 else 8
    return int(h[0]), width, np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpack(first: int, width: int, steps: bytes) -> np.ndarray:
    held = np.frombuffer(steps, np.uint8).reshape(-1, width)
    wide = np.zeros((len(held), 8), np.uint8)
    wide[:, :width] = held
    return np.cumsum(np.concatenate([[np.uint64(first)], wide.view("<u8").ravel()]).astype(np.uint64))


_SENT = pa.schema([("bucket", pa.int32()), ("first", pa.int64()), ("width", pa.int32()), ("steps", pa.binary()),
                   ("at", pa.binary()), ("nodes", pa.binary()), ("sizes", pa.binary())])


def _sent(docs: DataFrame, n: int, heavy: np.ndarray, buckets: int) -> DataFrame:
    """Packed (shingle, node) entries for the counting buckets; those of heavy
    shingles go to buckets from ``buckets`` on, dealt by block."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for block in gathered(batches, most_rows=60_000):
            own = {_node(s): s for s in _block_sets(block, hashes, n) if len(s)}
            if not own:
                continue
            nodes = np.fromiter(own, np.int64, len(own))
            sizes = np.fromiter(map(len, own.values()), np.int32, len(own))
            h = np.concatenate(list(own.values()))
            at = np.repeat(np.arange(len(own)), sizes)
            order = np.argsort(h, kind="stable")
            h, at = h[order], at[order]
            bucket = ((h >> np.uint64(24)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            place = np.minimum(np.searchsorted(shared.value, h), max(len(shared.value) - 1, 0))
            is_heavy = shared.value[place] == h if len(shared.value) else np.zeros(len(h), bool)
            rows = []
            deal = buckets + zlib.crc32(nodes.tobytes()) % buckets
            for mask, fixed in ((~is_heavy, None), (is_heavy, deal)):
                hh, aa, bb = h[mask], at[mask], bucket[mask]
                cuts = np.flatnonzero(np.diff(bb)) + 1 if fixed is None else np.empty(0, np.int64)
                for lo, hi in zip([0, *cuts], [*cuts, len(hh)]):
                    if lo == hi:
                        continue
                    used, back = np.unique(aa[lo:hi], return_inverse=True)
                    first, width, steps = _pack(hh[lo:hi])
                    rows.append({"bucket": int(bb[lo]) if fixed is None else fixed, "first": first, "width": width,
                                 "steps": steps, "at": back.astype("<u2").tobytes(), "nodes": nodes[used].tobytes(),
                                 "sizes": sizes[used].tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=_SENT)

    return map_arrow(docs.select("text"), run, "bucket int, first long, width int, steps binary, at binary, "
                     "nodes binary, sizes binary")


_BACK = pa.schema([("dest", pa.int32()), ("nodes", pa.binary()), ("sizes", pa.binary()), ("runs", pa.binary()),
                   ("h", pa.binary()), ("counts", pa.binary())])


def _counted(sent: DataFrame, buckets: int) -> DataFrame:
    """Shared shingles with their counts, packed by node for ``buckets`` destinations."""
    def one(table: pa.Table) -> pa.Table:
        hs, nodes, sizes = [], [], []
        for r in table.to_pylist():
            at = np.frombuffer(r["at"], "<u2")
            hs.append(_unpack(r["first"], r["width"], r["steps"]))
            nodes.append(np.frombuffer(r["nodes"], np.int64)[at])
            sizes.append(np.frombuffer(r["sizes"], np.int32)[at])
        h, node, size = map(np.concatenate, (hs, nodes, sizes))
        order = np.lexsort((node, h))
        h, node, size = h[order], node[order], size[order]
        once = np.append(True, (h[1:] != h[:-1]) | (node[1:] != node[:-1]))    # equal sets of several blocks
        h, node, size = h[once], node[once], size[once]
        if table.column("bucket")[0].as_py() >= buckets:
            count = np.full(len(h), HEAVY, np.uint32)
        else:
            starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            runs = np.diff(np.append(starts, len(h)))
            count = np.repeat(np.minimum(runs, 0xFFFFFFFE), runs).astype(np.uint32)
            some = count > 1
            h, node, size, count = h[some], node[some], size[some], count[some]
        dest = (node.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((h, node, dest))
        h, node, size, count, dest = (x[order] for x in (h, node, size, count, dest))
        cuts = np.flatnonzero(np.diff(dest)) + 1
        rows = []
        for lo, hi in zip([0, *cuts], [*cuts, len(h)]):
            if lo < hi:
                starts = np.flatnonzero(np.append(True, node[lo + 1:hi] != node[lo:hi - 1]))
                rows.append({"dest": int(dest[lo]), "nodes": node[lo:hi][starts].tobytes(),
                             "sizes": size[lo:hi][starts].tobytes(),
                             "runs": np.diff(np.append(starts, hi - lo)).astype("<u4").tobytes(),
                             "h": h[lo:hi].tobytes(), "counts": count[lo:hi].tobytes()})
        return pa.Table.from_pylist(rows, schema=_BACK)

    shipped(sent.sparkSession)
    return sent.groupBy("bucket").applyInArrow(
        one, "dest int, nodes binary, sizes binary, runs binary, h binary, counts binary")


def _active(counted: DataFrame, percent: int) -> DataFrame:
    """Nodes that may have links: node, n, u (shingles no other node has), h
    (shared shingles in count order), rare_to and often (see ``_keys``)."""
    def one(table: pa.Table) -> pa.Table:
        parts = {c: [] for c in ("node", "size", "h", "count")}
        for r in table.to_pylist():
            runs = np.frombuffer(r["runs"], "<u4")
            parts["node"].append(np.repeat(np.frombuffer(r["nodes"], np.int64), runs))
            parts["size"].append(np.repeat(np.frombuffer(r["sizes"], np.int32), runs))
            parts["h"].append(np.frombuffer(r["h"], np.uint64))
            parts["count"].append(np.frombuffer(r["counts"], np.uint32))
        node, size, h, count = (np.concatenate(parts[c]) for c in ("node", "size", "h", "count"))
        order = np.lexsort((h, node))
        node, size, h, count = (x[order] for x in (node, size, h, count))
        once = np.append(True, (h[1:] != h[:-1]) | (node[1:] != node[:-1]))   # a heavy shingle of several blocks
        node, size, h, count = (x[once] for x in (node, size, h, count))
        order = np.lexsort((h, count, node))
        node, size, h, count = (x[order] for x in (node, size, h, count))
        starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        rows = []
        for lo, hi in zip(starts, np.append(starts[1:], len(node))):
            n = int(size[lo])
            if 100 * (hi - lo) >= percent * n:
                bits = np.zeros(64 * SIGNATURE, np.uint8)
                bits[(h[lo:hi] % np.uint64(64 * SIGNATURE)).astype(np.int64)] = 1
                rows.append({"node": int(node[lo]), "n": n, "u": n - int(hi - lo), "h": h[lo:hi].view(np.int64),
                             "bits": np.packbits(bits).view(np.int64),
                             "counts": np.minimum(count[lo:hi], 0x7FFFFFFF).astype(np.int32)})
        return pa.Table.from_pylist(rows, schema=pa.schema(
            [("node", pa.int64()), ("n", pa.int32()), ("u", pa.int32()), ("h", pa.list_(pa.int64())),
             ("bits", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32()))]))

    return counted.groupBy("dest").applyInArrow(one, 
        "node long, n int, u int, h array<long>, bits array<long>, counts array<int>")


def _keys(active: DataFrame, percent: int, often: int, few: int) -> DataFrame:
    """The index: key, single (a frequent shingle by itself), few (the node has
    few frequent shingles), node, n, u."""
    need = F.ceil(F.col("n") * percent / 100 - F.lit(1e-9))
    prefix = F.greatest(F.lit(0), F.least(F.size("h"), (F.col("n") - need + K - F.col("u")).cast("int")))
    base = (active.select("node", "n", "u", F.slice("h", 1, prefix).alias("h"), F.slice("counts", 1, prefix).alias("c"))
            .withColumn("m", F.size(F.filter("c", lambda c: c > often)))
            .withColumn("rare", F.expr("slice(h, 1, size(h) - m)"))
            .withColumn("freq", F.expr("slice(h, size(h) - m + 1, m)")))
    pairs = f"""if(m between 2 and {few}, flatten(transform(sequence(1, m - 1), i -> transform(sequence(i + 1, m),
        j -> named_struct('key', xxhash64(freq[i - 1], freq[j - 1]), 'single', false)))),
        cast(array() as array<struct<key: bigint, single: boolean>>))"""
    every = F.concat(F.transform("rare", lambda x: F.struct(x.alias("key"), F.lit(False).alias("single"))),
                     F.transform("freq", lambda x: F.struct(x.alias("key"), F.lit(True).alias("single"))), F.expr(pairs))
    return (base.select("node", "n", "u", (F.col("m") <= few).alias("few"), F.explode(every).alias("k"))
            .select(F.col("k.key").alias("key"), F.col("k.single").alias("single"), "few", "node", "n", "u"))


def _linked(pairs: DataFrame, active: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) that link."""
    sets = active.select("node", "n", "h")
    x = pairs.join(sets.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("h").alias("hx")), "x")
    both = x.join(sets.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("h").alias("hy")), "y")
    common = both.select("x", "y", "nx", "ny", F.size(F.array_intersect("hx", "hy")).alias("common"))
    return common.where(100 * F.col("common") >= percent * (F.col("nx") + F.col("ny") - F.col("common"))).select("x", "y")


def components(links: DataFrame) -> DataFrame:
    """node and root (the least node of its component) of all nodes with links.

    Alternates large-star and small-star steps (every node points to the least
    neighbour) until nothing changes; only minima are gathered per node."""
    links = staged(links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u > v").distinct(),
                   "links")
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = staged(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .where("u > v").distinct(), "links")
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        stars = staged(large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
                       .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "links")
        changed = stars.exceptAll(links).isEmpty() and links.exceptAll(stars).isEmpty()
        links = stars
        if changed:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` with further links: they start from the stars found so far."""
    if links.isEmpty():
        return roots
    return components(links.unionByName(roots.select(F.col("node").alias("x"), F.col("root").alias("y"))))


def _rooted(index: DataFrame, roots: DataFrame) -> DataFrame:
    return index.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def join(docs: DataFrame, percent: int = 80, words: int = 5, key: str = "doc_id", text: str = "text",
         share: float = 0.002, often: int = 64, few: int = 12, bucket_shingles: int = 2_000_000) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    every = staged(_nodes(texts, words, share), "shingle-nodes")
    nodes = every.select("doc_id", "n_shingles", "node")
    totals = nodes.agg(F.sum("n_shingles").alias("shingles"), F.approx_count_distinct("node").alias("nodes")).first()
    # a shingle held by ``share`` of all nodes is held by as many of some block's
    heavy = np.sort(every.select(F.explode("heavy").alias("x")).groupBy("x.h").agg(F.sum("x.c").alias("c"))
                    .where(F.col("c") >= share / 2 * (totals["nodes"] or 0)).select("h").toPandas()["h"]
                    .to_numpy(np.int64).view(np.uint64))
    buckets = max(1, -(-(totals["shingles"] or 0) // bucket_shingles))
    counted = _counted(_sent(texts, words, heavy, buckets), buckets)
    active = staged(_active(counted, percent), "shingle-active")
    index = staged(_keys(active, percent, often, few), "shingle-index")

    groups = ["key", "single"]
    centre = (index.groupBy(*groups).agg(F.count("*").alias("size"), F.min(F.struct("u", "node")).alias("c"))
              .where("size > 1").select(*groups, F.col("c.node").alias("y")))
    stars = staged(index.select(*groups, F.col("node").alias("x")).join(centre, groups).where("x != y")
                   .groupBy("x", "y").agg(F.count("*").alias("keys")), "shingle-stars")
    best = stars.groupBy("x").agg(F.max(F.struct("keys", "y")).alias("b")).select("x", F.col("b.y").alias("y"))
    roots = components(_linked(best, active, percent))
    # other centres, where they lie in other components
    rest = (stars.select("x", "y").join(roots.select(F.col("node").alias("x"), F.col("root").alias("rx")), "x", "left")
            .join(roots.select(F.col("node").alias("y"), F.col("root").alias("ry")), "y", "left")
            .where(F.coalesce("rx", "x") != F.coalesce("ry", "y")).select("x", "y"))
    tried = staged(rest.join(best, ["x", "y"], "left_anti"), "shingle-tried")
    roots = _merged(roots, staged(_linked(tried, active, percent), "shingle-links"))
    # keys with several components: all their pairs that the bounds allow
    rooted = _rooted(index, roots)
    open_keys = (rooted.groupBy(*groups).agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a != b")
                 .select(*groups))
    members = staged(rooted.join(open_keys, groups).join(active.select("node", "bits"), "node")
                     .select(*groups, "few", "node", "n", "u", "root", "bits"), "shingle-open")
    left, right = (members.select(*groups, *(F.col(c).alias(f"{c}_{side}") for c in
                                             ("few", "node", "n", "u", "root", "bits"))) for side in "xy")
    lacks = lambda a, b: F.expr(" + ".join(f"bit_count(bits_{a}[{i}] & ~bits_{b}[{i}])" for i in range(SIGNATURE)))
    most = F.least(F.col("n_x") - F.col("u_x") - lacks("x", "y"), F.col("n_y") - F.col("u_y") - lacks("y", "x"))
    allowed = ((F.col("root_x") < F.col("root_y")) & ~(F.col("single") & F.col("few_x") & F.col("few_y"))
               & (100 * most >= percent * (F.col("n_x") + F.col("n_y") - most)))
    pairs = (left.join(right, groups).where(allowed).select(F.col("node_x").alias("x"), F.col("node_y").alias("y"))
             .distinct())
    done = stars.select("x", "y").unionByName(stars.select(F.col("y").alias("x"), F.col("x").alias("y")))
    others = staged(pairs.join(done, ["x", "y"], "left_anti"), "shingle-pairs")
    roots = _merged(roots, staged(_linked(others, active, percent), "shingle-links"))

    whole = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = whole.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return (whole.join(least, "root", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def op8_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return join(documents(spark, sf_dir))
