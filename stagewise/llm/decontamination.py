"""Operator 5 [native]: benchmark passages by spaced seeds.

A mask fixes which of a window's words count (1) and which do not (0).  The
words that count are hashed, at every place of every text and every benchmark
item, for several masks; a passage with some words replaced still agrees under
a mask that ignores them.  Documents' seeds are first tested against a bit set
of fixed size made from the benchmark's seeds (a Bloom filter), so that only
seeds that may match leave their task; these carry the word hashes around
them.  They are joined with the benchmark's seeds, and a hit is verified on
the words around it: some run of ``span`` words (the whole item, if shorter)
must agree in at least ``similarity`` of its places.

From 11 words on, three masks meet every allowed pattern of replaced words.
Shorter items have masks of their own length: all ways to leave out as many
words as may differ (none up to 4 words, one up to 9, two of 10).  Masks are
made for the lengths that the benchmark has; without short items there are none.

Only DataFrame and SQL functions.  The bit set does not grow with the data; a
benchmark too large for it passes more seeds on, with the same result.

Words are lower-cased.  Cases: null and empty texts and items have no seeds;
equal items are found as often as they stand; equal rows count as one
document; empty tables give an empty result; extra columns are ignored."""

from __future__ import annotations

from itertools import combinations
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, staged, words_column

MASKS = ("1101011", "11100101", "110010101")
SHORT = 10                                               # items up to so many words have masks of their own
REACH = 13
BITS = 24                                                # log2 of the bit set's size
BLOCK = 256                                              # places of a text that are looked at in one row


def _hashes(df: DataFrame, key: str, text: str, name: str) -> DataFrame:
    words = words_column(F.lower(F.col(text).cast("string")))
    return df.select(F.col(key).cast("long").alias(name), F.transform(words, lambda w: F.xxhash64(w)).alias("h"))


def short_masks(words: int, similarity: float) -> list[str]:
    """All ways to leave out the words of a short item that may differ."""
    out = words - ceil(words * similarity - 1e-9)
    return ["".join("0" if k in gaps else "1" for k in range(words)) for gaps in combinations(range(words), out)]


def _blocks(hashed: DataFrame, key: str, masks: list[str]) -> DataFrame:
    """(key, h) cut into rows of BLOCK places each: words (of the whole text),
    base (the first of the places), first (the place of h's first word), h (the
    words of these places and those that masks and runs around them reach).

    Spark keeps all rows that a generator makes of one row until that row is
    done, and each seed's row has its h with it.  With whole texts these are
    as many copies of a text as it has seeds that may match."""
    first, reach = f"greatest(b - {REACH}, 0)", BLOCK + max(map(len, masks)) + REACH
    return hashed.select(key, F.inline(F.expr(f"""transform(sequence(0, greatest(size(h) - 1, 0), {BLOCK}),
        b -> named_struct('words', size(h), 'base', b, 'first', {first},
                          'h', slice(h, {first} + 1, b - {first} + {reach})))""")))


def _seeds(masks: list[str]) -> Column:
    """The seeds of all masks at place ``at`` of the array h, in the masks' order:
    the hashes of the words that count, each rotated by its own number of bits."""
    def rotated(place: int, bits: int) -> str:
        x = f"get(h, at + {place})"
        return f"(shiftleft({x}, {bits}) | shiftrightunsigned({x}, {64 - bits}))" if bits else x
    return F.array(*(F.expr(" ^ ".join(rotated(k, 7 * n) for n, k in enumerate(
        k for k, c in enumerate(mask) if c == "1"))) for mask in masks))


def _placed(hashed: DataFrame, key: str, masks: list[str]) -> DataFrame:
    """The blocks of (key, h) with a row per place and mask that fits the text:
    at (the place in h), i (in the text), mask, seed.  Generators keep each seed
    a computed column, so that the tests on it stay small enough to be compiled."""
    spans = F.element_at(F.array(*(F.lit(len(m)) for m in masks)), F.col("mask") + 1)
    return (_blocks(hashed, key, masks).select("*", F.posexplode("h").alias("at", "_h"))
            .withColumn("i", F.col("first") + F.col("at"))
            .where(f"i >= base and i < base + {BLOCK}")
            .select(key, "words", "h", "at", "i", F.posexplode(_seeds(masks)).alias("mask", "seed"))
            .where(F.col("i") + spans <= F.col("words")))


def _around(masks: list[str]) -> Column:
    return F.expr(f"transform(sequence(-{REACH}, {max(map(len, masks)) + REACH}), k -> get(h, at + k))")


def seeds(items: DataFrame, masks: list[str]) -> DataFrame:
    """All seeds of (item_id, h): item_id, mask, seed, item_at, item_words,
    around; short items only by the masks of their length."""
    length = F.element_at(F.array(*(F.lit(len(m) if k >= len(MASKS) else 0) for k, m in enumerate(masks))), F.col("mask") + 1)
    own = F.when(F.col("words") <= SHORT, F.col("words")).otherwise(0)
    return (_placed(items, "item_id", masks).where(length == own)
            .select("item_id", "mask", "seed", F.col("i").alias("item_at"), F.col("words").alias("item_words"),
                    _around(masks).alias("item_around")))


def bit_set(seeded: DataFrame, bits: int = BITS) -> Column:
    """array<bigint> of 2^bits bits in which each seed sets two, as a scalar subquery."""
    words = 1 << (bits - 6)
    spark = seeded.sparkSession
    marks = (seeded.select(F.explode(F.array("seed", F.expr("shiftright(seed, 32)"))).alias("x"))
             .select(F.expr(f"cast(shiftright(x, 6) & {words - 1} as int)").alias("w"),
                     F.expr("shiftleft(1L, cast(x & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    every = spark.range(words).select(F.col("id").cast("int").alias("w"))
    return (every.join(marks, "w", "left").agg(F.expr(
        "transform(array_sort(collect_list(named_struct('w', w, 'b', coalesce(b, 0L)))), x -> x.b)").alias("bits"))
        .scalar())


def _marked(bits: Column, size: int = BITS) -> Column:
    """Both bits of the column seed are set."""
    def one(x: str) -> Column:
        word = F.expr(f"cast(shiftright({x}, 6) & {(1 << (size - 6)) - 1} as int)")
        return F.getbit(F.get(bits, word), F.expr(f"cast({x} & 63 as int)")) == 1
    return one("seed") & one("shiftright(seed, 32)")


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text",
          span: int = REACH, similarity: float = 0.8) -> DataFrame:
    """One row per document and item with a verified overlap: doc_id, item_id,
    first_word (place in the document of the best run), agreeing (words that
    agree in it), run_words, hits (verified seed hits)."""
    hashed = _hashes(benchmark, item, text, "item_id")
    lengths = sorted(r[0] for r in hashed.select(F.size("h").alias("n")).where(f"n between 1 and {SHORT}").distinct().collect())
    masks = [*MASKS, *(m for n in lengths for m in short_masks(n, similarity))]
    items = staged(seeds(hashed, masks), "benchmark-seeds")
    found = (_placed(_hashes(docs, key, text, "doc_id"), "doc_id", masks).where(_marked(bit_set(items)))
             .select("doc_id", "i", "mask", "seed", _around(masks).alias("around")))
    # agreement place by place around the seed; a run of ``w`` words begins at place o (from 1)
    agree = F.expr("transform(zip_with(around, item_around, (a, b) -> a = b), x -> if(x, 1, 0))")
    w = F.least(F.lit(span), F.col("item_words"))
    # the run must lie inside the item: item places item_at - REACH + o - 1 … + w - 1
    best = F.expr(f"""array_max(transform(filter(sequence(1, size(agree) - w + 1),
        o -> item_at - {REACH} + o - 1 >= 0 and item_at - {REACH} + o - 1 + w <= item_words),
        o -> named_struct('n', aggregate(slice(agree, o, w), 0, (a, x) -> a + x), 'o', -o)))""")
    verified = (found.join(items, ["mask", "seed"]).withColumn("agree", agree).withColumn("w", w)
                .withColumn("best", best).where(F.col("best.n") >= F.ceil(F.col("w") * similarity - 1e-9))
                .select("doc_id", "item_id", "w", F.col("best.n").alias("n"),
                        (F.col("i") - REACH - F.col("best.o") - 1).alias("at")))
    return (verified.groupBy("doc_id", "item_id")
            .agg(F.max(F.struct("n", (-F.col("at")).alias("at"), "w")).alias("b"), F.count("*").alias("hits"))
            .select("doc_id", "item_id", (-F.col("b.at")).cast("long").alias("first_word"),
                    F.col("b.n").cast("long").alias("agreeing"), F.col("b.w").cast("long").alias("run_words"), "hits"))


def without_leaks(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the documents of ``found`` (null keys stay)."""
    ids = found.select("doc_id").distinct().alias("found")
    return docs.alias("own").join(ids, F.col(f"own.`{key}`") == F.col("found.doc_id"), "left_anti")


def op5_spaced_seed_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
