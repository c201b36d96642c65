"""Operator 4 [native]: quality rules with risk-controlled cutoffs.

Counts of each whole text (words, symbols, repeated lines, repeated 5-word
windows) give shares; a rule rejects a document whose share exceeds a cutoff.
For every stratum (language), rule and candidate cutoff, the good documents of
a labelled holdout that it would reject are counted; the cutoff is safe if the
exact binomial tail ``P(Bin(n, alpha) <= rejected)`` is at most
``delta / tests`` (Bonferroni over all strata, rules and cutoffs), that is, if
with confidence ``1 - delta`` over all choices at once no chosen cutoff rejects
more than ``alpha`` of the stratum's good documents.  The strictest safe cutoff
is used; where none is safe (too few labels), the rule is off.

Only DataFrame and SQL functions; the counts of a text are computed from its
own arrays, with no exchange of words.  Windows are compared by 64-bit hashes.

Cases: null, empty and blank texts have zero words and fail the base rule; a
null language is a stratum of its own; null labels are ignored, a document
labelled twice counts by its least label; equal rows are judged alike; an
empty table gives an empty result; without labels every rule is off."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, staged, words_column

SYMBOLS = "#*$%&|<>"                                     # fixed by the rule
WINDOW = 5
CUTOFFS = {                                              # candidates, strictest first
    "symbol_share": (0.01, 0.02, 0.05, 0.1, 0.2, 0.3),
    "dup_line_share": (0.1, 0.2, 0.3, 0.4, 0.5, 0.6),
    "repeat_share": (0.02, 0.05, 0.08, 0.1, 0.15, 0.2),
    "same_word_share": (0.3, 0.4, 0.5, 0.6, 0.7, 0.8),
}


def counts(docs: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """doc_id, stratum, n_words, word_chars, n_symbols, n_lines (with a word),
    n_dup_lines, n_repeat_words, n_distinct_words (all long)."""
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\u000b\u000c\r"))) > 0)
    known = F.col(stratum).cast("string") if stratum in docs.columns else F.lit(None).cast("string")
    base = (docs.select(F.col(key).cast("long").alias("doc_id"), known.alias("stratum"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
            .select("doc_id", "stratum", "text", words_column("text").alias("words"), lines.alias("lines")))
    counted = base.select(
        "doc_id", "stratum", F.size("words").alias("n"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        reduce(lambda a, b: a + b, [F.octet_length("text") - F.octet_length(F.replace("text", F.lit(s), F.lit("")))
                                    for s in SYMBOLS]).alias("n_symbols"),
        F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size(F.array_distinct("words")).alias("n_distinct_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    windows = F.when(F.col("n") >= WINDOW, F.expr(
        f"transform(sequence(0, n - {WINDOW}), i -> xxhash64({', '.join(f'h[i + {k}]' for k in range(WINDOW))}))"
    )).otherwise(F.expr("array()").cast("array<bigint>"))
    hashed = counted.select("*", windows.alias("w")).select(
        "*", (F.size(F.array_distinct("w")) < F.size("w")).alias("again"), F.expr("length(bin(n))").alias("bits"))
    # hash and place in one long, sorted: equal hashes stand side by side
    packed = F.when(F.col("again"), F.expr(
        "sort_array(transform(w, (x, i) -> (shiftleft(x, bits) | cast(i as bigint))))"))
    repeated = F.when(F.col("again"), F.expr("""
        sort_array(transform(filter(transform(s, (x, k) -> named_struct('at', cast(x & (shiftleft(1L, bits) - 1) as int),
            'low', if(k > 0, cast(s[k - 1] & (shiftleft(1L, bits) - 1) as int), -1),
            'high', if(k < size(s) - 1, cast(s[k + 1] & (shiftleft(1L, bits) - 1) as int), -1))),
            p -> (p.low >= 0 and w[p.at] = w[p.low]) or (p.high >= 0 and w[p.at] = w[p.high])), p -> p.at))"""))
    covered = F.when(F.col("again"), F.expr(f"""
        aggregate(at, named_struct('last', -{WINDOW}, 'sum', 0),
            (a, p) -> named_struct('last', p, 'sum', a.sum + least({WINDOW}, p - a.last)), a -> a.sum)""")).otherwise(0)
    return (hashed.select("*", packed.alias("s")).select("*", repeated.alias("at"))
            .select("doc_id", "stratum", F.col("n").cast("long").alias("n_words"),
                    *(F.col(c).cast("long").alias(c) for c in
                      ("word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_distinct_words")),
                    covered.cast("long").alias("n_repeat_words")))


def shares(counted: DataFrame) -> DataFrame:
    """The rules' shares beside the counts."""
    part = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return (counted.withColumn("symbol_share", part("n_symbols", "word_chars"))
            .withColumn("dup_line_share", part("n_dup_lines", "n_lines"))
            .withColumn("repeat_share", part("n_repeat_words", "n_words"))
            .withColumn("same_word_share", 1 - part("n_distinct_words", "n_words")))


def _log_gamma(x: str) -> str:
    """SQL for ln Gamma(x), x >= 1: Stirling's series at x + 8."""
    y, rising = f"({x} + 8)", " * ".join(f"({x} + {i})" for i in range(8))
    return (f"(({y} - 0.5) * ln({y}) - {y} + 0.5 * ln(2 * pi()) + 1 / (12 * {y}) - 1 / (360 * pow({y}, 3)) "
            f"+ 1 / (1260 * pow({y}, 5)) - 1 / (1680 * pow({y}, 7)) - ln({rising}))")


def binomial_tail(n: str, k: str, p: float) -> Column:
    """P(Bin(n, p) <= k) where k < n p, and 1 otherwise; ``n`` and ``k`` name
    DOUBLE columns.  Terms are summed downwards from k; those beyond twelve
    standard deviations are below double precision."""
    log_term = (f"{_log_gamma(f'({n} + 1)')} - {_log_gamma(f'({k} + 1)')} - {_log_gamma(f'({n} - {k} + 1)')} "
                f"+ {k} * ln({p!r}D) + ({n} - {k}) * ln(1 - {p!r}D)")
    terms = f"cast(least({k}, 200 + ceil(12 * sqrt({n} * {p!r}D))) as int)"
    ratio = f"({k} - j) * (1 - {p!r}D) / (({n} - {k} + j + 1) * {p!r}D)"
    return F.expr(f"""case when {k} >= {n} * {p!r}D or {n} = 0 then 1D else least(1D, exp({log_term}) *
        aggregate(sequence(0, {terms}), named_struct('term', 1D, 'sum', 0D),
                  (a, j) -> named_struct('term', a.term * {ratio}, 'sum', a.sum + a.term), a -> a.sum)) end""")


def cutoffs(shared: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality",
            alpha: float = 0.005, delta: float = 0.05, candidates: dict | None = None) -> DataFrame:
    """stratum and, for each rule, the strictest safe cutoff (null: off)."""
    candidates = candidates or CUTOFFS
    good = (labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
            .where("label in (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label")).where("label = 1"))
    grid = [(rule, c) for rule, cs in candidates.items() for c in cs]
    held = shared.join(good, "doc_id", "left_semi")
    tallies = (held.groupBy("stratum")
               .agg(F.count("*").cast("double").alias("n"),
                    *(F.sum((F.col(r) > c).cast("int")).cast("double").alias(f"k{i}") for i, (r, c) in enumerate(grid))))
    tests = held.agg((F.count_distinct(F.coalesce("stratum", F.lit("")))    # a null stratum counts with ''
                      + F.max(F.col("stratum").isNull().cast("int"))) * len(grid)).scalar()
    safe = tallies.withColumn("tests", tests).select("stratum", *(
        (binomial_tail("n", f"k{i}", alpha) <= delta / F.col("tests")).alias(f"safe{i}") for i in range(len(grid))))
    strictest = []
    for rule in candidates:
        cases = [F.when(F.col(f"safe{i}"), F.lit(float(c))) for i, (r, c) in enumerate(grid) if r == rule]
        strictest.append(F.coalesce(*cases).alias(f"{rule}_cut"))
    return safe.select("stratum", *strictest)


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang",
          label: str = "quality", alpha: float = 0.005, delta: float = 0.05) -> DataFrame:
    """Counts, base_failed, the failed rules and kept, one row per document."""
    shared = shares(staged(counts(docs, key, text, stratum), "rule-counts"))
    cuts = staged(cutoffs(shared, labels, key, label, alpha, delta), "rule-cutoffs")   # one row per stratum
    joined = shared.join(cuts.withColumnRenamed("stratum", "cut_stratum"),
                         F.col("stratum").eqNullSafe(F.col("cut_stratum")), "left")
    failed = F.array_compact(F.array(*(F.when(F.col(r) > F.col(f"{r}_cut"), F.lit(r)) for r in CUTOFFS)))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (joined.withColumn("base_failed", base).withColumn("failed_rules", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "failed_rules"))


def op4_risk_controlled_rules(spark, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("failed_rules")
