"""Held-out accuracy of the toxicity models and the co-trained classifier."""

import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import SF_CHECK
from pyspark.sql import functions as F

from stagewise.llm import quality_classifier, toxicity


def _model(words_toxic, words_ordinary, words_all):
    frames = []
    for counts in (None, (words_toxic, words_ordinary)):
        rows = []
        for label, words in enumerate(counts or (words_all,)):
            tally = Counter(words)
            names = list(tally)
            weight = np.array([tally[w] for w in names])
            keys, prefixes, inside, index = toxicity._places(names)
            for o in range(toxicity.ORDER):
                ok = inside[o]
                rows += [(o + 1, k, p, s, n, label) for k, p, s, n in zip(
                    keys[o][ok], prefixes[o][ok], keys[o - 1][ok] if o else np.zeros_like(keys[0])[ok], weight[index][ok])]
        f = pd.DataFrame(rows, columns=["o", "key", "prefix", "suffix", "n", "label"])
        f["toxic"], f["ordinary"] = f["n"] * (f["label"] == 0), f["n"] * (f["label"] == 1)
        f = f.groupby(["o", "key", "prefix", "suffix"], as_index=False)[["toxic", "ordinary"]].sum()
        frames.append(f[f["o"] <= toxicity.SHARED + 1] if counts is None else f[f["o"] > toxicity.SHARED])
    return toxicity.Model(*frames)


def _kneser_ney(words, shared, history, char):
    """P(char | history) of one class, by the recursion."""
    def grams(ws, o):
        return Counter(s[i - o + 1: i + 1] for w in ws for s in ["\x02" + w + "\x03"] for i in range(max(1, o - 1), len(s)))

    def p(h, order):
        if order == 0:
            return 1 / len(grams(shared, 1))
        h = h[len(h) - order + 1:] if order > 1 else ""
        if order <= toxicity.SHARED:
            kinds = Counter(g[1:] for g in grams(shared, order + 1))
            c = {g: kinds.get(g, 0) for g in grams(shared, order)}
        else:
            c = grams(words, order)
        own = {g: n for g, n in c.items() if g[:-1] == h}
        total, some = sum(own.values()), sum(n > 0 for n in own.values())
        if not total:
            return p(h, order - 1)
        return max(own.get(h + char, 0) - 0.75, 0) / total + 0.75 * some / total * p(h, order - 1)

    return p(history, min(toxicity.ORDER, len(history) + 1))


def test_ratios_follow_the_recursion():
    rng = random.Random(1)
    make = lambda n: ["".join(rng.choice("abc") for _ in range(rng.randint(1, 8))) for _ in range(n)]
    toxic, ordinary = make(40), make(60)
    every = toxic + ordinary + make(50)
    model = _model(toxic, ordinary, every)
    words = make(15) + toxic[:3] + ordinary[:3]
    for word, got in zip(words, model.ratios(words)):
        s, expected = "\x02" + word + "\x03", 0.0
        for i in range(1, len(s)):
            h = s[max(0, i - 5): i]
            expected += math.log(_kneser_ney(toxic, every, h, s[i]) / _kneser_ney(ordinary, every, h, s[i]))
        assert got == pytest.approx(expected, abs=1e-3)


def test_rare_expressions_share_their_letters():
    model = _model(["grobian", "grobsack", "grobklotz"] * 5, ["garten", "sonne", "morgen"] * 20,
                   ["grobian", "grobsack", "grobklotz", "garten", "sonne", "morgen"])
    new, known = model.ratios(["grobheit", "garten"])
    assert new > 0 > known


def _auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    n = label.sum()
    return (rank[label == 1].sum() - n * (n - 1) / 2) / (n * (len(label) - n))


def test_toxicity_on_held_out_labels(spark):
    got = toxicity.op2_kneser_ney_toxicity(spark, SF_CHECK)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert got.where("held_out is null or not score between 0 and 1 or predicted != int(score >= 0.7)").count() == 0
    rows = got.where("held_out").join(spark.read.parquet(f"{SF_CHECK}/labels.parquet"), "doc_id").toPandas()
    assert _auc(rows["score"].to_numpy(), rows["toxic"].to_numpy()) > 0.9   # 33 toxic texts to learn from


def test_labels_do_not_leak(spark):
    """Held-out labels, languages and sources may change: the scores do not."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    held = F.expr("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1")
    base = toxicity.score(docs, labels, held).select("doc_id", "score")
    other = toxicity.score(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y")),
                           labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic"))), held)
    a, b = (dict(map(tuple, x.select("doc_id", "score").collect())) for x in (base, other))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    out = F.expr("pmod(xxhash64(doc_id), 3) = 0")
    got = quality_classifier.score(docs, labels, exclude=out)
    rows = got.where(out).join(labels, "doc_id").toPandas()
    assert got.count() == docs.count() and len(rows) > 100
    assert (rows["kept"].astype(int) == rows["quality"]).mean() > 0.95
    assert rows[rows["quality"] == 1]["kept"].mean() > 0.98


def _pick(pool, sure=0.95):
    """Naive choice among arrays: sort all free documents by surety."""
    left = set(range(len(pool[0])))

    def pick(models, most):
        given, gone = [], set()
        for view, model in enumerate(models):
            p = 1 / (1 + np.exp(-model.logit(pool[view])))
            rows = []
            for label in most:
                ranked = sorted(((-(p[i] if label else 1 - p[i]), i) for i in left))[:most[label]]
                rows += [(i, label) for s, i in ranked if -s >= sure]
            rows.sort()
            gone |= {i for i, _ in rows}
            given.append((pool[1 - view][[i for i, _ in rows]], np.array([c for _, c in rows], float)))
        left.difference_update(gone)
        return given

    return pick


def test_co_training_equals_the_naive_one(spark):
    """Spark's choice among all documents gives the classifiers of a plain loop."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").dropDuplicates(["text"])
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet").where("doc_id % 4 = 1")
    got = {r["doc_id"]: r["score"] for r in quality_classifier.score(docs, labels, sure=0.6, growth=0.2).collect()}
    whole = docs.join(labels.select("doc_id", F.col("quality").alias("label")), "doc_id", "left").select(
        "doc_id", "label", "text", "source", "lang", "n_chars").orderBy("doc_id").toArrow()
    table = pa.Table.from_batches(quality_classifier._features(whole.combine_chunks().to_batches()))
    has = np.array([x is not None for x in table.column("label").to_pylist()])
    x = quality_classifier._matrices(table)
    weights = quality_classifier._fit(table.filter(pa.array(has)), _pick([v[~has] for v in x], 0.6), 4, 0.2)
    (ta, tb), (pa_, pb) = weights[3]
    a, b, c = weights[2]
    z = (weights[0].logit(x[0]) * ta + tb) * a + (weights[1].logit(x[1]) * pa_ + pb) * b + c
    assert has.any() and len(got) == len(z) and len(set(got.values())) > 100
    assert np.allclose([got[d] for d in table.column("doc_id").to_pylist()], 1 / (1 + np.exp(-np.clip(z, -30, 30))), atol=1e-4)


def test_views_teach_each_other():
    """With few labels, exchanged pseudo-labels lift the weaker view."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 1200).astype(float)
    views = [y[:, None] * 2 + rng.normal(0, s, (1200, 6)) for s in (0.8, 2.5)]
    few, pool, test = slice(0, 16), slice(16, 800), slice(800, 1200)
    alone = quality_classifier.Logistic().fit(views[1][few], y[few], np.ones(16))
    both = quality_classifier.co_train([v[few] for v in views], y[few], _pick([v[pool] for v in views]), rounds=6, growth=5)
    hits = lambda m: ((m.logit(views[1][test]) > 0) == (y[test] > 0)).mean()
    assert hits(both[1]) > hits(alone)
