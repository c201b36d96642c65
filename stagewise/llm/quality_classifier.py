"""Operator 9: quality by co-training two views of a document.

* Text view: shares of word shapes (``Abc,`` → ``Aa,``; hashed to a fixed
  number of buckets), of words that repeat the word before, of distinct words,
  and the length in words.
* Page view (metadata): source and language (hashed), declared length, number
  of lines and mean line length.

Each view has its own logistic classifier.  In every round both are fitted and
score all documents without a label, and each gives the other those that it is
surest of, with its own label: a tenth (``growth``) as many as there are labels, in
the proportion of the classes among them, chosen by Spark over all documents.
Afterwards each view is calibrated on labelled documents that neither has
learnt from, a logistic curve combines the calibrated log-odds, and every
whole document is scored.

Features are computed once and written (16-bit shares, some 300 numbers a
document); rounds and scores read them.  Bounds: at most ``labelled`` labelled
documents, those with the least hash of their id, and the pseudo-labelled ones
reach the driver, as feature vectors; further labelled documents are scored in
the rounds as if they had no label.  The classifiers have fixed size.

Cases: null or empty texts have all text features zero; null metadata is a
value of its own; a missing metadata column counts as null; null labels are
skipped, repeated labels count as their least; an empty table gives an empty
result; with labels of one class only (or none) every document is kept with
that class's share as its score."""

from __future__ import annotations

import operator
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, gathered, map_arrow, raw, staged

SHAPES = 256
TEXT = SHAPES + 3
SOURCES, LANGS = 64, 16
PAGE = SOURCES + LANGS + 4
_RUNS = re.compile(rb"(.)\1+", re.S)
# letters to a or A (bytes above ASCII count as small letters), digits to 0
_KINDS = bytes(ord("0") if 48 <= b < 58 else ord("A") if 65 <= b < 91 else
               ord("a") if 97 <= b < 123 or b >= 128 else b for b in range(256))



class _Shapes(dict):
    """word → bucket of its shape."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = zlib.crc32(_RUNS.sub(rb"\1", word.translate(_KINDS))) % SHAPES
        return value


def _text_features(body: bytes, shapes: _Shapes, out: np.ndarray) -> None:
    words = body.split()
    n = len(words)
    if n:
        out[:SHAPES] = np.bincount(np.fromiter(map(shapes.__getitem__, words), np.int64, n), minlength=SHAPES) / n
        out[SHAPES] = sum(map(operator.eq, words, words[1:])) / n
        out[SHAPES + 1] = len(set(words)) / n
        out[SHAPES + 2] = np.log1p(n)


def _page_features(body: bytes, source, lang, n_chars, out: np.ndarray) -> None:
    out[zlib.crc32(repr(source).encode()) % SOURCES] = 1
    out[SOURCES + zlib.crc32(repr(lang).encode()) % LANGS] = 1
    lines = body.count(b"\n") + 1
    out[-4:] = n_chars is None, np.log1p(max(n_chars or 0, 0)), np.log1p(lines), np.log1p(len(body) / lines)


def _views(block: pa.Table, shapes: _Shapes) -> tuple[np.ndarray, np.ndarray]:
    n = block.num_rows
    text, page = np.zeros((n, TEXT), np.float32), np.zeros((n, PAGE), np.float32)
    meta = zip(*(block.column(c).to_pylist() for c in ("source", "lang", "n_chars")))
    for i, (body, (source, lang, n_chars)) in enumerate(zip(raw(block.column("text")), meta)):
        _text_features(body, shapes, text[i])
        _page_features(body, source, lang, n_chars, page[i])
    return text, page


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shapes = _Shapes()
    for block in gathered(batches):
        text, page = _views(block, shapes)
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id").combine_chunks(), block.column("label").combine_chunks(),
             pa.array([x.tobytes() for x in text.astype(np.float16)], pa.binary()),
             pa.array([x.tobytes() for x in page.astype(np.float16)], pa.binary())],
            names=["doc_id", "label", "text", "page"])


def _matrices(table: pa.Table | pa.RecordBatch) -> list[np.ndarray]:
    """The text and page features of rows."""
    return [np.frombuffer(b"".join(table.column(c).to_pylist()), np.float16).reshape(-1, d).astype(np.float32)
            for c, d in (("text", TEXT), ("page", PAGE))]


class Logistic:
    """Ridge logistic regression on standardised columns (gradient steps with
    a curvature bound, a fixed number of them)."""

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 15) -> "Logistic":
        mean, self.scale = x.mean(0, dtype=np.float64), x.std(0, dtype=np.float64) + 1e-2
        w, total = np.zeros(x.shape[1] + 1), weight.sum()
        keep = np.append(np.full(x.shape[1], ridge), 0)
        for _ in range(steps):
            curve, slope = np.diag(keep + 1e-6), -keep * w
            for lo in range(0, len(x), 2048):                # few rows are standardised at once
                some = slice(lo, lo + 2048)
                z = np.column_stack([(x[some] - mean) / self.scale, np.ones(len(x[some]))])
                p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
                curve += (z * (weight[some] * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ z / total
                slope += z.T @ (weight[some] * (y[some] - p)) / total
            step = np.linalg.solve(curve, slope)
            w = w + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-5:
                break
        self.w, self.b = w[:-1] / self.scale, w[-1] - (w[:-1] / self.scale) @ mean
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x @ self.w + self.b, -30, 30)


def surest(models: list[Logistic], views: list[np.ndarray], most: dict[int, int], sure: float, free: np.ndarray):
    """(view, label, rows, surety): the documents whose class a view holds at
    least ``sure`` probable, at most ``most[label]``, among the free ones."""
    for view, model in enumerate(models):
        p = 1 / (1 + np.exp(-model.logit(views[view])))
        for label, count in most.items():
            surety = np.where(free, p if label else 1 - p, 0)
            best = np.argsort(-surety, kind="stable")[:count]
            best = best[surety[best] >= sure]
            yield view, label, best, surety[best]


def co_train(views: list[np.ndarray], y: np.ndarray, pick, rounds: int = 4, growth: float = 0.1) -> list[Logistic]:
    """The two classifiers after ``rounds`` of exchanging pseudo-labels.
    ``pick(models, most)`` finds, for each view, what it is surest of among all
    documents that have no label yet: the *other* view's features and the labels."""
    own = [(v, y.astype(np.float64)) for v in views]
    most = {label: max(1, int(growth * share * len(y))) for label, share in ((1, y.mean()), (0, 1 - y.mean()))}
    for turn in range(rounds + 1):
        models = [Logistic().fit(x, t, np.ones(len(t))) for x, t in own]
        if turn == rounds:
            return models
        for view, (x, t) in enumerate(pick(models, most)):    # what one is sure of teaches the other
            if len(t):
                mine, known = own[1 - view]
                own[1 - view] = np.concatenate([mine, x]), np.concatenate([known, t])


def _picker(pool: DataFrame, sure: float):
    """``pick`` over a table of features: every task offers its surest documents
    (with their features), and Spark keeps the first of all."""
    taken = np.empty(0, np.int64)                             # at most 2 * growth * labels a round

    def pick(models: list[Logistic], most: dict[int, int]) -> list[tuple[np.ndarray, np.ndarray]]:
        nonlocal taken
        gone = taken

        def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                free = ~np.isin(batch.column("doc_id").to_numpy(), gone)
                for view, label, rows, surety in surest(models, _matrices(batch), most, sure, free):
                    some = batch.select(["doc_id", "text", "page"]).take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), view, np.int32)), pa.array(np.full(len(rows), label, np.int32)),
                         pa.array(surety.astype(np.float64)), *some.columns],
                        names=["view", "label", "surety", "doc_id", "text", "page"])

        offered = map_arrow(pool, offer, "view int, label int, surety double, doc_id long, text binary, page binary")
        place = F.row_number().over(Window.partitionBy("view", "label").orderBy(F.desc("surety"), "doc_id", "text", "page"))
        limit = F.when(F.col("label") == 1, most[1]).otherwise(most[0])
        best = (offered.withColumn("place", place).where(F.col("place") <= max(most.values())).where(F.col("place") <= limit)
                .drop("place", "surety").toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")]))
        given = []
        for view in (0, 1):
            some = best.filter(pa.array(best.column("view").to_numpy() == view))
            given.append((_matrices(some)[1 - view], some.column("label").to_numpy().astype(np.float64)))
        taken = np.union1d(taken, best.column("doc_id").to_numpy())
        return given

    return pick


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality",
          labelled: int = 12_000, cut: float = 0.5, exclude=None, rounds: int = 4, growth: float = 0.1,
          sure: float = 0.95) -> DataFrame:
    """``docs`` keys with score (probability of quality 1), text_score,
    page_score and kept (score >= cut).  ``exclude``: a column of doc_id, true
    where a label must not be used (a test set)."""
    spark = docs.sparkSession
    for name, kind in (("source", "string"), ("lang", "string"), ("n_chars", "long")):
        if name not in docs.columns:
            docs = docs.withColumn(name, F.lit(None).cast(kind))
    base = docs.select(F.col(key).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       F.col("n_chars").cast("long").alias("n_chars"))
    known = (labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
             .where(F.col("label").isin(0, 1)))
    if exclude is not None:
        known = known.where(~exclude)
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    ids = base.select("doc_id").where(F.col("doc_id").isNotNull())
    chosen = known.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    features = staged(map_arrow(base.join(F.broadcast(chosen), "doc_id", "left"), _features,
                                "doc_id long, label int, text binary, page binary"), "quality-features")
    sample = features.where("label is not null").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    once = np.unique(sample.column("doc_id").to_numpy(), return_index=True)[1]
    sample = sample.take(pa.array(once))
    pool = features.where("label is null and doc_id is not null").select("doc_id", "text", "page")
    weights = _fit(sample, _picker(pool, sure), rounds, growth)
    del sample
    schema = "doc_id long, text_logit double, page_logit double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, page = _matrices(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(weights[0].logit(text).astype(np.float64)),
                 pa.array(weights[1].logit(page).astype(np.float64))], names=["doc_id", "text_logit", "page_logit"])

    a, b, c = weights[2]
    (ta, tb), (pa_, pb) = weights[3]
    curve = lambda z: 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    return (map_arrow(features.select("doc_id", "text", "page"), run, schema)
            .withColumn("t", F.col("text_logit") * ta + tb).withColumn("p", F.col("page_logit") * pa_ + pb)
            .withColumn("score", curve(F.col("t") * a + F.col("p") * b + c))
            .select("doc_id", "score", curve(F.col("t")).alias("text_score"), curve(F.col("p")).alias("page_score"),
                    (F.col("score") >= cut).alias("kept")))


def _fit(sample: pa.Table, pick, rounds: int, growth: float) -> tuple:
    """The two view classifiers, the combination, and each view's calibration."""
    x, y = _matrices(sample), sample.column("label").to_numpy().astype(np.float64)
    check = np.array([zlib.crc32(str(d).encode()) % 4 == 0 for d in sample.column("doc_id").to_pylist()], bool)
    learn = ~check
    if min((len(set(y[m])) for m in (learn, check)), default=0) < 2:
        share = min(max(y.mean() if len(y) else 1.0, 1e-6), 1 - 1e-6)
        flat = [Logistic() for _ in x]
        for model, d in zip(flat, (TEXT, PAGE)):
            model.w, model.b = np.zeros(d), 0.0
        logit = float(np.log(share / (1 - share)))
        return (*flat, (0.0, 0.0, max(logit, 0.0)), ((0.0, logit), (0.0, logit)))
    models = co_train([v[learn] for v in x], y[learn], pick, rounds, growth)
    curves, calibrated = [], []
    for model, view in zip(models, x):
        z = model.logit(view[check])
        platt = Logistic().fit(z[:, None], y[check], np.ones(check.sum()), ridge=1e-2)
        curves.append((float(platt.w[0]), float(platt.b)))
        calibrated.append(platt.logit(z[:, None]))
    both = Logistic().fit(np.column_stack(calibrated), y[check], np.ones(check.sum()), ridge=1e-2)
    return (*models, (float(both.w[0]), float(both.w[1]), float(both.b)), tuple(curves))


def op9_co_trained_quality(spark, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
