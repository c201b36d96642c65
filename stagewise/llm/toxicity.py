"""Operator 2: toxicity by class-conditional Kneser-Ney models.

Two character models of words (orders 1 to 6, interpolated Kneser-Ney with
absolute discounting) are learnt, one from toxic and one from ordinary
documents.  Orders 3 to 6 hold each class's own counts; both back off to the
same continuation counts of orders 1 and 2, gathered from the words of *all*
documents, so an expression that is rare in both classes is judged by the
letters it shares with others instead of by its absence.

A document is compared by its length-normalised log-likelihoods: the mean
over its words of ``log P(word | toxic) - log P(word | ordinary)``, for the
whole text and for its most toxic run of three words (a long text with one
insult is toxic too).  A logistic curve fitted on labelled documents that the
models have not seen turns both means into a probability.

Bounds: at most ``per_class`` labelled documents of each class are learnt
from, those with the least hash of their id; the model tables grow with that
sample only, so they may be broadcast.  The shared counts cover every
document, and every whole text is scored.

Cases: a null, empty or letterless text has no evidence and gets the score of
means zero; null labels are not learnt from; repeated documents get equal
scores; an empty table gives an empty result; with labels of one class only
(or none) every score is that class's share of the labels (or 0.5)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, gathered, map_arrow, mixed, raw, staged

ORDER = 6            # characters of the longest n-gram
SHARED = 2           # orders up to this are shared by the classes
DISCOUNT = 0.75
RUN = 3              # words in a run
CLIP = 20.0          # most that one word counts
SLICE = 20_000       # words whose n-grams are held at a time
_LETTERS = re.compile(r"[^\W\d_]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)


def letter_words(text: bytes) -> list[str]:
    return _LETTERS.findall(text.decode("utf-8", "replace").lower())


def _places(words: list[str], longest: int = ORDER):
    """The places of the words (after a start sign, up to and with an end
    sign): for each order the keys of the n-gram that ends there, of its
    prefix, and whether it lies in its word; and the word's index."""
    joined = "".join(["\x02" + w + "\x03" for w in words])
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    index = np.repeat(np.arange(len(words)), lengths)
    depth = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    real = np.flatnonzero(depth > 0)
    symbols, key, keys, inside = mixed(points + np.uint64(1)), np.zeros(len(points), np.uint64), [], []
    for order in range(1, longest + 1):
        back = np.zeros(len(points), np.uint64)
        back[order - 1:] = symbols[: max(0, len(points) - order + 1)]
        key = key * _MULT + back                             # the newest character first
        keys.append(mixed(key + np.uint64(order)))
        inside.append(depth[real] >= order - 1)
    prefixes = [np.zeros(len(real), np.uint64)] + [k[real - 1] for k in keys[:-1]]
    return [k[real] for k in keys], prefixes, inside, index[real]


def _sliced(words: list) -> Iterator[list]:
    """Bounded slices: every place of a word takes some hundred bytes of keys."""
    for at in range(0, len(words), SLICE):
        yield words[at: at + SLICE]


def _rows(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(v.view(np.int64) if v.dtype == np.uint64 else v) for v in columns.values()], names=list(columns))


def _shared_kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of all texts up to one order above the shared ones."""
    known: set[bytes] = set()
    held = [np.empty((3, 0), np.uint64) for _ in range(SHARED + 1)]
    for block in gathered(batches):
        new = set().union(*(body.split() for body in raw(block.column("text")))) - known
        if len(known) > 400_000:                             # forgetting costs time, not kinds
            known.clear()
        known |= new
        words = list({x for w in new for x in letter_words(w)})
        for part in _sliced(words):
            keys, prefixes, inside, _ = _places(part, SHARED + 1)
            for o in range(SHARED + 1):
                ok = inside[o]
                rows = np.stack([keys[o][ok], prefixes[o][ok], (keys[o - 1] if o else np.zeros_like(keys[0]))[ok]])
                rows = np.concatenate([held[o], rows], 1)
                held[o] = rows[:, np.unique(rows[0], return_index=True)[1]]
    for o, rows in enumerate(held):
        yield _rows({"o": np.full(rows.shape[1], o + 1, np.int32), "key": rows[0], "prefix": rows[1], "suffix": rows[2]})


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the n-grams above the shared orders, by class."""
    tallies = {0: Counter(), 1: Counter()}

    def flush() -> Iterator[pa.RecordBatch]:
        for label, tally in tallies.items():
            for words in _sliced(list(tally)):
                weight = np.fromiter((tally[w] for w in words), np.int64, len(words))
                keys, prefixes, inside, index = _places(words)
                for o in range(SHARED, ORDER):
                    ok = inside[o]
                    key, first, back = np.unique(keys[o][ok], return_index=True, return_inverse=True)
                    n = np.bincount(back, weights=weight[index][ok], minlength=len(key)).astype(np.int64)
                    none = np.zeros(len(n), np.int64)
                    yield _rows({"o": np.full(len(key), o + 1, np.int32), "key": key, "prefix": prefixes[o][ok][first],
                                 "suffix": keys[o - 1][ok][first], "toxic": n if label else none,
                                 "ordinary": none if label else n})
            tally.clear()

    for block in gathered(batches):
        for body, label in zip(raw(block.column("text")), block.column("toxic").to_pylist()):
            tallies[label].update(letter_words(body))
        if sum(map(len, tallies.values())) > 300_000:
            yield from flush()
    yield from flush()


class Model:
    """n-gram key → log-probabilities of its last character (toxic, ordinary)
    and the log-weights of backing off from it as a history."""

    def __init__(self, shared: pd.DataFrame, own: pd.DataFrame):
        """``shared``: n-grams of all texts up to order SHARED + 1; ``own``:
        those above SHARED with both classes' counts; keys as unsigned."""
        letters = max(1, int((shared["o"] == 1).sum()))
        all_keys, all_logp, all_logb = [], [], []
        below, p_below = np.empty(0, np.uint64), np.empty((0, 2))
        for order in range(1, ORDER + 1):
            at = (shared if order <= SHARED else own)
            at = at[at["o"] == order].sort_values("key")
            key, prefix, suffix = (at[c].to_numpy(np.uint64) for c in ("key", "prefix", "suffix"))
            if order <= SHARED:                              # kinds of characters before: alike for both
                n = shared[shared["o"] == order + 1].groupby("suffix").size().reindex(key).fillna(0)
                n = np.repeat(n.to_numpy(np.float64)[:, None], 2, 1)
            else:
                n = at[["toxic", "ordinary"]].to_numpy(np.float64)
            histories, inverse = np.unique(prefix, return_inverse=True)
            total, kinds = np.zeros((len(histories), 2)), np.zeros((len(histories), 2))
            np.add.at(total, inverse, n)
            np.add.at(kinds, inverse, n > 0)
            weight = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            low = 1.0 / letters if order == 1 else p_below[_find(below, suffix)[0]]
            p = np.maximum(n - DISCOUNT, 0) / np.maximum(total[inverse], 1) + weight[inverse] * low
            if order > 1:
                logb = np.zeros((len(below), 2))
                place, hit = _find(below, histories)
                logb[place[hit]] = np.log(weight[hit])
                all_logb.append(logb)
            below, p_below = key, np.maximum(p, 1e-12)
            all_keys.append(key)
            all_logp.append(np.log(p_below))
        all_logb.append(np.zeros((len(below), 2)))
        order = np.argsort(keys := np.concatenate(all_keys))
        self.key = keys[order]
        self.logp = np.concatenate(all_logp)[order].astype(np.float32)
        self.logb = np.concatenate(all_logb)[order].astype(np.float32)
        self.floor = -float(np.log(letters + 1))

    def ratios(self, words: list[str]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) of each word."""
        if not words or not len(self.key):
            return np.zeros(len(words))
        return np.concatenate([self._ratios(part) for part in _sliced(words)])

    def _ratios(self, words: list[str]) -> np.ndarray:
        keys, prefixes, inside, index = _places(words)
        logp = np.zeros((len(index), 2), np.float32)
        open_ = np.arange(len(index))                        # places not found at a higher order
        for order in range(ORDER, 0, -1):
            here = inside[order - 1][open_]
            at = open_[here]
            place, hit = _find(self.key, keys[order - 1][at])
            logp[at[hit]] += self.logp[place[hit]]
            lost = at[~hit]
            if order > 1:
                back, known = _find(self.key, prefixes[order - 1][lost])
                logp[lost[known]] += self.logb[back[known]]
            else:
                logp[lost] += self.floor
            open_ = np.concatenate([open_[~here], lost])
        return np.bincount(index, weights=logp[:, 0] - logp[:, 1], minlength=len(words))


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return place, table[place] == keys


class _Ratios(dict):
    """raw word → mean ratio of its letter words (nan without letters)."""

    def learn(self, model: Model, bodies: list[list[bytes]]) -> None:
        if len(self) > 400_000:
            self.clear()
        new = list(set().union(*bodies) - self.keys())
        words = [letter_words(w) for w in new]
        ratios = np.clip(model.ratios([x for w in words for x in w]), -CLIP, CLIP)
        n = np.fromiter(map(len, words), np.int64, len(words))
        sums = np.bincount(np.repeat(np.arange(len(new)), n), weights=ratios, minlength=len(new))
        with np.errstate(invalid="ignore"):
            self.update(zip(new, (sums / n).tolist()))


_WORKER: dict = {}


def _evidence(docs: DataFrame, shared_model, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``whole`` and ``run``: the mean log-ratio of the
    text's words, and that of its most toxic run of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared_model.value
        if _WORKER.get("model") is not model:                # one table per Python process and model
            _WORKER.update(model=model, ratios=_Ratios())
        ratios = _WORKER["ratios"]
        for block in gathered(batches):
            bodies = [body.split() for body in raw(block.column("text"))]
            ratios.learn(model, bodies)
            whole, best = np.zeros(len(bodies)), np.zeros(len(bodies))
            for i, body in enumerate(bodies):
                x = np.fromiter(map(ratios.__getitem__, body), np.float64, len(body))
                x = x[~np.isnan(x)]
                if len(x):
                    sums = np.cumsum(np.concatenate([[0.0], x]))
                    n = min(RUN, len(x))
                    whole[i], best[i] = sums[-1] / len(x), (sums[n:] - sums[:-n]).max() / n
            yield pa.RecordBatch.from_arrays(
                [*(block.column(c).combine_chunks() for c in keep), pa.array(whole), pa.array(best)],
                names=[*keep, "whole", "run"])

    kept = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(docs.select(*keep, "text"), run, f"{kept}, whole double, run double")


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (the last is the constant) by Newton's steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w, keep = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, labels: DataFrame, held_out, key: str = "doc_id", text: str = "text",
          label: str = "toxic", per_class: int = 8_000, cut: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted
    (1 if score >= cut), whole, run (the two length-normalised log-ratios).

    ``held_out``: a column of ``key`` that is true where labels must not be
    learnt from."""
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    usable = (labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("int").alias("toxic"))
              .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out)
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("h", F.xxhash64("doc_id")))
    chosen = [usable.where(F.col("toxic") == c).orderBy("h", "doc_id").limit(per_class) for c in (0, 1)]
    chosen = staged(chosen[0].unionByName(chosen[1])         # at most 2 * per_class ids
                    .select("doc_id", "toxic", (F.pmod("h", F.lit(3)) == 0).alias("check")), "toxic-sample")
    labelled = texts.join(F.broadcast(chosen), "doc_id")

    schema = "o int, key long, prefix long, suffix long"
    shared = (map_arrow(texts.select("text"), _shared_kinds, schema)
              .groupBy("o", "key").agg(F.first("prefix").alias("prefix"), F.first("suffix").alias("suffix")))
    own = (map_arrow(labelled.where(~F.col("check")).select("text", "toxic"), _class_counts,
                     schema + ", toxic long, ordinary long")
           .groupBy("o", "key").agg(F.first("prefix").alias("prefix"), F.first("suffix").alias("suffix"),
                                    F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
           .where(F.expr("o <= 4 or toxic + ordinary >= 2")))
    # shared: kinds of three characters (bounded by the scripts in use); own: by the sample
    frames = [f.toPandas() for f in (shared, own)]
    for f in frames:
        for c in ("key", "prefix", "suffix"):
            f[c] = f[c].astype(np.int64).to_numpy().view(np.uint64)
    model = Model(*frames)
    shared_model = spark.sparkContext.broadcast(model)

    checked = _evidence(labelled.where("check"), shared_model, ["toxic"]).select("toxic", "whole", "run").toPandas()
    y = checked["toxic"].to_numpy(np.float64)
    if 0 < y.sum() < len(y):
        weights = _logistic(_features(checked["whole"].to_numpy(), checked["run"].to_numpy()), y)
    else:
        share = min(max(y.mean(), 1e-6), 1 - 1e-6) if len(y) else 0.5
        weights = np.append(np.zeros(_features(np.zeros(1), np.zeros(1)).shape[1]), np.log(share / (1 - share)))
    a, b, c = (float(w) for w in weights)
    z = F.col("whole") * a + F.col("run") * b + c
    return (_evidence(texts, shared_model, ["doc_id"])
            .withColumn("score", 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z)))))
            .select("doc_id", _on_key(held_out).alias("held_out"), "score",
                    (F.col("score") >= cut).cast("int").alias("predicted"), "whole", "run"))


def _features(whole: np.ndarray, run: np.ndarray) -> np.ndarray:
    return np.column_stack([whole, run])


def _on_key(column):
    return F.coalesce(column, F.lit(False))


def op2_kneser_ney_toxicity(spark, sf_dir: str) -> DataFrame:
    held_out = F.expr("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1")
    return score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out)
