"""Every operator on null, empty, repeated and very long texts, clashing extra
columns, and empty tables: no crash, and the results the docstrings state."""

import pytest
from llm_data import frame, odd_rows

from stagewise.llm import (decontamination, jaccard, packing, quality_classifier, quality_rules, sharding,
                           substrings, suffixes, token_files, toxicity)
from stagewise.llm.common import new_path
from pyspark.sql import functions as F

ODD = odd_rows()
LABELS = "doc_id long, quality int, toxic int"


def _labels(spark, rows=()):
    return spark.createDataFrame(list(rows), LABELS)


def _bench(spark, rows=((0, "seven words make one seed for masks indeed yes"),)):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def _files(spark, docs):
    folder = new_path(spark, "t")
    return token_files.read(spark, folder, token_files.write(docs, folder))


OPERATORS = {
    "sharding": lambda s, d: sharding.shard(d),
    "toxicity": lambda s, d: toxicity.score(d, _labels(s), F.lit(False)),
    "substrings": lambda s, d: substrings.repeated_passages(d),
    "quality_rules": lambda s, d: quality_rules.judge(d, _labels(s)),
    "decontamination": lambda s, d: decontamination.leaks(d, _bench(s)),
    "token_files": _files,
    "suffixes": lambda s, d: suffixes.repeated_passages(d),
    "jaccard": lambda s, d: jaccard.join(d),
    "quality_classifier": lambda s, d: quality_classifier.score(d, _labels(s)),
    "packing": lambda s, d: packing.pack(packing.pieces(d)),
}
PER_DOCUMENT = {"sharding", "toxicity", "quality_rules", "token_files", "jaccard", "quality_classifier"}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    rows = OPERATORS[name](spark, frame(spark, ODD)).collect()
    if name in PER_DOCUMENT:
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == \
            sorted((d is None, d or 0) for d, _ in ODD)
    elif name == "packing":
        assert {r["doc_id"] for r in rows} == {d for d, _ in ODD}
    elif name == "decontamination":
        assert rows == []
    else:
        assert {r["doc_id"] for r in rows} == {8}           # the long text with one more word


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, frame(spark, [])).collect() == []


@pytest.mark.parametrize("name", sorted(PER_DOCUMENT))
def test_repeated_rows(spark, name):
    rows = OPERATORS[name](spark, frame(spark, [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "h")])).collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 1, 2]


def test_empty_benchmark(spark):
    assert decontamination.leaks(frame(spark, ODD), _bench(spark, ())).collect() == []


def test_null_labels(spark):
    labels = _labels(spark, [(1, None, None), (2, 1, 0), (None, 0, 1), (3, 5, 5)])
    docs = frame(spark, [(1, "a b"), (2, "c d"), (3, "e")])
    assert toxicity.score(docs, labels, F.lit(False)).count() == 3
    assert all(r["kept"] for r in quality_classifier.score(docs, labels).collect())
    assert quality_rules.judge(docs, labels).count() == 3
