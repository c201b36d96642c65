"""The pipeline's stages: each one's decisions against its operator's rules."""

import random

import pytest
from conftest import SF_SMALL
from llm_data import SCHEMA, frame, odd_rows, prose

import corpus_pipeline as pipeline
from stagewise.llm.common import staged


@pytest.fixture(scope="module")
def steps(spark):
    """The documents of the small test data before and after every stage."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, SF_SMALL), f"test-{name}")
        out.append(docs)
    return out


def test_stages_are_the_named_ones_in_order():
    assert [n for n, _ in pipeline.STAGES] == [
        "quality_classifier", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "best_fit_packing"]


def test_columns_and_kept_rows(steps):
    for before, after in zip(steps, steps[1:-1]):
        assert after.columns == before.columns and after.schema == before.schema
        ids, kept = ({r["doc_id"] for r in x.select("doc_id").collect()} for x in (before, after))
        assert kept <= ids and len(kept) > 0.6 * len(ids)


def test_texts_change_in_one_stage_only(steps):
    for k, (before, after) in enumerate(zip(steps, steps[1:-1])):
        changed = before.alias("a").join(after.alias("b"), "doc_id").where("a.text != b.text").count()
        assert changed == 0 or k == 2


def test_no_near_duplicates_and_no_leaks_are_left(spark, steps):
    from stagewise.llm import decontamination, jaccard
    assert jaccard.join(steps[2]).where("component_id != doc_id").count() == 0
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    assert decontamination.leaks(steps[4], bench).count() == 0


def test_packing_holds_every_document(steps):
    packed = steps[-1].toPandas()
    assert set(packed["doc_id"]) == {r["doc_id"] for r in steps[-2].collect()}
    assert packed.groupby("sequence_id")["length"].sum().max() <= 4096


def test_odd_rows_and_further_columns(spark):
    docs = frame(spark, odd_rows())
    for _, stage in pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    kept = {r["doc_id"] for r in docs.collect()}
    assert {1, 2, 3, 4, 5, 7, 9, 10, None} == kept              # 6 repeats 5, 8 is 7 and one word more


def test_empty_table(spark):
    docs = frame(spark, [], extra=False)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.count() == 0


def test_planted_cases(spark):
    """Copies, near copies, shared passages and benchmark passages among clean documents."""
    rng = random.Random(12)
    clean = {d: " ".join(prose(rng, rng.randint(150, 300), 10**6)) for d in range(60)}
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").first()["text"]
    passage = " ".join(prose(rng, 70, 10**6))
    near = clean[2].split()
    near[5] = near[40] = "changed"
    rows = [*clean.items(), (100, clean[1]), (101, " ".join(near)), (102, clean[3] + " " + item),
            (103, " ".join(prose(rng, 90, 10**6)) + " " + passage), (104, passage + " " + " ".join(prose(rng, 90, 10**6)))]
    docs = frame(spark, rows)
    for _, stage in pipeline.STAGES[1:-1]:
        docs = staged(stage(spark, docs, SF_SMALL), "planted")
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(kept) == set(clean) | {103, 104}
    assert all(kept[d] == t for d, t in clean.items())
    assert kept[103] == dict(rows)[103] and len(kept[104]) < len(dict(rows)[104]) - 200


def test_long_document_of_benchmark_passages(spark):
    """Stage 4 finds every item in a text of 60,000 words and more (with a copy
    of the text for each seed that may match, it ran out of memory)."""
    rng = random.Random(14)
    items = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("text").collect()]
    words = prose(rng, 60_000, 10**6)
    docs = frame(spark, [(1, " ".join(words)), (2, " ".join([*words[:30_000], *items, *words[30_000:]])), (None, items[0])])
    kept = dict(pipeline.STAGES)["benchmark_decontamination"](spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, None}


def test_registered(spark):
    import __spark_entry__ as entry
    assert entry.queries()["pipeline"] is pipeline.run
    assert len([k for k in entry.queries() if k.startswith("op")]) == 13
