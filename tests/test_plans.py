"""Physical-plan properties the operators are designed for."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stagewise.plans import registry
from stagewise.plans.registry import Layer
from stagewise.operators import portfolio, quality
from stagewise.sources import testdata as td


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def layer(spark):
    return Layer(spark, SF_SMALL)


def test_first_per_key_limits_before_shuffle(layer):
    p = plan_of(layer.apps_clean)
    assert "WindowGroupLimit" in p and "Partial" in p


def test_anti_join_is_explicit(layer):
    p = plan_of(quality.keys_without_match(layer.apps, layer.decisions, "application_id"))
    assert "LeftAnti" in p


def test_curve_shuffles_plan_rows_only(layer):
    p = plan_of(portfolio.initiative_npv(layer.plan))
    assert p.count("Exchange") == 1 and "Generate" in p


def test_filters_and_columns_reach_the_scan(layer):
    p = plan_of(layer.decisions)
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,O))]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz," in p


def test_no_python_in_any_query(spark):
    for key, build in registry.queries().items():
        p = plan_of(build(spark, SF_SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in p, (key, node)


def test_source_gap_single_shuffle(spark):
    a = spark.range(100).withColumnRenamed("id", "k")
    b = spark.range(50, 150).withColumnRenamed("id", "k")
    g = quality.source_gap(a, b, "k")
    p = plan_of(g)
    assert "Union" in p and "Join" not in p        # tagged union + one grouping, no join
    r = g.first()
    assert (r.n_keys, r.matched, r.unmatched) == (100, 50, 50)


@pytest.mark.parametrize("key,table,scans", [
    ("r4_channel_stage_sla", "lineitem", 2),     # stage events, and the lines that applications are made of
    ("r2_stage_sla", "lineitem", 2), ("r9_box_stats", "lineitem", 2), ("r7_distribution", "lineitem", 2),
    ("p18_percentile", "lineitem", 1), ("w6_repeat_flags", "lineitem", 1), ("p21_outliers", "lineitem", 1), ("r10_iqr_outliers", "events", 1)])
def test_input_is_computed_once(spark, key, table, scans):
    df = registry.queries()[key](spark, SF_SMALL)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count(f"{table}.parquet") == scans, final


def test_order_joins_are_dealt_by_lines(spark, monkeypatch):
    """A task takes a number of lines, however well they pack, and the counts
    of the layers come out of those tasks without another exchange."""
    monkeypatch.setattr(td, "LINES_A_TASK", 1000, raising=False)
    layer = Layer(spark, SF_SMALL)
    lines = layer.t["lineitem"].count()
    for rows in (layer.apps, layer.events, layer.cards_raw):
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        assert sum(sizes) == lines and max(sizes) < 2000, sizes
    counts = quality.layer_counts(layer.apps, layer.events)
    assert counts.first().apps_raw == counts.first().events_raw == lines
    assert "hashpartitioning(application_id" not in plan_of(counts)
