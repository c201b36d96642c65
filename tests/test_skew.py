"""A key holding a third of all rows: results stay whole and right."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stagewise.operators import clean, process, quality
from stagewise.operators.reconcile import reconcile
from stagewise.operators.relational import first_per_key, flag_repeats

N = 3000
T0 = dt.datetime(2025, 1, 1)


@pytest.fixture(scope="module")
def hot(spark):
    rows = []
    for i in range(N):
        if i % 3 == 0:      # a third of the rows: one application, one technical-free client
            rows.append(("HOT", "C-HOT", "web", float(i % 97), T0 + dt.timedelta(hours=i), False))
        else:
            rows.append((f"A{i}", f"C{i % 50}", "branch", float(i % 89), T0 + dt.timedelta(hours=i % 500), False))
    return spark.createDataFrame(rows, "application_id string, client_id string, channel string,"
                                       " amount double, submitted_at timestamp_ntz, is_test boolean")


def test_dedupe_and_repeats_with_hot_key(hot):
    c = clean.clean_applications(hot)
    assert c.count() == 1 + (N - N // 3)
    assert c.where("application_id = 'HOT'").first().submitted_at == T0
    r = quality.repeat_summary(hot, "application_id").first()
    assert r.excess == N // 3 - 1
    f = flag_repeats(hot, "application_id", [F.col("submitted_at").asc_nulls_last()])
    assert f.count() == N and f.where("is_repeat").count() == N // 3 - 1
    assert process.first_rows_per_group(hot, "client_id", "submitted_at").count() == 51
    assert process.first_per_group_count(hot, "client_id", "submitted_at").first().first_rows == 51


def test_hot_stage_funnel_and_quantiles(spark, hot):
    ev = hot.select("application_id", F.when(F.col("application_id") == "HOT", "s1").otherwise("s2").alias("stage"),
                    F.col("amount").alias("hours"))
    f = {r.stage: r.reached for r in process.funnel(ev, clean.clean_keys(hot)).collect()}
    assert f == {"s1": 1, "s2": N - N // 3}
    got = {r.stage: (r.median_hours, r.p90_hours) for r in process.stage_sla(ev).collect()}
    want = ev.groupBy("stage").agg(F.round(F.percentile("hours", 0.5), 1).alias("m"), F.round(F.percentile("hours", 0.9), 1).alias("p"))
    assert got == {r.stage: (r.m, r.p) for r in want.collect()}


def test_identical_copies_reconcile(spark):
    same = [(1, "x")] * 1000
    a = spark.createDataFrame(same + [(2, "y")], "k int, v string")
    b = spark.createDataFrame(same[:-1] + [(2, "y"), (3, "z")], "k int, v string")
    d = sorted((r.c0, r.c1, r.side, r.copies) for r in reconcile(a, b).collect())
    assert d == [(1, "x", "left_only", 1), (3, "z", "right_only", 1)]
    many = spark.createDataFrame([(1, "x")] * 700, "k int, v string")
    got = sorted((r.c0, r.side, r.copies) for r in reconcile(a, many).collect())
    assert got == [(1, "left_only", 300), (2, "left_only", 1)]


def test_skew_settings_on(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_group_limit_runs_before_the_shuffle(hot):
    p = first_per_key(hot, "application_id", [F.col("submitted_at")])._jdf.queryExecution().executedPlan().toString()
    lines = p.split("\n")
    partial = max(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    exchange = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning(application_id" in line)
    assert partial > exchange            # printed below the exchange = runs before it
