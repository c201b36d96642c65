"""Data-quality reports and the clean layer on hand-made defect frames."""

import datetime as dt

import pytest

from pyspark.sql import functions as F
from stagewise.operators import clean, process, quality

T0 = dt.datetime(2025, 3, 1, 9, 0)


def ts(h):
    return None if h is None else T0 + dt.timedelta(hours=h)


@pytest.fixture(scope="module")
def apps(spark):
    rows = [  # id, client, channel, amount, submitted (h), is_test
        ("A1", "C1", "web", 100.0, 5, False),
        ("A1", "C1", "web", 100.0, 5, False),      # exact repeat
        ("A2", "C2", "branch", 200.0, 3, False),
        ("A2", "C2", "branch", 250.0, 1, False),   # same id, earlier: kept
        ("A2", "C2", "branch", 300.0, None, False),  # same id, NULL time: never first
        ("A3", "C3", "web", 50.0, 2, None),        # NULL flag: dropped by the clean predicate
        ("A4", None, "web", 60.0, 2, False),       # NULL client: dropped too
        ("A5", "C5", "web", 70.0, 2, True),        # test flag
        ("A6", "CL-TEST", "branch", 80.0, 2, False),  # technical client without flag
        ("A7", "C7", None, 90.0, 4, False),
    ]
    return spark.createDataFrame(
        [(i, c, ch, a, ts(h), t) for i, c, ch, a, h, t in rows],
        "application_id string, client_id string, channel string, amount double,"
        " submitted_at timestamp_ntz, is_test boolean")


@pytest.fixture(scope="module")
def events(spark):
    rows = [  # event, app, stage, entered (h), left (h)
        (1, "A1", "s1", 0, 10), (2, "A1", "s2", 10, 10),   # equal: neither reversed nor usable
        (3, "A2", "s1", 0, None),                          # open
        (4, "A2", "s2", 5, 2),                             # reversed
        (5, "A5", "s1", 0, 4),                             # event of a dropped application
        (6, "ZZ", "s1", 0, 4),                             # event without any application
        (7, "A7", "s1", 0, 20), (8, "A2", "s1", 1, 7),
    ]
    return spark.createDataFrame([(e, a, s, ts(x), ts(y)) for e, a, s, x, y in rows],
                                 "event_id int, application_id string, stage string,"
                                 " entered_at timestamp_ntz, left_at timestamp_ntz")


def test_overview_and_repeats(apps):
    r = quality.overview(apps, "application_id", "submitted_at").first()
    assert (r.n_rows, r.n_keys, r.first_day, r.last_day) == (10, 7, T0.date(), T0.date())
    r = quality.repeat_summary(apps, "application_id").first()
    assert r.excess == 3
    top = [(x.application_id, x.n_rows) for x in quality.repeat_list(apps, "application_id").collect()]
    assert top == [("A2", 3), ("A1", 2)]


def test_missing_and_service_records(apps):
    r = quality.missing_report(apps, ["client_id", "channel"]).first()
    assert (r.n_rows, r.missing_client_id, r.missing_channel) == (10, 1, 1)
    r = quality.service_records(apps).first()
    assert (r.flagged, r.technical_client, r.keys_to_drop) == (1, 1, 2)


def test_clean_applications_three_valued(apps):
    c = {r.application_id: r for r in clean.clean_applications(apps).collect()}
    assert set(c) == {"A1", "A2", "A7"}
    assert c["A2"].amount == 250.0            # earliest kept, NULL time never first
    assert "is_test" not in clean.clean_applications(apps).columns


def test_interval_and_clean_events(apps, events):
    r = quality.interval_check(events, "entered_at", "left_at").first()
    assert (r.total, r.time_reversed, r.not_closed, r.usable) == (8, 1, 1, 5)
    ev = clean.clean_stage_events(events, clean.clean_applications(apps))
    assert sorted(r.event_id for r in ev.collect()) == [1, 7, 8]
    assert {r.event_id: r.hours for r in ev.collect()} == {1: 10.0, 7: 20.0, 8: 6.0}
    with_ch = clean.clean_stage_events(events, clean.clean_applications(apps), attach=("channel",))
    assert sorted((r.event_id, r.channel) for r in with_ch.collect()) == [(1, "web"), (7, None), (8, "branch")]


def test_source_gap_and_anti_join(spark, apps):
    dec = spark.createDataFrame([("A1", "ok"), ("A1", "ok"), ("A2", "no"), ("ZZ", "ok")],
                                "application_id string, decision string")
    r = quality.source_gap(apps, dec, "application_id").first()
    assert (r.n_keys, r.matched, r.unmatched) == (7, 2, 5)
    miss = sorted(x.application_id for x in quality.keys_without_match(apps, dec, "application_id").collect())
    assert miss == ["A3", "A4", "A5", "A6", "A7"]


def test_defect_summary_and_conversion(spark, apps, events):
    dec = spark.createDataFrame([("A1", "ok"), ("A2", "no")], "application_id string, decision string")
    d = {r.defect: (r.n, r.action) for r in quality.defect_summary(apps, events, dec).collect()}
    assert d == {"row repeats": (3, "removed"), "test applications": (2, "removed"),
                 "exit before entry": (1, "removed"), "stage not closed": (1, "kept with caveat"),
                 "applications without decision": (5, "kept with caveat")}
    disb = spark.createDataFrame([("A1",), ("A1",), ("A5",)], "application_id string")
    r = quality.conversion_before_after(apps, disb).first()
    assert r.as_is_pct == 30.0                   # 3 / 10 rows
    assert r.cleaned_pct == pytest.approx(100 * 1 / 3, abs=0.05)


def test_zero_denominator_is_null(spark, apps):
    empty = apps.where("false")
    r = quality.conversion_before_after(empty, empty).first()
    assert r.as_is_pct is None and r.cleaned_pct is None


def test_funnel_and_shares(apps, events):
    c = clean.clean_applications(apps)
    ev = clean.clean_stage_events(events, c)
    f = {r.stage: (r.reached, r.share_pct) for r in process.funnel(ev, c).collect()}
    assert f == {"s1": (3, 100.0)}


def test_flag_repeats_keeps_every_row(apps):
    from pyspark.sql import functions as F
    from stagewise.operators.relational import flag_repeats
    f = flag_repeats(apps, "application_id", [F.col("submitted_at").asc_nulls_last()])
    assert f.count() == apps.count()
    unflagged = {r.application_id: r.amount for r in f.where(~F.col("is_repeat")).collect()}
    assert len(unflagged) == 7 and unflagged["A2"] == 250.0
    assert f.where("is_repeat").count() == 3


def test_clean_rows_equal_clean_keys(apps):
    assert clean.clean_applications(apps).count() == clean.clean_keys(apps).count()


def test_rejection_reasons_null_reason_and_missing_decision(spark, apps):
    dec = spark.createDataFrame([("A1", "Отказ", None), ("A2", "Отказ", "score"), ("A7", "Одобрено", None),
                                 ("A5", "Отказ", "score")],          # A5 is a test record: ignored
                                "application_id string, decision string, reason string")
    c = clean.clean_applications(apps)
    got = {r.reason: (r.applications, r.share_pct) for r in process.rejection_reasons(dec, c).collect()}
    assert got == {None: (1, 50.0), "score": (1, 50.0)}
    m = {r.year_month: (r.applications, r.approved_pct) for r in process.monthly_dynamics(c, dec).collect()}
    assert m == {"2025-03": (3, 33.3)}                  # undecided stays in the denominator


def test_null_key_counts_as_one_unmatched_key(spark):
    apps = spark.createDataFrame([("A1",), (None,), (None,), ("A2",)], "application_id string")
    dec = spark.createDataFrame([("A1",), (None,)], "application_id string")
    r = quality.source_gap(apps, dec, "application_id").first()
    assert (r.n_keys, r.matched, r.unmatched) == (3, 1, 2)      # DISTINCT keeps NULL; it never matches
    miss = sorted(quality.keys_without_match(apps, dec, "application_id").collect(),
                  key=lambda r: (r.application_id is None, r.application_id or ""))
    assert [r.application_id for r in miss] == ["A2", None]


def test_flag_repeats_many_equal_rows(spark):
    from stagewise.operators.relational import flag_repeats
    df = spark.createDataFrame([("a", 1, None)] * 2500 + [("a", 0, "x"), (None, 5, "y"), (None, 5, "y")], "k string, t int, v string")
    f = flag_repeats(df, "k", [F.col("t").asc_nulls_last()], chunk=1000)
    got = {(r.k, r.t, r.is_repeat): r["count"] for r in f.groupBy("k", "t", "is_repeat").count().collect()}
    assert got == {("a", 0, False): 1, ("a", 1, True): 2500, (None, 5, False): 1, (None, 5, True): 1}


def test_shares_need_no_folder_and_share_one_exchange(spark):
    from stagewise.operators.relational import with_share
    plan = with_share(spark.range(100).groupBy((F.col("id") % 3).alias("g")).agg(F.count(F.lit(1)).alias("n")), "n")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in text


def test_layer_counts(spark, apps):
    ev = spark.createDataFrame([("A1", 1, 2), ("A1", 2, 1), ("A2", 1, None), (None, 1, 2), ("zz", 1, 2)],
                               "application_id string, entered_at int, left_at int")
    r = quality.layer_counts(apps, ev).first()
    assert (r.apps_raw, r.apps_clean) == (apps.count(), clean.clean_applications(apps).count())
    assert (r.events_raw, r.events_clean) == (5, 1)
