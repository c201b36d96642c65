"""Stored tables and views of the catalog, read from other sessions."""

import uuid

import pytest
from conftest import SF_SMALL

from stagewise.plans import catalog_views as V
from stagewise.plans.registry import Layer, _catalog
from stagewise.plans.views import register_views
from stagewise.sources import catalog, sinks, tables
from stagewise.sources.schemas import SCHEMAS, TABLE_COMMENTS


@pytest.fixture
def database(spark):
    name = tables.create_database(spark, f"test_{uuid.uuid4().hex}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_a_new_session_reads_all_views_and_they_equal_the_frames(spark):
    L = Layer(spark, SF_SMALL)
    raw = {"raw_applications": L.apps, "raw_stage_events": L.events,
           "initiative_passport": L.passport, "initiative_fact": L.fact}
    frames, name, other = register_views(raw), _catalog(L), spark.newSession()
    plain = lambda df: sorted([str(r[c]) for c in sorted(df.columns)] for r in df.collect())
    assert set(V.VIEWS) == set(frames)
    for view, frame in frames.items():
        df = V.read_catalog_view(other, name, view)
        assert set(df.columns) == set(frame.columns), view
        assert plain(df) == plain(frame), view
        assert tables.table_comment(other, f"{name}.{view}") == V.VIEWS[view][0]
    curve = V.read_catalog_view(other, name, "v_portfolio_npv", "month_index").collect()
    assert [r.month_index for r in curve] == list(range(37))
    kinds = {r.name: r.table_type for r in catalog.list_tables(other).collect()}
    assert not set(V.VIEWS) & set(kinds)                              # not in the session's own database


def _raw(spark, database, rows):
    for table in V.RAW:
        tables.create_declared_table(spark, table, database)
    events = spark.createDataFrame(rows, SCHEMAS["raw_stage_events"])
    return tables.insert_strictly(events, f"{database}.raw_stage_events")


def test_views_are_replaced_and_dropped_and_show_new_rows(spark, database):
    import datetime as dt
    _raw(spark, database, [])
    assert V.create_views(spark, database) == list(V.VIEWS)
    other = spark.newSession()
    assert V.read_catalog_view(other, database, "v_stage_events_clean").count() == 0
    apps = spark.createDataFrame([("A", "CL-1", "p", "c", "r", None, None, "s", False)], SCHEMAS["raw_applications"])
    tables.insert_strictly(apps, f"{database}.raw_applications")
    hour = dt.datetime(2025, 1, 1, 1), dt.datetime(2025, 1, 1, 3)
    tables.insert_strictly(spark.createDataFrame([(1, "A", "x", *hour, None)], SCHEMAS["raw_stage_events"]), f"{database}.raw_stage_events")
    V.refresh(other, database)
    assert [r.hours for r in V.read_catalog_view(other, database, "v_stage_events_clean").collect()] == [2.0]
    V.create_views(spark, database)                                   # again: replaced
    V.drop_views(other, database)
    V.drop_views(spark, database)                                     # nothing left: no error
    left = {r["viewName"] for r in spark.sql(f"SHOW VIEWS IN {database}").where("not isTemporary").collect()}
    assert not left


def test_declared_table_has_types_and_comment(spark, database):
    name = tables.create_declared_table(spark, "raw_applications", database)
    assert [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in SCHEMAS["raw_applications"]]
    assert tables.table_comment(spark.newSession(), name) == TABLE_COMMENTS["raw_applications"]
    with pytest.raises(Exception, match="already exists"):
        tables.create_declared_table(spark, "raw_applications", database)
    tables.create_declared_table(spark, "raw_applications", database, replace=True)


def test_load_into_the_declared_table(spark, database, tmp_path):
    tables.create_declared_table(spark, "raw_decisions", database)
    good = "application_id,decision,decided_at,reason\nA1,yes,2025-01-06 09:00:00,\nA2,no,,late\n"
    (tmp_path / "good.csv").write_text(good)
    got = tables.load_declared_csv(spark, str(tmp_path / "good.csv"), "raw_decisions", database).orderBy("application_id").collect()
    assert [(r.application_id, r.reason) for r in got] == [("A1", None), ("A2", "late")] and got[1].decided_at is None
    (tmp_path / "bad.csv").write_text(good + "A3,no,not a time,x\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.load_declared_csv(spark, str(tmp_path / "bad.csv"), "raw_decisions", database)
    spark.catalog.refreshTable(f"{database}.raw_decisions")
    assert spark.table(f"{database}.raw_decisions").count() == 2       # nothing of the failed load


def test_inserts_are_strict(spark, database):
    name = tables.create_declared_table(spark, "initiative_fact", database)
    wide = spark.createDataFrame([("I", 1, 1.5, 2.5)], "initiative_id string, month_index long, actual_cost_rub double, actual_profit_rub double")
    with pytest.raises(Exception, match="(?i)cannot safely cast|incompatible"):
        tables.insert_strictly(wide, name)
    with pytest.raises(ValueError):
        tables.insert_strictly(wide.drop("month_index"), name)
    assert spark.conf.get("spark.sql.storeAssignmentPolicy").upper() == "ANSI"


def test_counts_come_from_the_footers(spark, tmp_path):
    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "a"))
    spark.range(0).write.parquet(str(tmp_path / "b"))
    got = tables.stored_row_counts(spark, {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 2 and "ReadSchema: struct<>" not in plan.replace("COUNT(*)", "")
    assert {r.table_name: r.n_rows for r in got.collect()} == {"a": 1000, "b": 0}
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_sinks_do_not_empty_an_existing_folder(spark, tmp_path):
    df = spark.range(3)
    sinks.write_csv(df, str(tmp_path / "o"))
    with pytest.raises(Exception, match="(?i)already exists"):
        sinks.write_csv(df, str(tmp_path / "o"))
