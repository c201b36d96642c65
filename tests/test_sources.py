"""Sources, sinks, catalog helpers, views and the streaming monitor."""

import tempfile


from conftest import SF_SMALL
from stagewise.plans.registry import Layer
from stagewise.plans.views import register_views
from stagewise.sources import catalog, readers, sinks
from stagewise.streaming import interval_counts_stream, run_available


def _write(path, text, bom=False):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write(text)


def test_declared_csv_and_text_export(spark):
    d = tempfile.mkdtemp(prefix="stagewise-src-")
    _write(f"{d}/ev.csv", "event_id,application_id,stage,entered_at,left_at,actor_role\n"
                          "1,A1,s1,2025-01-06 09:00:00,2025-01-06 11:30:00,r\n"
                          "2,A1,s2,2025-01-06 11:30:00,,r\n")
    ev = readers.read_declared_csv(spark, f"{d}/ev.csv", "raw_stage_events")
    rows = ev.collect()
    assert rows[1].left_at is None and rows[0].event_id == 1
    _write(f"{d}/cards.csv", "ID карты;Кредитный лимит\nCARD-1;12 000\nCARD-2;н/д\n", bom=True)
    tx = readers.read_text_export(spark, f"{d}/cards.csv")
    assert tx.columns == ["ID карты", "Кредитный лимит"]


def test_infer_numeric(spark):
    df = spark.createDataFrame([("1", "x", "2.5"), ("2", None, None), ("3", "4", "1e3")], "a string, b string, c string")
    out = readers.infer_numeric(df)
    types = dict(out.dtypes)
    assert types == {"a": "double", "b": "string", "c": "double"}


def test_catalog_and_sink(spark):
    L = Layer(spark, SF_SMALL)
    rc = {r.table_name: r.n_rows for r in catalog.row_counts({"a": L.apps, "d": L.decisions}).collect()}
    assert rc["a"] > rc["d"] > 0
    cols = catalog.columns_of(L.apps).collect()
    assert cols[0].column_name == "application_id" and cols[0].ordinal == 1
    prev = catalog.preview(L.apps, ["application_id"], ["application_id", "channel"]).collect()
    assert len(prev) == 5
    out = tempfile.mkdtemp(prefix="stagewise-sink-") + "/o"
    sinks.write_csv(L.apps.select("application_id", "channel").limit(10), out, sep=";")
    back = spark.read.option("header", True).option("sep", ";").csv(out)
    assert back.count() == 10 and back.columns == ["application_id", "channel"]
    catalog.publish_view(L.decisions, "decisions_view")
    assert "decisions_view" in {r.name for r in catalog.list_tables(spark).collect()}
    assert readers.run_sql(spark, "SELECT count(*) AS n FROM decisions_view").first().n == L.decisions.count()


def test_register_views(spark):
    L = Layer(spark, SF_SMALL)
    views = register_views({"raw_applications": L.apps, "raw_stage_events": L.events,
                            "initiative_passport": L.passport, "initiative_fact": L.fact},
                           persist_clean=True)
    assert len(views) == 8
    n = spark.sql("SELECT count(*) AS n FROM v_applications_clean").first().n
    assert n == L.apps_clean.count()
    assert spark.table("v_portfolio_npv").count() == 37


def test_streaming_interval_counts(spark):
    L = Layer(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="stagewise-stream-")
    L.events.write.mode("overwrite").parquet(f"{d}/in")
    stream = spark.readStream.schema(L.events.schema).parquet(f"{d}/in")
    got = run_available(interval_counts_stream(stream), "interval_counts_test")
    batch = {r.stage: r.total for r in L.events.groupBy("stage").count().withColumnRenamed("count", "total").collect()}
    assert {r.stage: r.total for r in got.collect()} == batch


def test_streaming_resumes_from_checkpoint(spark):
    L = Layer(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="stagewise-stream2-")
    ev = L.events.select("stage", "entered_at", "left_at")
    ev.write.mode("overwrite").parquet(f"{d}/in/part=1")
    stream = spark.readStream.schema(ev.schema).parquet(f"{d}/in/part=1")
    ck = f"{d}/ck"
    first = {r.stage: r.total for r in run_available(interval_counts_stream(stream), "resume_a", checkpoint=ck).collect()}
    ev.write.mode("append").parquet(f"{d}/in/part=1")          # a second export lands
    again = {r.stage: r.total for r in run_available(interval_counts_stream(stream), "resume_b", checkpoint=ck).collect()}
    assert again == {k: 2 * v for k, v in first.items()}        # state carried over, nothing recounted


def test_bucketed_clean_layer_joins_without_shuffle(spark):
    L = Layer(spark, SF_SMALL)
    raw = {"raw_applications": L.apps, "raw_stage_events": L.events,
           "initiative_passport": L.passport, "initiative_fact": L.fact}
    views = register_views(raw, bucket_clean=4, bucket_tables=("clean_applications_b", "clean_stage_events_b"))
    panel = views["v_pipeline_stage_sla"]
    want = register_views(raw)["v_pipeline_stage_sla"]
    assert sorted(map(tuple, panel.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # tiny fixture: force the big-table path
    try:
        j = spark.table("clean_stage_events_b").join(spark.table("clean_applications_b"), "application_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == L.events_clean.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_number_shapes(spark):
    from stagewise.sources.readers import infer_numeric
    df = spark.createDataFrame([("12d", "1e3", " 4 ", "5F"), ("3", "-.5", "+2.", "1")], "a string, b string, c string, d string")
    assert [t for _, t in infer_numeric(df).dtypes] == ["string", "double", "double", "string"]
    assert infer_numeric(df).first().b == 1000.0


def test_byte_order_mark_is_written_once_per_file(spark, tmp_path):
    from stagewise.sources.readers import read_text_export
    from stagewise.sources.sinks import write_csv
    df = spark.createDataFrame([("1", " x ")], "id string, v string").coalesce(1)
    write_csv(df, str(tmp_path / "o"), bom=True)
    body = next((tmp_path / "o").glob("part-*")).read_bytes()
    assert body.startswith(b"\xef\xbb\xbfid;v") and body.count(b"\xef\xbb\xbf") == 1
    back = read_text_export(spark, str(tmp_path / "o"))
    assert back.columns == ["id", "v"] and back.first().v == " x "


def test_saved_table_has_its_comment_and_is_a_base_table(spark):
    from stagewise.sources.catalog import list_tables
    from stagewise.sources.schemas import SCHEMAS, TABLE_COMMENTS, with_comments
    from stagewise.sources.sinks import save_table
    save_table(spark.createDataFrame([], SCHEMAS["raw_decisions"]), "decisions_saved", TABLE_COMMENTS["raw_decisions"])
    spark.createDataFrame([(1,)], "a int").createOrReplaceTempView("only_a_view")
    said = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED decisions_saved").collect()}
    assert said["Comment"] == TABLE_COMMENTS["raw_decisions"]
    base = {r.name for r in list_tables(spark, base_only=True).collect()}
    assert "decisions_saved" in base and "only_a_view" not in base
    assert all(f.metadata["table_comment"] for f in with_comments("raw_decisions"))


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    import pytest
    from stagewise import session

    class Conf:
        def get(self, *a):
            return None

    class Cluster:
        conf, sparkContext = Conf(), type("C", (), {"master": "spark://x"})()
    with pytest.raises(ValueError):
        session.checkpoint_dir(Cluster())
