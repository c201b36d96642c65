"""Registry of test-data queries: key → (Spark builder, DuckDB oracle SQL).

Every builder reads the driver's parquet tables through the adapters in
``stagewise.sources.testdata`` and runs one operator of the package over the
whole tables.  The oracle states the same result in DuckDB SQL.
"""

from __future__ import annotations

import uuid
from functools import cached_property
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.functions import numeric as N
from stagewise.functions.temporal import hours_between, month_label
from stagewise.functions.text import normalize_channel, parse_amount, parse_date
from stagewise.operators import cards, clean, frames, ordered, portfolio, process, quality, reconcile, relational
from stagewise.plans import catalog_views
from stagewise.plans.oracle import PCT, R, alias_case, hours, parse_amount_sql, parse_date_sql, with_ctes
from stagewise.session import shared_path
from stagewise.sources import catalog, readers, sinks, tables, testdata as td
from stagewise.sources.schemas import TABLE_COMMENTS

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def query(key: str, sql: str | None = None):
    def deco(fn: Callable[["Layer"], DataFrame]):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Layer(spark, sf_dir))
        build.__name__ = key
        build.__doc__ = fn.__doc__
        REGISTRY[key] = (build, with_ctes(sql) if sql else None)
        return fn
    return deco


class Layer:
    """The adapted relations and the clean layer of one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = td.load(spark, sf_dir)

    @cached_property
    def apps(self) -> DataFrame:
        return td.applications(self.t)

    @cached_property
    def events(self) -> DataFrame:
        return td.stage_events(self.t)

    @cached_property
    def decisions(self) -> DataFrame:
        return td.decisions(self.t)

    @cached_property
    def disb(self) -> DataFrame:
        return td.disbursements(self.t)

    @cached_property
    def passport(self) -> DataFrame:
        return td.passport(self.t)

    @cached_property
    def fact(self) -> DataFrame:
        return td.fact(self.t)

    @cached_property
    def cards_raw(self) -> DataFrame:
        return td.cards_export(self.t)

    @cached_property
    def apps_clean(self) -> DataFrame:
        return clean.clean_applications(self.apps)

    @cached_property
    def clean_keys(self) -> DataFrame:
        return clean.clean_keys(self.apps)

    @cached_property
    def events_clean(self) -> DataFrame:
        # membership needs the clean keys only, not the deduplicated rows
        return clean.clean_stage_events(self.events, self.clean_keys)

    @cached_property
    def events_by_channel(self) -> DataFrame:
        """Clean events with the application channel attached in the same join."""
        return clean.clean_stage_events(self.events, self.apps_clean, attach=("channel",))

    @cached_property
    def plan(self) -> DataFrame:
        return portfolio.initiative_plan(self.passport)

    @cached_property
    def npv(self) -> DataFrame:
        return portfolio.initiative_npv(self.plan)

    @cached_property
    def port(self) -> DataFrame:
        return portfolio.portfolio_npv(self.npv)

    @cached_property
    def cards_clean(self) -> DataFrame:
        return cards.clean_cards(self.cards_raw)


def _dbl(df: DataFrame, *cols: str) -> DataFrame:
    """Exact decimals leave as DOUBLE (identical on both engines)."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


SLOW = td.SLOW_STAGE
REJ, APP = td.REJECTED, td.APPROVED

# ------------------------------------------------------------------ sources / catalog


@query("s5_infer_numeric", """
SELECT TRY_CAST(card_id AS DOUBLE) AS card_id, issued, channel, tariff, credit_limit,
       first_purchase, status
FROM cards_export""")
def s5_infer_numeric(L: Layer) -> DataFrame:
    """A text column becomes numeric iff every non-null value parses."""
    return readers.infer_numeric(L.cards_raw)


@query("s7_row_counts", """
SELECT 'raw_applications' AS table_name, count(*) AS n_rows FROM raw_applications
UNION ALL SELECT 'raw_stage_events', count(*) FROM raw_stage_events
UNION ALL SELECT 'raw_decisions', count(*) FROM raw_decisions
UNION ALL SELECT 'raw_disbursements', count(*) FROM raw_disbursements
UNION ALL SELECT 'initiative_passport', count(*) FROM initiative_passport
UNION ALL SELECT 'initiative_fact', count(*) FROM initiative_fact""")
def s7_row_counts(L: Layer) -> DataFrame:
    """UNION ALL of per-table counts."""
    return catalog.row_counts({"raw_applications": L.apps, "raw_stage_events": L.events,
                               "raw_decisions": L.decisions, "raw_disbursements": L.disb,
                               "initiative_passport": L.passport, "initiative_fact": L.fact})


OVERVIEW_LABELS = {"n_rows": "Всего строк, шт.", "n_keys": "Разных ключей, шт.",
                   "first_day": "Самый ранний день", "last_day": "Самый поздний день"}


@query("f1_labelled_overview", """
SELECT count(*) AS "Всего строк, шт.", count(DISTINCT application_id) AS "Разных ключей, шт.",
       strftime(min(submitted_at), '%Y-%m-%d') AS "Самый ранний день",
       strftime(max(submitted_at), '%Y-%m-%d') AS "Самый поздний день"
FROM raw_applications""")
def f1(L: Layer) -> DataFrame:
    """projection under display labels (spaces, Cyrillic)."""
    o = _iso_days(quality.overview(L.apps, "application_id", "submitted_at"), "first_day", "last_day")
    return relational.with_labels(o, OVERVIEW_LABELS)


# ------------------------------------------------------------------ the 21 paired operations


# Check queries hand dates over as ISO text and nullable integers as DOUBLE,
# so that both engines' pandas conversions render them identically.
def _iso_days(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in cols})


@query("p01_overview", """
SELECT count(*) AS n_rows, count(DISTINCT application_id) AS n_keys,
       strftime(min(submitted_at), '%Y-%m-%d') AS first_day,
       strftime(max(submitted_at), '%Y-%m-%d') AS last_day
FROM raw_applications""")
def p01(L: Layer) -> DataFrame:
    return _iso_days(quality.overview(L.apps, "application_id", "submitted_at"), "first_day", "last_day")


@query("p03_preview", """
SELECT application_id, product, channel, CAST(amount_requested AS DOUBLE) AS amount_requested
FROM raw_applications ORDER BY application_id LIMIT 5""")
def p03(L: Layer) -> DataFrame:
    """Sort, project, first 5 (repeats of one id carry identical values)."""
    return _dbl(catalog.preview(L.apps, ["application_id"],
                                ["application_id", "product", "channel", "amount_requested"]),
                "amount_requested")


@query("p04_filter", f"""
SELECT count(*) AS n_apps, {R('avg(CAST(amount_requested AS DOUBLE))', 0)} AS avg_amount
FROM raw_applications WHERE product = 'BUILDING' AND amount_requested > 300000""")
def p04(L: Layer) -> DataFrame:
    """F2 + A9: conjunctive filter, filtered average."""
    f = L.apps.where((F.col("product") == "BUILDING") & (F.col("amount_requested") > 300000))
    return f.agg(F.count(F.lit(1)).alias("n_apps"),
                 N.round_half_up(F.avg(F.col("amount_requested").cast("double")), 0).alias("avg_amount"))


@query("p05_distinct", "SELECT DISTINCT channel FROM raw_applications ORDER BY channel")
def p05(L: Layer) -> DataFrame:
    """A10: distinct values, sorted."""
    return L.apps.select("channel").distinct().orderBy("channel")


@query("p06_frequencies", """
SELECT channel, count(*) AS applications FROM raw_applications GROUP BY channel
ORDER BY applications DESC""")
def p06(L: Layer) -> DataFrame:
    """Value frequencies, most frequent first (a NULL group is kept)."""
    return (L.apps.groupBy("channel").agg(F.count(F.lit(1)).alias("applications"))
            .orderBy(F.col("applications").desc(), F.col("channel")))


@query("p07_missing", """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE left_at IS NULL) AS no_exit,
       count(*) FILTER (WHERE actor_role IS NULL) AS no_role
FROM raw_stage_events""")
def p07(L: Layer) -> DataFrame:
    """Q2 / A4: NULLs per column in one pass."""
    return quality.missing_report(L.events, ["left_at", "actor_role"],
                                  {"left_at": "no_exit", "actor_role": "no_role"})


@query("p08_excess", """
SELECT count(*) AS n_rows, count(DISTINCT application_id) AS n_keys,
       count(*) - count(DISTINCT application_id) AS excess
FROM raw_applications""")
def p08(L: Layer) -> DataFrame:
    """Q3 / A3: excess rows."""
    return quality.repeat_summary(L.apps, "application_id")


@query("p09_dedup", """
SELECT DISTINCT ON (application_id) application_id, strftime(submitted_at, '%Y-%m-%d') AS submitted_on, source_system
FROM raw_applications ORDER BY application_id, submitted_at, source_system""")
def p09(L: Layer) -> DataFrame:
    """The earliest row per id, the whole row breaking ties."""
    first = relational.first_per_key(L.apps, "application_id", [F.col("submitted_at").asc_nulls_last()])
    return _iso_days(first.select("application_id", F.col("submitted_at").alias("submitted_on"), "source_system"),
                     "submitted_on")


@query("p10_coerce", f"SELECT {R('sum(amount_requested)', 0)} AS total_amount FROM raw_applications")
def p10(L: Layer) -> DataFrame:
    """Sum of a typed amount, rounded."""
    return L.apps.agg(N.round_half_up(F.sum("amount_requested"), 0).alias("total_amount"))


@query("p11_group", f"""
SELECT channel, count(*) AS applications,
       {R('avg(CAST(amount_requested AS DOUBLE))', 0)} AS avg_amount,
       {R('sum(amount_requested)', 0)} AS total_amount
FROM raw_applications GROUP BY channel ORDER BY applications DESC""")
def p11(L: Layer) -> DataFrame:
    """Several named metrics per group."""
    return (L.apps.groupBy("channel").agg(
        F.count(F.lit(1)).alias("applications"),
        N.round_half_up(F.avg(F.col("amount_requested").cast("double")), 0).alias("avg_amount"),
        N.round_half_up(F.sum("amount_requested"), 0).alias("total_amount"))
        .orderBy(F.col("applications").desc()))


@query("p12_having", """
WITH per AS (SELECT channel, count(*) AS applications FROM raw_applications GROUP BY channel)
SELECT * FROM per WHERE applications > (SELECT avg(applications) FROM per)""")
def p12(L: Layer) -> DataFrame:
    """filter after aggregate (channels above the mean channel)."""
    per = L.apps.groupBy("channel").agg(F.count(F.lit(1)).alias("applications"))
    return (per.where(F.col("applications") > per.agg(F.avg("applications")).scalar())
            .orderBy(F.col("applications").desc(), F.col("channel")))


@query("p13_topn", f"""
SELECT region, {R('sum(amount_requested)', 0)} AS total_amount FROM raw_applications
GROUP BY region ORDER BY total_amount DESC, region LIMIT 3""")
def p13(L: Layer) -> DataFrame:
    """Top-3 groups by a measure, key as tie-break."""
    g = L.apps.groupBy("region").agg(N.round_half_up(F.sum("amount_requested"), 0).alias("total_amount"))
    return relational.top_n(g, "total_amount", "region", 3)


@query("p14_join", f"""
SELECT a.channel, count(*) AS rejections
FROM raw_applications a JOIN raw_decisions d ON d.application_id = a.application_id
WHERE d.decision = '{REJ}' GROUP BY a.channel ORDER BY rejections DESC""")
def p14(L: Layer) -> DataFrame:
    """Raw × raw inner join; fan-out on repeated ids is kept on purpose."""
    j = L.apps.select("application_id", "channel").join(
        L.decisions.where(F.col("decision") == REJ).select("application_id"), "application_id")
    return j.groupBy("channel").agg(F.count(F.lit(1)).alias("rejections")).orderBy(F.col("rejections").desc())


@query("p15_month", """
SELECT strftime(submitted_at, '%Y-%m') AS year_month, count(*) AS applications
FROM raw_applications GROUP BY 1 ORDER BY 1""")
def p15(L: Layer) -> DataFrame:
    """Group by month label."""
    return (L.apps.groupBy(month_label("submitted_at").alias("year_month"))
            .agg(F.count(F.lit(1)).alias("applications")).orderBy("year_month"))


@query("p16_pivot", """
SELECT product, count(*) FILTER (WHERE channel = '1-URGENT') AS urgent,
       count(*) FILTER (WHERE channel = '2-HIGH') AS high
FROM raw_applications GROUP BY product ORDER BY product""")
def p16(L: Layer) -> DataFrame:
    """Cross-tab with fixed columns."""
    return relational.pivot_counts(L.apps, "product", "channel",
                                   {"1-URGENT": "urgent", "2-HIGH": "high"}).orderBy("product")


@query("p17_share", f"""
SELECT channel, count(*) AS applications,
       {PCT('count(*)', 'sum(count(*)) OVER ()')} AS share_pct
FROM raw_applications GROUP BY channel ORDER BY applications DESC""")
def p17(L: Layer) -> DataFrame:
    """Share of total."""
    g = L.apps.groupBy("channel").agg(F.count(F.lit(1)).alias("applications"))
    return relational.with_share(g, "applications").orderBy(F.col("applications").desc())


@query("p18_percentile", f"""
SELECT stage, {R(f"quantile_cont({hours()}, 0.5)", 1)} AS median_hours,
       {R(f"quantile_cont({hours()}, 0.9)", 1)} AS p90_hours
FROM raw_stage_events WHERE left_at IS NOT NULL AND left_at > entered_at
GROUP BY stage ORDER BY median_hours DESC""")
def p18(L: Layer) -> DataFrame:
    """Exact interpolated median and P90 of hours per stage."""
    ev = (L.events.where(F.col("left_at").isNotNull() & (F.col("left_at") > F.col("entered_at")))
          .withColumn("hours", hours_between("entered_at", "left_at")))
    return process.stage_sla(ev).select("stage", "median_hours", "p90_hours")


@query("p19_buckets", """
SELECT CASE WHEN amount_requested < 100000 THEN '1. under 100k'
            WHEN amount_requested < 300000 THEN '2. 100k-300k'
            ELSE '3. 300k and more' END AS bucket, count(*) AS n_rows
FROM raw_applications GROUP BY 1 ORDER BY 1""")
def p19(L: Layer) -> DataFrame:
    """F8 → R12: half-open buckets with counts."""
    return process.bucket_counts(L.apps, "amount_requested", [100000, 300000],
                                 ["1. under 100k", "2. 100k-300k", "3. 300k and more"])


_FIRST_SQL = """
SELECT client_id, strftime(min(submitted_at), '%Y-%m-%d') AS submitted_on FROM {source} GROUP BY client_id"""


def _first_rows(apps: DataFrame) -> DataFrame:
    first = process.first_rows_per_group(apps, "client_id", "submitted_at")
    return _iso_days(first.select("client_id", F.col("submitted_at").alias("submitted_on")), "submitted_on")


@query("p20_first", _FIRST_SQL.format(source="raw_applications"))
def p20(L: Layer) -> DataFrame:
    """W1 → R11: first application per client (NULL clients are one group)."""
    return _first_rows(L.apps)


@query("p21_outliers", f"""
WITH h AS (SELECT {hours()} AS hours FROM raw_stage_events
           WHERE stage = '{SLOW}' AND left_at > entered_at),
     g AS (SELECT quantile_cont(hours, 0.25) AS q1, quantile_cont(hours, 0.75) AS q3 FROM h)
SELECT (SELECT count(*) FROM h, g WHERE h.hours > g.q3 + 1.5 * (g.q3 - g.q1)) AS outliers,
       {R('(SELECT q3 + 1.5 * (q3 - q1) FROM g)', 1)} AS threshold""")
def p21(L: Layer) -> DataFrame:
    """1.5·IQR upper fence on one stage's hours."""
    ev = (L.events.where((F.col("stage") == SLOW) & (F.col("left_at") > F.col("entered_at")))
          .select(hours_between("entered_at", "left_at").alias("hours")))
    return process.iqr_outliers(ev, "hours")


# ------------------------------------------------------------------ data quality (Q1-Q12)


@query("q1_overview_events", """
SELECT count(*) AS n_rows, count(DISTINCT application_id) AS n_keys,
       strftime(min(entered_at), '%Y-%m-%d') AS first_day,
       strftime(max(entered_at), '%Y-%m-%d') AS last_day
FROM raw_stage_events""")
def q1(L: Layer) -> DataFrame:
    return _iso_days(quality.overview(L.events, "application_id", "entered_at"), "first_day", "last_day")


@query("q2_missing", """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE amount_requested IS NULL) AS no_amount,
       count(*) FILTER (WHERE channel IS NULL) AS no_channel,
       count(*) FILTER (WHERE region IS NULL) AS no_region,
       count(*) FILTER (WHERE submitted_at IS NULL) AS no_submitted
FROM raw_applications""")
def q2(L: Layer) -> DataFrame:
    return quality.missing_report(L.apps, ["amount_requested", "channel", "region", "submitted_at"],
                                  {"amount_requested": "no_amount", "channel": "no_channel",
                                   "region": "no_region", "submitted_at": "no_submitted"})


@query("q3_repeat_list", """
SELECT application_id, count(*) AS n_rows FROM raw_applications GROUP BY application_id
HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def q3(L: Layer) -> DataFrame:
    return quality.repeat_list(L.apps, "application_id", 5)


@query("q4_service_records", """
SELECT count(*) FILTER (WHERE is_test) AS flagged,
       count(*) FILTER (WHERE client_id = 'CL-TEST') AS technical_client,
       count(DISTINCT application_id) FILTER (WHERE is_test OR client_id = 'CL-TEST') AS keys_to_drop
FROM raw_applications""")
def q4(L: Layer) -> DataFrame:
    return quality.service_records(L.apps)


@query("q5_interval_check", """
SELECT count(*) AS total, count(*) FILTER (WHERE left_at < entered_at) AS time_reversed,
       count(*) FILTER (WHERE left_at IS NULL) AS not_closed,
       count(*) FILTER (WHERE left_at > entered_at) AS usable
FROM raw_stage_events""")
def q5(L: Layer) -> DataFrame:
    return quality.interval_check(L.events, "entered_at", "left_at")


@query("q6_source_gap", """
SELECT count(*) AS n_keys, count(d.application_id) AS matched,
       count(*) - count(d.application_id) AS unmatched
FROM (SELECT DISTINCT application_id FROM raw_applications) a
LEFT JOIN (SELECT DISTINCT application_id FROM raw_decisions) d ON d.application_id = a.application_id""")
def q6(L: Layer) -> DataFrame:
    return quality.source_gap(L.apps, L.decisions, "application_id")


@query("q7_defect_summary", """
WITH per_key AS (SELECT application_id, count(*) AS n_rows, coalesce(bool_or(is_test OR client_id = 'CL-TEST'), false) AS test,
                        application_id IN (SELECT application_id FROM raw_decisions) AS decided
                 FROM raw_applications GROUP BY application_id),
ev AS (SELECT sum(CASE WHEN left_at < entered_at THEN 1 ELSE 0 END) AS reversed,
              count(*) - count(left_at) AS unclosed FROM raw_stage_events)
SELECT pos, defect, CAST(n AS BIGINT) AS n, CASE WHEN pos <= 3 THEN 'removed' ELSE 'kept with caveat' END AS action
FROM (SELECT unnest([1, 2, 3, 4, 5]) AS pos,
             unnest(['row repeats', 'test applications', 'exit before entry', 'stage not closed',
                     'applications without decision']) AS defect,
             unnest([(SELECT sum(n_rows - 1) FROM per_key), (SELECT count(*) FROM per_key WHERE test),
                     (SELECT reversed FROM ev), (SELECT unclosed FROM ev),
                     (SELECT count(*) FROM per_key WHERE NOT decided)]) AS n) t""")
def q7(L: Layer) -> DataFrame:
    return quality.defect_summary(L.apps, L.events, L.decisions)


@query("q8_conversion", f"""
WITH clean AS (SELECT DISTINCT application_id FROM raw_applications WHERE is_test = false AND client_id != 'CL-TEST'),
n AS (SELECT (SELECT count(*) FROM raw_applications) AS all_rows, (SELECT count(*) FROM raw_disbursements) AS paid_rows,
             (SELECT count(*) FROM clean) AS clean_keys,
             (SELECT count(*) FROM clean SEMI JOIN raw_disbursements USING (application_id)) AS paid_keys)
SELECT {PCT('paid_rows', 'all_rows')} AS as_is_pct, {PCT('paid_keys', 'clean_keys')} AS cleaned_pct FROM n""")
def q8(L: Layer) -> DataFrame:
    return quality.conversion_before_after(L.apps, L.disb)


@query("q9_layer_counts", """
SELECT (SELECT count(*) FROM raw_applications) AS apps_raw,
       (SELECT count(*) FROM v_applications_clean) AS apps_clean,
       (SELECT count(*) FROM raw_stage_events) AS events_raw,
       (SELECT count(*) FROM v_stage_events_clean) AS events_clean""")
def q9(L: Layer) -> DataFrame:
    return quality.layer_counts(L.apps, L.events)


@query("q10_clean_applications", """
SELECT application_id, client_id, product, channel, region,
       CAST(amount_requested AS DOUBLE) AS amount_requested, submitted_at, source_system
FROM v_applications_clean""")
def q10(L: Layer) -> DataFrame:
    """Q10: F3 + earliest row per id — the clean application layer."""
    return _dbl(L.apps_clean, "amount_requested")


@query("q11_clean_stage_events", "SELECT * FROM v_stage_events_clean")
def q11(L: Layer) -> DataFrame:
    """Q11: events of clean applications, closed and forward in time, with hours."""
    return L.events_clean


@query("q12_reconcile", """
WITH a AS (SELECT application_id AS k, trim(channel) AS t, amount_requested AS v, count(*) AS n
           FROM raw_applications GROUP BY ALL),
b AS (SELECT application_id AS k, CASE WHEN application_id % 5 = 0 THEN 'changed' ELSE trim(channel) END AS t,
             amount_requested + CASE WHEN application_id % 7 = 0 THEN 0.01 ELSE 0 END AS v, count(*) AS n
      FROM v_applications_clean GROUP BY ALL),
pairs AS (SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS na, coalesce(b.n, 0) AS nb
          FROM a FULL JOIN b ON a.k = b.k AND a.t IS NOT DISTINCT FROM b.t AND a.v IS NOT DISTINCT FROM b.v),
keys AS (SELECT k, CAST(sum(na) AS BIGINT) AS left_rows, CAST(sum(nb) AS BIGINT) AS right_rows,
                CAST(sum(greatest(na - nb, 0)) AS BIGINT) AS left_extra,
                CAST(sum(greatest(nb - na, 0)) AS BIGINT) AS right_extra
         FROM pairs GROUP BY k HAVING sum(abs(na - nb)) > 0)
SELECT k AS c0, CASE WHEN right_rows = 0 THEN 'left_only' WHEN left_rows = 0 THEN 'right_only' ELSE 'differs' END AS side,
       CASE WHEN left_rows = 0 OR right_rows = 0 THEN '' WHEN left_rows > 1 OR right_rows > 1 THEN '*'
            ELSE concat_ws(',', CASE WHEN k % 5 = 0 THEN 'c1' END, CASE WHEN k % 7 = 0
                 AND (SELECT any_value(a.v) FROM a WHERE a.k = keys.k) IS NOT NULL THEN 'c2' END) END AS diff_columns,
       left_rows, right_rows, left_extra, right_extra
FROM keys""")
def q12(L: Layer) -> DataFrame:
    """Q12: raw applications (ids repeat) against the clean layer with some
    texts and amounts altered, by id: a whole number, a text and a decimal."""
    k = F.col("application_id")
    right = L.apps_clean.select(
        k, F.when(k % 5 == 0, "changed").otherwise(F.concat(F.lit("  "), "channel")).alias("channel"),
        (F.col("amount_requested") + F.when(k % 7 == 0, F.lit("0.01").cast("decimal(18,2)"))
         .otherwise(F.lit("0").cast("decimal(18,2)"))).alias("amount"))
    return reconcile.reconcile(L.apps.select("application_id", "channel", "amount_requested"), right, keys=[0])


_MOVED = "application_id + CASE WHEN application_id % 50 = 0 THEN 40 ELSE 0 END"


@query("q12_reconcile_ordered", f"""
WITH a AS (SELECT row_number() OVER (ORDER BY application_id) - 1 AS row_index, application_id AS k,
                  CAST(amount_requested AS VARCHAR) AS v FROM v_applications_clean),
b AS (SELECT row_number() OVER (ORDER BY {_MOVED}, application_id) - 1 AS row_index, application_id AS k,
             CAST(amount_requested AS VARCHAR) AS v FROM v_applications_clean)
SELECT row_index, 'differs' AS side, concat_ws(',', CASE WHEN a.k <> b.k THEN 'c0' END, CASE WHEN a.v IS DISTINCT FROM b.v THEN 'c1' END)
         AS diff_columns, CAST(a.k AS VARCHAR) AS l0, CAST(b.k AS VARCHAR) AS r0, a.v AS l1, b.v AS r1
FROM a JOIN b USING (row_index) WHERE a.k <> b.k OR a.v IS DISTINCT FROM b.v""")
def q12o(L: Layer) -> DataFrame:
    """Q12 in order: equal as bags, but every fiftieth id has moved down."""
    rows = L.apps_clean.select("application_id", "amount_requested")
    return reconcile.reconcile_ordered(rows, rows, ["application_id"], [F.expr(_MOVED).asc(), F.col("application_id").asc()])


# ------------------------------------------------------------------ process analytics


@query("r1_funnel", f"""
SELECT stage, count(DISTINCT application_id) AS reached,
       {PCT('count(DISTINCT application_id)', '(SELECT count(*) FROM v_applications_clean)')} AS share_pct
FROM v_stage_events_clean GROUP BY stage""")
def r1(L: Layer) -> DataFrame:
    return process.funnel_of_raw(L.events, L.apps)


def _sla_sql(group: str, source: str, where: str = "", n: str = "events") -> str:
    w = f"WHERE {where}" if where else ""
    return f"""
SELECT {group}, count(*) AS {n}, {R('quantile_cont(hours, 0.5)', 1)} AS median_hours,
       {R('quantile_cont(hours, 0.9)', 1)} AS p90_hours
FROM {source} {w} GROUP BY {group}"""


@query("r2_stage_sla", _sla_sql("stage", "v_stage_events_clean"))
def r2(L: Layer) -> DataFrame:
    return process.stage_sla(L.events_clean)


_EV_APPS = ("v_stage_events_clean e JOIN v_applications_clean a "
            "ON a.application_id = e.application_id")


@query("r3_stage_sla_by_channel", _sla_sql("a.channel", _EV_APPS, f"e.stage = '{SLOW}'"))
def r3(L: Layer) -> DataFrame:
    return process.stage_sla_by(L.events_by_channel, None, "channel", SLOW)


@query("r4_channel_stage_sla", _sla_sql("a.channel, e.stage", _EV_APPS, n="applications"))
def r4(L: Layer) -> DataFrame:
    """The published panel: channel × stage durations."""
    return process.channel_stage_sla(L.events_by_channel, None)


@query("r5_rejection_reasons", f"""
WITH refused AS (SELECT reason FROM raw_decisions SEMI JOIN v_applications_clean USING (application_id)
                 WHERE decision = '{REJ}')
SELECT reason, count(*) AS applications, {PCT('count(*)', '(SELECT count(*) FROM refused)')} AS share_pct
FROM refused GROUP BY reason""")
def r5(L: Layer) -> DataFrame:
    return process.rejection_reasons(L.decisions, L.clean_keys, rejected=REJ)


@query("r6_monthly_dynamics", f"""
WITH yes AS (SELECT DISTINCT application_id FROM raw_decisions WHERE decision = '{APP}')
SELECT left(CAST(submitted_at AS VARCHAR), 7) AS year_month, count(*) AS applications,
       {PCT('sum(CASE WHEN application_id IN (SELECT application_id FROM yes) THEN 1 ELSE 0 END)', 'count(*)')} AS approved_pct
FROM v_applications_clean GROUP BY 1""")
def r6(L: Layer) -> DataFrame:
    return process.monthly_dynamics(L.apps_clean, L.decisions, approved=APP)


@query("r7_distribution", f"""
SELECT {R('avg(hours)', 1)} AS mean, {R('quantile_cont(hours, 0.5)', 1)} AS median,
       {R('quantile_cont(hours, 0.9)', 1)} AS p90, {R('max(hours)', 1)} AS max_value,
       count(hours) AS n, {R('avg(hours) - quantile_cont(hours, 0.5)', 1)} AS mean_minus_median
FROM v_stage_events_clean WHERE stage = '{SLOW}'""")
def r7(L: Layer) -> DataFrame:
    return process.distribution_summary(L.events_clean.where(F.col("stage") == SLOW), "hours")


@query("r8_histogram", f"""
WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
c AS (SELECT CAST(CASE WHEN b.hi = b.lo THEN 1
                       ELSE least(floor((e.value - b.lo) / (b.hi - b.lo) * 45.0::DOUBLE) + 1, 45) END AS INTEGER) AS bin,
             count(*) AS n
      FROM events e CROSS JOIN b WHERE e.value IS NOT NULL GROUP BY 1)
SELECT s.bin, b.lo + ((b.hi - b.lo) / 45.0::DOUBLE) * (s.bin - 1) AS bin_lo,
       b.lo + ((b.hi - b.lo) / 45.0::DOUBLE) * s.bin AS bin_hi, coalesce(c.n, 0) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 46)) s CROSS JOIN b
LEFT JOIN c ON c.bin = s.bin WHERE b.lo IS NOT NULL""")
def r8(L: Layer) -> DataFrame:
    return process.histogram(L.t["events"], "value", 45)


@query("r9_box_stats", f"""
WITH d AS (SELECT a.channel, e.hours FROM {_EV_APPS} WHERE e.stage = '{SLOW}'),
q AS (SELECT channel, count(hours) AS n, quantile_cont(hours, 0.25) AS q1,
             quantile_cont(hours, 0.5) AS med, quantile_cont(hours, 0.75) AS q3
      FROM d GROUP BY channel)
SELECT q.channel, q.n, {R('q.q1', 1)} AS q1, {R('q.med', 1)} AS median, {R('q.q3', 1)} AS q3,
       {R('min(CASE WHEN d.hours >= q.q1 - 1.5 * (q.q3 - q.q1) THEN d.hours END)', 1)} AS whisker_lo,
       {R('max(CASE WHEN d.hours <= q.q3 + 1.5 * (q.q3 - q.q1) THEN d.hours END)', 1)} AS whisker_hi
FROM d JOIN q ON q.channel IS NOT DISTINCT FROM d.channel GROUP BY q.channel, q.n, q.q1, q.med, q.q3""")
def r9(L: Layer) -> DataFrame:
    return process.box_stats(L.events_by_channel.where(F.col("stage") == SLOW), "channel", "hours")


@query("r10_iqr_outliers", f"""
WITH g AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT (SELECT count(*) FROM events, g WHERE value > g.q3 + 1.5 * (g.q3 - g.q1)) AS outliers,
       {R('(SELECT q3 + 1.5 * (q3 - q1) FROM g)', 1)} AS threshold""")
def r10(L: Layer) -> DataFrame:
    return process.iqr_outliers(L.t["events"], "value")


@query("r11_first_per_client", _FIRST_SQL.format(source="v_applications_clean"))
def r11(L: Layer) -> DataFrame:
    return _first_rows(L.apps_clean)


@query("r12_bucket_counts", """
SELECT CASE WHEN value < 10 THEN 'a. under 10' WHEN value < 100 THEN 'b. 10-100'
            ELSE 'c. 100 and more' END AS bucket, count(*) AS n_rows
FROM events GROUP BY 1""")
def r12(L: Layer) -> DataFrame:
    return process.bucket_counts(L.t["events"], "value", [10, 100],
                                 ["a. under 10", "b. 10-100", "c. 100 and more"])


# ------------------------------------------------------------------ portfolio model


@query("n1_plan", """
SELECT initiative_id, name, direction, start_month, CAST(cost_rub AS DOUBLE) AS cost_rub,
       months_to_profit, months_to_payback, monthly_cost_rub, monthly_profit_rub
FROM v_initiative_plan""")
def n1(L: Layer) -> DataFrame:
    return _dbl(L.plan, "cost_rub")


@query("n2_cashflow", """
SELECT initiative_id, name, direction, month_index, cash_flow_rub,
       CAST(discounted_rub AS DOUBLE) AS discounted_rub
FROM v_initiative_cashflow""")
def n2(L: Layer) -> DataFrame:
    return _dbl(portfolio.cashflow(L.plan), "discounted_rub")


_NPV_SQL = """
SELECT initiative_id, name, direction, month_index, cash_flow_rub,
       CAST(discounted_rub AS DOUBLE) AS discounted_rub, CAST(cum_npv_rub AS DOUBLE) AS cum_npv_rub
FROM v_initiative_npv"""


@query("n3_initiative_npv", _NPV_SQL)
def n3(L: Layer) -> DataFrame:
    return _dbl(L.npv, "discounted_rub", "cum_npv_rub")


@query("n4_portfolio_npv", """
SELECT month_index, CAST(cash_flow_rub AS BIGINT) AS cash_flow_rub,
       CAST(discounted_rub AS DOUBLE) AS discounted_rub, CAST(cum_npv_rub AS DOUBLE) AS cum_npv_rub
FROM v_portfolio_npv""")
def n4(L: Layer) -> DataFrame:
    return _dbl(L.port, "discounted_rub", "cum_npv_rub")


@query("n5_fact_vs_plan", """
WITH turn AS (SELECT initiative_id, name, direction, start_month + months_to_profit AS earns_from,
                     monthly_cost_rub AS cost, monthly_profit_rub AS profit FROM v_initiative_plan)
SELECT initiative_id, name, direction, month_index, CAST(actual_cost_rub AS DOUBLE) AS actual_cost_rub,
       CAST(actual_profit_rub AS DOUBLE) AS actual_profit_rub,
       if(month_index < earns_from, cost, 0) AS plan_cost_rub,
       if(month_index < earns_from, 0, profit) AS plan_profit_rub
FROM turn JOIN initiative_fact USING (initiative_id)""")
def n5(L: Layer) -> DataFrame:
    return _dbl(portfolio.fact_vs_plan(L.fact, L.plan), "actual_cost_rub", "actual_profit_rub")


def _breakeven_sql(source: str, key: str | None) -> str:
    k = f"{key}, " if key else ""
    on = f"m.{key} = n.{key} AND " if key else ""
    on2 = f"t.{key} = n.{key}" if key else "TRUE"
    grp = f"GROUP BY n.{key}" if key else ""
    return f"""
WITH m AS (SELECT {k}min(cum_npv_rub) AS tv FROM {source} {'GROUP BY ' + key if key else ''}),
t AS (SELECT {'n.' + key + ', ' if key else ''}min(n.month_index) AS trough_month, min(m.tv) AS trough_npv_rub
      FROM {source} n JOIN m ON {on}n.cum_npv_rub = m.tv {grp})
SELECT {'t.' + key + ', ' if key else ''}t.trough_month, CAST(t.trough_npv_rub AS DOUBLE) AS trough_npv_rub,
       CAST(min(CASE WHEN n.cum_npv_rub >= 0 AND n.month_index > t.trough_month THEN n.month_index END)
            AS DOUBLE) AS breakeven_month
FROM {source} n JOIN t ON {on2}
GROUP BY {'t.' + key + ', ' if key else ''}t.trough_month, t.trough_npv_rub"""


@query("n6_breakeven", _breakeven_sql("v_initiative_npv", "initiative_id"))
def n6(L: Layer) -> DataFrame:
    """Per initiative, first month after the trough with cumulative NPV ≥ 0."""
    return _dbl(portfolio.breakeven_month(L.npv, ["initiative_id"]), "trough_npv_rub", "breakeven_month")


@query("n6_portfolio_breakeven", _breakeven_sql("v_portfolio_npv", None))
def n6p(L: Layer) -> DataFrame:
    """N6 on the portfolio curve."""
    return _dbl(portfolio.breakeven_month(L.port), "trough_npv_rub", "breakeven_month")


@query("n7_latest_payback", """
SELECT initiative_id, name, start_month + months_to_payback AS payback_month
FROM initiative_passport ORDER BY payback_month DESC, initiative_id LIMIT 3""")
def n7(L: Layer) -> DataFrame:
    return portfolio.latest_payback(L.passport, 3)


@query("n7_latest_payback_ties", """
SELECT initiative_id, name, start_month + months_to_payback AS payback_month
FROM initiative_passport
WHERE start_month + months_to_payback >= (
  SELECT min(p) FROM (SELECT start_month + months_to_payback AS p FROM initiative_passport
                      ORDER BY p DESC LIMIT 3) t)""")
def n7t(L: Layer) -> DataFrame:
    """N7 variant keeping every row tied with the n-th (rank() <= n)."""
    return portfolio.latest_payback(L.passport, 3, with_ties=True)


@query("n8_cost_by_direction", """
SELECT direction, CAST(sum(cost_rub) AS DOUBLE) AS cost_rub FROM initiative_passport GROUP BY direction""")
def n8(L: Layer) -> DataFrame:
    return _dbl(portfolio.cost_by_direction(L.passport), "cost_rub")


@query("n9_kpis", """
SELECT initiative_id, name, start_month, months_to_payback,
       start_month + months_to_payback AS payback_month,
       (SELECT count(*) FROM initiative_passport) AS initiatives
FROM initiative_passport""")
def n9(L: Layer) -> DataFrame:
    return portfolio.initiative_kpis(L.passport)


@query("n10_not_recovered", """
SELECT initiative_id, name, CAST(cum_npv_rub AS DOUBLE) AS cum_npv_rub
FROM v_initiative_npv WHERE month_index = 36 AND cum_npv_rub < 0""")
def n10(L: Layer) -> DataFrame:
    return _dbl(portfolio.not_recovered(L.npv), "cum_npv_rub")


def _what_if_sql() -> str:
    from stagewise.plans.oracle import CTES
    plan = CTES["v_initiative_plan"].replace("initiative_passport", "passport_alt")
    cash = CTES["v_initiative_cashflow"].replace("v_initiative_plan", "plan_alt")
    port = CTES["v_portfolio_npv"].replace("v_initiative_cashflow", "cash_alt")
    return f"""
WITH passport_alt AS (
  SELECT initiative_id, name, direction,
         CAST(CASE WHEN initiative_id = (SELECT initiative_id FROM initiative_passport
                                         ORDER BY cost_rub DESC, initiative_id LIMIT 1)
                   THEN start_month + 3 ELSE start_month END AS INTEGER) AS start_month,
         cost_rub, months_to_profit, months_to_payback
  FROM initiative_passport),
plan_alt AS ({plan}),
cash_alt AS ({cash}),
port_alt AS ({port})
SELECT b.month_index, CAST(b.cum_npv_rub AS DOUBLE) AS base_cum_npv_rub,
       CAST(a.cum_npv_rub AS DOUBLE) AS what_if_cum_npv_rub,
       CAST(a.cum_npv_rub - b.cum_npv_rub AS DOUBLE) AS delta_rub
FROM v_portfolio_npv b JOIN port_alt a ON a.month_index = b.month_index"""


@query("n11_what_if", _what_if_sql())
def n11(L: Layer) -> DataFrame:
    """Portfolio curve with the most expensive initiative starting 3 months later."""
    return _dbl(portfolio.what_if(L.passport), "base_cum_npv_rub", "what_if_cum_npv_rub", "delta_rub")


# ------------------------------------------------------------------ cards


@query("c1_channels", f"""
SELECT DISTINCT channel AS raw_channel, {alias_case('channel')} AS channel FROM cards_export""")
def c1(L: Layer) -> DataFrame:
    return L.cards_raw.select(F.col("channel").alias("raw_channel"),
                              normalize_channel("channel").alias("channel")).distinct()


@query("c2_amounts", f"""
SELECT credit_limit AS raw_amount, {parse_amount_sql('credit_limit')} AS amount FROM cards_export""")
def c2(L: Layer) -> DataFrame:
    return L.cards_raw.select(F.col("credit_limit").alias("raw_amount"),
                              parse_amount("credit_limit").alias("amount"))


def _iso(c: str):
    return F.date_format(c, "yyyy-MM-dd").alias(c)


# Parsed dates leave these two checks as ISO text ('' never occurs; NULL stays NULL).
@query("c3_dates", f"""
SELECT issued AS raw_issued, strftime({parse_date_sql('issued')}, '%Y-%m-%d') AS issued,
       first_purchase AS raw_first_purchase,
       strftime({parse_date_sql('first_purchase')}, '%Y-%m-%d') AS first_purchase
FROM cards_export""")
def c3(L: Layer) -> DataFrame:
    p = L.cards_raw.select(F.col("issued").alias("raw_issued"), parse_date("issued").alias("issued"),
                           F.col("first_purchase").alias("raw_first_purchase"),
                           parse_date("first_purchase").alias("first_purchase"))
    return p.select("raw_issued", _iso("issued"), "raw_first_purchase", _iso("first_purchase"))


@query("c4_clean_cards", """
SELECT card_id, strftime(issued, '%Y-%m-%d') AS issued, channel, tariff, credit_limit,
       strftime(first_purchase, '%Y-%m-%d') AS first_purchase, status
FROM cards_clean""")
def c4(L: Layer) -> DataFrame:
    c = L.cards_clean
    return c.select("card_id", _iso("issued"), "channel", "tariff", "credit_limit",
                    _iso("first_purchase"), "status")


def _activation_sql(dim: str) -> str:
    name = alias_case(dim) if dim == "channel" else dim
    return f"""
WITH parsed AS (SELECT trim(card_id) AS card, {name} AS dim, {parse_date_sql('issued')} AS issued,
                       {parse_date_sql('first_purchase')} AS bought FROM cards_export),
cards AS (SELECT DISTINCT ON (card) * FROM parsed
          ORDER BY card, issued ASC NULLS LAST, dim ASC NULLS LAST, bought ASC NULLS LAST),
gaps AS (SELECT dim, coalesce(date_diff('day', issued, bought) BETWEEN 0 AND 30, false) AS live FROM cards)
SELECT dim AS {dim}, count(*) AS total, count(*) FILTER (WHERE live) AS active,
       {PCT('count(*) FILTER (WHERE live)', 'count(*)')} AS active_pct
FROM gaps GROUP BY dim"""


@query("c5_activation_by_channel", _activation_sql("channel"))
def c5(L: Layer) -> DataFrame:
    return cards.activation_of_export(L.cards_raw, "channel")


@query("c5_activation_by_tariff", _activation_sql("tariff"))
def c5t(L: Layer) -> DataFrame:
    return cards.activation_of_export(L.cards_raw, "tariff")


# ------------------------------------------------------------------ single operators, chart frame


@query("a8_coerce_sum", f"""
SELECT {R('sum(TRY_CAST(credit_limit AS DOUBLE))', 0)} AS total,
       count(credit_limit) - count(TRY_CAST(credit_limit AS DOUBLE)) AS failed
FROM cards_export""")
def a8(L: Layer) -> DataFrame:
    """Plain coercion (``to_numeric(errors='coerce')``): sum and failures."""
    v = F.col("credit_limit").try_cast("double")
    return L.cards_raw.agg(N.round_half_up(F.sum(v), 0).alias("total"),
                           (F.count("credit_limit") - F.count(v)).alias("failed"))


@query("j5_without_decision", """
SELECT DISTINCT a.application_id FROM raw_applications a
WHERE NOT EXISTS (SELECT 1 FROM raw_decisions d WHERE d.application_id = a.application_id)""")
def j5(L: Layer) -> DataFrame:
    """Applications with no decision (explicit anti join)."""
    return quality.keys_without_match(L.apps, L.decisions, "application_id")


@query("w6_repeat_flags", """
SELECT application_id, strftime(submitted_at, '%Y-%m-%d') AS submitted_on, source_system,
       row_number() OVER (PARTITION BY application_id ORDER BY submitted_at, source_system) > 1 AS is_repeat
FROM raw_applications""")
def w6(L: Layer) -> DataFrame:
    """Every repeat except the first is flagged (``duplicated``)."""
    rows = L.apps.select("application_id", "submitted_at", "source_system")
    f = relational.flag_repeats(rows, "application_id", [F.col("submitted_at").asc_nulls_last()])
    return _iso_days(f.withColumnRenamed("submitted_at", "submitted_on"), "submitted_on")


@query("w3_running_amount", """
SELECT application_id, source_system, strftime(submitted_at, '%Y-%m-%d') AS submitted_on,
       CAST(sum(amount_requested) OVER (PARTITION BY source_system ORDER BY submitted_at) AS DOUBLE) AS amount_so_far
FROM raw_applications""")
def w3(L: Layer) -> DataFrame:
    """Every row with its source's sum up to its day (days are peers; two
    sources, so each holds far more than a third of the rows)."""
    rows = L.apps.select("application_id", "source_system", "submitted_at", "amount_requested")
    f = ordered.with_running_sum(rows, "submitted_at", "amount_requested", "amount_so_far", ["source_system"])
    f = f.withColumnRenamed("submitted_at", "submitted_on").drop("amount_requested")
    return _dbl(_iso_days(f, "submitted_on"), "amount_so_far")


@query("w4_running_total", """
SELECT application_id, strftime(disbursed_at, '%Y-%m-%d') AS disbursed_on,
       CAST(sum(sum(amount_disbursed)) OVER (ORDER BY disbursed_at, application_id) AS DOUBLE) AS paid_so_far
FROM raw_disbursements GROUP BY disbursed_at, application_id""")
def w4(L: Layer) -> DataFrame:
    """The running total over all disbursements, in order of time and id."""
    f = ordered.running_sums(L.disb, ["disbursed_at", "application_id"], {"amount_disbursed": "paid_so_far"})
    return _dbl(_iso_days(f.withColumnRenamed("disbursed_at", "disbursed_on"), "disbursed_on"), "paid_so_far")


@query("v1_chart_frame", """
WITH s AS (SELECT CASE WHEN max(abs(CAST(cum_npv_rub AS DOUBLE))) >= 1000000 THEN 1000000.0 ELSE 1.0 END
             AS d FROM v_portfolio_npv)
SELECT month_index AS x, '' AS series, CAST(cum_npv_rub AS DOUBLE) / s.d AS y,
       CASE WHEN s.d > 1 THEN 'mln' ELSE '' END AS unit
FROM v_portfolio_npv CROSS JOIN s""")
def v1(L: Layer) -> DataFrame:
    """V1: the portfolio NPV curve as a chart frame (y in millions)."""
    return frames.chart_frame(L.port, "month_index", "cum_npv_rub")




# ------------------------------------------------------------------ SQL text over the published views


@query("s13_sql_over_views", _sla_sql("a.channel, e.stage", _EV_APPS, n="applications"))
def s13(L: Layer) -> DataFrame:
    """S11 + S13: publish the eight views, then answer with SQL text over them."""
    from stagewise.plans.views import register_views
    register_views({"raw_applications": L.apps, "raw_stage_events": L.events,
                    "initiative_passport": L.passport, "initiative_fact": L.fact})
    return readers.run_sql(L.spark, """
        SELECT channel, stage, applications, median_hours, p90_hours
        FROM v_pipeline_stage_sla ORDER BY median_hours DESC""")


def _catalog(L: Layer) -> str:
    """A database of its own with the raw tables and the eight views."""
    name = tables.create_database(L.spark, f"stagewise_{uuid.uuid4().hex}")
    for table, df in {"raw_applications": L.apps, "raw_stage_events": L.events, "initiative_passport": L.passport,
                      "initiative_fact": L.fact}.items():
        sinks.save_table(df, f"{name}.{table}", TABLE_COMMENTS[table])
    catalog_views.create_views(L.spark, name)
    return name


@query("s11_catalog_panel", _sla_sql("a.channel, e.stage", _EV_APPS, n="applications"))
def s11(L: Layer) -> DataFrame:
    """S3 + S4 + S11: stored raw tables, catalog views over them, and the panel
    as a new session reads it."""
    return catalog_views.read_catalog_view(L.spark.newSession(), _catalog(L), "v_pipeline_stage_sla")


@query("s12_catalog_curves", _NPV_SQL)
def s12(L: Layer) -> DataFrame:
    """S11 + S12: the initiatives' curves, read back by a new session."""
    found = catalog_views.read_catalog_view(L.spark.newSession(), _catalog(L), "v_initiative_npv")
    return _dbl(found, "discounted_rub", "cum_npv_rub")


# ------------------------------------------------------------------ files written and read back


_ROUND_TRIP_COLUMNS = ["application_id", "client_id", "product", "channel", "region", "amount_requested",
                       "submitted_at", "source_system", "is_test"]


@query("s1_csv_round_trip", """
SELECT CAST(application_id AS VARCHAR) AS application_id, client_id, product, channel, region,
       CAST(amount_requested AS DOUBLE) AS amount_requested, submitted_at, source_system, is_test
FROM raw_applications""")
def s1(L: Layer) -> DataFrame:
    """S1 + S10: the applications written as comma CSV and loaded into their declared schema."""
    path = shared_path(L.spark, "csv")
    out = L.apps.select(*_ROUND_TRIP_COLUMNS).withColumn("submitted_at", F.date_format("submitted_at", "yyyy-MM-dd HH:mm:ss"))
    sinks.write_csv(out, path, sep=",")
    return _dbl(readers.read_declared_csv(L.spark, path, "raw_applications"), "amount_requested")


@query("s2_export_round_trip", """
SELECT card_id, issued, channel, tariff, credit_limit, nullif(first_purchase, '') AS first_purchase, status
FROM cards_export""")
def s2(L: Layer) -> DataFrame:
    """S2 + S10: the cards export written with ';' and a byte order mark under
    its own headers, and read back as text."""
    path = shared_path(L.spark, "export")
    headers = {v: k for k, v in cards.EXPORT_COLUMNS.items()}
    out = L.cards_raw.select(*[F.col(c).alias(headers[c]) for c in L.cards_raw.columns])
    sinks.write_csv(out, path, sep=";", bom=True)
    return cards.from_export(readers.read_text_export(L.spark, path))


@query("s3_declared_table", """
SELECT CAST(application_id AS VARCHAR) AS application_id, client_id, product, channel, region,
       CAST(amount_requested AS DOUBLE) AS amount_requested, submitted_at, source_system, is_test
FROM raw_applications""")
def s3(L: Layer) -> DataFrame:
    """S1 + S3 + S4: the applications' CSV loaded into a catalog table that was
    created from the declared schema, and read back from it."""
    path, name = shared_path(L.spark, "csv"), tables.create_database(L.spark, f"stagewise_{uuid.uuid4().hex}")
    out = L.apps.select(*_ROUND_TRIP_COLUMNS).withColumn("submitted_at", F.date_format("submitted_at", "yyyy-MM-dd HH:mm:ss"))
    sinks.write_csv(out, path, sep=",")
    tables.create_declared_table(L.spark, "raw_applications", name)
    tables.load_declared_csv(L.spark, path, "raw_applications", name)
    return _dbl(readers.read_table(L.spark, f"{name}.raw_applications"), "amount_requested")


_STORED = ["customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier"]


@query("s7_stored_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _STORED))
def s7f(L: Layer) -> DataFrame:
    """Counts of the stored tables from their footers."""
    return tables.stored_row_counts(L.spark, {t: f"{L.t.sf_dir}/{t}.parquet" for t in _STORED})


def queries() -> dict[str, Builder]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1]}
