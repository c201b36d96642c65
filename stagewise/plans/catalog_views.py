"""The eight views as catalog views over stored tables.

``register_views`` publishes DataFrames for one session.  Here the same
relations are SQL text over the tables of a database, so they outlive the
session, follow the tables, and any session that sees the catalog reads them (a
session keeps the file list of a table that it has read; ``refresh`` renews it).  The texts are in dependency order: created forwards, dropped backwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from stagewise.operators.portfolio import HORIZON, discount_factors
from stagewise.sources.tables import _text

RAW = ("raw_applications", "raw_stage_events", "initiative_passport", "initiative_fact")

_KEPT = ["application_id", "client_id", "product", "channel", "region", "amount_requested", "submitted_at", "source_system"]
_ORDER = ", ".join(f"{c} NULLS LAST" for c in ["submitted_at", *[c for c in _KEPT if c not in ("application_id", "submitted_at")]])
_HOURS = "CAST(timestampdiff(MICROSECOND, e.entered_at, e.left_at) AS DOUBLE) / 3600000000D"


def _half_up(x: str) -> str:
    return f"coalesce(CAST(round(try_cast({x} AS DECIMAL(38,6)), 1) AS DOUBLE), {x})"


_WHOLE = "CAST(round(pv.{c}, 20) * 100000000000000000000BD AS DECIMAL(24,0))"
_FACTORS = "array(" + ", ".join(f"CAST({d:f}BD AS DECIMAL(30,28))" for d in discount_factors(HORIZON)) + ")"

#: name → (comment, text); ``{db}`` stands for the database.
VIEWS: dict[str, tuple[str, str]] = {
    "v_applications_clean": (
        "applications without service records, the earliest row of each id",
        f"""SELECT {', '.join(_KEPT)}
FROM (SELECT *, row_number() OVER (PARTITION BY application_id ORDER BY {_ORDER}) AS place
      FROM {{db}}.raw_applications WHERE NOT is_test AND client_id <> 'CL-TEST')
WHERE place = 1"""),
    "v_stage_events_clean": (
        "completed stages of clean applications with their hours",
        f"""SELECT e.*, {_HOURS} AS hours
FROM {{db}}.raw_stage_events e LEFT SEMI JOIN {{db}}.v_applications_clean a ON a.application_id = e.application_id
WHERE e.left_at > e.entered_at"""),
    "v_pipeline_stage_sla": (
        "median and P90 hours by channel and stage",
        f"""SELECT channel, stage, applications, {_half_up('med')} AS median_hours, {_half_up('p90')} AS p90_hours
FROM (SELECT a.channel, e.stage, count(*) AS applications, percentile(e.hours, 0.5) AS med, percentile(e.hours, 0.9) AS p90
      FROM {{db}}.v_stage_events_clean e JOIN {{db}}.v_applications_clean a ON a.application_id = e.application_id
      GROUP BY a.channel, e.stage)"""),
    "v_initiative_plan": (
        "an initiative's passport as monthly cost and monthly profit",
        f"""SELECT initiative_id, name, direction, start_month, cost_rub, months_to_profit, months_to_payback,
       CAST(floor(try_divide(cost_rub, months)) AS BIGINT) AS monthly_cost_rub,
       CAST(ceil(CAST(try_divide(cost_rub * {_WHOLE.format(c='spend')}, months * nullif({_WHOLE.format(c='unit')}, 0))
                      AS DECIMAL(38,6))) AS BIGINT) AS monthly_profit_rub
FROM (SELECT *, CAST(if(months_to_profit > 0, months_to_profit, NULL) AS DECIMAL(10,0)) AS months,
             aggregate(if(months_to_payback >= 0, sequence(0, months_to_payback), CAST(array() AS ARRAY<INT>)),
                       named_struct('d', CAST(1 AS DECIMAL(30,28)), 'spend', CAST(0 AS DECIMAL(32,28)), 'unit', CAST(0 AS DECIMAL(32,28))),
                       (x, t) -> named_struct('d', CAST(x.d / 1.01BD AS DECIMAL(30,28)),
                                              'spend', CAST(x.spend + if(t < months_to_profit, x.d, 0BD) AS DECIMAL(32,28)),
                                              'unit', CAST(x.unit + if(t < months_to_profit, 0BD, x.d) AS DECIMAL(32,28)))) AS pv
      FROM {{db}}.initiative_passport)"""),
    "v_initiative_cashflow": (
        "an initiative's flow of money by month, plain and discounted",
        f"""SELECT initiative_id, name, direction, month_index, cash_flow_rub,
       CAST(round(CAST(cash_flow_rub AS DECIMAL(20,0)) * element_at({_FACTORS}, month_index + 1), 2) AS DECIMAL(38,2)) AS discounted_rub
FROM (SELECT initiative_id, name, direction, month_index,
             CASE WHEN month_index < start_month THEN 0L
                  WHEN month_index - start_month < months_to_profit THEN -monthly_cost_rub
                  ELSE monthly_profit_rub END AS cash_flow_rub
      FROM (SELECT /*+ REPARTITION(initiative_id) */ * FROM {{db}}.v_initiative_plan)
      LATERAL VIEW explode(sequence(0, {HORIZON})) months AS month_index)"""),
    "v_initiative_npv": (
        "an initiative's running NPV by month",
        """SELECT *, CAST(sum(discounted_rub) OVER (PARTITION BY initiative_id ORDER BY month_index) AS DECIMAL(38,2)) AS cum_npv_rub
FROM {db}.v_initiative_cashflow"""),
    "v_portfolio_npv": (
        "the whole portfolio's curve: the initiatives' sums by month and their running total",
        """SELECT month_index, cash_flow_rub, discounted_rub, sum(discounted_rub) OVER (ORDER BY month_index) AS cum_npv_rub
FROM (SELECT month_index, sum(cash_flow_rub) AS cash_flow_rub, sum(discounted_rub) AS discounted_rub
      FROM {db}.v_initiative_cashflow GROUP BY month_index)"""),
    "v_initiative_fact_vs_plan": (
        "booked cost and profit beside the plan's",
        """SELECT f.initiative_id, p.name, p.direction, f.month_index, f.actual_cost_rub, f.actual_profit_rub,
       if(f.month_index - p.start_month < p.months_to_profit, p.monthly_cost_rub, 0L) AS plan_cost_rub,
       if(f.month_index - p.start_month < p.months_to_profit, 0L, p.monthly_profit_rub) AS plan_profit_rub
FROM {db}.initiative_fact f JOIN {db}.v_initiative_plan p ON p.initiative_id = f.initiative_id"""),
}


def create_views(spark: SparkSession, database: str) -> list[str]:
    """Create or replace the eight views over the database's tables (``RAW``)."""
    for name, (comment, text) in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} COMMENT {_text(comment)} AS {text.replace('{db}', database)}")
    return list(VIEWS)


def drop_views(spark: SparkSession, database: str) -> None:
    """Drop the views that exist, those that read others first."""
    for name in reversed(VIEWS):
        spark.sql(f"DROP VIEW IF EXISTS {database}.{name}")


def refresh(spark: SparkSession, database: str) -> None:
    """See what other sessions have added to the raw tables."""
    for table in RAW:
        spark.catalog.refreshTable(f"{database}.{table}")


def read_catalog_view(spark: SparkSession, database: str, name: str, *order: Column) -> DataFrame:
    """A view of the catalog, from any session, optionally ordered."""
    df = spark.table(f"{database}.{name}")
    return df.orderBy(*order) if order else df
