"""Adapters from the driver's TPC-H-like tables to the reference's data model.

Each adapter is a plain projection/join of the given tables, so its work grows
with them.  The oracle SQL (``stagewise.plans.oracle``) defines the same
relations in DuckDB text; both sides must stay in step.

Mapping (application = order; an export row per order line gives repeats):

* raw_applications  = lineitem ⋈ orders ⋈ customer(⋈ nation ⋈ region):
  id = o_orderkey, client = 'CL-'||o_custkey, product = c_mktsegment,
  channel = o_orderpriority, region = r_name, amount = o_totalprice,
  submitted = o_orderdate plus 0 to 6 days by line number (so the repeats of
  an application differ and its earliest row is not its first line),
  source system = l_linestatus, test record = customer with a negative
  account balance.  By remainders of the keys some clients are the technical
  client, and some clients, flags, channels, regions, amounts and actor roles
  are missing (``GAPS``).
* raw_stage_events  = lineitem ⋈ orders: stage = l_returnflag||l_linestatus,
  entered = o_orderdate, left = l_shipdate, or NULL when the shipment lies
  after the export moment (the latest order date).
* raw_decisions     = orders that are not open: decision = o_orderstatus
  ('F' approved, 'P' rejected), reason = o_orderpriority.
* raw_disbursements = orders with status 'F'.
* initiative_passport = part; initiative_fact = lineitem by (part, line number).
* cards export      = lineitem ⋈ orders rendered as text in the export's styles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.functions.numeric import as_money

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# ---------------------------------------------------------------------------
# The 16 channel spellings of the cards export, in its order.
CARD_CHANNEL_SPELLINGS = [
    "Отделение", "отделение", "ОТДЕЛЕНИЕ", "Отделение ", "Офис банка",
    "Мобильное приложение", "мобильное приложение", "Мобильный банк", "МП",
    "Сайт банка", "сайт банка", "Веб-сайт",
    "Партнёрская сеть", "Партнерская сеть", "партнёрская сеть", "Партнёр",
]
# ---------------------------------------------------------------------------

# Where values are missing or the client is technical: remainders of a key.
GAPS = {
    "technical_client": ("o_custkey", 50, 7), "client_id": ("o_custkey", 61, 3), "is_test": ("o_custkey", 37, 2),
    "channel": ("o_orderkey", 71, 9), "region": ("o_orderkey", 43, 5), "amount_requested": ("o_orderkey", 83, 11),
    "actor_role": ("l_orderkey", 29, 4),
}


def _gap(name: str):
    key, modulus, rest = GAPS[name]
    return F.col(key) % modulus == rest


def _unless(name: str, value):
    return F.when(~_gap(name), value)


# Parameters the test-data queries pass to the operators.
APPROVED, REJECTED = "F", "P"
SLOW_STAGE = "RF"


class Tables(dict):
    """Lazily loaded parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __missing__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        self[name] = df
        return df


def load(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def _export_moment(t: Tables):
    """The latest order date: shipments after it had not happened at export time.

    A single scalar, computed once per load and used as a literal: as a
    subquery it was referenced (after filter inference) from several places
    of each plan and re-run for every reference.  The literal is built from
    its ISO text as TIMESTAMP_NTZ, so no session time zone is involved."""
    if not hasattr(t, "export_moment"):
        v = t["orders"].agg(F.max("o_orderdate").cast("string").alias("m")).first()["m"]
        t.export_moment = F.lit(v).cast("timestamp_ntz")
    return t.export_moment


# Order lines that one task of a join by order takes, on average.
LINES_A_TASK = 1_000_000


def _by_order(t: Tables, df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by order over tasks of some million lines at most.

    Left to itself, Spark joins small partitions to tasks of a number of
    compressed bytes, and sorted keys pack so well that one task would sort
    tens of millions of rows.  The lines are counted in the files' footers;
    where one task can take them all, Spark is left to itself."""
    if not hasattr(t, "order_tasks"):
        lines = t["lineitem"].count()
        t.order_tasks = 0 if lines <= LINES_A_TASK else max(
            int(t.spark.conf.get("spark.sql.shuffle.partitions")), -(-lines // LINES_A_TASK))
    return df.repartition(t.order_tasks, key) if t.order_tasks else df


def applications(t: Tables) -> DataFrame:
    li = t["lineitem"].select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_linestatus")
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice", "o_orderdate")
    geo = (t["customer"].select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
           .join(t["nation"].select("n_nationkey", "n_regionkey"),
                 F.col("c_nationkey") == F.col("n_nationkey"), "left")
           .join(t["region"].select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    # customers are looked up by order, not by line; the lines come last
    placed = o.join(geo, F.col("o_custkey") == F.col("c_custkey"), "left")
    rows = _by_order(t, li, "o_orderkey").join(_by_order(t, placed, "o_orderkey"), "o_orderkey")
    return rows.select(
        F.col("o_orderkey").alias("application_id"),
        F.when(_gap("technical_client"), F.lit("CL-TEST")).otherwise(_unless(
            "client_id", F.concat(F.lit("CL-"), F.col("o_custkey").cast("string")))).alias("client_id"),
        F.col("c_mktsegment").alias("product"),
        _unless("channel", F.col("o_orderpriority")).alias("channel"),
        _unless("region", F.col("r_name")).alias("region"),
        _unless("amount_requested", as_money("o_totalprice")).alias("amount_requested"),
        F.expr("o_orderdate + make_dt_interval((l_linenumber * 3) % 7)").alias("submitted_at"),
        F.col("l_linestatus").alias("source_system"),
        _unless("is_test", F.col("c_acctbal") < 0).alias("is_test"),
    )


def stage_events(t: Tables) -> DataFrame:
    li = t["lineitem"].select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    o = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderstatus")
    cut = _export_moment(t)
    return _by_order(t, li, "l_orderkey").join(_by_order(t, o, "l_orderkey"), "l_orderkey").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("event_id"),
        F.col("l_orderkey").alias("application_id"),
        F.concat("l_returnflag", "l_linestatus").alias("stage"),
        F.col("o_orderdate").alias("entered_at"),
        F.when(F.col("l_shipdate") > cut, F.lit(None)).otherwise(F.col("l_shipdate")).alias("left_at"),
        _unless("actor_role", F.col("o_orderstatus")).alias("actor_role"),
    )


def decisions(t: Tables) -> DataFrame:
    return t["orders"].where(F.col("o_orderstatus") != "O").select(
        F.col("o_orderkey").alias("application_id"),
        F.col("o_orderstatus").alias("decision"),
        F.col("o_orderdate").alias("decided_at"),
        F.col("o_orderpriority").alias("reason"),
    )


def disbursements(t: Tables) -> DataFrame:
    return t["orders"].where(F.col("o_orderstatus") == APPROVED).select(
        F.col("o_orderkey").alias("application_id"),
        F.col("o_orderdate").alias("disbursed_at"),
        as_money("o_totalprice").alias("amount_disbursed"),
    )


def passport(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    mp = (F.lit(3) + k % 10).cast("int")
    return t["part"].select(
        k.alias("initiative_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("direction"),
        (k % 10).cast("int").alias("start_month"),
        (F.col("p_size") * F.lit(1_000_000)).cast("decimal(18,2)").alias("cost_rub"),
        mp.alias("months_to_profit"),
        (mp + F.lit(6) + k % 15).cast("int").alias("months_to_payback"),
    )


def fact(t: Tables) -> DataFrame:
    li = t["lineitem"]
    price = as_money("l_extendedprice")
    return li.groupBy(F.col("l_partkey").alias("initiative_id"),
                      F.col("l_linenumber").alias("month_index")).agg(
        F.sum(price).alias("actual_cost_rub"),
        F.sum(price * F.col("l_discount").cast("decimal(4,2)")).alias("actual_profit_rub"),
    )


def cards_export(t: Tables) -> DataFrame:
    """Orders rendered as the cards export: every field text, several number and
    date spellings, 16 channel spellings, one row per order line (repeats)."""
    li = t["lineitem"].select("l_orderkey", "l_linenumber", "l_linestatus", "l_shipdate")
    o = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate",
                           "o_orderpriority", "o_totalprice")
    cut = _export_moment(t)
    line = F.col("l_linenumber")
    whole = F.floor("o_totalprice")
    spaced = F.when(whole >= 1000, F.concat(
        F.floor(whole / 1000).cast("string"), F.lit(" "),
        F.lpad((whole % 1000).cast("string"), 3, "0"))).otherwise(whole.cast("string"))
    exact = as_money("o_totalprice").cast("string")
    spell = F.array(*[F.lit(s) for s in CARD_CHANNEL_SPELLINGS])

    def ru_or_iso(ts, ru):
        return F.when(ru, F.date_format(ts, "dd.MM.yyyy")).otherwise(F.date_format(ts, "yyyy-MM-dd"))

    return _by_order(t, li, "l_orderkey").join(_by_order(t, o, "l_orderkey"), "l_orderkey").select(
        F.col("l_orderkey").cast("string").alias("card_id"),
        ru_or_iso(F.col("o_orderdate"), line % 2 == 1).alias("issued"),
        F.element_at(spell, ((F.col("l_orderkey") + line) % 16 + 1).cast("int")).alias("channel"),
        F.col("o_orderpriority").alias("tariff"),
        F.when(line % 4 == 0, F.lit("н/д"))
         .when(line % 4 == 1, spaced)
         .when(line % 4 == 2, F.regexp_replace(exact, "\\.", ","))
         .otherwise(exact).alias("credit_limit"),
        F.when(F.col("l_shipdate") > cut, F.lit(""))
         .otherwise(ru_or_iso(F.col("l_shipdate"), line % 2 == 0)).alias("first_purchase"),
        F.when(F.col("l_linestatus") == "O",
               F.when(line % 2 == 0, F.lit("Активна")).otherwise(F.lit("активна")))
         .otherwise(F.lit("Закрыта")).alias("status"),
    )
