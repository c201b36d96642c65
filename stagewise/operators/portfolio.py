"""Portfolio model (N1-N11): passport → plan → cash flow → NPV curves.

Model: spending is spread evenly over the months before profitability; the
monthly profit is the smallest whole amount whose discounted stream pays the
discounted spending back by the payback month.

The plan is per-row arithmetic (no shuffle).  Curves are generated per
initiative with ``explode(sequence(0, horizon))`` after hash-partitioning the
one-row-per-initiative plan, so the running sum per initiative needs no
further exchange; the portfolio then sums by month (≤ horizon+1 groups,
map-side combined).

Powers and quotients are decimal, as the model's SQL computes them: the factor
of a month is the one before divided by 1 + rate, to 28 decimals; the monthly
profit's quotient has 6 decimals before it is rounded up, so a quotient that is
a whole number stays one (in doubles it may come out a unit higher).
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal, localcontext
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewise.functions.temporal import month_series

# Discount rate per month and portfolio horizon in months.
RATE = 0.01
HORIZON = 36

_DISC = "decimal(38,2)"


_FACTOR = "decimal(30,28)"
_FACTORS = "decimal(32,28)"          # sums of factors


def _growth(rate: float) -> Decimal:
    return 1 + Decimal(str(rate))


def discount_factors(last: int, rate: float = RATE) -> list[Decimal]:
    """The factors of months 0..last, with the rounding of the decimal types below."""
    with localcontext() as c:
        c.prec = 60
        out = [Decimal(1)]
        for _ in range(last):
            quotient = out[-1] / _growth(rate)
            scale = 28 + len(_growth(rate).as_tuple().digits) + 1       # of Spark's quotient
            out.append(quotient.quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP).quantize(Decimal(1).scaleb(-28), ROUND_HALF_UP))
        return out


def initiative_plan(passport: DataFrame, rate: float = RATE) -> DataFrame:
    """Monthly cost = floor(cost / mp); monthly profit = ceil(spend_pv / unit_pv)
    with spend_pv = Σ_{t=0}^{mp-1} (cost/mp)/(1+r)^(start+t) and
    unit_pv = Σ_{t=mp}^{pb} 1/(1+r)^(start+t) (both ends inclusive).  The factor
    of the start cancels out, so the sums run over t alone.

    Policy for an impossible passport (months_to_profit ≤ 0, or payback
    before profitability, where the SQL original divides by zero): the
    monthly amounts are NULL instead of failing the whole job."""
    mp, pb = F.col("months_to_profit"), F.col("months_to_payback")
    none = F.lit(0).cast(_FACTORS)
    start = F.struct(F.lit(1).cast(_FACTOR).alias("d"), none.alias("spend"), none.alias("unit"))

    def month(acc: Column, t: Column) -> Column:
        spend, d = t < mp, acc["d"]
        return F.struct((d / F.lit(_growth(rate))).cast(_FACTOR).alias("d"),
                        F.when(spend, (acc["spend"] + d).cast(_FACTORS)).otherwise(acc["spend"]).alias("spend"),
                        F.when(spend, acc["unit"]).otherwise((acc["unit"] + d).cast(_FACTORS)).alias("unit"))

    # both sums as whole multiples of 1e-20, so that their quotient keeps its decimals
    whole = lambda c: (F.round(c, 20).cast("decimal(24,20)") * F.lit(Decimal(10) ** 20)).cast("decimal(24,0)")
    sums = F.aggregate(month_series(F.lit(0), pb), start, month)
    spend_pv, unit_pv = F.col("cost_rub").cast("decimal(18,2)") * whole(sums["spend"]), mp.cast("decimal(10,0)") * whole(sums["unit"])
    quotient = F.try_divide(spend_pv, F.when((mp > 0) & (unit_pv > 0), unit_pv)).cast("decimal(38,6)")
    return passport.select(
        "initiative_id", "name", "direction", "start_month", "cost_rub",
        "months_to_profit", "months_to_payback",
        F.floor(F.try_divide(F.col("cost_rub").cast("decimal(18,2)"), F.when(mp > 0, mp).cast("decimal(10,0)")))
         .cast("bigint").alias("monthly_cost_rub"),
        F.ceil(quotient).cast("bigint").alias("monthly_profit_rub"))


def _flow(m: Column) -> Column:
    start, mp = F.col("start_month"), F.col("months_to_profit")
    return (F.when(m < start, F.lit(0).cast("bigint"))
            .when(m < start + mp, -F.col("monthly_cost_rub"))
            .otherwise(F.col("monthly_profit_rub")))


def _discounted(flow: Column, m: Column, horizon: int, rate: float) -> Column:
    factors = F.array(*[F.lit(d).cast(_FACTOR) for d in discount_factors(horizon, rate)])
    return F.round(flow.cast("decimal(20,0)") * F.element_at(factors, m + 1), 2).cast(_DISC)


def initiative_npv(plan: DataFrame, horizon: int = HORIZON, rate: float = RATE) -> DataFrame:
    """N2+N3: one row per initiative and month 0..horizon with the cash flow,
    its discounted value (rounded to kopecks) and the running NPV, which sums
    the *rounded* discounted values.

    The plan (one row per initiative) is hash-partitioned by initiative before
    the months are generated, so the exploded rows already sit in their
    window partition: the only shuffle moves plan rows, not horizon+1 times as
    many curve rows."""
    m = F.col("month_index")
    rows = (plan.repartition("initiative_id")
            .select("initiative_id", "name", "direction", "start_month", "months_to_profit",
                    "monthly_cost_rub", "monthly_profit_rub",
                    F.explode(F.sequence(F.lit(0), F.lit(horizon))).alias("month_index"))
            .withColumn("cash_flow_rub", _flow(m))
            .withColumn("discounted_rub", _discounted(F.col("cash_flow_rub"), m, horizon, rate)))
    w = (Window.partitionBy("initiative_id").orderBy("month_index")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.select("initiative_id", "name", "direction", "month_index", "cash_flow_rub",
                       "discounted_rub", F.sum("discounted_rub").over(w).cast(_DISC).alias("cum_npv_rub"))


def cashflow(plan: DataFrame, horizon: int = HORIZON, rate: float = RATE) -> DataFrame:
    """Months 0..horizon: 0 before start, −monthly cost for the months to
    profitability, +monthly profit afterwards (no end); discounted = round(flow/(1+r)^m, 2)."""
    return initiative_npv(plan, horizon, rate).drop("cum_npv_rub")


def portfolio_npv(cash: DataFrame) -> DataFrame:
    """Per month Σ flow, Σ discounted and the running total.  The window has
    no partition but runs after grouping, over horizon+1 rows."""
    by_month = cash.groupBy("month_index").agg(F.sum("cash_flow_rub").alias("cash_flow_rub"),
                                               F.sum("discounted_rub").alias("discounted_rub"))
    w = Window.orderBy("month_index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return by_month.withColumn("cum_npv_rub", F.sum("discounted_rub").over(w)).orderBy("month_index")


def fact_vs_plan(fact: DataFrame, plan: DataFrame) -> DataFrame:
    """Plan cost while month < start + months_to_profit, plan profit from
    then on.  No lower bound: a fact row before the start still gets plan cost."""
    edge = F.col("start_month") + F.col("months_to_profit")
    p = plan.select("initiative_id", "name", "direction", "start_month", "months_to_profit",
                    "monthly_cost_rub", "monthly_profit_rub")
    return fact.join(p, "initiative_id").select(
        "initiative_id", "name", "direction", "month_index", "actual_cost_rub", "actual_profit_rub",
        F.when(F.col("month_index") < edge, F.col("monthly_cost_rub")).otherwise(F.lit(0))
         .alias("plan_cost_rub"),
        F.when(F.col("month_index") >= edge, F.col("monthly_profit_rub")).otherwise(F.lit(0))
         .alias("plan_profit_rub"))


def breakeven_month(curve: DataFrame, keys: list[str] | None = None, month: str = "month_index",
                    cum: str = "cum_npv_rub") -> DataFrame:
    """First month after the trough where the running NPV is ≥ 0 (NULL if
    never).  A curve is 0 before its start, so 'first month with cum ≥ 0' would
    be wrong.  Trough = earliest month of the minimum.

    One pass: the trough comes from a window over each curve (horizon+1 rows;
    a curve from ``initiative_npv`` is already partitioned by initiative, so
    neither the window nor the grouping shuffles again).  Without ``keys`` the
    input is a single (portfolio) curve."""
    keys = keys or []
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    t = curve.withColumn("_t", F.min(F.struct(F.col(cum), F.col(month))).over(w))
    trough_m = F.col("_t")[month]
    return t.groupBy(*keys, trough_m.alias("trough_month"), F.col("_t")[cum].alias("trough_npv_rub")).agg(
        F.min(F.when((F.col(cum) >= 0) & (F.col(month) > trough_m), F.col(month))).alias("breakeven_month"))


def latest_payback(passport: DataFrame, n: int = 3, with_ties: bool = False) -> DataFrame:
    """Payback month from the portfolio start (start + months_to_payback),
    latest ``n``; ties broken by id, or all tied rows kept (``rank() <= n``)."""
    p = passport.select("initiative_id", "name",
                        (F.col("start_month") + F.col("months_to_payback")).alias("payback_month"))
    if with_ties:
        from stagewise.operators.relational import top_n_with_ties
        return top_n_with_ties(p, "payback_month", n)
    return p.orderBy(F.col("payback_month").desc(), F.col("initiative_id")).limit(n)


def cost_by_direction(passport: DataFrame) -> DataFrame:
    """Total cost per direction, largest first."""
    return (passport.groupBy("direction").agg(F.sum("cost_rub").alias("cost_rub"))
            .orderBy(F.col("cost_rub").desc(), F.col("direction")))


def initiative_kpis(passport: DataFrame) -> DataFrame:
    """Per initiative the relative payback (months from its own start) and
    the absolute payback month (from the portfolio start), with the count of
    initiatives on every row."""
    total = passport.agg(F.count(F.lit(1))).scalar()
    return passport.select(
        "initiative_id", "name", "start_month", "months_to_payback",
        (F.col("start_month") + F.col("months_to_payback")).alias("payback_month"),
        total.cast("bigint").alias("initiatives"))


def not_recovered(curve: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Initiatives whose running NPV at the horizon is still negative."""
    return curve.where((F.col("month_index") == horizon) & (F.col("cum_npv_rub") < 0)).select(
        "initiative_id", "name", "cum_npv_rub")


def shift_most_expensive(passport: DataFrame, months: int = 3) -> DataFrame:
    """What-if alteration: the most expensive initiative (id breaks ties) starts
    later.  Its id is the value of a top-1 subquery."""
    top = passport.orderBy(F.col("cost_rub").desc(), F.col("initiative_id")).select("initiative_id").limit(1)
    hit = F.col("initiative_id") == top.scalar()
    return passport.withColumn("start_month", F.when(hit, F.col("start_month") + months)
                               .otherwise(F.col("start_month")).cast("int"))


def what_if(passport: DataFrame, alter: Callable[[DataFrame], DataFrame] = shift_most_expensive,
            horizon: int = HORIZON, rate: float = RATE) -> DataFrame:
    """Re-run plan → cash flow → portfolio curve on an altered passport and
    set the two curves side by side per month."""
    def curve(p: DataFrame) -> DataFrame:
        return portfolio_npv(cashflow(initiative_plan(p, rate), horizon, rate))
    base = curve(passport).select("month_index", F.col("cum_npv_rub").alias("base_cum_npv_rub"))
    alt = curve(alter(passport)).select("month_index", F.col("cum_npv_rub").alias("what_if_cum_npv_rub"))
    return (base.join(alt, "month_index")
            .withColumn("delta_rub", F.col("what_if_cum_npv_rub") - F.col("base_cum_npv_rub"))
            .orderBy("month_index"))
