"""Golden values of the portfolio model on the committed 10-initiative passport."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stagewise.operators import portfolio as P

# The committed passport: id, direction, start, cost, months to profit, months to payback.
PASSPORT = [
    ("INI-01", "Карты", 0, 4200000, 5, 14), ("INI-02", "Карты", 2, 6800000, 7, 19),
    ("INI-03", "Кредиты", 1, 9500000, 9, 24), ("INI-04", "Кредиты", 4, 3100000, 4, 11),
    ("INI-05", "Обслуживание", 3, 7400000, 8, 21), ("INI-06", "Обслуживание", 6, 2600000, 3, 9),
    ("INI-07", "Данные", 0, 12000000, 12, 30), ("INI-08", "Данные", 8, 5300000, 6, 17),
    ("INI-09", "Бизнес", 5, 8100000, 7, 20), ("INI-10", "Бизнес", 9, 4700000, 5, 13),
]
# id: monthly cost, monthly profit, payback month, cumulative NPV at month 36
GOLDEN = {
    "INI-01": (840000, 452403, 14, "7737813.61"), "INI-02": (971428, 577517, 21, "6497377.89"),
    "INI-03": (1055555, 671905, 25, "5431930.48"), "INI-04": (775000, 411258, 15, "6679841.25"),
    "INI-05": (925000, 589390, 24, "5224428.98"), "INI-06": (866666, 390311, 15, "6339611.28"),
    "INI-07": (1000000, 736242, 30, "3165698.12"), "INI-08": (883333, 482830, 25, "3903376.17"),
    "INI-09": (1157142, 641902, 25, "5189376.51"), "INI-10": (940000, 559764, 22, "5847928.04"),
}


@pytest.fixture(scope="module")
def passport(spark):
    rows = [(i, f"initiative {i}", d, s, c, mp, pb) for i, d, s, c, mp, pb in PASSPORT]
    return spark.createDataFrame(
        rows, "initiative_id string, name string, direction string, start_month int, cost_rub long,"
              " months_to_profit int, months_to_payback int").withColumn(
        "cost_rub", F.col("cost_rub").cast("decimal(18,2)"))


def test_plan_amounts(passport):
    got = {r.initiative_id: (r.monthly_cost_rub, r.monthly_profit_rub)
           for r in P.initiative_plan(passport).collect()}
    assert got == {k: v[:2] for k, v in GOLDEN.items()}


def test_curves_breakeven_and_final_npv(passport):
    curve = P.initiative_npv(P.initiative_plan(passport))
    assert curve.count() == 10 * 37
    be = {r.initiative_id: r.breakeven_month for r in P.breakeven_month(curve, ["initiative_id"]).collect()}
    assert be == {k: v[2] for k, v in GOLDEN.items()}
    final = {r.initiative_id: r.cum_npv_rub for r in curve.where("month_index = 36").collect()}
    assert final == {k: Decimal(v[3]) for k, v in GOLDEN.items()}
    # payback month = start + months to payback: cumulative NPV is >= 0 there
    assert P.not_recovered(curve).count() == 0


def test_portfolio_curve(passport):
    port = {r.month_index: r for r in P.portfolio_npv(P.cashflow(P.initiative_plan(passport))).collect()}
    assert port[0].cum_npv_rub == Decimal("-1840000.00")
    assert port[11].cum_npv_rub == Decimal("-47757315.11")
    assert port[22].cum_npv_rub == Decimal("-1583075.08")
    assert port[23].cum_npv_rub == Decimal("2802610.74")
    assert port[36].cum_npv_rub == Decimal("56017382.33")
    be = P.breakeven_month(P.portfolio_npv(P.cashflow(P.initiative_plan(passport)))).first()
    assert (be.trough_month, be.breakeven_month) == (11, 23)


def test_portfolio_equals_sum_of_initiatives(passport):
    cash = P.cashflow(P.initiative_plan(passport))
    by_hand = cash.groupBy("month_index").agg(F.sum("discounted_rub").alias("s"))
    port = P.portfolio_npv(cash)
    bad = port.join(by_hand, "month_index").where(F.col("s") != F.col("discounted_rub"))
    assert bad.count() == 0


def test_what_if_shift_most_expensive(passport):
    w = {r.month_index: r for r in P.what_if(passport).collect()}
    assert w[11].what_if_cum_npv_rub == Decimal("-44786920.05")
    assert w[36].what_if_cum_npv_rub == Decimal("54410913.61")
    shifted = P.shift_most_expensive(passport).where("initiative_id = 'INI-07'").first()
    assert shifted.start_month == 3


def test_direction_and_latest_payback(passport):
    cost = [(r.direction, int(r.cost_rub)) for r in P.cost_by_direction(passport).collect()]
    assert cost == [("Данные", 17300000), ("Бизнес", 12800000), ("Кредиты", 12600000),
                    ("Карты", 11000000), ("Обслуживание", 10000000)]
    top = [r.initiative_id for r in P.latest_payback(passport, 3).collect()]
    assert top == ["INI-07", "INI-03", "INI-08"]          # 30, then 25-ties by id
    ties = sorted(r.initiative_id for r in P.latest_payback(passport, 3, with_ties=True).collect())
    assert ties == ["INI-03", "INI-07", "INI-08", "INI-09"]


def test_fact_vs_plan_has_no_lower_bound(spark, passport):
    plan = P.initiative_plan(passport)
    fact = spark.createDataFrame([("INI-06", 2, 1.0, 0.0), ("INI-06", 9, 0.0, 5.0), ("INI-99", 1, 1.0, 1.0)],
                                 "initiative_id string, month_index int, actual_cost_rub double,"
                                 " actual_profit_rub double")
    rows = {r.month_index: r for r in P.fact_vs_plan(fact, plan).collect()}
    assert set(rows) == {2, 9}                              # unknown initiative dropped
    assert rows[2].plan_cost_rub == 866666 and rows[2].plan_profit_rub == 0   # before start: still cost
    assert rows[9].plan_cost_rub == 0 and rows[9].plan_profit_rub == 390311


def test_empty_series_guard(spark):
    from stagewise.functions.temporal import month_series
    r = spark.range(1).select(month_series(F.lit(0), F.lit(-1)).alias("s"),
                              month_series(F.lit(2), F.lit(4)).alias("t")).first()
    assert r.s == [] and r.t == [2, 3, 4]


def test_edge_passports(spark):
    rows = [("Z0", "d", 0, 1000000, 0, 5),      # months_to_profit = 0
            ("Z1", "d", 0, 1000000, 6, 4),      # payback before profitability
            ("Z2", "d", 40, 1000000, 2, 5),     # starts beyond the horizon
            ("Z3", "d", 0, 1000000, 2, 5)]
    pp = spark.createDataFrame(
        [(i, i, d, s, c, mp, pb) for i, d, s, c, mp, pb in rows],
        "initiative_id string, name string, direction string, start_month int, cost_rub long,"
        " months_to_profit int, months_to_payback int").withColumn("cost_rub", F.col("cost_rub").cast("decimal(18,2)"))
    plan = {r.initiative_id: r for r in P.initiative_plan(pp).collect()}
    assert plan["Z0"].monthly_cost_rub is None and plan["Z0"].monthly_profit_rub is None
    assert plan["Z1"].monthly_profit_rub is None and plan["Z1"].monthly_cost_rub == 166666
    assert plan["Z3"].monthly_cost_rub == 500000
    curve = P.initiative_npv(P.initiative_plan(pp))
    z2 = [r.cash_flow_rub for r in curve.where("initiative_id = 'Z2'").collect()]
    assert len(z2) == 37 and set(z2) == {0}           # nothing happens inside the horizon
    be = {r.initiative_id: r.breakeven_month for r in P.breakeven_month(curve, ["initiative_id"]).collect()}
    assert be["Z3"] == 5


def test_a_whole_quotient_is_not_rounded_up(spark):
    """Spending of one month, paid back in the month after: the quotient is
    cost * 1.01, a whole number.  Doubles make it a rouble more for some."""
    import math
    doubles = lambda s, c: math.ceil((c / 1.01 ** s) / (1 / 1.01 ** (s + 1)))
    assert doubles(1, 100) == 102
    rows = [(str(c), "n", "d", s, Decimal(c), 1, 1) for c in range(100, 10_100, 100) for s in (0, 1)]
    plan = P.initiative_plan(spark.createDataFrame(
        rows, "initiative_id string, name string, direction string, start_month int, cost_rub decimal(18,2),"
              " months_to_profit int, months_to_payback int")).collect()
    assert len(plan) == 200 and all(r.monthly_profit_rub == r.cost_rub * 101 / 100 for r in plan)


def test_discount_factors_equal_spark_decimals(spark):
    step = lambda a, _: (a / F.lit(Decimal("1.01"))).cast("decimal(30,28)")
    got = [spark.range(1).select(F.aggregate(F.array([F.lit(i) for i in range(n)]), F.lit(1).cast("decimal(30,28)"), step)).first()[0]
           for n in (1, 2, 17, 36, 60)]
    want = P.discount_factors(60)
    assert got == [want[n] for n in (1, 2, 17, 36, 60)]
    assert abs(want[60] - 1 / Decimal("1.01") ** 60) < Decimal("1e-26")


def test_plan_equals_exact_fractions(spark):
    from fractions import Fraction
    import math
    import random
    rng = random.Random(6)
    rows = []
    for i in range(300):
        mp = rng.randint(1, 30)
        rows.append((str(i), "n", "d", rng.randint(0, 12), Decimal(rng.randrange(1, 10**11)) / 100, mp, mp + rng.randint(0, 60)))
    got = P.initiative_plan(spark.createDataFrame(
        rows, "initiative_id string, name string, direction string, start_month int, cost_rub decimal(18,2),"
              " months_to_profit int, months_to_payback int")).collect()
    d = [Fraction(100, 101) ** n for n in range(100)]
    for r in got:
        mp, pb, cost = r.months_to_profit, r.months_to_payback, Fraction(r.cost_rub)
        assert r.monthly_cost_rub == math.floor(cost / mp)
        assert r.monthly_profit_rub == math.ceil(cost / mp * sum(d[:mp]) / sum(d[mp:pb + 1]))
