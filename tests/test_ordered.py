"""Row numbers, running sums and comparison in order, over tasks."""

import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stagewise.operators import ordered, reconcile, relational

SCHEMA = "k string, o int, v decimal(18,2), x string"


@pytest.fixture(scope="module")
def rows():
    """A key holding a third of the rows, ties in the order, NULL keys, orders
    and values, a key without a value."""
    rng = random.Random(8)
    keys = ["hot"] * 5 + list("abcdefghi") + [None]
    out = [(rng.choice(keys), rng.choice([None, *range(60)]), None if rng.random() < .1 else Decimal(rng.randrange(-999, 999)) / 100,
            "x") for _ in range(3000)]
    return out + [("none", i, None, "x") for i in range(3)] + [("hot", 30, Decimal("1.00"), "x")] * 500


def _range_sums(rows, keyed):
    """SUM() OVER (PARTITION BY k ORDER BY o) by pandas: peers share the sum."""
    df = pd.DataFrame([(r[0] if keyed else 0, 10**9 if r[1] is None else r[1], r[2]) for r in rows], columns=list("kov"))
    out = {}
    for k, g in df.groupby("k", dropna=False):
        total, any_value = Decimal(0), False
        for o, peers in g.groupby("o"):
            known = [v for v in peers["v"] if v is not None]
            total, any_value = total + sum(known, Decimal(0)), any_value or bool(known)
            out[(None if pd.isna(k) else k) if keyed else 0, None if o == 10**9 else o] = total if any_value else None
    return out


@pytest.mark.parametrize("keyed", [True, False])
def test_running_sums_are_the_range_frame(spark, rows, keyed):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    keys = ["k"] if keyed else []
    got = ordered.running_sums(df, "o", {"v": "cum"}, keys).collect()
    assert {((r.k if keyed else 0), r.o): r.cum for r in got} == _range_sums(rows, keyed)
    assert len(got) == len({(r[0] if keyed else 0, r[1]) for r in rows})


def test_every_row_gets_its_peers_sum(spark, rows):
    got = ordered.with_running_sum(spark.createDataFrame(rows, SCHEMA), "o", "v", "cum", ["k"]).collect()
    want = _range_sums(rows, True)
    assert len(got) == len(rows) and all(r.cum == want[r.k, r.o] for r in got)


def test_a_hot_key_is_spread_and_no_window_has_one_partition(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").alias("o"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # few rows would be one partition
    try:
        ranged = ordered._ranged(df, [F.col("k"), F.col("o")])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in ranged.groupBy("_part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 20_000 / 2
    for keys in ([], ["k"]):
        got = ordered.running_sums(df, "o", {"v": "n"}, keys)
        assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.where("n != o + 1").isEmpty() and got.count() == 20_000


def test_empty_inputs(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert ordered.running_sums(none, "o", {"v": "cum"}, ["k"]).count() == 0
    assert ordered.running_sums(none, "o", {"v": "cum"}).count() == 0
    assert ordered.row_index(none, [F.col("o")]).count() == 0
    assert reconcile.reconcile_ordered(none, none, ["o"]).isEmpty()


def test_row_index_is_gapless_and_ordered(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = ordered.row_index(df, [F.col("o").desc_nulls_last(), F.col("v").asc_nulls_first()]).orderBy("row_index").collect()
    assert [r.row_index for r in got] == list(range(len(rows)))
    order = [(-10**9 if r.o is None else r.o) for r in got]
    assert order == sorted(order, reverse=True)
    plain = lambda v: None if v is None else float(v)
    assert sorted(map(str, [(r.k, r.o, plain(r.v), r.x) for r in got])) == sorted(map(str, [(k, o, plain(v), x) for k, o, v, x in rows]))


def test_equal_rows_are_spread(spark):
    same = spark.range(10_000).select(F.lit(1).alias("o"))
    got = ordered.row_index(same, [F.col("o")])
    assert got.agg(F.countDistinct("row_index"), F.max("row_index")).first() == (10_000, 9_999)


def test_moved_rows_differ_in_order_only(spark):
    a = spark.createDataFrame([(i, f"t{i % 3}") for i in range(50)], "k int, t string")
    b = a.select("k", F.concat(F.lit(" "), "t").alias("t"))
    assert reconcile.reconcile(a, b).isEmpty()
    assert reconcile.reconcile_ordered(a, b, ["k"]).isEmpty()
    swapped = [F.when(F.col("k") == 10, 11).when(F.col("k") == 11, 10).otherwise(F.col("k")).asc()]
    diff = reconcile.reconcile_ordered(a, b, ["k"], swapped)
    got = [tuple(r) for r in diff.orderBy("row_index").collect()]
    assert got == [(10, "differs", "c0,c1", "10", "11", "t1", "t2"), (11, "differs", "c0,c1", "11", "10", "t2", "t1")]
    assert reconcile.first_differences(reconcile.reconcile_ordered(a, b, ["k"], [F.col("k").desc()]), 10).count() == 10


def test_ties_and_lengths(spark):
    a = spark.createDataFrame([(1, 5.0001), (1, 7.0), (2, None)], "o int, v double")
    b = spark.createDataFrame([(1, 7.0), (1, 5.0), (2, None), (3, 1.0)], "o int, v double")
    diff = reconcile.reconcile_ordered(a, b, ["o"]).collect()              # ties follow the values, rounded
    assert [(r.row_index, r.side, r.diff_columns, r.l0, r.r0) for r in diff] == [(3, "right_only", "", None, "3")]
    assert reconcile.reconcile_ordered(a, b.select("o"), ["o"]).first().side == "shape"


def test_repeat_flags_with_copies_and_hot_key(spark):
    rng = random.Random(1)
    rows = [("hot", rng.randrange(40), "x") for _ in range(900)] + [("same", 1, "y")] * 2500 + [(None, None, None)] * 3
    rows += [(f"k{i}", i, "z") for i in range(300)]
    got = relational.flag_repeats(spark.createDataFrame(rows, "k string, t int, s string"), "k",
                                  [F.col("t").asc_nulls_last()], chunk=100).collect()
    assert sorted(map(str, [(r.k, r.t, r.s) for r in got])) == sorted(map(str, rows))
    firsts = [(r.k, r.t) for r in got if not r.is_repeat]
    assert len(firsts) == 303 and ("hot", 0) in firsts and ("same", 1) in firsts and (None, None) in firsts


def test_repeat_flags_move_all_rows_once(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    plan = relational.flag_repeats(df, "k", [F.col("t").asc()])._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(_row" in line]
    assert "WindowGroupLimit" in plan and all("_first" in line or "_row" in line for line in wide)
