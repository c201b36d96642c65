"""Reconciliation of two datasets (bags and keyed)."""

from stagewise.operators.reconcile import reconcile, reconcile_verdict


def test_equal_bags_in_other_order(spark):
    a = spark.createDataFrame([(1, "x", 1.0001), (2, "y", None), (2, "y", None)], "k int, s string, v double")
    b = spark.createDataFrame([(2, " y", None), (1, "x ", 1.0004), (2, "y", None)], "id int, t string, w double")
    assert reconcile_verdict(reconcile(a, b))


def test_fourth_decimal_and_extra_row(spark):
    a = spark.createDataFrame([(1, 1.0001), (2, 2.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.0009), (2, 2.0), (3, 3.0)], "k int, v double")
    d = {(r.c0, r.side, r.copies) for r in reconcile(a, b).collect()}
    assert d == {(1.0, "left_only", 1), (1.0, "right_only", 1), (3.0, "right_only", 1)}
    keyed = {(r.c0, r.side, r.diff_columns) for r in reconcile(a, b, keys=[0]).collect()}
    assert keyed == {(1.0, "differs", "c1"), (3.0, "right_only", "")}


def test_null_equals_null_keyed(spark):
    a = spark.createDataFrame([(1, None), (None, 5.0)], "k int, v double")
    b = spark.createDataFrame([(1, None), (None, 5.0)], "k int, v double")
    assert reconcile(a, b, keys=[0]).count() == 0


def test_whole_numbers_and_decimals_are_exact(spark):
    a = spark.createDataFrame([(9007199254740993, "1.001")], "k long, v string").selectExpr("k", "cast(v as decimal(38,20)) v")
    b = spark.createDataFrame([(9007199254740992, "1.001")], "k long, v string").selectExpr("k", "cast(v as decimal(38,20)) v")
    assert reconcile(a, b).count() == 2 and reconcile(a, b, keys=[1]).count() == 1
    c = a.selectExpr("k", "cast('1.00100000000000000001' as decimal(38,20)) as v")
    assert reconcile(a, c).count() == 2


def test_repeated_keys(spark):
    a = spark.createDataFrame([(1, 10), (1, 20), (1, 30), (2, 5)], "k int, v int")
    b = spark.createDataFrame([(1, 30), (1, 10), (1, 99), (2, 5)], "k int, v int")
    assert [tuple(r) for r in reconcile(a, b, keys=[0]).collect()] == [(1, "differs", "*", 3, 3, 1, 1)]
    two = spark.createDataFrame([(1, "x"), (1, "x")], "k int, v string")
    assert [tuple(r) for r in reconcile(two, two.limit(1), keys=[0]).collect()] == [(1, "differs", "*", 2, 1, 1, 0)]


def test_text_against_number_and_shape(spark):
    a = spark.createDataFrame([(1, "5")], "k int, v string")
    b = spark.createDataFrame([(1, 5)], "k int, v int")
    assert reconcile_verdict(reconcile(a, b))
    shape = reconcile(a, b.select("k"))
    assert not reconcile_verdict(shape) and shape.first().side == "shape"
