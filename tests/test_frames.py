"""Chart frames (V1)."""

import pytest

from stagewise.operators.frames import chart_frame


def test_missing_column_lists_available(spark):
    df = spark.createDataFrame([(1, 2.0)], "m int, v double")
    with pytest.raises(ValueError, match="available: m, v"):
        chart_frame(df, "m", "nope")
    with pytest.raises(ValueError, match="no column 'grp'"):
        chart_frame(df, "m", "v", series="grp")


def test_empty_result_raises(spark):
    df = spark.createDataFrame([(1, 2.0)], "m int, v double").where("false")
    with pytest.raises(ValueError, match="no rows"):
        chart_frame(df, "m", "v", check_empty=True)


def test_scaling_and_order(spark):
    df = spark.createDataFrame([(2, "b", 3_000_000.0), (1, "b", -1_500_000.0), (1, "a", 10.0)],
                               "m int, s string, v double")
    out = [(r.x, r.series, r.y, r.unit) for r in chart_frame(df, "m", "v", series="s").collect()]
    assert out == [(1, "a", 1e-5, "mln"), (1, "b", -1.5, "mln"), (2, "b", 3.0, "mln")]
    small = spark.createDataFrame([(1, 5.0)], "m int, v double")
    assert chart_frame(small, "m", "v").first().unit == ""
