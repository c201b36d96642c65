"""Property-based checks (hypothesis): parsing round trips, first row per key
against pandas, split exact quantiles against numpy."""

import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stagewise.functions.text import parse_amount, parse_date
from stagewise.operators.quantiles import grouped_quantiles
from stagewise.operators.relational import first_per_key

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _spaced(units: int) -> str:
    s = f"{units:,}".replace(",", " ")
    return s.replace(" ", " ", 1) if units % 2 else s


@settings(**SETTINGS)
@given(st.lists(st.integers(min_value=0, max_value=10**11), min_size=1, max_size=60))
def test_amount_styles_round_trip(spark, cents):
    texts, want = [], []
    for c in cents:
        units, frac = divmod(c, 100)
        texts += [_spaced(units), f"{units},{frac:02d}", f"{units}.{frac:02d}", "н/д", ""]
        want += [float(units), float(f"{units}.{frac:02d}"), float(f"{units}.{frac:02d}"), None, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.x for r in df.select("i", parse_amount("t").alias("x")).orderBy("i").collect()]
    assert got == want


@settings(**SETTINGS)
@given(st.lists(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31)), min_size=1, max_size=60))
def test_date_styles_round_trip(spark, days):
    texts, want = [], []
    for d in days:
        texts += [d.strftime("%d.%m.%Y"), d.isoformat(), f" {d.strftime('%d.%m.%Y')} "]
        want += [d, d, d]
    texts += ["31.02.2025", "2025-13-01", "н/д", "", "15/03/2025"]
    want += [None] * 5
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.x for r in df.select("i", parse_date("t").alias("x")).orderBy("i").collect()]
    assert got == want


rows_strategy = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 5)),              # key (NULL allowed)
              st.one_of(st.none(), st.integers(0, 3)),              # time (NULL allowed, ties)
              st.integers(0, 2), st.one_of(st.none(), st.text("ab", max_size=2))),
    min_size=1, max_size=40)


def _order(r):
    """The operator's total order: time (NULL last), then v, s (NULL last)."""
    t, v, x = r[1], r[2], r[3]
    return ((t is None, t or 0), (v is None, v or 0), (x is None, x or ""))


@settings(**SETTINGS)
@given(rows_strategy)
def test_first_per_key_matches_pandas(spark, rows):
    df = spark.createDataFrame(rows, "k int, t int, v int, s string")
    got = [tuple(r) for r in first_per_key(df, "k", [F.col("t").asc_nulls_last()]).collect()]
    pdf = pd.DataFrame({"k": [r[0] for r in rows], "o": [_order(r) for r in rows], "r": rows})
    want = [r for r in pdf.sort_values("o", kind="stable").drop_duplicates("k", keep="first")["r"]]
    full = lambda r: ((r[0] is None, r[0] or 0), _order(r))
    assert sorted(got, key=full) == sorted(want, key=full)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.floats(-1e12, 1e12)), min_size=1, max_size=200))
def test_quantiles_match_numpy(spark, rows):
    df = spark.createDataFrame([(g, float(x)) for g, x in rows], "g string, x double")
    ps = [0.0, 0.3, 0.5, 0.9, 1.0]
    got = {r.g: [r[f"q{i}"] for i in range(len(ps))]
           for r in grouped_quantiles(df, ["g"], "x", {f"q{i}": p for i, p in enumerate(ps)}).collect()}
    for g in {g for g, _ in rows}:
        xs = np.array([x for gg, x in rows if gg == g], dtype=float)
        assert np.allclose(got[g], np.quantile(xs, ps), rtol=1e-12, atol=1e-9), (g, got[g])
