"""Run queries() against oracle_sql() the way the driver does: the Spark
result and the DuckDB result must agree on row count, column names and an
order-insensitive exact comparison of values."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark, key, builder, sql, sf_dir, con):
    t0 = time.time()
    sdf = builder(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(key=key, ok=None, rows=len(s_rows), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    info = dict(key=key, rows=len(s_rows), oracle_rows=len(d_rows), spark_s=round(t1 - t0, 2))
    if sorted(s_cols) != sorted(d_cols):
        return dict(info, ok=False, why=f"columns {sorted(s_cols)} vs {sorted(d_cols)}")
    if len(s_rows) != len(d_rows):
        return dict(info, ok=False, why="row count")
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return dict(info, ok=False, why=f"{len(bad)} rows differ, e.g. {bad[0]}")
    return dict(info, ok=True)


def compare_pandas(spark, key, builder, sql, sf_dir, con):
    """Pessimistic variant: both sides through pandas, cells compared as text."""
    if sql is None:
        return dict(key=key, ok=None)
    a = builder(spark, sf_dir).toPandas()
    b = con.execute(sql).df()
    if sorted(a.columns) != sorted(b.columns):
        return dict(key=key, ok=False, why="columns")
    cols = sorted(a.columns)
    ra = sorted(map(tuple, a[cols].astype(str).values.tolist()))
    rb = sorted(map(tuple, b[cols].astype(str).values.tolist()))
    if ra != rb:
        bad = [(x, y) for x, y in zip(ra, rb) if x != y]
        return dict(key=key, ok=False, why=f"{len(bad)} differ as text, e.g. {bad[:1]}",
                    dtypes=(dict(a.dtypes.astype(str)), dict(b.dtypes.astype(str))))
    return dict(key=key, ok=True)


def main(argv):
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from stagewise.session import get_spark
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = get_spark("local[8]")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    keys = argv or list(qs)
    fails = 0
    cmp = compare_pandas if os.environ.get("PANDAS_MODE") else compare
    for k in keys:
        try:
            r = cmp(spark, k, qs[k], sqls.get(k), sf_dir, con)
        except Exception as exc:  # noqa: BLE001
            r = dict(key=k, ok=False, why=f"{type(exc).__name__}: {str(exc)[:300]}")
        fails += r.get("ok") is False
        print(r, flush=True)
    print("FAILS", fails)


if __name__ == "__main__":
    main(sys.argv[1:])
