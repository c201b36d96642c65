"""Data-quality reports (Q1-Q9).  Each returns a small DataFrame; the scans,
joins and aggregations behind it run distributed in one or two passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.functions.numeric import pct
from stagewise.functions.temporal import day


def _n(name: str = "n_rows") -> Column:
    return F.count(F.lit(1)).alias(name)


def test_predicate(flag: str = "is_test", client: str = "client_id", technical: str = "CL-TEST") -> Column:
    """service record — flagged OR technical client (NULL-tolerant OR)."""
    return F.col(flag) | (F.col(client) == technical)


def clean_predicate(flag: str = "is_test", client: str = "client_id", technical: str = "CL-TEST") -> Column:
    """``NOT is_test AND client_id <> 'CL-TEST'`` in three-valued logic: a
    NULL flag or NULL client drops the row (deliberately no coalesce)."""
    return ~F.col(flag) & (F.col(client) != technical)


def overview(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Q1 / A1: rows, distinct keys, first and last day."""
    return df.agg(_n("n_rows"), F.countDistinct(key).alias("n_keys"),
                  day(F.min(ts)).alias("first_day"), day(F.max(ts)).alias("last_day"))


def missing_report(df: DataFrame, cols: list[str], names: dict[str, str] | None = None) -> DataFrame:
    """Q2 / A4: total rows and NULL count per column, one scan (FILTER clauses)."""
    names = names or {}
    return df.agg(_n("n_rows"), *[F.count_if(F.col(c).isNull()).alias(names.get(c, f"missing_{c}"))
                                for c in cols])


def repeat_summary(df: DataFrame, key: str) -> DataFrame:
    """Q3 / A3: rows, distinct keys, excess rows = rows - distinct keys."""
    return (df.agg(_n("n_rows"), F.countDistinct(key).alias("n_keys"))
            .withColumn("excess", F.col("n_rows") - F.col("n_keys")))


def repeat_list(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """Keys with more than one row, most repeated first (top-n report)."""
    return (df.groupBy(key).agg(_n("n_rows")).where(F.col("n_rows") > 1)
            .orderBy(F.col("n_rows").desc(), F.col(key).asc_nulls_last()).limit(n))


def service_records(df: DataFrame, key: str = "application_id", flag: str = "is_test",
                    client: str = "client_id", technical: str = "CL-TEST") -> DataFrame:
    """Q4 / A5: flagged rows, technical-client rows, distinct keys to drop."""
    return df.agg(F.count_if(F.col(flag)).alias("flagged"),
                  F.count_if(F.col(client) == technical).alias("technical_client"),
                  F.countDistinct(F.when(test_predicate(flag, client, technical), F.col(key)))
                  .alias("keys_to_drop"))


def interval_check(df: DataFrame, start: str, end: str) -> DataFrame:
    """Total, end before start, end missing, usable (end after start).
    An end equal to the start falls in none of the buckets."""
    s, e = F.col(start), F.col(end)
    return df.agg(_n("total"), F.count_if(e < s).alias("time_reversed"),
                  F.count_if(e.isNull()).alias("not_closed"), F.count_if(e > s).alias("usable"))


def _tagged_keys(left: DataFrame, right: DataFrame, key: str, keep_null: bool = False) -> DataFrame:
    """Distinct keys of both sides with side flags — one shuffle for both.
    A NULL key never matches (as in an equality join); with ``keep_null`` a
    left NULL key stays as one unmatched key (as ``SELECT DISTINCT`` keeps it)."""
    both = (left.select(F.col(key), F.lit(1).alias("_l"), F.lit(0).alias("_r"))
            .unionByName(right.where(F.col(key).isNotNull())
                         .select(F.col(key), F.lit(0).alias("_l"), F.lit(1).alias("_r"))))
    if not keep_null:
        both = both.where(F.col(key).isNotNull())
    return both.groupBy(key).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))


def source_gap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct left keys (a NULL key counts once, unmatched), with a
    match on the right, without one."""
    k = _tagged_keys(left, right, key, keep_null=True).where(F.col("_l") == 1)
    return k.agg(_n("n_keys"), F.count_if(F.col("_r") == 1).alias("matched"),
                 F.count_if(F.col("_r") == 0).alias("unmatched"))


def keys_without_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct left keys with no right row (explicit anti join); a NULL
    key never matches, so it is listed once.  Both sides are distinct, so a
    crowded key is one row."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def defect_summary(apps: DataFrame, events: DataFrame, decisions: DataFrame,
                   key: str = "application_id", start: str = "entered_at", end: str = "left_at",
                   flag: str = "is_test", client: str = "client_id",
                   technical: str = "CL-TEST") -> DataFrame:
    """Q7: the five defect counts as labelled rows with the action taken
    (repeats/test/time-reversed are removed; open and undecided are kept with a caveat).

    Applications and decisions are tagged, unioned and grouped by key once:
    repeats, test keys and undecided keys all come out of that single shuffle
    (map-side combined, so a crowded key is one row per task)."""
    a = apps.select(F.col(key), F.lit(1).alias("_rows"),
                    test_predicate(flag, client, technical).cast("int").alias("_test"), F.lit(0).alias("_dec"))
    d = decisions.where(F.col(key).isNotNull()).select(
        F.col(key), F.lit(0).alias("_rows"), F.lit(None).cast("int").alias("_test"), F.lit(1).alias("_dec"))
    per_key = a.unionByName(d).groupBy(key).agg(
        F.sum("_rows").alias("_rows"), F.max("_test").alias("_test"), F.max("_dec").alias("_dec"))
    k = F.col(key).isNotNull()
    counts = per_key.agg(
        (F.sum("_rows") - F.count_if(k & (F.col("_rows") > 0))).alias("repeats"),
        F.count_if(k & (F.col("_test") == 1)).alias("tests"),
        # a NULL key never matches a decision: it counts once, as SELECT DISTINCT keeps it
        F.count_if((F.col("_rows") > 0) & (F.col("_dec") == 0)).alias("undecided"))
    e = events.agg(F.count_if(F.col(end) < F.col(start)).alias("reversed"),
                   F.count_if(F.col(end).isNull()).alias("open"))
    one = counts.crossJoin(e)

    def row(pos, label, n, action):
        return F.struct(F.lit(pos).alias("pos"), F.lit(label).alias("defect"),
                        F.col(n).alias("n"), F.lit(action).alias("action"))

    return one.select(F.inline(F.array(
        row(1, "row repeats", "repeats", "removed"),
        row(2, "test applications", "tests", "removed"),
        row(3, "exit before entry", "reversed", "removed"),
        row(4, "stage not closed", "open", "kept with caveat"),
        row(5, "applications without decision", "undecided", "kept with caveat"))))


def conversion_before_after(apps: DataFrame, disb: DataFrame, key: str = "application_id",
                            flag: str = "is_test", client: str = "client_id",
                            technical: str = "CL-TEST") -> DataFrame:
    """Conversion as-is (rows/rows) and after cleaning (distinct
    disbursed clean keys / distinct clean keys), both in % with 1 decimal.

    One pass: applications and disbursements are tagged, unioned and grouped
    by key once; both conversions come from that grouping."""
    a = apps.select(F.col(key), F.lit(1).alias("_a"), F.lit(0).alias("_d"),
                    clean_predicate(flag, client, technical).cast("int").alias("_c"))
    d = disb.select(F.col(key), F.lit(0).alias("_a"), F.lit(1).alias("_d"), F.lit(None).cast("int").alias("_c"))
    per_key = a.unionByName(d).groupBy(key).agg(
        F.sum("_a").alias("_a"), F.sum("_d").alias("_d"), F.max("_c").alias("_c"))
    clean = F.col(key).isNotNull() & (F.col("_c") == 1)
    t = per_key.agg(F.sum("_a").alias("_apps"), F.sum("_d").alias("_disb"),
                    F.count_if(clean).alias("_clean"), F.count_if(clean & (F.col("_d") > 0)).alias("_conv"))
    return t.select(pct("_disb", "_apps").alias("as_is_pct"), pct("_conv", "_clean").alias("cleaned_pct"))


def layer_counts(apps: DataFrame, events: DataFrame, key: str = "application_id", start: str = "entered_at",
                 end: str = "left_at", flag: str = "is_test", client: str = "client_id",
                 technical: str = "CL-TEST") -> DataFrame:
    """Rows before and after each cleaning layer, one row.

    Each raw table is read once: both are tagged, unioned and grouped by key
    (counts combine in the map tasks), and all four counts come out of it."""
    usable = (F.col(end) > F.col(start)).cast("int")
    tagged = apps.select(F.col(key), F.lit(1).alias("_a"), F.lit(0).alias("_e"), F.lit(0).alias("_u"),
                         clean_predicate(flag, client, technical).cast("int").alias("_c")).unionByName(
        events.select(F.col(key), F.lit(0).alias("_a"), F.lit(1).alias("_e"),
                      F.coalesce(usable, F.lit(0)).alias("_u"), F.lit(None).cast("int").alias("_c")))
    per_key = tagged.groupBy(key).agg(*[F.sum(c).alias(c) for c in ("_a", "_e", "_u")], F.max("_c").alias("_c"))
    clean = F.col("_c") == 1
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per_key.agg(total("_a").alias("apps_raw"), F.count_if(clean).alias("apps_clean"),
                       total("_e").alias("events_raw"),
                       total(F.when(clean & F.col(key).isNotNull(), F.col("_u"))).alias("events_clean"))
