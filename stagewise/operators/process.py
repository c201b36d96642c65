"""Process analytics over the clean layer.

Percentiles are exact with linear interpolation (as ``percentile_cont``) and
hold no group in one task (``operators.quantiles``)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.functions.numeric import pct, round_half_up
from stagewise.functions.temporal import month_label
from stagewise.operators import quantiles as Q
from stagewise.operators.quality import clean_predicate
from stagewise.operators.quantiles import grouped_quantiles
from stagewise.operators.relational import bucket, first_per_key, with_share


def _sla(df: DataFrame, keys: Sequence[str], hours: str, n_name: str) -> DataFrame:
    g = grouped_quantiles(df, keys, hours, {"_med": 0.5, "_p90": 0.9}, [Q.n_rows().alias(n_name)])
    return g.select(*keys, n_name, round_half_up(F.col("_med"), 1).alias("median_hours"),
                    round_half_up(F.col("_p90"), 1).alias("p90_hours"))


def funnel(events: DataFrame, apps: DataFrame, key: str = "application_id",
           stage: str = "stage") -> DataFrame:
    """Per stage, distinct applications that completed it and their share
    of all clean applications.  The distinct count is planned by (stage, key)
    first, so a crowded stage is spread over many tasks."""
    reached = events.groupBy(stage).agg(F.countDistinct(key).alias("reached"))
    total = apps.agg(F.count(F.lit(1)).alias("_total"))
    return (reached.crossJoin(F.broadcast(total))
            .select(stage, "reached", pct("reached", "_total").alias("share_pct"))
            .orderBy(F.col("reached").desc(), F.col(stage)))


def funnel_of_raw(events: DataFrame, apps: DataFrame, key: str = "application_id", stage: str = "stage",
                  start: str = "entered_at", end: str = "left_at", flag: str = "is_test",
                  client: str = "client_id", technical: str = "CL-TEST") -> DataFrame:
    """R1 straight from the raw tables, each read once: rows are tagged,
    unioned and grouped by key; a clean key then counts once for every stage
    it completed and once for the total."""
    valid = events.where(F.col(end) > F.col(start))
    none = F.lit(None).cast(events.schema[stage].dataType)
    tagged = (apps.where(clean_predicate(flag, client, technical)).select(
        F.col(key), F.lit(1).alias("_c"), F.lit(0).alias("_e"), none.alias(stage)).unionByName(
        valid.where(F.col(key).isNotNull()).select(F.col(key), F.lit(0).alias("_c"), F.lit(1).alias("_e"), F.col(stage))))
    # one row per key and stage in the map tasks already; a key's set of stages is small
    per_key = (tagged.groupBy(key).agg(F.max("_c").alias("_c"), F.collect_set(F.when(F.col("_e") == 1, F.struct(stage)))
                                       .alias("_s")).where(F.col("_c") == 1))
    counted = (per_key.select(F.explode(F.concat(F.transform("_s", lambda x: F.struct(F.lit(False).alias("all"), x.alias("s"))),
                                                 F.array(F.struct(F.lit(True).alias("all"), F.struct(none.alias(stage)).alias("s")))))
                              .alias("_x"))
               .groupBy("_x.all", f"_x.s.{stage}").agg(F.count(F.lit(1)).alias("reached")))
    total = counted.where("all").select(F.col("reached").alias("_total"))
    return (counted.where("not all").crossJoin(F.broadcast(total))          # one row
            .select(stage, "reached", pct("reached", "_total").alias("share_pct"))
            .orderBy(F.col("reached").desc(), F.col(stage)))


def stage_sla(events: DataFrame, stage: str = "stage", hours: str = "hours") -> DataFrame:
    """R2: per stage — events, median and P90 hours (1 decimal)."""
    return (_sla(events, [stage], hours, "events")
            .orderBy(F.col("median_hours").desc_nulls_first(), F.col(stage)))


def stage_sla_by(events: DataFrame, apps: DataFrame | None, dim: str, stage_value: str | None = None,
                 key: str = "application_id", stage: str = "stage", hours: str = "hours") -> DataFrame:
    """The same measures by an application attribute, optionally for one
    stage (the stage filter is applied before the join)."""
    ev = events if stage_value is None else events.where(F.col(stage) == stage_value)
    joined = ev if apps is None else ev.select(key, hours).join(apps.select(key, dim), key)
    return (_sla(joined, [dim], hours, "events")
            .orderBy(F.col("median_hours").desc_nulls_first(), F.col(dim)))


def channel_stage_sla(events: DataFrame, apps: DataFrame | None, dim: str = "channel",
                      key: str = "application_id", stage: str = "stage", hours: str = "hours") -> DataFrame:
    """The published panel — dim × stage: applications (= events), median
    and P90 hours.  Pass ``apps=None`` when ``events`` already carry ``dim``
    (``clean_stage_events(..., attach=(dim,))``)."""
    joined = events if apps is None else events.select(key, stage, hours).join(apps.select(key, dim), key)
    return _sla(joined, [dim, stage], hours, "applications")


def rejection_reasons(decisions: DataFrame, apps: DataFrame, key: str = "application_id",
                      decision: str = "decision", rejected: str = "Отказ",
                      reason: str = "reason") -> DataFrame:
    """Rejections of clean applications by reason, with the share of all
    rejections.  Clean applications are unique per key, so the inner join of
    the reference is a semi join here (no columns carried, no fan-out)."""
    rej = decisions.where(F.col(decision) == rejected).join(apps.select(key), key, "left_semi")
    counts = rej.groupBy(reason).agg(F.count(F.lit(1)).alias("applications"))
    return with_share(counts, "applications").orderBy(F.col("applications").desc(), F.col(reason))


def monthly_dynamics(apps: DataFrame, decisions: DataFrame, key: str = "application_id",
                     ts: str = "submitted_at", decision: str = "decision",
                     approved: str = "Одобрено") -> DataFrame:
    """Per month — applications and approved % (undecided applications
    stay in the denominator).  The last month may be partial."""
    joined = (apps.select(key, month_label(ts).alias("year_month"))
              .join(decisions.select(key, decision), key, "left"))
    return (joined.groupBy("year_month").agg(
        F.count(F.lit(1)).alias("applications"),
        pct(F.count_if(F.col(decision) == approved), F.count(F.lit(1))).alias("approved_pct"))
        .orderBy("year_month"))


def distribution_summary(df: DataFrame, x: str) -> DataFrame:
    """Mean, median, P90, max, n and the mean − median gap (1 decimal)."""
    g = grouped_quantiles(df, [], x, {"_med": 0.5, "_p90": 0.9},
                          [Q.mean().alias("_mean"), Q.maximum().alias("_max"), Q.n_values().alias("n")])
    return g.select(round_half_up(F.col("_mean"), 1).alias("mean"),
                    round_half_up(F.col("_med"), 1).alias("median"),
                    round_half_up(F.col("_p90"), 1).alias("p90"),
                    round_half_up(F.col("_max"), 1).alias("max_value"), "n",
                    round_half_up(F.col("_mean") - F.col("_med"), 1).alias("mean_minus_median"))


def histogram(df: DataFrame, x: str, bins: int = 45) -> DataFrame:
    """Equal-width bins from min to max, last edge closed, empty bins
    included; edges are not rounded, NULL and NaN are in no bin.  The bounds
    are a one-row subquery; the counting pass groups into ≤ ``bins`` groups.
    Without values there is no bin."""
    v = F.col(x).cast("double")
    known = df.where(v.isNotNull() & ~F.isnan(v))
    spark = df.sparkSession
    lo, hi = known.agg(F.min(v)).scalar(), known.agg(F.max(v)).scalar()
    idx = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor((v - lo) / (hi - lo) * F.lit(float(bins))) + 1, F.lit(bins))).cast("int")
    counts = known.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / F.lit(float(bins))
    return (spine.join(counts, "bin", "left").where(lo.isNotNull())
            .select("bin", (lo + width * (F.col("bin") - 1)).alias("bin_lo"),
                    (lo + width * F.col("bin")).alias("bin_hi"), F.coalesce("n", F.lit(0)).alias("n"))
            .orderBy("bin"))


def box_stats(df: DataFrame, group: str, x: str, k: float = 1.5) -> DataFrame:
    """Box-plot numbers per group: quartiles and whiskers (the most extreme
    values inside ``k``·IQR of the box), groups ordered by median.  The counted
    values behind the quartiles, not rows, are joined with their group's."""
    q = grouped_quantiles(df, [group], x, {"_q1": 0.25, "_med": 0.5, "_q3": 0.75}, [Q.n_values().alias("n")])
    iqr = F.col("_q3") - F.col("_q1")
    values = Q.counted(df, [group], x).select(F.col("_k").alias("_g"), "_x")
    w = (values.join(q.withColumn("_k", F.struct(group)), F.col("_g") == F.col("_k"))
         .groupBy("_g", "n", "_q1", "_med", "_q3").agg(
             F.min(F.when(F.col("_x") >= F.col("_q1") - F.lit(k) * iqr, F.col("_x"))).alias("_wlo"),
             F.max(F.when(F.col("_x") <= F.col("_q3") + F.lit(k) * iqr, F.col("_x"))).alias("_whi"))
         .withColumn(group, F.col("_g")[group]))
    return w.select(group, "n", *[round_half_up(F.col(c), 1).alias(a) for c, a in
                                  [("_q1", "q1"), ("_med", "median"), ("_q3", "q3"),
                                   ("_wlo", "whisker_lo"), ("_whi", "whisker_hi")]]
                    ).orderBy(F.col("median").asc_nulls_last(), F.col(group))


def iqr_outliers(df: DataFrame, x: str, k: float = 1.5) -> DataFrame:
    """Upper fence ``q3 + k·IQR`` (1 decimal) and the number of values
    strictly above it.  The quartiles are one row, joined to the counted values."""
    q = grouped_quantiles(df, [], x, {"_q1": 0.25, "_q3": 0.75})
    fence = q.select((F.col("_q3") + F.lit(k) * (F.col("_q3") - F.col("_q1"))).alias("_fence"))
    return (Q.counted(df, [], x).crossJoin(F.broadcast(fence))               # one row
            .agg(F.coalesce(F.sum(F.when(F.col("_x") > F.col("_fence"), F.col("_n"))), F.lit(0)).alias("outliers"),
                 F.max("_fence").alias("_fence"))
            .select("outliers", round_half_up(F.col("_fence"), 1).alias("threshold")))


def first_rows_per_group(df: DataFrame, group: str, ts: str) -> DataFrame:
    """Each group with the time of its first row (``row_number() = 1``)."""
    return first_per_key(df.select(group, ts), group, [F.col(ts).asc_nulls_last()])


def first_per_group_count(df: DataFrame, group: str, ts: str) -> DataFrame:
    """Number of first rows per group (``row_number() = 1``)."""
    return first_per_key(df.select(group, ts), group, [F.col(ts).asc_nulls_last()]).agg(
        F.count(F.lit(1)).alias("first_rows"))


def bucket_counts(df: DataFrame, x: str, edges: Sequence[float], labels: Sequence[str],
                  name: str = "bucket") -> DataFrame:
    """Counts per half-open bucket, ordered by label."""
    return (df.groupBy(bucket(F.col(x), edges, labels).alias(name))
            .agg(F.count(F.lit(1)).alias("n_rows")).orderBy(name))
