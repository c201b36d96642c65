"""The clean layer (Q10, Q11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.functions.temporal import hours_between
from stagewise.operators.quality import clean_predicate
from stagewise.operators.relational import first_per_key


def clean_applications(df: DataFrame, key: str = "application_id", ts: str = "submitted_at",
                       flag: str = "is_test", client: str = "client_id",
                       technical: str = "CL-TEST") -> DataFrame:
    """Q10: drop service records (F3), then keep the earliest row per key.
    The flag column is dropped.  Ties on the timestamp are broken by the whole
    row, so the result is deterministic."""
    kept = df.where(clean_predicate(flag, client, technical)).drop(flag)
    return first_per_key(kept, key, [F.col(ts).asc_nulls_last()])


def clean_keys(df: DataFrame, key: str = "application_id", flag: str = "is_test",
               client: str = "client_id", technical: str = "CL-TEST") -> DataFrame:
    """The keys of ``clean_applications`` without building its rows: a key is
    clean iff some row of it passes F3 (the earliest-row choice does not change
    membership).  A distinct aggregation — no whole-row sort — and the same
    count as the clean layer (a NULL key, if any, is one group there too)."""
    return df.where(clean_predicate(flag, client, technical)).select(key).distinct()


def clean_stage_events(events: DataFrame, clean_apps: DataFrame, key: str = "application_id",
                       start: str = "entered_at", end: str = "left_at",
                       attach: tuple[str, ...] = ()) -> DataFrame:
    """Q11: events of clean applications (semi join), closed and forward in
    time, with their duration in hours.

    ``attach`` names application columns (e.g. the channel) to carry along:
    clean applications are unique per key, so the membership test and the
    attribute lookup become one inner join instead of a semi join followed by
    a second join against the same clean layer."""
    ev = events.where(F.col(end).isNotNull() & (F.col(end) > F.col(start)))
    if attach:
        ev = ev.join(clean_apps.select(key, *attach), key)
    else:
        ev = ev.join(clean_apps.select(key), key, "left_semi")
    return ev.withColumn("hours", hours_between(start, end))
