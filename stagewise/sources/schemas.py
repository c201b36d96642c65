"""Declared schemas of the raw exports and the portfolio tables (S3)."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _TS, _I, _L, _B = T.StringType(), T.TimestampNTZType(), T.IntegerType(), T.LongType(), T.BooleanType()
MONEY = T.DecimalType(18, 2)


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "raw_applications": _st(
        ("application_id", _S), ("client_id", _S), ("product", _S), ("channel", _S),
        ("region", _S), ("amount_requested", MONEY), ("submitted_at", _TS),
        ("source_system", _S), ("is_test", _B)),
    "raw_stage_events": _st(
        ("event_id", _L), ("application_id", _S), ("stage", _S), ("entered_at", _TS),
        ("left_at", _TS), ("actor_role", _S)),
    "raw_decisions": _st(
        ("application_id", _S), ("decision", _S), ("decided_at", _TS), ("reason", _S)),
    "raw_disbursements": _st(
        ("application_id", _S), ("disbursed_at", _TS), ("amount_disbursed", MONEY)),
    "initiative_passport": _st(
        ("initiative_id", _S), ("name", _S), ("direction", _S), ("start_month", _I),
        ("cost_rub", MONEY), ("months_to_profit", _I), ("months_to_payback", _I)),
    "initiative_fact": _st(
        ("initiative_id", _S), ("month_index", _I), ("actual_cost_rub", MONEY),
        ("actual_profit_rub", MONEY)),
}

TABLE_COMMENTS: dict[str, str] = {
    "raw_applications": "one row per exported application line; not deduplicated",
    "raw_stage_events": "one row per visit of an application to a stage; times not validated",
    "raw_decisions": "at most one decision per application",
    "raw_disbursements": "money paid out, per application",
    "initiative_passport": "planning parameters, one row per initiative",
    "initiative_fact": "booked cost and profit per initiative and month",
}


def with_comments(name: str) -> T.StructType:
    """The declared schema, each field carrying the table's comment as metadata."""
    st = SCHEMAS[name]
    return T.StructType([
        T.StructField(f.name, f.dataType, f.nullable, {"table_comment": TABLE_COMMENTS[name]})
        for f in st.fields])
