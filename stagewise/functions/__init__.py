"""Column expressions.  All are built-in Spark expressions (whole-stage codegen,
no Python UDF), so they can be used inside any select/agg."""

from stagewise.functions.numeric import round_half_up, pct, scale_unit, as_money
from stagewise.functions.temporal import hours_between, month_label, day, month_series
from stagewise.functions.text import (
    normalize_text, normalize_channel, parse_amount, parse_date, CHANNEL_ALIASES,
)

__all__ = [
    "round_half_up", "pct", "scale_unit", "as_money",
    "hours_between", "month_label", "day", "month_series",
    "normalize_text", "normalize_channel", "parse_amount", "parse_date", "CHANNEL_ALIASES",
]
