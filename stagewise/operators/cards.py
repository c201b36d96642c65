"""Cards export cleaning and activation (C1-C5): lenient parsing as column
expressions, repeats dropped per card, activation per dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.functions.numeric import pct
from stagewise.functions.text import normalize_channel, parse_amount, parse_date, sentence_case
from stagewise.operators.relational import first_per_key

ACTIVE_WITHIN_DAYS = 30

# The export's column headers, in file order, and our names.
EXPORT_COLUMNS = {
    "ID карты": "card_id",
    "Дата выдачи": "issued",
    "Канал оформления": "channel",
    "Тарифный план": "tariff",
    "Регион": "region",
    "Кредитный лимит": "credit_limit",
    "Дата первой покупки": "first_purchase",
    "Оборот за 30 дней": "turnover_30d",
    "Оборот за 90 дней": "turnover_90d",
    "Статус": "status",
}


def from_export(df: DataFrame) -> DataFrame:
    """Rename the export's headers (read as text by ``read_text_export``) to
    the names the card operators use; unknown headers are kept as they are."""
    return df.select(*[F.col(f"`{c}`").alias(EXPORT_COLUMNS.get(c.strip(), c)) for c in df.columns])


def clean_export(df: DataFrame) -> DataFrame:
    """C4 on a raw export: headers renamed, limit and both turnovers parsed as
    amounts, both dates parsed, channel canonical, status case-folded, one
    row per card."""
    d = from_export(df)
    amounts = tuple(c for c in ("credit_limit", "turnover_30d", "turnover_90d") if c in d.columns)
    return clean_cards(d, amount_cols=amounts)


def clean_cards(df: DataFrame, card: str = "card_id", issued: str = "issued",
                channel: str = "channel", amount_cols: tuple[str, ...] = ("credit_limit",),
                date_cols: tuple[str, ...] = ("first_purchase",), status: str = "status") -> DataFrame:
    """C4: channel to canonical name (C1), amounts (C2) and dates (C3) parsed,
    status case-folded, then one row per card (earliest issue date, the whole
    row breaking ties)."""
    out = df.withColumns({
        card: F.trim(F.col(card)),
        issued: parse_date(issued),
        channel: normalize_channel(channel),
        status: sentence_case(F.trim(F.col(status))),
        **{c: parse_amount(c) for c in amount_cols},
        **{c: parse_date(c) for c in date_cols},
    })
    return first_per_key(out, card, [F.col(issued).asc_nulls_last()])


def activation_of_export(df: DataFrame, dim: str, card: str = "card_id", issued: str = "issued",
                         first_purchase: str = "first_purchase", channel: str = "channel",
                         days: int = ACTIVE_WITHIN_DAYS) -> DataFrame:
    """C5 straight from the export: only the columns it needs are parsed and
    sorted; among a card's rows of one issue date the least (dim, first
    purchase) counts."""
    cols = {card: F.trim(F.col(card)), issued: parse_date(issued),
            dim: normalize_channel(dim) if dim == channel else F.col(dim), first_purchase: parse_date(first_purchase)}
    needed = df.select(*[c.alias(n) for n, c in cols.items()])
    return activation_by(first_per_key(needed, card, [F.col(issued).asc_nulls_last()]), dim, issued, first_purchase, days)


def activation_by(cards: DataFrame, dim: str, issued: str = "issued",
                  first_purchase: str = "first_purchase", days: int = ACTIVE_WITHIN_DAYS) -> DataFrame:
    """Rows ``[dim, total, active, active %]``; a card is active when its
    first purchase falls within ``days`` days of issue (late or never: not active)."""
    gap = F.datediff(F.col(first_purchase), F.col(issued))
    return (cards.groupBy(dim).agg(F.count(F.lit(1)).alias("total"),
                                   F.count_if((gap >= 0) & (gap <= days)).alias("active"))
            .withColumn("active_pct", pct("active", "total"))
            .orderBy(F.col("total").desc(), F.col(dim)))
