"""Lenient parsing of text exports (numbers, dates, category spellings)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from stagewise.functions._util import col_of

# ---------------------------------------------------------------------------
# Fixed values (must equal the cards export's vocabulary).
# Canonical channel names and every spelling seen in the export, keyed by the
# normalised form (trimmed, lower-case, "ё" read as "е").
CHANNEL_ALIASES = {
    "отделение": "Отделение",
    "офис банка": "Отделение",
    "мобильное приложение": "Мобильное приложение",
    "мобильный банк": "Мобильное приложение",
    "мп": "Мобильное приложение",
    "сайт банка": "Сайт банка",
    "веб-сайт": "Сайт банка",
    "партнерская сеть": "Партнёрская сеть",
    "партнер": "Партнёрская сеть",
}
# Accepted shapes, each with its parse pattern: day.month.year or ISO.
DATE_SHAPES = [(r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"), (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d")]
NUMBER_SHAPE = r"^[+-]?(\d+\.?\d*|\.\d+)$"
# ---------------------------------------------------------------------------

_SPACES = "[\\s\\u00a0\\u202f]"


def normalize_text(c) -> Column:
    """trim + lower-case + 'ё' → 'е' (comparison key for category spellings)."""
    return F.replace(F.lower(F.trim(col_of(c))), F.lit("ё"), F.lit("е"))


def normalize_channel(c, aliases: dict[str, str] | None = None) -> Column:
    """Map any spelling to its canonical name through a literal map (no join,
    stays inside codegen).  Unknown spellings are kept, trimmed."""
    table = aliases or CHANNEL_ALIASES
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(sorted(table.items()))])
    return F.coalesce(F.try_element_at(lookup, normalize_text(c)), F.trim(col_of(c)))


def parse_amount(c) -> Column:
    """'12 000' → 12000, '12000,50' / '12000.5' → 12000.5, '' / 'н/д' → NULL."""
    cleaned = F.regexp_replace(F.regexp_replace(col_of(c), _SPACES, ""), ",", ".")
    # Only number-shaped text reaches the cast: a failing cast costs a JVM
    # exception per row, and most unparsable cells are markers like 'н/д'.
    return F.when(cleaned.rlike(NUMBER_SHAPE), cleaned.try_cast("double"))


def parse_date(c) -> Column:
    """'dd.MM.yyyy' or ISO 'yyyy-MM-dd' → DATE; anything else (incl. 31.02) → NULL."""
    s = F.trim(col_of(c))
    # The shape picks the pattern, so a parse is only attempted where it can
    # succeed (a failed parse is an exception inside the JVM); impossible
    # calendar dates such as 31.02 still come out NULL.
    expr = None
    for shape, fmt in DATE_SHAPES:
        branch = F.try_to_date(s, fmt)
        expr = F.when(s.rlike(shape), branch) if expr is None else expr.when(s.rlike(shape), branch)
    return expr


def sentence_case(c) -> Column:
    """First letter upper-case, the rest lower-case."""
    x = col_of(c)
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 2147483647)))
