"""Lenient parsing and activation of the cards export."""

import datetime as dt


from stagewise.functions.text import CHANNEL_ALIASES, normalize_channel, parse_amount, parse_date
from stagewise.operators import cards


def _one(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r.x for r in df.select(fn("v").alias("x")).collect()]


def test_channel_aliases(spark):
    got = _one(spark, ["ОТДЕЛЕНИЕ ", "Партнерская сеть", "МП", "Веб-сайт", "Офис банка",
                       "партнёрская сеть", "Неизвестный "], normalize_channel)
    assert got == ["Отделение", "Партнёрская сеть", "Мобильное приложение", "Сайт банка",
                   "Отделение", "Партнёрская сеть", "Неизвестный"]
    assert set(CHANNEL_ALIASES.values()) == {"Отделение", "Мобильное приложение", "Сайт банка",
                                             "Партнёрская сеть"}


def test_amounts(spark):
    got = _one(spark, ["12 000", "12000,50", "12000.5", "", "н/д", "12 000", "0", "0,00", None],
               parse_amount)
    assert got == [12000.0, 12000.5, 12000.5, None, None, 12000.0, 0.0, 0.0, None]


def test_dates(spark):
    got = _one(spark, ["15.03.2025", "2025-03-15", "", "31.02.2025", "н/д", " 01.12.2024 "], parse_date)
    assert got == [dt.date(2025, 3, 15), dt.date(2025, 3, 15), None, None, None, dt.date(2024, 12, 1)]


def test_clean_and_activation(spark):
    rows = [
        ("1", "10.01.2025", "МП", "A", "50 000", "15.01.2025", "Активна"),
        ("1", "2025-01-10", "мобильное приложение", "A", "50000,00", "2025-01-15", "активна"),  # repeat
        ("2", "10.01.2025", "ОТДЕЛЕНИЕ", "A", "н/д", "", "Закрыта"),                              # never used
        ("3", "10.01.2025", "Партнёр", "B", "1000", "20.02.2025", "Активна"),                     # late
        ("4", "10.01.2025", "Партнерская сеть", "B", "1000", "09.02.2025", "активна"),             # day 30
    ]
    df = spark.createDataFrame(rows, "card_id string, issued string, channel string, tariff string,"
                                     " credit_limit string, first_purchase string, status string")
    clean = cards.clean_cards(df)
    assert clean.count() == 4
    assert {r.status for r in clean.collect()} == {"Активна", "Закрыта"}
    act = {r.channel: (r.total, r.active, r.active_pct) for r in cards.activation_by(clean, "channel").collect()}
    assert act == {"Мобильное приложение": (1, 1, 100.0), "Отделение": (1, 0, 0.0),
                   "Партнёрская сеть": (2, 1, 50.0)}
