"""The cards export as a file: BOM, ';', Cyrillic headers, all text."""

import tempfile

from stagewise.operators import cards
from stagewise.sources.readers import read_text_export

HEADER = "ID карты;Дата выдачи;Канал оформления;Тарифный план;Регион;Кредитный лимит;" \
         "Дата первой покупки;Оборот за 30 дней;Оборот за 90 дней;Статус"
ROWS = [
    "CARD-1;15.03.2025;ОТДЕЛЕНИЕ ;Классический;Южный;100 000;2025-03-20;12000,50;30000.00;Активна",
    "CARD-1;15.03.2025;ОТДЕЛЕНИЕ ;Классический;Южный;100 000;2025-03-20;12000,50;30000.00;Активна",
    "CARD-2;2025-03-15;МП;Зарплатный;Южный;50000,00;;0;0,00;активна",
    "CARD-3;01.02.2025;Партнерская сеть;Классический;Сибирский;75000.00;н/д;;;Закрыта",
    "CARD-4;01.02.2025;Веб-сайт;Премиальный;Сибирский;300 000;10.04.2025;0;1 500,00;Заблокирована",
    "CARD-5;31.01.2025;Мобильный банк;Зарплатный;Центральный;200 000;02.03.2025;5 000;9 000;Активна",
]


def test_export_to_activation(spark):
    d = tempfile.mkdtemp(prefix="stagewise-cards-")
    with open(f"{d}/cards.csv", "w", encoding="utf-8-sig") as f:
        f.write("\n".join([HEADER] + ROWS) + "\n")
    raw = read_text_export(spark, f"{d}/cards.csv")
    assert raw.count() == 6 and all(t == "string" for _, t in raw.dtypes)
    clean = cards.clean_export(raw)
    assert clean.count() == 5
    r = {x.card_id: x for x in clean.collect()}
    assert r["CARD-1"].channel == "Отделение" and r["CARD-1"].credit_limit == 100000.0
    assert r["CARD-1"].turnover_30d == 12000.5 and r["CARD-4"].turnover_90d == 1500.0
    assert r["CARD-2"].first_purchase is None and r["CARD-3"].first_purchase is None
    assert r["CARD-2"].status == "Активна"
    act = {x.channel: (x.total, x.active) for x in cards.activation_by(clean, "channel").collect()}
    # CARD-5: 30 days after issue counts as active; CARD-4: 68 days is late
    assert act == {"Отделение": (1, 1), "Мобильное приложение": (2, 1), "Партнёрская сеть": (1, 0),
                   "Сайт банка": (1, 0)}
