"""The reference's own data model end to end: declared CSV loads → the eight
views → SQL text with back-quoted Cyrillic aliases."""

import tempfile

import pytest

from stagewise.plans.views import register_views
from stagewise.sources import readers

APPS = """application_id,client_id,product,channel,region,amount_requested,submitted_at,source_system,is_test
APP-1,CL-1,Автокредит,Отделение,Южный,1500000.00,2025-01-06 09:00:00,АБС,false
APP-1,CL-1,Автокредит,Отделение,Южный,1500000.00,2025-01-06 09:00:00,АБС,false
APP-2,CL-2,Кредитная карта,Мобильное приложение,Южный,150000.00,2025-01-07 10:00:00,CRM,false
APP-3,CL-TEST,Автокредит,Отделение,Южный,300000.00,2025-01-07 11:00:00,CRM,false
APP-4,CL-4,Кредит для бизнеса,Партнёрская сеть,Сибирский,5000000.00,2025-02-03 12:00:00,АБС,true
APP-5,CL-5,Автокредит,Партнёрская сеть,Сибирский,2500000.00,2025-02-04 08:00:00,АБС,false
"""
EVENTS = """event_id,application_id,stage,entered_at,left_at,actor_role
1,APP-1,Приём заявки,2025-01-06 09:00:00,2025-01-06 10:00:00,r
2,APP-1,Андеррайтинг,2025-01-06 10:00:00,2025-01-07 10:00:00,r
3,APP-2,Приём заявки,2025-01-07 10:00:00,2025-01-07 12:00:00,r
4,APP-2,Андеррайтинг,2025-01-07 12:00:00,,r
5,APP-5,Приём заявки,2025-02-04 08:00:00,2025-02-04 07:00:00,r
6,APP-5,Андеррайтинг,2025-02-04 09:00:00,2025-02-05 21:00:00,r
7,APP-4,Приём заявки,2025-02-03 12:00:00,2025-02-03 13:00:00,r
"""
PASSPORT = """initiative_id,name,direction,start_month,cost_rub,months_to_profit,months_to_payback
INI-01,a,Карты,0,4200000,5,14
INI-07,g,Данные,0,12000000,12,30
"""
FACT = """initiative_id,month_index,actual_cost_rub,actual_profit_rub
INI-01,0,826245,0
INI-01,5,0,400000
"""


@pytest.fixture(scope="module")
def views(spark):
    d = tempfile.mkdtemp(prefix="stagewise-e2e-")
    raw = {}
    for name, text in [("raw_applications", APPS), ("raw_stage_events", EVENTS),
                       ("initiative_passport", PASSPORT), ("initiative_fact", FACT)]:
        with open(f"{d}/{name}.csv", "w", encoding="utf-8") as f:
            f.write(text)
        raw[name] = readers.read_declared_csv(spark, f"{d}/{name}.csv", name)
    return register_views(raw)


def test_views_exist_and_clean(spark, views):
    assert len(views) == 8
    ids = sorted(r.application_id for r in spark.sql("SELECT application_id FROM v_applications_clean").collect())
    assert ids == ["APP-1", "APP-2", "APP-5"]                  # repeat, technical client, test flag gone
    ev = {r.event_id: r.hours for r in spark.sql("SELECT event_id, hours FROM v_stage_events_clean").collect()}
    assert ev == {1: 1.0, 2: 24.0, 3: 2.0, 6: 36.0}            # open and reversed events dropped


def test_sql_text_with_cyrillic_labels(spark, views):
    rows = spark.sql("""
        SELECT e.stage AS `Этап`,
               count(*) AS `Событий`,
               round(percentile(e.hours, 0.5), 1) AS `Медиана, ч`
        FROM v_stage_events_clean e
        JOIN v_applications_clean a USING (application_id)
        GROUP BY e.stage ORDER BY `Медиана, ч` DESC""").collect()
    assert [(r["Этап"], r["Событий"], r["Медиана, ч"]) for r in rows] == [
        ("Андеррайтинг", 2, 30.0), ("Приём заявки", 2, 1.5)]
    panel = {(r.channel, r.stage): r.applications for r in spark.table("v_pipeline_stage_sla").collect()}
    assert panel[("Отделение", "Андеррайтинг")] == 1 and panel[("Партнёрская сеть", "Андеррайтинг")] == 1


def test_portfolio_views(spark, views):
    plan = {r.initiative_id: r.monthly_profit_rub for r in spark.table("v_initiative_plan").collect()}
    assert plan == {"INI-01": 452403, "INI-07": 736242}
    fvp = {r.month_index: (r.plan_cost_rub, r.plan_profit_rub) for r in spark.table("v_initiative_fact_vs_plan").collect()}
    assert fvp == {0: (840000, 0), 5: (0, 452403)}
    assert spark.table("v_portfolio_npv").count() == 37
