"""DuckDB text of the test-data relations, for the independent SQL oracle.

Every relation mirrors one adapter or clean-layer function; ``with_ctes``
prepends exactly the relations a query body mentions (and what they need).
Doubles are compared after the same decimal snap-and-round as on the Spark
side (``R``), and exact decimals are cast to DOUBLE on output.
"""

from __future__ import annotations

import re

from stagewise.sources.testdata import CARD_CHANNEL_SPELLINGS, GAPS
from stagewise.functions.text import CHANNEL_ALIASES


def R(expr: str, n: int) -> str:
    """SQL twin of ``round_half_up``."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,6)), {n}) AS DOUBLE)"


def PCT(num: str, den: str, n: int = 1) -> str:
    """SQL twin of ``pct``."""
    return R(f"(100.0 * CAST({num} AS DOUBLE)) / NULLIF(CAST({den} AS DOUBLE), 0)", n)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_SPELLINGS = "[" + ", ".join(_q(s) for s in CARD_CHANNEL_SPELLINGS) + "]"
_ALIAS_CASE = ("CASE lower(trim({c})).replace('ё', 'е') "
               + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in sorted(CHANNEL_ALIASES.items()))
               + " ELSE trim({c}) END")


def alias_case(c: str) -> str:
    return _ALIAS_CASE.replace("{c}", c)


def parse_amount_sql(c: str) -> str:
    x = f"replace(regexp_replace({c}, '[\\s\\x{{00a0}}\\x{{202f}}]', '', 'g'), ',', '.')"
    return f"CASE WHEN regexp_full_match({x}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)') THEN TRY_CAST({x} AS DOUBLE) END"


def parse_date_sql(c: str) -> str:
    s = f"trim({c})"
    return (f"CAST(CASE WHEN regexp_full_match({s}, '\\d{{1,2}}\\.\\d{{1,2}}\\.\\d{{4}}') "
            f"THEN try_strptime({s}, '%d.%m.%Y') "
            f"WHEN regexp_full_match({s}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') "
            f"THEN try_strptime({s}, '%Y-%m-%d') END AS DATE)")


EXPORT_MOMENT = "(SELECT max(o_orderdate) FROM orders)"

CTES: dict[str, str] = {}

def _gap(name: str) -> str:
    key, modulus, rest = GAPS[name]
    return f"{key} % {modulus} = {rest}"


CTES["raw_applications"] = f"""
SELECT o.o_orderkey AS application_id,
       CASE WHEN {_gap('technical_client')} THEN 'CL-TEST'
            WHEN NOT ({_gap('client_id')}) THEN 'CL-' || CAST(o.o_custkey AS VARCHAR) END AS client_id,
       g.c_mktsegment AS product,
       CASE WHEN NOT ({_gap('channel')}) THEN o.o_orderpriority END AS channel,
       CASE WHEN NOT ({_gap('region')}) THEN g.r_name END AS region,
       CASE WHEN NOT ({_gap('amount_requested')}) THEN CAST(o.o_totalprice AS DECIMAL(18,2)) END AS amount_requested,
       o.o_orderdate + to_days(CAST((l.l_linenumber * 3) % 7 AS INTEGER)) AS submitted_at,
       l.l_linestatus AS source_system,
       CASE WHEN NOT ({_gap('is_test')}) THEN g.c_acctbal < 0 END AS is_test
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN (SELECT c.c_custkey, c.c_mktsegment, c.c_acctbal, r.r_name
           FROM customer c
           LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
           LEFT JOIN region r ON r.r_regionkey = n.n_regionkey) g ON g.c_custkey = o.o_custkey"""

CTES["raw_stage_events"] = f"""
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS event_id,
       l.l_orderkey AS application_id,
       l.l_returnflag || l.l_linestatus AS stage,
       o.o_orderdate AS entered_at,
       CASE WHEN l.l_shipdate > {EXPORT_MOMENT} THEN NULL ELSE l.l_shipdate END AS left_at,
       CASE WHEN NOT ({_gap('actor_role')}) THEN o.o_orderstatus END AS actor_role
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey"""

CTES["raw_decisions"] = """
SELECT o_orderkey AS application_id, o_orderstatus AS decision, o_orderdate AS decided_at,
       o_orderpriority AS reason
FROM orders WHERE o_orderstatus <> 'O'"""

CTES["raw_disbursements"] = """
SELECT o_orderkey AS application_id, o_orderdate AS disbursed_at,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount_disbursed
FROM orders WHERE o_orderstatus = 'F'"""

CTES["initiative_passport"] = """
SELECT p_partkey AS initiative_id, p_name AS name, p_brand AS direction,
       CAST(p_partkey % 10 AS INTEGER) AS start_month,
       CAST(p_size * 1000000 AS DECIMAL(18,2)) AS cost_rub,
       CAST(3 + p_partkey % 10 AS INTEGER) AS months_to_profit,
       CAST(3 + p_partkey % 10 + 6 + p_partkey % 15 AS INTEGER) AS months_to_payback
FROM part"""

CTES["initiative_fact"] = """
SELECT l_partkey AS initiative_id, l_linenumber AS month_index,
       sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS actual_cost_rub,
       sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS actual_profit_rub
FROM lineitem GROUP BY l_partkey, l_linenumber"""

CTES["cards_export"] = f"""
SELECT CAST(l.l_orderkey AS VARCHAR) AS card_id,
       CASE WHEN l.l_linenumber % 2 = 1 THEN strftime(o.o_orderdate, '%d.%m.%Y')
            ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS issued,
       {_SPELLINGS}[CAST((l.l_orderkey + l.l_linenumber) % 16 + 1 AS INTEGER)] AS channel,
       o.o_orderpriority AS tariff,
       CASE WHEN l.l_linenumber % 4 = 0 THEN 'н/д'
            WHEN l.l_linenumber % 4 = 1 THEN
                 CASE WHEN floor(o.o_totalprice) >= 1000
                      THEN CAST(CAST(floor(floor(o.o_totalprice) / 1000) AS BIGINT) AS VARCHAR) || ' '
                           || lpad(CAST(CAST(floor(o.o_totalprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0')
                      ELSE CAST(CAST(floor(o.o_totalprice) AS BIGINT) AS VARCHAR) END
            WHEN l.l_linenumber % 4 = 2 THEN replace(CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
            ELSE CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS credit_limit,
       CASE WHEN l.l_shipdate > {EXPORT_MOMENT} THEN ''
            WHEN l.l_linenumber % 2 = 0 THEN strftime(l.l_shipdate, '%d.%m.%Y')
            ELSE strftime(l.l_shipdate, '%Y-%m-%d') END AS first_purchase,
       CASE WHEN l.l_linestatus = 'O' THEN
                 CASE WHEN l.l_linenumber % 2 = 0 THEN 'Активна' ELSE 'активна' END
            ELSE 'Закрыта' END AS status
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey"""

CTES["v_applications_clean"] = """
SELECT application_id, client_id, product, channel, region, amount_requested, submitted_at, source_system
FROM (SELECT *, row_number() OVER (
          PARTITION BY application_id
          ORDER BY submitted_at ASC NULLS LAST, client_id ASC NULLS LAST, product ASC NULLS LAST,
                   channel ASC NULLS LAST, region ASC NULLS LAST, amount_requested ASC NULLS LAST,
                   submitted_at ASC NULLS LAST, source_system ASC NULLS LAST) AS rn
      FROM raw_applications
      WHERE NOT is_test AND client_id <> 'CL-TEST') t
WHERE rn = 1"""

HOURS = "CAST(date_diff('microsecond', {a}, {b}) AS DOUBLE) / 3600000000.0"


def hours(a: str = "entered_at", b: str = "left_at") -> str:
    return HOURS.format(a=a, b=b)


CTES["v_stage_events_clean"] = f"""
SELECT e.*, {hours('e.entered_at', 'e.left_at')} AS hours
FROM raw_stage_events e
WHERE e.left_at IS NOT NULL AND e.left_at > e.entered_at
  AND e.application_id IN (SELECT application_id FROM v_applications_clean)"""



def _factor_list(last: int) -> str:
    """1.01 ** -m for m = 0..last as whole multiples of 1e-28 (HUGEINT)."""
    out = [10**28]
    for _ in range(last):
        out.append((2 * out[-1] * 100 + 101) // 202)              # half up
    return "[" + ", ".join(f"{d}::HUGEINT" for d in out) + "]"


# Whole numbers stand for decimals: sums of factors in 1e-20, money in kopecks,
# the quotient in 1e-6 roubles.
CTES["v_initiative_plan"] = f"""
SELECT initiative_id, name, direction, start_month, cost_rub, months_to_profit, months_to_payback,
       CAST(kopecks // (100 * months_to_profit) AS BIGINT) AS monthly_cost_rub,
       CAST(((2 * kopecks * spend * 10000 + months_to_profit * unit) // (2 * months_to_profit * unit) + 999999) // 1000000
            AS BIGINT) AS monthly_profit_rub
FROM (SELECT *, CAST(cost_rub * 100 AS HUGEINT) AS kopecks,
             (list_reduce(f[1:months_to_profit], lambda a, b: a + b) + 50000000) // 100000000 AS spend,
             (list_reduce(f[months_to_profit + 1:months_to_payback + 1], lambda a, b: a + b) + 50000000) // 100000000 AS unit
      FROM (SELECT *, {_factor_list(60)} AS f FROM initiative_passport) x) sums"""

# Money of a month: nothing until the first month of spending, then the phase's
# flow, read off a list by how far the month lies into the initiative.
CTES["v_initiative_cashflow"] = f"""
SELECT initiative_id, name, direction, month_index, cash_flow_rub,
       CAST(sign(cash_flow_rub) * ((2 * abs(CAST(cash_flow_rub AS HUGEINT)) * {_factor_list(36)}[month_index + 1] + {10**26}::HUGEINT)
                                   // {2 * 10**26}::HUGEINT) AS DECIMAL(30,0)) * 0.01::DECIMAL(2,2) AS discounted_rub
FROM (SELECT initiative_id, name, direction, month_index,
             [0, -monthly_cost_rub, monthly_profit_rub][
                 1 + CAST(month_index >= start_month AS INTEGER)
                   + CAST(month_index >= start_month + months_to_profit AS INTEGER)] AS cash_flow_rub
      FROM (SELECT *, CAST(unnest(range(0, 37)) AS INTEGER) AS month_index FROM v_initiative_plan) months) flows"""

CTES["v_initiative_npv"] = """
SELECT *, sum(discounted_rub) OVER (PARTITION BY initiative_id ORDER BY month_index) AS cum_npv_rub
FROM v_initiative_cashflow"""

CTES["v_portfolio_npv"] = """
WITH by_month AS (SELECT month_index AS m, sum(cash_flow_rub) AS flow, sum(discounted_rub) AS worth
                  FROM v_initiative_cashflow GROUP BY 1)
SELECT now.m AS month_index, any_value(now.flow) AS cash_flow_rub, any_value(now.worth) AS discounted_rub,
       sum(past.worth) AS cum_npv_rub
FROM by_month now JOIN by_month past ON past.m <= now.m GROUP BY now.m"""

CTES["cards_clean"] = f"""
SELECT card_id, issued, channel, tariff, credit_limit, first_purchase, status
FROM (SELECT *, row_number() OVER (
          PARTITION BY card_id
          ORDER BY issued ASC NULLS LAST, channel ASC NULLS LAST, tariff ASC NULLS LAST,
                   credit_limit ASC NULLS LAST, first_purchase ASC NULLS LAST,
                   status ASC NULLS LAST) AS rn
      FROM (SELECT trim(card_id) AS card_id, {parse_date_sql('issued')} AS issued,
                   {alias_case('channel')} AS channel, tariff,
                   {parse_amount_sql('credit_limit')} AS credit_limit,
                   {parse_date_sql('first_purchase')} AS first_purchase,
                   upper(left(trim(status), 1)) || lower(substr(trim(status), 2)) AS status
            FROM cards_export) p) t
WHERE rn = 1"""


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the relations it mentions, dependencies first."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    order = [n for n in CTES if n in needed]
    head = ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in order)
    text = body.strip()
    if re.match(r"(?i)with\s", text):
        return "WITH " + head + ",\n" + text[4:].lstrip()
    return "WITH " + head + "\n" + text
