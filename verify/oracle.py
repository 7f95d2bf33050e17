"""The registered queries once more, as plain SQL for an independent engine.

Every statement is put together from common table expressions over the given
tables. ``R`` rounds the way the library does: half up on the decimal form.
"""

from __future__ import annotations

import json
from pathlib import Path

from tallywater.sources.network import SAMPLE

_NETWORK = json.loads(Path(SAMPLE).read_text(encoding="utf-8"))


def R(expr: str, digits: int = 6) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def D(number: float) -> str:
    return f"{number}::DOUBLE"


def day(column: str, alias: str | None = None) -> str:
    return f"CAST({column} AS VARCHAR) AS {alias or column.split('.')[-1]}"


def stamp(column: str, alias: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {alias}"


def pick(values: tuple[str, ...], index: str) -> str:
    texts = ", ".join(f"'{v}'" for v in values)
    return f"([{texts}])[CAST(({index}) % {len(values)} AS INTEGER) + 1]"


def big(expr: str, alias: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {alias}"


def text(value: object) -> str:
    return "NULL::VARCHAR" if value is None else f"'{value}'"


# Texts that rules compare, and made-up ones beside them.
CATEGORIES = (
    "Billing Dispute", "Water Quality", "Leakage", "No Water", "Pressure Issues",
    "New Connection", "Hydrant Hire", "Garden Metering", "Works Notice", "Tour Booking",
)
CHANNELS = ("Phone", "Letter", "Web Portal", "Mobile App", "Counter", "Field Crew")
METHODS = (
    "Giro", "Standing Order", "Kiosk", "Voucher", "Payroll", "Wallet",
)
SEGMENTS = ("Residential", "Business", "Government", "Industrial")
ROLES = ("Agent", "Senior Agent", "Team Lead", "Supervisor")
PAYERS = ("reliable", "occasional_late", "problematic")
DEPARTMENTS = (
    "Catchments", "Pipelines", "Sampling", "Front Desk", "Accounts", "Night Crew", "Stores",
)


def service_day(days: int) -> str:
    return (
        "(DATE '2025-01-01' + CAST(date_diff('day', DATE '1995-01-01', "
        f"CAST(l_shipdate AS DATE)) % {days} AS INTEGER))"
    )


def tickets(days: int = 60, gaps: bool = False) -> dict[str, str]:
    unresolved = "(l_returnflag = 'R')"
    resolved = f"CAST(NOT {unresolved} AS INTEGER)"
    if gaps:
        resolved = f"CASE WHEN l_partkey % 13 <> 0 THEN {resolved} END"
    complexity = (
        "CASE WHEN issue_category IN ('Billing Dispute', 'Water Quality') THEN 1.5::DOUBLE "
        "WHEN issue_category IN ('Leakage', 'Pressure Issues') THEN 1.3::DOUBLE "
        "ELSE 1.0::DOUBLE END"
    )
    response = (
        "CASE WHEN issue_channel = 'Phone' THEN 0.8::DOUBLE "
        "WHEN issue_channel IN ('Web Portal', 'Mobile App') THEN 1.2::DOUBLE ELSE 2.0::DOUBLE END"
    )
    score = (
        "3.5::DOUBLE + 0.5::DOUBLE * resolved_in_first_contact - 1.0::DOUBLE * reopened "
        "- 0.5::DOUBLE * (1 - sla_compliance) + jitter"
    )
    return {
        "raw": f"""
            SELECT l_orderkey * 8 + l_linenumber AS ticket_id, {service_day(days)} AS date_id,
                   l_suppkey + 1 AS agent_id, l_suppkey % 7 + 1 AS facility_id,
                   (l_suppkey + 1) % 2 + 4 AS department_id, o_custkey AS customer_id,
                   {pick(CATEGORIES, 'l_partkey')} AS issue_category,
                   {pick(CHANNELS, 'l_orderkey')} AS issue_channel,
                   l_quantity / 10 AS base_time_hrs, l_partkey % 15 + 1 AS base_response_mins,
                   {resolved} AS resolved_in_first_contact,
                   CAST({unresolved} AND l_linestatus = 'O' AS INTEGER) AS reopened,
                   CAST(l_discount <= 0.07::DOUBLE AS INTEGER) AS sla_compliance,
                   CAST(trunc(l_quantity) AS INTEGER) % 30 + 1 AS days_in_backlog,
                   (l_partkey % 11 - 5) / 10.0::DOUBLE AS jitter,
                   3.5::DOUBLE + (l_orderkey % 16) / 10.0::DOUBLE AS low_effort, l_partkey
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
        "scored": f"""
            SELECT *, {R(f'base_time_hrs * ({complexity})', 2)} AS resolution_time_hrs,
                   greatest(1, CAST(trunc(base_response_mins * ({response})) AS INTEGER))
                       AS response_time_mins,
                   {R(f'greatest(1.0::DOUBLE, least(5.0::DOUBLE, {score}))', 1)}
                       AS satisfaction_score
            FROM raw""",
        "tickets": f"""
            SELECT *, CAST(trunc((satisfaction_score - 3) * 4) AS INTEGER) AS nps_score,
                   CASE WHEN satisfaction_score > 3 THEN {R('6 - satisfaction_score', 1)}
                        ELSE low_effort END AS effort_score,
                   resolved_in_first_contact IS DISTINCT FROM 1
                       AND (sla_compliance = 0 OR reopened = 1) AS escalated
            FROM scored""",
    }


AGENTS = {
    "agents": f"""
        SELECT s_suppkey + 1 AS agent_id, s_name AS agent_name,
               (s_suppkey + 1) % 2 + 4 AS department_id,
               {pick(ROLES, '(s_suppkey + 1)')} AS role_title,
               DATE '2025-01-01' - CAST((s_suppkey + 1) % 40 * 100 AS INTEGER) AS hire_date
        FROM supplier"""
}

CUSTOMERS = {
    "customers": f"""
        SELECT c_custkey AS customer_id, 'District ' || (c_custkey % 9 + 1) AS district,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Domestic' WHEN 'BUILDING' THEN 'Commercial'
                    WHEN 'FURNITURE' THEN 'Industrial' WHEN 'HOUSEHOLD' THEN 'Government'
                    WHEN 'MACHINERY' THEN 'Non-Profit' ELSE '' END AS tariff_category,
               {pick(SEGMENTS, 'c_nationkey')} AS customer_segment
        FROM customer"""
}

DEPARTMENT_ROWS = {
    "departments": "SELECT * FROM (VALUES "
    + ", ".join(f"({n}, '{name}')" for n, name in enumerate(DEPARTMENTS, start=1))
    + ") d(department_id, department_name)"
}

TOTALS = {
    "totals": """
        SELECT date_id, agent_id, count(*) AS total, sum(reopened) AS reopened,
               sum(1 - sla_compliance) AS breaches,
               sum(CASE WHEN resolved_in_first_contact IS DISTINCT FROM 1 THEN 1 ELSE 0 END) AS open,
               sum(CASE WHEN escalated THEN 1 ELSE 0 END) AS escalated,
               CAST(sum(CAST(resolution_time_hrs AS DECIMAL(18,4))) AS DOUBLE) AS hours
        FROM tickets GROUP BY 1, 2"""
}


def performance(
    days: int = 60, every_agent: bool = True, varied: bool = True, gaps: bool = False
) -> dict[str, str]:
    if every_agent:
        grain = f"""
            SELECT agent_id, coalesce(department_id, 4) AS department_id,
                   coalesce(role_title, '') AS role_title, date_id,
                   coalesce(total, 0) AS total, coalesce(reopened, 0) AS reopened,
                   coalesce(breaches, 0) AS breaches, coalesce(open, 0) AS open,
                   coalesce(escalated, 0) AS escalated, coalesce(hours, 0) AS hours
            FROM (SELECT agent_id, date_id FROM known CROSS JOIN (
                SELECT CAST(unnest(generate_series(DATE '2025-01-01',
                       DATE '2025-01-01' + {days - 1}, INTERVAL 1 DAY)) AS DATE) AS date_id)
                UNION SELECT agent_id, date_id FROM totals)
            LEFT JOIN totals t USING (agent_id, date_id) LEFT JOIN known a USING (agent_id)"""
    else:
        grain = """
            SELECT t.*, coalesce(a.department_id, 4) AS department_id,
                   coalesce(a.role_title, '') AS role_title
            FROM totals t LEFT JOIN known a USING (agent_id)"""
    base = (
        "CASE WHEN role_title LIKE '%Supervisor%' THEN 0.85::DOUBLE "
        "WHEN role_title LIKE '%Team Lead%' THEN 0.80::DOUBLE "
        "WHEN role_title LIKE '%Senior%' THEN 0.75::DOUBLE ELSE 0.70::DOUBLE END"
    )
    used = (
        "least(0.98::DOUBLE, 0.40::DOUBLE + total * 0.03::DOUBLE)"
        if varied
        else f"least(0.98::DOUBLE, {base} + total / 100)"
    )
    rate = "CAST(total - open AS DOUBLE) / CAST(total AS DOUBLE) * 100.0::DOUBLE"
    return {
        **tickets(days, gaps),
        **AGENTS,
        "known": "SELECT * FROM agents" + (" WHERE (agent_id - 1) % 4 <> 1" if gaps else ""),
        **TOTALS,
        "grain": grain,
        "perf": f"""
            SELECT CAST(strftime(date_id, '%Y%m%d') AS BIGINT) * 10000000 + agent_id
                       AS performance_id,
                   date_id, agent_id, department_id, CAST(total AS BIGINT) AS total_tickets_handled,
                   {R('hours * 60 / greatest(1, total)', 1)} AS avg_handle_time_mins,
                   {R('CAST(escalated AS DOUBLE) / greatest(1, total)', 3)} AS escalation_rate,
                   CAST(open AS BIGINT) AS backlog, CAST(reopened AS BIGINT) AS reopened_tickets,
                   {R(used, 2)} AS utilization_rate, CAST(breaches AS BIGINT) AS sla_breaches,
                   CASE WHEN total > 0 THEN {R(rate, 2)} ELSE 0 END AS resolution_rate
            FROM grain""",
    }


MEASURES = {
    "utilization": "utilization_rate",
    "handle_time": "avg_handle_time_mins",
    "backlog": "backlog",
}
ROLLING = [f"avg_{m}_{n}d" for n in (7, 30) for m in MEASURES]
STRESS = (
    "escalation_rate * 0.3::DOUBLE + least(sla_breaches / 10::DOUBLE, 1.0::DOUBLE) * 0.4::DOUBLE "
    "+ utilization_rate * 0.3::DOUBLE"
)


def rolling(source: str, partition: str) -> str:
    """Trailing means and differences over the rows of ``source``."""
    parts = []
    for n in (7, 30):
        for measure, column in MEASURES.items():
            parts.append(
                f"CASE WHEN count({column}) OVER w{n} >= 3 "
                f"THEN avg({column}) OVER w{n} END AS avg_{measure}_{n}d"
            )
    for name, column in (
        ("utilization_trend", "utilization_rate"),
        ("escalation_trend", "escalation_rate"),
        ("workload_velocity", "backlog"),
    ):
        parts.append(f"{column} - lag({column}, 7) OVER w AS {name}")
    order = f"(PARTITION BY {partition} ORDER BY date_id"
    return f"""
        SELECT *, {', '.join(parts)},
               lead(date_id) OVER w IS NULL AS is_latest
        FROM {source}
        WINDOW w AS {order}), w7 AS {order} ROWS 6 PRECEDING), w30 AS {order} ROWS 29 PRECEDING)"""


def flags(source: str, tenure: str = "12", filled: bool = False) -> str:
    """Index, flags and tenure; with ``filled`` missing history becomes 0 (after the flags)."""
    names = [*ROLLING, "utilization_trend", "escalation_trend", "workload_velocity"]
    replaced = ", ".join(f"coalesce({n}, 0) AS {n}" for n in names)
    star = f"* REPLACE ({replaced})" if filled else "*"
    return f"""
        SELECT {star}, {STRESS} AS stress_index,
               CAST(coalesce(avg_handle_time_7d > avg_handle_time_30d * 1.15::DOUBLE, FALSE)
                    AS INTEGER) AS performance_declining,
               CAST(backlog > 10 AS INTEGER) AS persistent_backlog,
               {tenure} AS tenure_months
        FROM {source}"""


def features(filled: bool = False, **kwargs) -> dict[str, str]:
    return {
        **performance(**kwargs),
        "rolled": rolling("perf", "agent_id"),
        "features": flags("rolled", filled=filled),
    }


TICKET_METRICS = {
    "metrics": """
        SELECT date_id, agent_id, count(*) AS total_tickets,
               CAST(sum(CAST(satisfaction_score AS DECIMAL(12,4))) AS DOUBLE) / count(*) AS avg_csat,
               sum(reopened) AS reopened_count,
               sum(CASE WHEN sla_compliance = 0 THEN 1 ELSE 0 END) AS sla_breach_count
        FROM tickets GROUP BY 1, 2"""
}

SIGNS = {
    "critical": "CAST(utilization_rate >= 0.90::DOUBLE AS INT) + CAST(escalation_rate >= 0.22::DOUBLE AS INT) "
    "+ CAST(backlog >= 12 AS INT) + CAST(sla_breaches >= 5 AS INT) + CAST(stress_index >= 0.65::DOUBLE AS INT)",
    "extreme": "utilization_rate >= 0.95::DOUBLE OR escalation_rate >= 0.30::DOUBLE OR backlog >= 20",
    "high": "CAST(utilization_rate >= 0.78::DOUBLE AS INT) + CAST(escalation_rate >= 0.12::DOUBLE AS INT) "
    "+ CAST(backlog >= 7 AS INT) + CAST(sla_breaches >= 3 AS INT) + persistent_backlog "
    "+ performance_declining + CAST(stress_index >= 0.50::DOUBLE AS INT)",
    "medium": "utilization_rate >= 0.65::DOUBLE OR backlog >= 4 OR stress_index >= 0.40::DOUBLE "
    "OR escalation_rate >= 0.08::DOUBLE OR sla_breaches >= 1",
}
LABEL = (
    f"CASE WHEN {SIGNS['critical']} >= 2 OR {SIGNS['extreme']} THEN 'Critical' "
    f"WHEN {SIGNS['high']} >= 2 THEN 'High' WHEN {SIGNS['medium']} THEN 'Medium' ELSE 'Low' END"
)


def training(varied: bool = True) -> dict[str, str]:
    """Training frame with rule labels: complete rows only."""
    complete = " AND ".join(
        f"{n} IS NOT NULL"
        for n in [*ROLLING, "utilization_trend", "escalation_trend", "workload_velocity"]
    )
    return {
        **performance(varied=varied),
        **TICKET_METRICS,
        "joined": """
            SELECT p.*, coalesce(m.total_tickets, 0) AS total_tickets,
                   coalesce(m.avg_csat, 0) AS avg_csat,
                   coalesce(m.reopened_count, 0) AS reopened_count,
                   coalesce(m.sla_breach_count, 0) AS sla_breach_count, a.role_title, a.hire_date
            FROM perf p LEFT JOIN metrics m USING (date_id, agent_id)
                 LEFT JOIN agents a USING (agent_id)""",
        "rolled": rolling("joined", "agent_id"),
        "flagged": flags(
            "rolled", "CAST(trunc(date_diff('day', hire_date, date_id) / 30) AS INTEGER)"
        ),
        "labelled": f"""
            SELECT *, {LABEL} AS burnout_risk_label FROM flagged WHERE {complete}""",
    }


def scored() -> dict[str, str]:
    """Filled features with the repeatable class probabilities."""
    weights = ", ".join(
        f"(agent_id * {k + 3} + dayofyear(date_id) * {2 * k + 1}) % 10 + 1 AS w{k}"
        for k in range(4)
    )
    total = "CAST(w0 + w1 + w2 + w3 AS DOUBLE)"
    shares = ", ".join(f"w{k} / {total} AS p{k}" for k in range(4))
    return {
        **features(filled=True),
        "weighted": f"SELECT *, {weights} FROM features",
        "shared": f"SELECT *, {shares} FROM weighted",
        "rated": f"""
            SELECT *, greatest(p0, p1, p2, p3) AS confidence_score,
                   CASE WHEN w0 >= greatest(w1, w2, w3) THEN 'Critical'
                        WHEN w1 >= greatest(w2, w3) THEN 'High'
                        WHEN w2 >= w3 THEN 'Low' ELSE 'Medium' END AS risk_category,
                   p2 * 0.0::DOUBLE + p3 * 0.33::DOUBLE + p1 * 0.67::DOUBLE + p0 * 1.0::DOUBLE
                       AS base_risk
            FROM shared""",
    }


FACTORS = {
    "workload_factor": "CASE WHEN utilization_rate > 0.95::DOUBLE THEN 0.10 "
    "WHEN utilization_rate > 0.85::DOUBLE THEN 0.05 WHEN utilization_rate < 0.60::DOUBLE THEN -0.05 "
    "ELSE 0 END + CASE WHEN backlog > 15 THEN 0.05 WHEN backlog > 10 THEN 0.03 ELSE 0 END",
    "decline_factor": "CASE WHEN performance_declining = 1 THEN 0.08 ELSE 0 END "
    "+ CASE WHEN utilization_trend > 0.10::DOUBLE THEN 0.04 "
    "WHEN utilization_trend < -0.10::DOUBLE THEN -0.04 ELSE 0 END",
    "quality_factor": "CASE WHEN escalation_rate > 0.25::DOUBLE THEN 0.06 "
    "WHEN escalation_rate > 0.15::DOUBLE THEN 0.03 ELSE 0 END "
    "+ CASE WHEN sla_breaches >= 5 THEN 0.04 WHEN sla_breaches >= 3 THEN 0.02 ELSE 0 END",
    "persistence_factor": "CASE WHEN persistent_backlog = 1 THEN 0.05 ELSE 0 END "
    "+ CASE WHEN workload_velocity > 5 THEN 0.03 WHEN workload_velocity < -5 THEN -0.03 ELSE 0 END",
    "efficiency_factor": "CASE WHEN avg_handle_time_7d > avg_handle_time_30d * 1.20::DOUBLE THEN 0.05 "
    "WHEN avg_handle_time_7d > avg_handle_time_30d * 1.10::DOUBLE THEN 0.03 "
    "WHEN avg_handle_time_7d < avg_handle_time_30d * 0.90::DOUBLE THEN -0.03 ELSE 0 END",
    "volume_factor": "CASE WHEN total_tickets_handled > 10 THEN 0.04 "
    "WHEN total_tickets_handled < 3 THEN -0.03 ELSE 0 END "
    "+ CASE WHEN reopened_tickets > 3 THEN 0.03 ELSE 0 END",
}

PRODUCTIVITY = {
    "throughput": "least(0.30::DOUBLE, total_tickets_handled / 8.0::DOUBLE * 0.30::DOUBLE)",
    "quality": "greatest(0::DOUBLE, 0.35::DOUBLE "
    "- greatest(0::DOUBLE, escalation_rate - 0.10::DOUBLE) * 0.5::DOUBLE "
    "- reopened_tickets / CAST(greatest(1, total_tickets_handled) AS DOUBLE) * 0.3::DOUBLE)",
    "efficiency": "CASE WHEN avg_handle_time_mins <= avg_handle_time_30d * 0.90::DOUBLE THEN 0.25 "
    "WHEN avg_handle_time_mins <= avg_handle_time_30d * 1.10::DOUBLE THEN 0.20 "
    "WHEN avg_handle_time_mins <= avg_handle_time_30d * 1.20::DOUBLE THEN 0.15 ELSE 0.10 END",
    "utilization_share": "CASE WHEN utilization_rate >= 0.70::DOUBLE "
    "AND utilization_rate <= 0.85::DOUBLE THEN 0.10 WHEN (utilization_rate >= 0.60::DOUBLE "
    "AND utilization_rate < 0.70::DOUBLE) OR (utilization_rate > 0.85::DOUBLE "
    "AND utilization_rate <= 0.90::DOUBLE) THEN 0.07 ELSE 0.03 END",
}

REDUCTION = """CASE risk_category
    WHEN 'Critical' THEN least(50, 35 + CASE WHEN utilization_rate > 0.95::DOUBLE THEN 5 ELSE 0 END
        + CASE WHEN backlog > 20 THEN 5 ELSE 0 END)
    WHEN 'High' THEN least(30, 20 + CASE WHEN utilization_rate > 0.90::DOUBLE THEN 5 ELSE 0 END
        + CASE WHEN backlog > 15 THEN 3 ELSE 0 END)
    WHEN 'Medium' THEN least(15, 10 + CASE WHEN utilization_rate > 0.85::DOUBLE THEN 3 ELSE 0 END
        + CASE WHEN backlog > 10 THEN 2 ELSE 0 END
        + CASE WHEN escalation_rate > 0.15::DOUBLE THEN 2 ELSE 0 END)
    ELSE CASE WHEN utilization_rate > 0.80::DOUBLE THEN 3 WHEN backlog > 8 THEN 2
        WHEN stress_index > 0.55::DOUBLE THEN 2 ELSE 0 END END"""

ACTION = """CASE risk_category WHEN 'Low' THEN 'Continue monitoring'
    WHEN 'Medium' THEN 'Proactive check-in scheduled'
    WHEN 'High' THEN 'Redistribute 5-8 cases immediately'
    WHEN 'Critical' THEN 'URGENT: Mandatory rest + workload redistribution' END"""

HISTORY_ACTION = """CASE risk_category WHEN 'Low' THEN 'Continue monitoring'
    WHEN 'Medium' THEN 'Proactive check-in' WHEN 'High' THEN 'Redistribute workload'
    WHEN 'Critical' THEN 'Immediate intervention' END"""

CODE = "CASE risk_category WHEN 'Critical' THEN 0 WHEN 'High' THEN 1 WHEN 'Low' THEN 2 ELSE 3 END"


def advised() -> dict[str, str]:
    """Daily scores and advice."""
    factors = " + ".join(f"({e})" for e in FACTORS.values())
    shares = " + ".join(f"({e})" for e in PRODUCTIVITY.values())
    return {
        **scored(),
        "advised": f"""
            SELECT *, greatest(0::DOUBLE, least(1::DOUBLE, base_risk + {factors}))
                       AS burnout_risk_score,
                   greatest(0::DOUBLE, least(1::DOUBLE, {shares})) AS productivity_index,
                   {CODE} AS risk_category_encoded, {REDUCTION} AS workload_reduction_pct,
                   {ACTION} AS recommended_action
            FROM rated""",
    }


def forced() -> dict[str, str]:
    """Even days hold no Critical; the top scorer above 0.6 becomes one."""
    urgent = "'URGENT: Mandatory rest + workload redistribution'"
    parts = {**scored()}
    parts["rated"] = parts["rated"].replace(
        "CASE WHEN w0 >= greatest(w1, w2, w3) THEN 'Critical'",
        "CASE WHEN w0 >= greatest(w1, w2, w3) THEN "
        "CASE WHEN day(date_id) % 2 = 0 THEN 'High' ELSE 'Critical' END",
    )
    return {
        **parts,
        "advised": advised()["advised"],
        "ranked": """
            SELECT *, count(*) OVER (PARTITION BY date_id) AS agents,
                   sum(CASE WHEN risk_category = 'Critical' THEN 1 ELSE 0 END)
                       OVER (PARTITION BY date_id) AS criticals,
                   row_number() OVER (PARTITION BY date_id
                       ORDER BY round(burnout_risk_score, 9) DESC, agent_id) AS place
            FROM advised""",
        "chosen": """
            SELECT *, agents >= 10 AND criticals = 0 AND place = 1
                      AND burnout_risk_score > 0.6::DOUBLE AS is_forced FROM ranked""",
        "final": f"""
            SELECT * REPLACE (
                CASE WHEN is_forced THEN 'Critical' ELSE risk_category END AS risk_category,
                CASE WHEN is_forced THEN 0 ELSE risk_category_encoded END AS risk_category_encoded,
                CASE WHEN is_forced THEN 35 ELSE workload_reduction_pct END
                    AS workload_reduction_pct,
                CASE WHEN is_forced THEN {urgent} ELSE recommended_action END
                    AS recommended_action)
            FROM chosen""",
    }


def usage(days: int = 365) -> dict[str, str]:
    volume = "base_consumption * seasonal_factor * customer_factor"
    amount = "consumption_m3 * rate_per_m3 * (1 - discount_applied)"
    ceiling = (
        "CASE WHEN tariff_category = 'Non-Profit' THEN 0.20::DOUBLE "
        "WHEN customer_segment = 'Government' THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END"
    )
    return {
        **CUSTOMERS,
        "used": f"""
            SELECT l_orderkey AS billing_id, {service_day(days)} AS date_id,
                   o_custkey AS customer_id, l_quantity * 2 AS base_consumption,
                   0.7::DOUBLE + (l_partkey % 7) / 10::DOUBLE AS seasonal_factor,
                   0.8::DOUBLE + (o_custkey % 5) / 10::DOUBLE AS customer_factor,
                   l_discount * 2 AS discount, l_suppkey % 46 AS late,
                   CASE l_returnflag WHEN 'A' THEN 'Paid' WHEN 'N' THEN 'Pending'
                        ELSE 'Overdue' END AS payment_status,
                   {pick(PAYERS, 'l_linenumber')} AS payer_class,
                   {pick(METHODS, 'l_linenumber')} AS payment_method,
                   customer_segment, tariff_category
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey
                 JOIN customers ON customer_id = o_custkey""",
        "seasoned": """
            SELECT *, CASE WHEN month(date_id) IN (12, 1, 2, 3) THEN 'dry'
                           WHEN month(date_id) BETWEEN 6 AND 10 THEN 'rainy'
                           ELSE 'transition' END AS season FROM used""",
        "banded": """
            SELECT *, CASE season WHEN 'dry' THEN 1.1::DOUBLE WHEN 'rainy' THEN 0.7::DOUBLE
                        ELSE 0.9::DOUBLE END AS low,
                      CASE season WHEN 'dry' THEN 1.3::DOUBLE WHEN 'rainy' THEN 0.9::DOUBLE
                        ELSE 1.1::DOUBLE END AS high FROM seasoned""",
        "measured": f"""
            SELECT *, CASE tariff_category WHEN 'Domestic' THEN 0.57::DOUBLE
                        WHEN 'Commercial' THEN 1.35::DOUBLE WHEN 'Industrial' THEN 1.50::DOUBLE
                        WHEN 'Government' THEN 1.20::DOUBLE ELSE 0.85::DOUBLE END AS rate_per_m3,
                   {R(volume, 2)} AS consumption_m3, {ceiling} AS ceiling,
                   CASE WHEN {ceiling} > 0 THEN discount ELSE 0 END AS discount_applied,
                   CASE WHEN payment_status = 'Paid' THEN late ELSE 0 END AS days_late
            FROM banded""",
        "bills": f"""
            SELECT *, {R(amount, 2)} AS billed_amount,
                   CAST(seasonal_factor BETWEEN low AND high AS INTEGER) AS season_valid,
                   CAST(discount_applied = 0 OR discount_applied BETWEEN 0.05::DOUBLE AND ceiling
                        AS INTEGER) AS discount_valid,
                   CAST(payment_status <> 'Paid' OR CASE payer_class
                        WHEN 'reliable' THEN days_late BETWEEN 0 AND 7
                        WHEN 'occasional_late' THEN days_late BETWEEN 3 AND 20
                        ELSE days_late BETWEEN 15 AND 45 END AS INTEGER) AS lateness_valid
            FROM measured""",
    }


def triaged() -> dict[str, str]:
    def among(values: tuple[str, ...]) -> str:
        return "[" + ", ".join(f"'{v}'" for v in values) + "]"

    other = ("Pending Customer Response", "Complex Investigation Required", "Third Party Dependency")
    papers = (
        "Pending Customer Response", "Document Verification Required", "Third Party Dependency",
    )
    field = ("Parts Unavailable", "Field Team Scheduled", "Weather Delay")
    experts = (
        "Escalated to Technical Team", "Complex Investigation Required",
        "Senior Specialist Review Needed",
    )
    return {
        **tickets(),
        "unresolved": "SELECT * FROM tickets WHERE resolved_in_first_contact <> 1",
        "staged": f"""
            SELECT *, CASE WHEN escalated THEN {among(('Escalated', 'In Progress'))}
                           WHEN days_in_backlog > 14 THEN {among(('Pending', 'On Hold'))}
                           ELSE {among(('Pending', 'In Progress'))} END AS statuses
            FROM unresolved""",
        "placed": "SELECT *, statuses[ticket_id % 2 + 1] AS backlog_status FROM staged",
        "reasoned": f"""
            SELECT *, CASE WHEN backlog_status = 'Escalated' THEN {among(experts)}
                           WHEN issue_category IN ('Billing Dispute', 'Water Quality')
                               THEN {among(papers)}
                           WHEN issue_category IN ('Leakage', 'No Water') THEN {among(field)}
                           ELSE {among(other)} END AS reasons
            FROM placed""",
        "triaged": """
            SELECT *, reasons[ticket_id % 3 + 1] AS backlog_reason,
                   CASE WHEN days_in_backlog <= 3 THEN '0-3 days' WHEN days_in_backlog <= 7
                        THEN '4-7 days' WHEN days_in_backlog <= 14 THEN '8-14 days'
                        ELSE '15+ days' END AS backlog_age_category,
                   CASE WHEN sla_compliance = 0 AND reopened = 1 THEN 'Critical'
                        WHEN sla_compliance = 0 THEN 'High' WHEN reopened = 1 THEN 'Medium'
                        ELSE 'Low' END AS priority,
                   CASE WHEN escalated THEN least(3, days_in_backlog // 7) ELSE 0 END
                       AS escalation_level,
                   CAST(days_in_backlog > 7 OR sla_compliance = 0 AS INTEGER) AS sla_breached,
                   date_id - days_in_backlog AS assigned_date,
                   date_id + CAST(ticket_id % 7 + 1 AS INTEGER) AS expected_resolution_date
            FROM reasoned""",
    }


def _facility_rows() -> str:
    rows = []
    for number, (name, f) in enumerate(_NETWORK["facilities"].items(), start=1):
        listed = ", ".join(text(s) for s in f.get("priority_sensors", ()))
        rows.append(
            f"({number}, {text(name)}, {text(f['type'])}, {text(f['district'])}, "
            f"{text(f.get('supply_chain'))}, {text(f.get('upstream_facility'))}, "
            f"{text(f.get('downstream_facility'))}, CAST([{listed}] AS VARCHAR[]))"
        )
    return ", ".join(rows)


def _sensor_rows() -> str:
    rows = []
    for place, (name, s) in enumerate(_NETWORK["sensors"].items()):
        low, high = s["normal_range"]
        rows.append(
            f"({place}, {text(name)}, {text(s['unit'])}, {D(low)}, {D(high)}, "
            f"{D(s['critical_low'])}, {D(s['critical_high'])}, {text(s['analytics_category'])}, "
            f"[{', '.join(map(text, s['facility_types']))}])"
        )
    return ", ".join(rows)


NETWORK = {
    "facilities": f"""
        SELECT * FROM (VALUES {_facility_rows()}) f(facility_id, facility_name, facility_type,
            district, supply_chain, upstream_facility, downstream_facility, priority_sensors)""",
    "sensors": f"""
        SELECT * FROM (VALUES {_sensor_rows()}) s(place, sensor_type, unit, threshold_min,
            threshold_max, critical_low, critical_high, analytics_category, facility_types)""",
}

CALIBRATION = (
    "CASE WHEN facility_type = 'dam' AND sensor_type = 'water_level' THEN 1.5::DOUBLE "
    "WHEN facility_type = 'pumping_station' AND sensor_type = 'pressure' THEN 1.3::DOUBLE "
    "WHEN facility_type = 'reservoir' AND sensor_type = 'water_level' THEN 1.2::DOUBLE "
    "ELSE 1.0::DOUBLE END"
)


def readings() -> dict[str, str]:
    raw = R("critical_low + (value - 10) / 60 * (critical_high - critical_low)", 2)
    return {
        **NETWORK,
        "raw_readings": f"""
            SELECT event_id AS reading_id, ts, s.*, f.facility_name, f.facility_type,
                   {raw} AS raw_value
            FROM events JOIN sensors s ON s.place = event_id % {len(_NETWORK['sensors'])}
                 JOIN facilities f ON f.facility_id = user_id % {len(_NETWORK['facilities'])} + 1""",
        "readings": f"""
            SELECT *, raw_value * {CALIBRATION} AS value,
                   CASE WHEN raw_value BETWEEN threshold_min AND threshold_max THEN 'normal'
                        WHEN raw_value < threshold_min THEN
                            CASE WHEN raw_value > critical_low THEN 'warning' ELSE 'critical' END
                        ELSE CASE WHEN raw_value < critical_high THEN 'warning'
                                  ELSE 'critical' END END AS status
            FROM raw_readings""",
        "ranked_readings": """
            SELECT *, CASE status WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END AS rank
            FROM readings""",
    }


LEVELS = """(['operational', 'warning', 'critical'])[worst + 1] AS status,
            ([0, 2, 3])[worst + 1] AS alert_level"""


def events() -> dict[str, str]:
    """Newest reading per facility, hour and sensor, and the events they form."""
    return {
        **readings(),
        "kept": """
            SELECT * FROM (
                SELECT *, date_trunc('hour', ts) AS cycle, row_number() OVER (
                    PARTITION BY facility_name, date_trunc('hour', ts), sensor_type
                    ORDER BY ts DESC, reading_id DESC) AS place_in_cycle
                FROM ranked_readings) WHERE place_in_cycle = 1""",
        "sensor_rows": """
            SELECT *, md5(facility_name || '|' || strftime(cycle, '%Y-%m-%d %H:%M:%S')) AS event_id
            FROM kept""",
        "grouped": """
            SELECT event_id, cycle, facility_name, max(rank) AS worst,
                   count(*) AS active_sensors, list(sensor_type) AS seen,
                   string_agg(CASE WHEN status <> 'normal'
                       THEN sensor_type || ': ' || CAST(value AS VARCHAR) || unit END, ', '
                       ORDER BY sensor_type) AS anomalies
            FROM sensor_rows GROUP BY 1, 2, 3""",
        "sensor_events": f"SELECT *, {LEVELS} FROM grouped",
    }


def singles() -> dict[str, str]:
    """Each reading as an event of its own."""
    return {
        **readings(),
        "singles": f"""
            SELECT *, {LEVELS} FROM (SELECT *, rank AS worst FROM
                (SELECT * EXCLUDE (status) FROM ranked_readings))""",
    }


def sql(parts: dict[str, str], final: str) -> str:
    body = ", ".join(f"{name} AS ({text_})" for name, text_ in parts.items())
    return f"WITH {body} {final}"
