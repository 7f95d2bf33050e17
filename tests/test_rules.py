"""Every threshold just below, at and just above its bound; nulls never satisfy one."""

import pytest
from pyspark.sql import functions as F

from tallywater.functions import risk, sensing, service

CALM = {
    "utilization_rate": 0.5,
    "escalation_rate": 0.0,
    "backlog": 0,
    "sla_breaches": 0,
    "stress_index": 0.1,
    "persistent_backlog": 0,
    "performance_declining": 0,
    "avg_handle_time_mins": 100.0,
    "avg_handle_time_7d": 100.0,
    "avg_handle_time_30d": 100.0,
    "utilization_trend": 0.0,
    "workload_velocity": 0,
    "total_tickets_handled": 5,
    "reopened_tickets": 0,
    "risk_category": "Low",
}
DDL = (
    "utilization_rate double, escalation_rate double, backlog int, sla_breaches int, "
    "stress_index double, persistent_backlog int, performance_declining int, "
    "avg_handle_time_mins double, avg_handle_time_7d double, avg_handle_time_30d double, "
    "utilization_trend double, workload_velocity int, total_tickets_handled int, "
    "reopened_tickets int, risk_category string"
)


def values(spark, column, cases, base=CALM, ddl=DDL):
    rows = [tuple({**base, **case, "n": n}.values()) for n, case in enumerate(cases)]
    df = spark.createDataFrame(rows, ddl + ", n int")
    return [r[0] for r in df.select(column.alias("v"), "n").orderBy("n").select("v").collect()]


LABEL_CASES = [
    ({}, "Low"),
    ({"utilization_rate": 0.649}, "Low"),
    ({"utilization_rate": 0.65}, "Medium"),
    ({"backlog": 3}, "Low"),
    ({"backlog": 4}, "Medium"),
    ({"stress_index": 0.40}, "Medium"),
    ({"escalation_rate": 0.08}, "Medium"),
    ({"escalation_rate": 0.079}, "Low"),
    ({"sla_breaches": 1}, "Medium"),
    ({"utilization_rate": 0.78}, "Medium"),
    ({"utilization_rate": 0.78, "escalation_rate": 0.12}, "High"),
    ({"utilization_rate": 0.78, "escalation_rate": 0.119}, "Medium"),
    ({"backlog": 7, "sla_breaches": 3}, "High"),
    ({"persistent_backlog": 1, "performance_declining": 1}, "High"),
    ({"performance_declining": 1, "stress_index": 0.50}, "High"),
    ({"performance_declining": 1}, "Low"),
    ({"utilization_rate": 0.90, "escalation_rate": 0.22}, "Critical"),
    ({"utilization_rate": 0.90, "escalation_rate": 0.219}, "High"),
    ({"backlog": 12, "sla_breaches": 5}, "Critical"),
    ({"sla_breaches": 5, "stress_index": 0.65}, "Critical"),
    ({"utilization_rate": 0.95}, "Critical"),
    ({"utilization_rate": 0.949}, "Medium"),
    ({"escalation_rate": 0.30}, "Critical"),
    ({"backlog": 20}, "Critical"),
    ({"backlog": 19}, "Medium"),
    ({"utilization_rate": None, "escalation_rate": None, "stress_index": None}, "Low"),
]


def test_burnout_label(spark):
    got = values(spark, risk.burnout_label(), [c for c, _ in LABEL_CASES])
    assert got == [label for _, label in LABEL_CASES]


FACTOR_CASES = [
    ("workload_factor", {"utilization_rate": 0.951}, 0.10),
    ("workload_factor", {"utilization_rate": 0.95}, 0.05),
    ("workload_factor", {"utilization_rate": 0.85}, 0.0),
    ("workload_factor", {"utilization_rate": 0.60}, 0.0),
    ("workload_factor", {"utilization_rate": 0.599}, -0.05),
    ("workload_factor", {"utilization_rate": 0.7, "backlog": 16}, 0.05),
    ("workload_factor", {"utilization_rate": 0.7, "backlog": 15}, 0.03),
    ("workload_factor", {"utilization_rate": 0.7, "backlog": 10}, 0.0),
    ("decline_factor", {"performance_declining": 1, "utilization_trend": 0.11}, 0.12),
    ("decline_factor", {"utilization_trend": 0.10}, 0.0),
    ("decline_factor", {"utilization_trend": -0.11}, -0.04),
    ("quality_factor", {"escalation_rate": 0.26, "sla_breaches": 5}, 0.10),
    ("quality_factor", {"escalation_rate": 0.25, "sla_breaches": 4}, 0.05),
    ("quality_factor", {"escalation_rate": 0.15, "sla_breaches": 2}, 0.0),
    ("persistence_factor", {"persistent_backlog": 1, "workload_velocity": 6}, 0.08),
    ("persistence_factor", {"workload_velocity": 5}, 0.0),
    ("persistence_factor", {"workload_velocity": -6}, -0.03),
    ("efficiency_factor", {"avg_handle_time_7d": 121.0}, 0.05),
    ("efficiency_factor", {"avg_handle_time_7d": 120.0}, 0.03),
    ("efficiency_factor", {"avg_handle_time_7d": 105.0}, 0.0),
    ("efficiency_factor", {"avg_handle_time_7d": 89.0}, -0.03),
    ("volume_factor", {"total_tickets_handled": 11, "reopened_tickets": 4}, 0.07),
    ("volume_factor", {"total_tickets_handled": 10, "reopened_tickets": 3}, 0.0),
    ("volume_factor", {"total_tickets_handled": 2}, -0.03),
]


def test_risk_factors(spark):
    for name in {n for n, _, _ in FACTOR_CASES}:
        cases = [(c, v) for n, c, v in FACTOR_CASES if n == name]
        got = values(spark, risk.risk_factors()[name], [c for c, _ in cases])
        assert got == pytest.approx([v for _, v in cases]), name


PRODUCTIVITY_CASES = [
    ({"total_tickets_handled": 8, "utilization_rate": 0.70}, 0.30 + 0.35 + 0.20 + 0.10),
    ({"total_tickets_handled": 4, "utilization_rate": 0.70}, 0.15 + 0.35 + 0.20 + 0.10),
    ({"total_tickets_handled": 0, "utilization_rate": 0.85}, 0.35 + 0.20 + 0.10),
    ({"total_tickets_handled": 0, "utilization_rate": 0.60}, 0.35 + 0.20 + 0.07),
    ({"total_tickets_handled": 0, "utilization_rate": 0.90}, 0.35 + 0.20 + 0.07),
    ({"total_tickets_handled": 0, "utilization_rate": 0.901}, 0.35 + 0.20 + 0.03),
    ({"total_tickets_handled": 0, "avg_handle_time_mins": 90.0}, 0.35 + 0.25 + 0.03),
    ({"total_tickets_handled": 0, "avg_handle_time_mins": 115.0}, 0.35 + 0.15 + 0.03),
    ({"total_tickets_handled": 0, "avg_handle_time_mins": 121.0}, 0.35 + 0.10 + 0.03),
    ({"total_tickets_handled": 10, "reopened_tickets": 10, "escalation_rate": 0.9}, 0.30 + 0.20 + 0.03),
    ({"total_tickets_handled": 0, "escalation_rate": 0.30}, 0.25 + 0.20 + 0.03),
]


def test_productivity_index(spark):
    got = values(spark, risk.productivity_index(), [c for c, _ in PRODUCTIVITY_CASES])
    assert got == pytest.approx([v for _, v in PRODUCTIVITY_CASES])


REDUCTION_CASES = [
    ({"risk_category": "Critical", "utilization_rate": 0.95, "backlog": 20}, 35),
    ({"risk_category": "Critical", "utilization_rate": 0.96, "backlog": 21}, 45),
    ({"risk_category": "High", "utilization_rate": 0.90, "backlog": 15}, 20),
    ({"risk_category": "High", "utilization_rate": 0.91, "backlog": 16}, 28),
    ({"risk_category": "Medium", "utilization_rate": 0.86, "backlog": 11, "escalation_rate": 0.16}, 15),
    ({"risk_category": "Medium", "backlog": 11}, 12),
    ({"risk_category": "Low", "utilization_rate": 0.81, "backlog": 9}, 3),
    ({"risk_category": "Low", "utilization_rate": 0.80, "backlog": 9}, 2),
    ({"risk_category": "Low", "stress_index": 0.56}, 2),
    ({"risk_category": "Low", "stress_index": 0.55}, 0),
]


def test_workload_reduction(spark):
    got = values(spark, risk.workload_reduction_pct(), [c for c, _ in REDUCTION_CASES])
    assert got == [v for _, v in REDUCTION_CASES]


def test_score_is_clamped(spark):
    high = F.array(*[F.lit(x) for x in (1.0, 0.0, 0.0, 0.0)])
    low = F.array(*[F.lit(x) for x in (0.0, 0.0, 1.0, 0.0)])
    busy = {"utilization_rate": 0.99}
    idle = {"utilization_rate": 0.1, "total_tickets_handled": 0}
    assert values(spark, risk.burnout_risk_score(high), [busy]) == [1.0]
    assert values(spark, risk.burnout_risk_score(low), [idle]) == [0.0]


def test_stress_caps_breaches(spark):
    cases = [{"sla_breaches": 10}, {"sla_breaches": 25}]
    got = values(spark, risk.stress_index(), cases)
    assert got == pytest.approx([0.55, 0.55])


def test_codes_round_trip(spark):
    cases = [{"risk_category": c} for c in risk.SEVERITY]
    assert values(spark, risk.label_code("risk_category"), cases) == [2, 3, 1, 0]
    assert values(spark, risk.risk_rank("risk_category"), cases) == [0, 1, 2, 3]
    decoded = risk.label_of_code(risk.label_code("risk_category"))
    assert values(spark, decoded, cases) == list(risk.SEVERITY)


TICKET = {
    "ticket_id": 1,
    "issue_category": "Tour Booking",
    "issue_channel": "Email",
    "base_time_hrs": 2.0,
    "base_response_mins": 5,
    "resolved_in_first_contact": 0,
    "reopened": 0,
    "sla_compliance": 1,
    "days_in_backlog": 1,
    "backlog_status": "Pending",
    "satisfaction_score": 4.0,
    "role_title": "",
}
TICKET_DDL = (
    "ticket_id long, issue_category string, issue_channel string, base_time_hrs double, "
    "base_response_mins int, resolved_in_first_contact int, reopened int, sla_compliance int, "
    "days_in_backlog int, backlog_status string, satisfaction_score double, role_title string"
)


def ticket_values(spark, column, cases):
    return values(spark, column, cases, TICKET, TICKET_DDL)


def test_ticket_times(spark):
    names = ["Billing Dispute", "Water Quality", "Leakage", "Pressure Issues", "No Water"]
    got = ticket_values(
        spark, service.resolution_time_hrs(), [{"issue_category": n} for n in names]
    )
    assert got == [3.0, 3.0, 2.6, 2.6, 2.0]
    channels = ["Phone", "Web Portal", "Mobile App", "Letter"]
    got = ticket_values(
        spark, service.response_time_mins(), [{"issue_channel": n} for n in channels]
    )
    assert got == [4, 6, 6, 10]
    tiny = [{"issue_channel": "Phone", "base_response_mins": 1}]
    assert ticket_values(spark, service.response_time_mins(), tiny) == [1]


def test_survey_scores(spark):
    cases = [
        {"resolved_in_first_contact": 1},
        {"reopened": 1, "sla_compliance": 0},
        {"sla_compliance": 0},
        {},
    ]
    assert ticket_values(spark, service.satisfaction_score(), cases) == [4.0, 2.0, 3.0, 3.5]
    low = service.satisfaction_score(F.lit(-3.0))
    assert ticket_values(spark, low, cases) == [1.0, 1.0, 1.0, 1.0]
    scores = [{"satisfaction_score": s} for s in (4.4, 3.0, 2.9, 1.0)]
    assert ticket_values(spark, service.nps_score(), scores) == [5, 0, 0, -8]
    assert ticket_values(spark, service.effort_score(), scores) == [1.6, None, None, None]
    assert ticket_values(spark, service.effort_score(F.lit(4.0)), scores) == [1.6, 4.0, 4.0, 4.0]


def test_backlog_rules(spark):
    days = [{"days_in_backlog": d} for d in (3, 4, 7, 8, 14, 15)]
    ages = ["0-3 days", "4-7 days", "4-7 days", "8-14 days", "8-14 days", "15+ days"]
    assert ticket_values(spark, service.backlog_age_category(), days) == ages
    flags = [
        {"sla_compliance": 0, "reopened": 1},
        {"sla_compliance": 0},
        {"reopened": 1},
        {},
    ]
    assert ticket_values(spark, service.priority(), flags) == ["Critical", "High", "Medium", "Low"]
    assert ticket_values(spark, service.is_escalated(), flags) == [True, True, True, False]
    levels = [{"sla_compliance": 0, "days_in_backlog": d} for d in (6, 7, 14, 21, 30)]
    assert ticket_values(spark, service.escalation_level(), levels) == [0, 1, 2, 3, 3]
    assert ticket_values(spark, service.escalation_level(), days) == [0] * 6
    assert ticket_values(spark, service.backlog_sla_breached(), days) == [0, 0, 0, 1, 1, 1]
    assert ticket_values(spark, service.allowed_statuses(), [flags[1], {"days_in_backlog": 15}, {}]) == [
        ["Escalated", "In Progress"],
        ["Pending", "On Hold"],
        ["Pending", "In Progress"],
    ]
    reasons = ticket_values(
        spark,
        service.allowed_reasons(),
        [
            {"backlog_status": "Escalated", "issue_category": "Leakage"},
            {"issue_category": "Water Quality"},
            {"issue_category": "No Water"},
            {"issue_category": "Technical Support"},
        ],
    )
    assert [r[0] for r in reasons] == [
        "Escalated to Technical Team",
        "Pending Customer Response",
        "Parts Unavailable",
        "Pending Customer Response",
    ]


def test_base_utilization_order(spark):
    roles = ["Supervisor", "Team Lead", "Senior Agent", "Agent", "", None, "Senior Supervisor"]
    got = ticket_values(spark, service.base_utilization(), [{"role_title": r} for r in roles])
    assert got == [0.85, 0.80, 0.75, 0.70, 0.70, 0.70, 0.85]


def test_season_and_tariff(spark):
    months = spark.sql("select explode(sequence(date'2025-01-15', date'2025-12-15', interval 1 month)) date_id")
    rows = months.select(service.season(), service.season_band()).collect()
    names = ["dry"] * 3 + ["transition"] * 2 + ["rainy"] * 5 + ["transition", "dry"]
    assert [r[0] for r in rows] == names
    assert rows[0][1] == (1.1, 1.3) and rows[5][1] == (0.7, 0.9) and rows[10][1] == (0.9, 1.1)
    tariffs = spark.createDataFrame(
        [(t,) for t in ("Domestic", "Commercial", "Industrial", "Government", "Non-Profit")],
        "tariff_category string",
    )
    assert [r[0] for r in tariffs.select(service.tariff_rate()).collect()] == [
        0.57, 1.35, 1.50, 1.20, 0.85,
    ]


def test_sensor_status_and_calibration(spark):
    ddl = (
        "raw_value double, threshold_min double, threshold_max double, critical_low double, "
        "critical_high double, facility_type string, sensor_type string"
    )
    points = [2.0, 2.4, 2.5, 8.5, 8.6, 10.0, 1.9, 10.1, None]
    df = spark.createDataFrame(
        [(p, 2.5, 8.5, 2.0, 10.0, "dam", "water_level") for p in points], ddl
    )
    got = [r[0] for r in df.select(sensing.reading_status()).collect()]
    assert got == [
        "critical", "warning", "normal", "normal", "warning", "critical", "critical", "critical", None,
    ]
    kinds = [
        ("dam", "water_level", 15.0),
        ("reservoir", "water_level", 12.0),
        ("pumping_station", "pressure", 13.0),
        ("dam", "pressure", 10.0),
        ("treatment_plant", "water_level", 10.0),
    ]
    rows = spark.createDataFrame([(10.0, 0.0, 1.0, 0.0, 1.0, k, s) for k, s, _ in kinds], ddl)
    assert [r[0] for r in rows.select(sensing.calibrated()).collect()] == [v for _, _, v in kinds]
