"""Burnout rules: labels, contextual risk, productivity and recommendations.

Every function returns a column over the feature columns of
``operators.features``. Missing measurements never satisfy a threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallywater.functions.steps import choose, clamp, count_reached, first_step, flag

# Class names in order of severity and in code (alphabetical) order.
SEVERITY = ("Low", "Medium", "High", "Critical")
CODES = ("Critical", "High", "Low", "Medium")

# Label thresholds.
CRITICAL_SIGNS = {
    "utilization_rate": 0.90,
    "escalation_rate": 0.22,
    "backlog": 12,
    "sla_breaches": 5,
    "stress_index": 0.65,
}
EXTREME_SIGNS = {"utilization_rate": 0.95, "escalation_rate": 0.30, "backlog": 20}
HIGH_SIGNS = {
    "utilization_rate": 0.78,
    "escalation_rate": 0.12,
    "backlog": 7,
    "sla_breaches": 3,
    "persistent_backlog": 1,
    "performance_declining": 1,
    "stress_index": 0.50,
}
MEDIUM_SIGNS = {
    "utilization_rate": 0.65,
    "backlog": 4,
    "stress_index": 0.40,
    "escalation_rate": 0.08,
    "sla_breaches": 1,
}

# Weight of each class in the base score.
CLASS_WEIGHTS = {"Low": 0.0, "Medium": 0.33, "High": 0.67, "Critical": 1.0}

# Contextual adjustments, each list read top down.
UTILIZATION_STEPS = [(">", 0.95, 0.10), (">", 0.85, 0.05), ("<", 0.60, -0.05)]
BACKLOG_STEPS = [(">", 15, 0.05), (">", 10, 0.03)]
DECLINING_STEPS = [(">=", 1, 0.08)]
TREND_STEPS = [(">", 0.10, 0.04), ("<", -0.10, -0.04)]
ESCALATION_STEPS = [(">", 0.25, 0.06), (">", 0.15, 0.03)]
BREACH_STEPS = [(">=", 5, 0.04), (">=", 3, 0.02)]
PERSISTENT_STEPS = [(">=", 1, 0.05)]
VELOCITY_STEPS = [(">", 5, 0.03), ("<", -5, -0.03)]
HANDLE_TIME_STEPS = [(">", 1.20, 0.05), (">", 1.10, 0.03), ("<", 0.90, -0.03)]
VOLUME_STEPS = [(">", 10, 0.04), ("<", 3, -0.03)]
REOPENED_STEPS = [(">", 3, 0.03)]

# Recommendation texts and flat reductions.
DAILY_ACTIONS = {
    "Low": "Continue monitoring",
    "Medium": "Proactive check-in scheduled",
    "High": "Redistribute 5-8 cases immediately",
    "Critical": "URGENT: Mandatory rest + workload redistribution",
}
HISTORY_ACTIONS = {
    "Low": "Continue monitoring",
    "Medium": "Proactive check-in",
    "High": "Redistribute workload",
    "Critical": "Immediate intervention",
}
HISTORY_REDUCTIONS = {"Critical": 35, "High": 20, "Medium": 10, "Low": 0}

# Reduction per class: start, extra steps, cap.
REDUCTIONS = {
    "Critical": (35, [("utilization_rate", 0.95, 5), ("backlog", 20, 5)], 50),
    "High": (20, [("utilization_rate", 0.90, 5), ("backlog", 15, 3)], 30),
    "Medium": (
        10,
        [("utilization_rate", 0.85, 3), ("backlog", 10, 2), ("escalation_rate", 0.15, 2)],
        15,
    ),
}


def stress_index() -> Column:
    breaches = F.least(F.col("sla_breaches") / F.lit(10), F.lit(1.0))
    return (
        F.col("escalation_rate") * 0.3 + breaches * 0.4 + F.col("utilization_rate") * 0.3
    )


def performance_declining() -> Column:
    return flag(F.col("avg_handle_time_7d") > F.col("avg_handle_time_30d") * 1.15)


def persistent_backlog() -> Column:
    return flag(F.col("backlog") > 10)


def tenure_months(day: str = "date_id", hired: str = "hire_date") -> Column:
    return (F.datediff(day, hired) / 30).cast("int")


def burnout_label() -> Column:
    severe = (count_reached(CRITICAL_SIGNS) >= 2) | (count_reached(EXTREME_SIGNS) >= 1)
    return (
        F.when(severe, "Critical")
        .when(count_reached(HIGH_SIGNS) >= 2, "High")
        .when(count_reached(MEDIUM_SIGNS) >= 1, "Medium")
        .otherwise("Low")
    )


def label_code(label: Column | str) -> Column:
    """Alphabetical class code: Critical 0, High 1, Low 2, Medium 3."""
    return choose(label, {name: code for code, name in enumerate(CODES)}, None).cast("int")


def label_of_code(code: Column | str) -> Column:
    return choose(code, dict(enumerate(CODES)), None)


def risk_rank(label: Column | str) -> Column:
    """Ordered severity for users: Low 0 up to Critical 3."""
    return choose(label, {name: rank for rank, name in enumerate(SEVERITY)}, None).cast("int")


def base_risk(probability: Column | str = "probability") -> Column:
    """Expected class weight; ``probability`` is an array in code order."""
    p = F.col(probability) if isinstance(probability, str) else probability
    parts = [
        F.coalesce(F.get(p, F.lit(CODES.index(name))), F.lit(0.0)) * weight
        for name, weight in CLASS_WEIGHTS.items()
    ]
    return sum(parts[1:], parts[0])


def confidence(probability: Column | str = "probability") -> Column:
    return F.array_max(probability)


def _handle_time_ratio_steps() -> Column:
    """The 7-day handle time against multiples of the 30-day one."""
    chosen = F
    for symbol, factor, value in HANDLE_TIME_STEPS:
        month = F.col("avg_handle_time_30d") * factor
        week = F.col("avg_handle_time_7d")
        chosen = chosen.when(week > month if symbol == ">" else week < month, F.lit(value))
    return chosen.otherwise(F.lit(0.0))


def risk_factors() -> dict[str, Column]:
    """The six contextual adjustments by name."""
    return {
        "workload_factor": first_step("utilization_rate", UTILIZATION_STEPS, 0.0)
        + first_step("backlog", BACKLOG_STEPS, 0.0),
        "decline_factor": first_step("performance_declining", DECLINING_STEPS, 0.0)
        + first_step("utilization_trend", TREND_STEPS, 0.0),
        "quality_factor": first_step("escalation_rate", ESCALATION_STEPS, 0.0)
        + first_step("sla_breaches", BREACH_STEPS, 0.0),
        "persistence_factor": first_step("persistent_backlog", PERSISTENT_STEPS, 0.0)
        + first_step("workload_velocity", VELOCITY_STEPS, 0.0),
        "efficiency_factor": _handle_time_ratio_steps(),
        "volume_factor": first_step("total_tickets_handled", VOLUME_STEPS, 0.0)
        + first_step("reopened_tickets", REOPENED_STEPS, 0.0),
    }


def burnout_risk_score(probability: Column | str = "probability") -> Column:
    factors = list(risk_factors().values())
    return clamp(base_risk(probability) + sum(factors[1:], factors[0]), 0.0, 1.0)


def productivity_parts() -> dict[str, Column]:
    """Throughput, quality, efficiency and utilisation shares of the productivity index."""
    tickets, handle = F.col("total_tickets_handled"), F.col("avg_handle_time_mins")
    month, used = F.col("avg_handle_time_30d"), F.col("utilization_rate")
    over_escalated = F.greatest(F.lit(0.0), F.col("escalation_rate") - 0.10) * 0.5
    reopened = F.col("reopened_tickets") / F.greatest(F.lit(1), tickets) * 0.3
    return {
        "throughput": F.least(F.lit(0.30), tickets / F.lit(8.0) * 0.30),
        "quality": F.greatest(F.lit(0.0), F.lit(0.35) - over_escalated - reopened),
        "efficiency": F.when(handle <= month * 0.90, 0.25)
        .when(handle <= month * 1.10, 0.20)
        .when(handle <= month * 1.20, 0.15)
        .otherwise(0.10),
        "utilization_share": F.when(used.between(0.70, 0.85), 0.10)
        .when(used.between(0.60, 0.90), 0.07)
        .otherwise(0.03),
    }


def productivity_index() -> Column:
    parts = list(productivity_parts().values())
    return clamp(sum(parts[1:], parts[0]), 0.0, 1.0)


def workload_reduction_pct(label: str = "risk_category") -> Column:
    chosen = F
    for name, (start, extras, cap) in REDUCTIONS.items():
        total = F.lit(start)
        for column, bound, extra in extras:
            total = total + flag(F.col(column) > bound) * extra
        chosen = chosen.when(F.col(label) == name, F.least(total, F.lit(cap)))
    low = (
        F.when(F.col("utilization_rate") > 0.80, 3)
        .when(F.col("backlog") > 8, 2)
        .when(F.col("stress_index") > 0.55, 2)
        .otherwise(0)
    )
    return chosen.otherwise(low).cast("int")


def recommended_action(label: str = "risk_category", texts: dict[str, str] = DAILY_ACTIONS):
    return choose(label, texts, "")


def flat_reduction(label: str = "risk_category") -> Column:
    return choose(label, HISTORY_REDUCTIONS, 0).cast("int")
