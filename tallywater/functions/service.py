"""Ticket, backlog and billing rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallywater.functions.steps import choose, clamp, first_step, flag, text_choice

# Work factors by category, channel and role.
COMPLEXITY = {
    "Billing Dispute": 1.5,
    "Water Quality": 1.5,
    "Leakage": 1.3,
    "Pressure Issues": 1.3,
}
RESPONSE_FACTORS = {"Phone": 0.8, "Web Portal": 1.2, "Mobile App": 1.2}
RESPONSE_OTHER = 2.0
BASE_UTILIZATION = {"Supervisor": 0.85, "Team Lead": 0.80, "Senior": 0.75}
BASE_UTILIZATION_OTHER = 0.70
MAX_UTILIZATION = 0.98

# Backlog ages, states and reasons.
AGE_STEPS = [("<=", 3, "0-3 days"), ("<=", 7, "4-7 days"), ("<=", 14, "8-14 days")]
AGE_OTHER = "15+ days"
STATUS_ESCALATED = ("Escalated", "In Progress")
STATUS_OLD = ("Pending", "On Hold")
STATUS_NEW = ("Pending", "In Progress")
REASONS_ESCALATED = (
    "Escalated to Technical Team",
    "Complex Investigation Required",
    "Senior Specialist Review Needed",
)
REASONS_DOCUMENTS = (
    "Pending Customer Response",
    "Document Verification Required",
    "Third Party Dependency",
)
REASONS_FIELD = ("Parts Unavailable", "Field Team Scheduled", "Weather Delay")
REASONS_OTHER = (
    "Pending Customer Response",
    "Complex Investigation Required",
    "Third Party Dependency",
)

# Tariffs, seasons, discounts and payment delays.
TARIFF_RATES = {"Domestic": 0.57, "Commercial": 1.35, "Industrial": 1.50, "Government": 1.20}
TARIFF_OTHER = 0.85
SEASON_MONTHS = {"dry": (12, 1, 2, 3), "rainy": (6, 7, 8, 9, 10)}
SEASON_BANDS = {"dry": (1.1, 1.3), "rainy": (0.7, 0.9), "transition": (0.9, 1.1)}
DISCOUNT_TARIFF = ("Non-Profit", 0.05, 0.20)
DISCOUNT_SEGMENT = ("Government", 0.05, 0.15)
LATE_BANDS = {"reliable": (0, 7), "occasional_late": (3, 20)}
LATE_OTHER = (15, 45)


def complexity_factor() -> Column:
    return choose("issue_category", COMPLEXITY, 1.0)


def resolution_time_hrs(base: str = "base_time_hrs") -> Column:
    return F.round(F.col(base) * complexity_factor(), 2)


def response_time_mins(base: str = "base_response_mins") -> Column:
    factor = choose("issue_channel", RESPONSE_FACTORS, RESPONSE_OTHER)
    return F.greatest(F.lit(1), (F.col(base) * factor).cast("int"))


def satisfaction_score(jitter: Column | None = None) -> Column:
    score = (
        F.lit(3.5)
        + 0.5 * flag(F.col("resolved_in_first_contact") == 1)
        - 1.0 * flag(F.col("reopened") == 1)
        - 0.5 * flag(F.col("sla_compliance") == 0)
    )
    return F.round(clamp(score + (F.lit(0.0) if jitter is None else jitter), 1.0, 5.0), 1)


def nps_score() -> Column:
    return ((F.col("satisfaction_score") - 3) * 4).cast("int")


def effort_score(low_effort: Column | None = None) -> Column:
    """Easy contacts follow the satisfaction; for the others the given value, if any."""
    given = F.lit(None).cast("double") if low_effort is None else low_effort
    happy = F.col("satisfaction_score") > 3
    return F.when(happy, F.round(6 - F.col("satisfaction_score"), 1)).otherwise(given)


def is_unresolved() -> Column:
    """Everything not flagged 1, also a ticket without the flag: each ticket goes one way."""
    return ~F.col("resolved_in_first_contact").eqNullSafe(1)


def is_escalated() -> Column:
    missed, again = F.col("sla_compliance").eqNullSafe(0), F.col("reopened").eqNullSafe(1)
    return is_unresolved() & (missed | again)


def base_utilization(role: str = "role_title") -> Column:
    return text_choice(role, BASE_UTILIZATION, BASE_UTILIZATION_OTHER)


def backlog_age_category() -> Column:
    return first_step("days_in_backlog", AGE_STEPS, AGE_OTHER)


def priority() -> Column:
    missed, again = F.col("sla_compliance") == 0, F.col("reopened") == 1
    return (
        F.when(missed & again, "Critical")
        .when(missed, "High")
        .when(again, "Medium")
        .otherwise("Low")
    )


def _texts(values: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def allowed_statuses() -> Column:
    return (
        F.when(is_escalated(), _texts(STATUS_ESCALATED))
        .when(F.col("days_in_backlog") > 14, _texts(STATUS_OLD))
        .otherwise(_texts(STATUS_NEW))
    )


def allowed_reasons() -> Column:
    category = F.col("issue_category")
    return (
        F.when(F.col("backlog_status") == "Escalated", _texts(REASONS_ESCALATED))
        .when(category.isin("Billing Dispute", "Water Quality"), _texts(REASONS_DOCUMENTS))
        .when(category.isin("Leakage", "No Water"), _texts(REASONS_FIELD))
        .otherwise(_texts(REASONS_OTHER))
    )


def pick(options: Column, spread: Column) -> Column:
    """A repeatable choice from an array."""
    return F.get(options, F.pmod(spread, F.size(options)).cast("int"))


def escalation_level() -> Column:
    weeks = F.floor(F.col("days_in_backlog") / 7).cast("int")
    return F.when(is_escalated(), F.least(F.lit(3), weeks)).otherwise(F.lit(0))


def backlog_sla_breached() -> Column:
    return flag((F.col("days_in_backlog") > 7) | (F.col("sla_compliance") == 0))


def tariff_rate(tariff: str = "tariff_category") -> Column:
    return choose(tariff, TARIFF_RATES, TARIFF_OTHER)


def season(day: str = "date_id") -> Column:
    month = F.month(day)
    return (
        F.when(month.isin(*SEASON_MONTHS["dry"]), "dry")
        .when(month.isin(*SEASON_MONTHS["rainy"]), "rainy")
        .otherwise("transition")
    )


def season_band(day: str = "date_id") -> Column:
    """Lowest and highest consumption multiplier of the season."""
    name = season(day)
    low = choose(name, {k: v[0] for k, v in SEASON_BANDS.items()}, None)
    high = choose(name, {k: v[1] for k, v in SEASON_BANDS.items()}, None)
    return F.struct(low.alias("low"), high.alias("high"))


def discount_ceiling() -> Column:
    """Largest discount the account may get; 0 where it may get none."""
    tariff, _, most = DISCOUNT_TARIFF
    segment, _, less = DISCOUNT_SEGMENT
    return (
        F.when(F.col("tariff_category") == tariff, F.lit(most))
        .when(F.col("customer_segment") == segment, F.lit(less))
        .otherwise(F.lit(0.0))
    )


def discount_applied(given: str = "discount") -> Column:
    return F.when(discount_ceiling() > 0, F.col(given)).otherwise(F.lit(0.0))


def discount_valid(applied: str = "discount_applied") -> Column:
    """A discount is absent, or between 0.05 and the ceiling of the account."""
    amount = F.col(applied)
    return flag((amount == 0) | amount.between(F.lit(DISCOUNT_TARIFF[1]), discount_ceiling()))


def days_late(given: str = "days_late") -> Column:
    """Lateness counts only for paid bills."""
    return F.when(F.col("payment_status") == "Paid", F.col(given)).otherwise(F.lit(0)).cast("int")


def days_late_expected(payer: str = "payer_class") -> Column:
    """Whether a paid bill's delay lies in the band of its payer class."""
    low = choose(payer, {k: v[0] for k, v in LATE_BANDS.items()}, LATE_OTHER[0])
    high = choose(payer, {k: v[1] for k, v in LATE_BANDS.items()}, LATE_OTHER[1])
    return flag((F.col("payment_status") != "Paid") | F.col("days_late").between(low, high))
