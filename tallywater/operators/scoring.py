"""Turn class probabilities and features into stored prediction records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallywater.functions import risk
from tallywater.operators.joins import one_row_per_day
from tallywater.operators.ranking import number_within
from tallywater.schemas import TABLES

# Fewest agents and lowest score for a forced Critical.
FORCE_AGENTS = 10
FORCE_SCORE = 0.6
SCORE_DIGITS = 9
FORCE_REDUCTION = 35

HISTORY_PRODUCTIVITY = 0.75
AGENTS_PER_BLOCK = 1024

# Stored column for each current measurement.
CURRENT = {
    "current_utilization": "utilization_rate",
    "current_backlog": "backlog",
    "current_escalation_rate": "escalation_rate",
    "current_sla_breaches": "sla_breaches",
    "current_stress_index": "stress_index",
    "current_handle_time_mins": "avg_handle_time_mins",
    "current_total_tickets": "total_tickets_handled",
    "current_reopened_tickets": "reopened_tickets",
}


def score_daily(scored: DataFrame) -> DataFrame:
    """Risk, productivity and advice for rows with ``probability`` and ``risk_category``."""
    return scored.withColumns(
        {
            "burnout_risk_score": risk.burnout_risk_score(),
            "productivity_index": risk.productivity_index(),
            "risk_category_encoded": risk.label_code("risk_category"),
            "workload_reduction_pct": risk.workload_reduction_pct(),
            "recommended_action": risk.recommended_action(),
            "confidence_score": risk.confidence(),
        }
    )


def score_history(scored: DataFrame) -> DataFrame:
    """The simpler record of the historical backfill: top probability and flat advice."""
    return scored.withColumns(
        {
            "burnout_risk_score": risk.confidence(),
            "productivity_index": F.lit(HISTORY_PRODUCTIVITY),
            "risk_category_encoded": risk.label_code("risk_category"),
            "workload_reduction_pct": risk.flat_reduction(),
            "recommended_action": risk.recommended_action(texts=risk.HISTORY_ACTIONS),
            "confidence_score": risk.confidence(),
        }
    )


def ensure_critical(scored: DataFrame, day: str = "date_id") -> DataFrame:
    """On a day with ten agents or more and no Critical, the top scorer above 0.6 becomes one.

    Scores are compared to nine digits; the lowest agent id wins a tie. Days are summed up
    first, then the few rows
    that reach the top score of a day in need; no task ever holds or sorts all
    agents of a day.
    """
    critical = (F.col("risk_category") == "Critical").cast("int")
    compared = F.round("burnout_risk_score", SCORE_DIGITS)
    days = scored.groupBy(day).agg(
        F.count("*").alias("_agents"),
        F.max(critical).alias("_critical"),
        F.max(compared).alias("_top"),
    )
    needy = days.where(
        (F.col("_agents") >= FORCE_AGENTS)
        & (F.col("_critical") == 0)
        & (F.col("_top") > FORCE_SCORE)
    ).select(day, "_top")
    leaders = scored.join(one_row_per_day(needy), day).where(compared == F.col("_top"))
    chosen = leaders.groupBy(day).agg(F.min("agent_id").alias("_chosen"))
    joined = scored.join(one_row_per_day(chosen), day, "left")
    forced = F.col("agent_id") == F.col("_chosen")
    new = {
        "risk_category": F.lit("Critical"),
        "risk_category_encoded": F.lit(risk.CODES.index("Critical")),
        "workload_reduction_pct": F.lit(FORCE_REDUCTION),
        "recommended_action": F.lit(risk.DAILY_ACTIONS["Critical"]),
    }
    changed = {name: F.when(forced, value).otherwise(F.col(name)) for name, value in new.items()}
    return joined.withColumns(changed).drop("_chosen")


def number_predictions(scored: DataFrame, day: str = "date_id") -> DataFrame:
    """``prediction_id`` 1, 2, ... per day in agent order."""
    blocks = scored.withColumn("_block", F.floor(F.col("agent_id") / AGENTS_PER_BLOCK))
    numbered = number_within(blocks, [day], ["_block"], ["agent_id"], "prediction_id")
    return numbered.drop("_block")


def prediction_record(scored: DataFrame, model_version: str | None = None) -> DataFrame:
    """The stored 30-column record."""
    spec = TABLES["fact_agent_burnout_prediction"]
    version = F.lit(model_version) if model_version else spec.default("model_version")

    def source(name: str) -> Column:
        if name == "model_version":
            return version
        return F.col(CURRENT.get(name, name))

    return scored.select(
        *[source(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields]
    )
