"""Agent-day performance from tickets."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tallywater.functions import service
from tallywater.functions.steps import exact_sum, ratio
from tallywater.operators.joins import lookup
from tallywater.operators.tickets import DEFAULT_DEPARTMENT

# Fixed value: decimal digits that the agent has at least inside a performance id.
AGENT_DIGITS = 2


def agent_day_totals(tickets: DataFrame) -> DataFrame:
    """Per agent and day: tickets, reopened, breaches, backlog, escalations, handle time.

    Partial sums are built before the shuffle, so a busy agent-day arrives as
    one row per input partition.
    """
    return tickets.groupBy("date_id", "agent_id").agg(
        F.count("*").alias("total"),
        F.sum("reopened").alias("reopened"),
        F.sum(1 - F.col("sla_compliance")).alias("breaches"),
        F.count_if(service.is_unresolved()).alias("open"),
        F.count_if(service.is_escalated()).alias("escalated"),
        exact_sum("resolution_time_hrs").alias("hours"),
    )


def agent_calendar(agents: DataFrame, start: Column | date, end: Column | date) -> DataFrame:
    """One row per agent and calendar day: the grain of the performance table."""
    first, last = (d if isinstance(d, Column) else F.lit(d) for d in (start, end))
    return agents.select(
        "agent_id",
        "department_id",
        "role_title",
        F.explode(F.sequence(first, last)).alias("date_id"),
    )


def agent_width(agents: DataFrame, totals: DataFrame) -> Column:
    """Digits of the largest agent id, known or not, and at least two."""
    largest = agents.select("agent_id").union(totals.select("agent_id")).agg(F.max("agent_id"))
    digits = F.length(F.coalesce(largest.scalar(), F.lit(0)).cast("string"))
    return F.greatest(digits, F.lit(AGENT_DIGITS))


def agent_daily_performance(
    tickets: DataFrame,
    agents: DataFrame,
    start: Column | date | None = None,
    end: Column | date | None = None,
    every_agent: bool = True,
    agent_digits: int | None = None,
) -> DataFrame:
    """Performance rows for every agent of every day, also those without tickets.

    The days run from ``start`` to ``end``, by default the first and last
    ticket day. With ``every_agent=False`` only agent-days with tickets appear.
    Tickets of agents missing from the dimension (department 4, no role), without
    an agent, or of days outside the range have their rows in either form, so the
    totals are those of the tickets. ``performance_id`` holds the day and then the
    agent in as many digits as the largest agent id needs, or in ``agent_digits``.
    """
    totals = agent_day_totals(tickets)
    about = agents.select("agent_id", "department_id", "role_title")
    unknown = {"department_id": DEFAULT_DEPARTMENT, "role_title": ""}
    if every_agent:
        first = start if start is not None else tickets.agg(F.min("date_id")).scalar()
        last = end if end is not None else tickets.agg(F.max("date_id")).scalar()
        days = agent_calendar(agents, first, last).drop("department_id", "role_title")
        totals = days.join(totals, ["date_id", "agent_id"], "full")
    grain = lookup(totals, about, "agent_id", unknown)
    digits = agent_width(agents, totals) if agent_digits is None else F.lit(agent_digits)
    counted = grain.na.fill(0, subset=["total", "reopened", "breaches", "open", "escalated"])
    counted = counted.na.fill(0.0, subset=["hours"])
    total, open_ = F.col("total"), F.col("open")
    busy = service.base_utilization() + total / 100
    stamp = F.date_format("date_id", "yyyyMMdd").cast("long")
    return counted.select(
        (stamp * F.pow(F.lit(10), digits).cast("long") + F.coalesce("agent_id", F.lit(0))).alias(
            "performance_id"
        ),
        "date_id",
        "agent_id",
        "department_id",
        total.cast("int").alias("total_tickets_handled"),
        F.round(F.col("hours") * 60 / F.greatest(F.lit(1), total), 1).alias(
            "avg_handle_time_mins"
        ),
        F.round(F.col("escalated") / F.greatest(F.lit(1), total), 3).alias("escalation_rate"),
        open_.cast("int").alias("backlog"),
        F.col("reopened").cast("int").alias("reopened_tickets"),
        F.round(F.least(F.lit(service.MAX_UTILIZATION), busy), 2).alias("utilization_rate"),
        F.col("breaches").cast("int").alias("sla_breaches"),
        F.round(ratio(total - open_, total, 100.0), 2).alias("resolution_rate"),
    )


def day_totals(perf: DataFrame) -> DataFrame:
    """Per day: tickets, backlog and resolved over all agents, and the number of agents."""
    return perf.groupBy("date_id").agg(
        F.sum("total_tickets_handled").alias("tickets"),
        F.sum("backlog").alias("backlog"),
        F.sum(F.col("total_tickets_handled") - F.col("backlog")).alias("resolved"),
        F.count("*").alias("agents"),
    )
