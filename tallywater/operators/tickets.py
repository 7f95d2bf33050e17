"""Ticket scoring, routing to resolved or backlog, and backlog records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallywater.functions import service
from tallywater.functions.steps import exact_sum
from tallywater.operators.joins import lookup
from tallywater.operators.ranking import number_rows

DEFAULT_DEPARTMENT = 4
KEY_BLOCKS = 1024
#: What a row takes from its customer's account; where rows carry it along, in a list (ids may repeat).
CONTEXT = ("customer_segment", "tariff_category", "district")
ACCOUNTS = "_accounts"


def key_block(key: str) -> Column:
    """One of many equal shares of the keys: numbering runs per day and share, so a day
    of any size is spread, whoever handled its tickets."""
    return F.pmod(F.xxhash64(key), F.lit(KEY_BLOCKS))


def score_tickets(tickets: DataFrame) -> DataFrame:
    """Times and survey scores from ``base_time_hrs``, ``base_response_mins`` and the flags.

    Optional inputs: ``jitter`` shifts the satisfaction, ``low_effort`` is the
    effort score of unhappy contacts.
    """
    jitter = F.col("jitter") if "jitter" in tickets.columns else None
    effort = F.col("low_effort") if "low_effort" in tickets.columns else None
    return (
        tickets.withColumns(
            {
                "resolution_time_hrs": service.resolution_time_hrs(),
                "response_time_mins": service.response_time_mins(),
                "satisfaction_score": service.satisfaction_score(jitter),
            }
        )
        .withColumns(
            {"nps_score": service.nps_score(), "effort_score": service.effort_score(effort)}
        )
    )


def with_agent(tickets: DataFrame, agents: DataFrame) -> DataFrame:
    """Department (4 when unknown) and role (empty when unknown) of each ticket's agent."""
    about = agents.select("agent_id", "department_id", "role_title")
    return lookup(
        tickets, about, "agent_id", {"department_id": DEFAULT_DEPARTMENT, "role_title": ""}
    )


def with_customer(tickets: DataFrame, customers: DataFrame) -> DataFrame:
    """Segment, tariff and district of each ticket's customer, empty when unknown."""
    if ACCOUNTS in tickets.columns:
        return tickets.select("*", F.inline(ACCOUNTS)).drop(ACCOUNTS)
    about = customers.select("customer_id", *CONTEXT)
    return lookup(tickets, about, "customer_id", {name: "" for name in CONTEXT})


def with_accounts(dealt: DataFrame, customers: DataFrame, key: str, tasks: int) -> DataFrame:
    """Rows that lie in ``tasks`` by ``_block`` (see ``key_block``), with the accounts of their customer.

    Wide rows stay where they are: keys and customers travel to the dimension and back, so a busy
    customer doesn't gather rows either. ``with_facility`` and ``with_customer`` then find what they
    look up in the row. Plan it inside ``co_partitioned``, else the rows move to be joined.
    """
    about = F.struct(*[F.coalesce(name, F.lit("")).alias(name) for name in CONTEXT])
    accounts = customers.groupBy("customer_id").agg(F.collect_list(about).alias(ACCOUNTS))
    asked = dealt.select(key, "customer_id").join(accounts, "customer_id")
    # A struct, as nulls inside of one are equal.
    pair = {"_pair": F.struct(F.col(key), F.col("customer_id"))}
    told = asked.repartition(tasks, key_block(key)).withColumn("_block", key_block(key)).withColumns(pair)
    told = told.select("_block", "_pair", ACCOUNTS).dropDuplicates(["_block", "_pair"])
    joined = dealt.withColumns(pair).join(told, ["_block", "_pair"], "left")
    unknown = F.array(F.struct(*[F.lit("").alias(name) for name in CONTEXT]))
    return joined.select(*dealt.columns, F.coalesce(ACCOUNTS, unknown).alias(ACCOUNTS))


def assign_facility(rows: DataFrame, facilities: DataFrame, spread: Column) -> DataFrame:
    """A facility of the row's district, or any facility where the district has none.

    ``spread`` is a whole number per row; the choice is repeatable. The facilities of a district are
    one array, looked up by district, and the row takes the element that its number points at; those
    of all districts are a single value of the plan. Without facilities the column is null.
    """
    ids = F.array_sort(F.collect_list("facility_id"))
    known = facilities.where(F.col("facility_id").isNotNull())
    by_district = known.groupBy("district").agg(ids.alias("_ids"))
    everywhere = known.agg(ids).scalar()
    placed = lookup(rows, by_district, "district")
    choices = F.coalesce("_ids", everywhere)
    place = F.pmod(spread, F.nullif(F.size(choices), F.lit(0))) + 1
    return placed.withColumn("facility_id", F.try_element_at(choices, place.cast("int"))).drop("_ids")


def with_facility(rows: DataFrame, customers: DataFrame, facilities: DataFrame, spread: str) -> DataFrame:
    """Rows with a facility of their customer's district; a given ``facility_id`` is kept."""
    if "facility_id" in rows.columns:
        return rows
    plain = rows.drop("district")
    if ACCOUNTS in rows.columns:
        others = [name for name in plain.columns if name != "customer_id"]
        known = plain.select("customer_id", *others, F.explode(f"{ACCOUNTS}.district").alias("district"))
    else:
        known = lookup(plain, customers.select("customer_id", "district"), "customer_id", {"district": ""})
    return assign_facility(known, facilities, F.col(spread)).drop("district")


def resolved_tickets(tickets: DataFrame) -> DataFrame:
    return tickets.where(~service.is_unresolved())


def unresolved_tickets(tickets: DataFrame) -> DataFrame:
    return tickets.where(service.is_unresolved())


def ticket_metrics(tickets: DataFrame) -> DataFrame:
    """Per agent and day: tickets, mean satisfaction, reopened and SLA breaches."""
    score = "satisfaction_score"
    return tickets.groupBy("date_id", "agent_id").agg(
        F.count("*").alias("total_tickets"),
        (exact_sum(score) / F.count(score)).alias("avg_csat"),
        F.sum("reopened").cast("long").alias("reopened_count"),
        F.count_if(F.col("sla_compliance") == 0).alias("sla_breach_count"),
    )


def triage(unresolved: DataFrame) -> DataFrame:
    """Age, priority, state, level, reason and dates of unresolved tickets.

    ``days_in_backlog`` is given. A given ``backlog_status``, ``backlog_reason``
    or ``days_to_resolve`` is kept and checked against the allowed set; where
    absent, one is chosen repeatably from the ticket id.
    """
    spread = F.col("ticket_id")
    given = unresolved.columns

    def kept(name: str, chosen: Column) -> Column:
        return F.coalesce(F.col(name), chosen) if name in given else chosen

    staged = unresolved.withColumns(
        {
            "is_escalated": service.is_escalated().cast("int"),
            "backlog_age_category": service.backlog_age_category(),
            "priority": service.priority(),
            "allowed_statuses": service.allowed_statuses(),
            "escalation_level": service.escalation_level(),
            "sla_breached": service.backlog_sla_breached(),
        }
    ).withColumn(
        "backlog_status", kept("backlog_status", service.pick(F.col("allowed_statuses"), spread))
    )
    reasoned = staged.withColumn("allowed_reasons", service.allowed_reasons()).withColumn(
        "backlog_reason", kept("backlog_reason", service.pick(F.col("allowed_reasons"), spread))
    )
    wait = kept("days_to_resolve", (F.pmod(spread, F.lit(7)) + 1)).cast("int")
    return reasoned.withColumns(
        {
            "status_valid": F.array_contains("allowed_statuses", F.col("backlog_status")).cast("int"),
            "reason_valid": F.array_contains("allowed_reasons", F.col("backlog_reason")).cast("int"),
            "assigned_date": F.date_sub("date_id", F.col("days_in_backlog")),
            "expected_resolution_date": F.date_add("date_id", wait),
            "last_updated": F.col("date_id"),
            "reopened_count": F.col("reopened"),
            "resolution_notes": F.lit(""),
        }
    )


def build_backlog(
    unresolved: DataFrame, customers: DataFrame, last_id: Column | int = 0, dealt: bool = False
) -> DataFrame:
    """Backlog records: triage, customer context and ids continuing after ``last_id``.

    Rows of few days that were ``dealt`` by a ``_block`` are numbered where they are.
    """
    triaged = with_customer(triage(unresolved), customers)
    spaced = triaged if dealt else triaged.withColumn("_block", key_block("ticket_id"))
    numbered = number_rows(
        spaced, [["date_id"], ["_block"]], ["ticket_id"], "backlog_id", last_id, few=dealt
    )
    return numbered.drop("_block", "allowed_statuses", "allowed_reasons")
