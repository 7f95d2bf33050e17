"""KPI measures: department drill-downs, executive summary and per-entity measures.

Facts are summed to the grain of the join key before dimensions are joined, so
a customer or department with a large share of the rows costs one row per input
partition. Money, hours and scores are summed as whole ten-thousandths, so the
result does not depend on the order of partial sums, and sums of days can be
added to and taken from sums over all days.

Every measure is made of sums: ``*_sums`` reads facts, ``*_of`` turns sums into
measures. The functions named after a measure do both; ``plans.jobs`` keeps the
sums per day and adds up only what changed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallywater.functions.steps import UNITS, ratio, units
from tallywater.operators.joins import lookup
from tallywater.operators.ranking import number_rows
from tallywater.schemas import TABLES

OVERALL = "Overall"


def _drilldown(
    parts: DataFrame, departments: DataFrame, table: str, scale: int = 1
) -> DataFrame:
    """``parts`` holds date_id, department_id, ``part`` and ``whole``; adds the overall rows.

    Parts are whole numbers, ``scale`` to the unit. Department 0 stands for the
    whole organisation.
    """
    by_department = parts.groupBy("date_id", "department_id").agg(
        F.sum("part").alias("part"), F.sum("whole").alias("whole")
    )
    grouped = by_department.groupingSets(
        [["date_id"], ["date_id", "department_id"]], "date_id", "department_id"
    ).agg(
        F.sum("part").alias("part"),
        F.sum("whole").alias("whole"),
        F.grouping("department_id").alias("_overall"),
    )
    valued = grouped.select(
        F.when(F.col("_overall") == 1, F.lit(0)).otherwise(F.col("department_id")).alias(
            "department_id"
        ),
        F.col("date_id").alias("measure_date"),
        ratio(F.col("part") / scale, F.col("whole")).cast("decimal(18,4)").alias("measure_value"),
    )
    names = departments.select("department_id", "department_name")
    named = lookup(valued, names, "department_id").withColumn(
        "department_name",
        F.when(F.col("department_id") == 0, F.lit(OVERALL)).otherwise(
            F.coalesce("department_name", F.lit(""))
        ),
    )
    numbered = number_rows(named, [["measure_date"]], ["department_id"], "measure_id")
    spec = TABLES[table]
    return numbered.withColumn("parent_kpi", spec.default("parent_kpi")).select(*spec.columns)


def performance_department_sums(perf: DataFrame) -> DataFrame:
    return perf.groupBy("date_id", "department_id").agg(
        F.sum(F.col("total_tickets_handled") - F.col("backlog")).alias("resolved"),
        F.sum("total_tickets_handled").alias("handled"),
    )


def tickets_department_sums(tickets: DataFrame) -> DataFrame:
    return tickets.groupBy("date_id", "department_id").agg(
        F.sum(units("satisfaction_score")).alias("csat"),
        F.count("satisfaction_score").alias("rated"),
        F.sum(units("resolution_time_hrs")).alias("hours"),
        F.count("resolution_time_hrs").alias("timed"),
        F.sum("sla_compliance").alias("met"),
        F.count("*").alias("judged"),
        F.sum("nps_score").alias("nps"),
    )


def backlog_department_sums(backlog: DataFrame) -> DataFrame:
    return backlog.groupBy("date_id", "department_id").agg(
        F.sum(1 - F.col("sla_breached")).alias("met"), F.count("*").alias("judged")
    )


def _parts(sums: DataFrame, part: Column, whole: str) -> DataFrame:
    return sums.select("date_id", "department_id", part.alias("part"), F.col(whole).alias("whole"))


def resolution_rate_of(sums: DataFrame, departments: DataFrame) -> DataFrame:
    parts = _parts(sums, F.col("resolved") * 100, "handled")
    return _drilldown(parts, departments, "meas_resolution_rate_drilldown")


def csat_of(sums: DataFrame, departments: DataFrame) -> DataFrame:
    parts = _parts(sums, F.col("csat"), "rated")
    return _drilldown(parts, departments, "meas_csat_drilldown", UNITS)


def sla_of(tickets: DataFrame, backlog: DataFrame, departments: DataFrame) -> DataFrame:
    """Resolved tickets and open backlog together, so open breaches count as well."""
    met = F.col("met") * 100
    parts = _parts(tickets, met, "judged").unionByName(_parts(backlog, met, "judged"))
    return _drilldown(parts, departments, "meas_sla_compliance_drilldown")


def resolution_time_of(sums: DataFrame, departments: DataFrame) -> DataFrame:
    parts = _parts(sums, F.col("hours"), "timed")
    return _drilldown(parts, departments, "meas_avg_resolution_time_drilldown", UNITS)


def resolution_rate_drilldown(perf: DataFrame, departments: DataFrame) -> DataFrame:
    return resolution_rate_of(performance_department_sums(perf), departments)


def csat_drilldown(tickets: DataFrame, departments: DataFrame) -> DataFrame:
    return csat_of(tickets_department_sums(tickets), departments)


def sla_drilldown(tickets: DataFrame, backlog: DataFrame, departments: DataFrame) -> DataFrame:
    return sla_of(tickets_department_sums(tickets), backlog_department_sums(backlog), departments)


def resolution_time_drilldown(tickets: DataFrame, departments: DataFrame) -> DataFrame:
    return resolution_time_of(tickets_department_sums(tickets), departments)


def _long(df: DataFrame, ids: list[str], measures: dict[str, Column]) -> DataFrame:
    """Wide measures to ``measure_name``/``measure_value`` rows; measures without value drop."""
    wide = df.select(*ids, *[c.cast("double").alias(n) for n, c in measures.items()])
    melted = wide.unpivot(ids, list(measures), "measure_name", "measure_value")
    return melted.where(F.col("measure_value").isNotNull())


def billing_day_sums(billing: DataFrame) -> DataFrame:
    return billing.groupBy("date_id").agg(F.sum(units("billed_amount")).alias("billed"))


def executive_summary(
    perf: DataFrame, tickets: DataFrame, backlog: DataFrame, billing: DataFrame
) -> DataFrame:
    """Organisation-wide measures per day in long form; every fact is read once."""
    return executive_summary_of(
        performance_department_sums(perf),
        tickets_department_sums(tickets),
        backlog_department_sums(backlog),
        billing_day_sums(billing),
    )


def executive_summary_of(
    perf: DataFrame, tickets: DataFrame, backlog: DataFrame, billing: DataFrame
) -> DataFrame:
    solved = tickets.withColumn("tickets", F.col("judged"))
    daily = [df.drop("department_id") for df in (perf, solved, backlog, billing)]
    stacked = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), daily)
    sums = stacked.groupBy("date_id").agg(
        *[F.sum(c).alias(c) for c in stacked.columns if c != "date_id"]
    )

    def mean(part: Column, whole: str) -> Column:
        return F.when(F.col(whole) > 0, part / F.col(whole))

    measures = {
        "Resolution Rate %": mean(F.col("resolved") * 100, "handled"),
        "CSAT Score": mean(F.col("csat") / UNITS, "rated"),
        "SLA Compliance %": mean(F.col("met") * 100, "judged"),
        "Avg Resolution Time": mean(F.col("hours") / UNITS, "timed"),
        "NPS": mean(F.col("nps"), "tickets"),
        "Ticket Count": F.col("tickets"),
        "Total Billed": F.col("billed") / UNITS,
    }
    dated = sums.withColumnRenamed("date_id", "measure_date")
    melted = _long(dated, ["measure_date"], measures)
    numbered = number_rows(melted, [["measure_date"]], ["measure_name"], "measure_id")
    return numbered.select(*TABLES["meas_executive_summary"].columns)


def tickets_customer_sums(tickets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sums per customer and category; with ``by`` of every day for itself."""
    return tickets.groupBy(*by, "customer_id", "issue_category").agg(
        F.sum(units("satisfaction_score")).alias("csat"),
        F.count("satisfaction_score").alias("rated"),
        F.sum("resolved_in_first_contact").alias("first"),
        F.sum("sla_compliance").alias("met"),
        F.sum("nps_score").alias("nps"),
        F.sum(units("effort_score")).alias("effort"),
        F.count("effort_score").alias("efforts"),
        F.sum("response_time_mins").alias("response"),
        F.count("*").alias("n"),
    )


def customer_service_measures(
    tickets: DataFrame, customers: DataFrame, measured_on: Column | None = None
) -> DataFrame:
    """Satisfaction, first-contact, SLA, NPS, effort and response by district and category."""
    return customer_service_of(tickets_customer_sums(tickets), customers, measured_on)


def customer_service_of(
    sums: DataFrame, customers: DataFrame, measured_on: Column | None = None
) -> DataFrame:
    places = customers.select("customer_id", "district")
    grouped = (
        lookup(sums, places, "customer_id", {"district": ""})
        .groupBy("district", "issue_category")
        .agg(*[F.sum(name).alias(name) for name in sums.columns if name not in ("customer_id", "issue_category")])
    )
    n = F.col("n")
    measures = {
        "CSAT Score": F.when(F.col("rated") > 0, ratio(F.col("csat") / UNITS, n)),
        "First Contact Resolution %": ratio(F.col("first"), n, 100.0),
        "SLA Compliance %": ratio(F.col("met"), n, 100.0),
        "NPS": ratio(F.col("nps"), n),
        "Effort Score": F.when(
            F.col("efforts") > 0, F.col("effort") / UNITS / F.col("efforts")
        ),
        "Response Time Mins": ratio(F.col("response"), n),
    }
    melted = _long(grouped, ["district", "issue_category"], measures)
    dated = melted.withColumn("measure_date", measured_on if measured_on is not None else F.current_date())
    numbered = number_rows(
        dated, [["district", "issue_category"]], ["measure_name"], "measure_id"
    )
    return numbered.select(*TABLES["meas_customer_service"].columns)


def performance_agent_sums(perf: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    total = F.col("total_tickets_handled")
    return perf.groupBy(*by, "agent_id").agg(
        F.sum(total).alias("n"),
        F.sum(units(F.col("avg_handle_time_mins") * total)).alias("minutes"),
        F.sum(units(F.col("escalation_rate") * total)).alias("escalated"),
        F.sum(total - F.col("backlog")).alias("resolved"),
        F.sum(units("utilization_rate")).alias("used"),
        F.count("*").alias("days"),
    )


def agent_measures(perf: DataFrame, measured_on: Column | None = None) -> DataFrame:
    """Handle time (ticket-weighted), utilisation, resolution and escalation per agent."""
    return agent_measures_of(performance_agent_sums(perf), measured_on)


def agent_measures_of(sums: DataFrame, measured_on: Column | None = None) -> DataFrame:
    n = F.col("n")
    measures = {
        "Avg Handle Time Mins": ratio(F.col("minutes") / UNITS, n),
        "Utilization Rate": F.col("used") / UNITS / F.col("days"),
        "Resolution Rate %": ratio(F.col("resolved"), n, 100.0),
        "Escalation Rate": ratio(F.col("escalated") / UNITS, n),
    }
    return _per_entity(_long(sums, ["agent_id"], measures), "agent_id", "measure_date",
                       "meas_agent_performance", measured_on)


def billing_customer_sums(billing: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    amount, status = units("billed_amount"), F.col("payment_status")
    paid_late = F.when(status == "Paid", F.col("days_late"))
    return billing.groupBy(*by, "customer_id").agg(
        F.sum(amount).alias("billed"),
        F.sum(units("consumption_m3")).alias("consumption"),
        F.sum(F.when(status == "Paid", amount).otherwise(0)).alias("paid"),
        F.sum(F.when(status == "Overdue", amount).otherwise(0)).alias("overdue"),
        F.sum(units("discount_applied")).alias("discount"),
        F.count("*").alias("n"),
        F.sum(paid_late).alias("late"),
        F.count(paid_late).alias("paid_bills"),
    )


def billing_measures(
    billing: DataFrame, customers: DataFrame, measured_on: Column | None = None
) -> DataFrame:
    """Billed amount, consumption, collected and overdue share, mean discount per segment."""
    return billing_measures_of(billing_customer_sums(billing), customers, measured_on)


def billing_measures_of(
    sums: DataFrame, customers: DataFrame, measured_on: Column | None = None
) -> DataFrame:
    segments = customers.select("customer_id", "customer_segment")
    grouped = (
        lookup(sums, segments, "customer_id", {"customer_segment": ""})
        .groupBy("customer_segment")
        .agg(*[F.sum(c).alias(c) for c in sums.columns if c != "customer_id"])
    )
    measures = {
        "Total Billed": F.col("billed") / UNITS,
        "Total Consumption": F.col("consumption") / UNITS,
        "Collection Rate %": ratio(F.col("paid"), F.col("billed"), 100.0),
        "Overdue %": ratio(F.col("overdue"), F.col("billed"), 100.0),
        "Avg Discount": ratio(F.col("discount") / UNITS, F.col("n")),
    }
    melted = _long(grouped, ["customer_segment"], measures)
    dated = melted.withColumn("measure_date", measured_on if measured_on is not None else F.current_date())
    numbered = number_rows(dated, [["customer_segment"]], ["measure_name"], "measure_id")
    return numbered.select(*TABLES["meas_billing"].columns)


def customer_measures(
    tickets: DataFrame, billing: DataFrame, measured_on: Column | None = None
) -> DataFrame:
    """Ticket count, mean satisfaction and mean lateness of paid bills per customer."""
    return customer_measures_of(
        tickets_customer_sums(tickets), billing_customer_sums(billing), measured_on
    )


def customer_measures_of(
    tickets: DataFrame, billing: DataFrame, measured_on: Column | None = None
) -> DataFrame:
    contacts = tickets.groupBy("customer_id").agg(
        F.sum("n").alias("n"), F.sum("csat").alias("csat"), F.sum("rated").alias("rated")
    )
    csat = F.when(F.col("rated") > 0, F.col("csat") / UNITS / F.col("rated"))
    late = F.when(F.col("paid_bills") > 0, F.col("late") / F.col("paid_bills"))
    rows = _long(
        contacts, ["customer_id"], {"Ticket Count": F.col("n"), "Mean CSAT": csat}
    ).unionByName(_long(billing, ["customer_id"], {"Mean Days Late": late}))
    return _per_entity(rows, "customer_id", "prediction_date", "meas_predictive", measured_on)


def _per_entity(
    rows: DataFrame, entity: str, day: str, table: str, measured_on: Column | None
) -> DataFrame:
    """Number measure rows in entity order; ids are grouped in two sizes of block."""
    blocks = rows.withColumns(
        {"_coarse": F.shiftright(entity, 20), "_fine": F.shiftright(entity, 10)}
    )
    numbered = number_rows(
        blocks, [["_coarse"], ["_fine"]], [entity, "measure_name"], "measure_id"
    )
    dated = numbered.withColumn(day, measured_on if measured_on is not None else F.current_date())
    return dated.select(*TABLES[table].columns)
