"""Canonical inputs of the library, derived from the given sample tables."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, timedelta
from functools import lru_cache, reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallywater.operators import features, performance, sensors as sensor_ops, tickets as ticket_ops
from tallywater.session import fresh_folder, stored
from tallywater.sources.network import SAMPLE, facility_dimension, sample_network, sensor_dimension

EPOCH = date(1995, 1, 1)
FIRST_DAY = date(2025, 1, 1)
DENSE_DAYS = 60
GAPPY_DAYS = 600
YEAR_DAYS = 365
AGENT_DIGITS = 7
CYCLE = "1 hour"
CYCLE_SECONDS = 3600
MEASURED_ON = date(2026, 1, 1)

# Texts that rules compare (first five categories, three channels, roles, tariffs,
# payers); the others are made up.
CATEGORIES = (
    "Billing Dispute", "Water Quality", "Leakage", "No Water", "Pressure Issues",
    "New Connection", "Hydrant Hire", "Garden Metering", "Works Notice", "Tour Booking",
)
CHANNELS = ("Phone", "Letter", "Web Portal", "Mobile App", "Counter", "Field Crew")
METHODS = (
    "Giro", "Standing Order", "Kiosk", "Voucher", "Payroll", "Wallet",
)
TARIFFS = ("Domestic", "Commercial", "Industrial", "Government", "Non-Profit")
MARKETS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
SEGMENTS = ("Residential", "Business", "Government", "Industrial")
ROLES = ("Agent", "Senior Agent", "Team Lead", "Supervisor")
DEPARTMENTS = (
    "Catchments", "Pipelines", "Sampling", "Front Desk", "Accounts", "Night Crew", "Stores",
)
PAYERS = ("reliable", "occasional_late", "problematic")


@lru_cache(maxsize=None)
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; files are listed and schemas read once per session."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def listed(values: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(index, F.lit(len(values))).cast("int"))


def service_day(days: int) -> Column:
    elapsed = F.datediff(F.to_date("l_shipdate"), F.lit(EPOCH))
    return F.date_add(F.lit(FIRST_DAY), F.pmod(elapsed, F.lit(days)))


_LINES: dict[str, DataFrame] = {}
LINE = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag",
    "l_linestatus", "l_shipdate",
)


@contextmanager
def joined_lines(spark: SparkSession, sf: str) -> Iterator[None]:
    """Inside, tickets and bills come from lines that were joined with their customers once and written:
    every join of its own would shuffle all lines again. An order's customer brings its account context
    along (a list, as ids may repeat), so that the lines needn't move by customer either."""
    context = customers(spark, sf).groupBy("customer_id").agg(
        F.collect_list(F.struct("customer_segment", "tariff_category")).alias("context")
    )
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"))
    rows = table(spark, sf, "lineitem").select(*LINE).join(orders.join(context, "customer_id", "left"), "l_orderkey")
    _LINES[sf] = stored(rows, "lines")
    try:
        yield
    finally:
        del _LINES[sf]


def lines(spark: SparkSession, sf: str, customers: bool) -> DataFrame:
    """Order lines, with the customer of the order only where it is needed."""
    rows = table(spark, sf, "lineitem")
    if not customers:
        return rows
    if sf in _LINES:
        return _LINES[sf]
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id")
    )
    return rows.join(orders, "l_orderkey")


def raw_tickets(
    spark: SparkSession, sf: str, days: int = DENSE_DAYS, customers: bool = False, gaps: bool = False
) -> DataFrame:
    """Tickets from order lines; with ``gaps`` every thirteenth lacks the flag of resolution."""
    unresolved = F.col("l_returnflag") == "R"
    resolved = (~unresolved).cast("int")
    if gaps:
        resolved = F.when(F.col("l_partkey") % 13 != 0, resolved)
    return lines(spark, sf, customers).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ticket_id"),
        service_day(days).alias("date_id"),
        (F.col("l_suppkey") + 1).alias("agent_id"),
        (F.pmod(F.col("l_suppkey"), F.lit(7)) + 1).alias("facility_id"),
        (F.pmod(F.col("l_suppkey") + 1, F.lit(2)) + 4).alias("department_id"),
        listed(CATEGORIES, F.col("l_partkey")).alias("issue_category"),
        listed(CHANNELS, F.col("l_orderkey")).alias("issue_channel"),
        (F.col("l_quantity") / 10).alias("base_time_hrs"),
        (F.pmod("l_partkey", F.lit(15)) + 1).alias("base_response_mins"),
        resolved.alias("resolved_in_first_contact"),
        (unresolved & (F.col("l_linestatus") == "O")).cast("int").alias("reopened"),
        (F.col("l_discount") <= 0.07).cast("int").alias("sla_compliance"),
        (F.pmod(F.col("l_quantity").cast("int"), F.lit(30)) + 1).alias("days_in_backlog"),
        ((F.pmod("l_partkey", F.lit(11)) - 5) / 10.0).alias("jitter"),
        (F.lit(3.5) + F.pmod("l_orderkey", F.lit(16)) / 10.0).alias("low_effort"),
        *([F.col("customer_id")] if customers else []),
    )


def tickets(
    spark: SparkSession, sf: str, days: int = DENSE_DAYS, customers: bool = False, gaps: bool = False
) -> DataFrame:
    return ticket_ops.score_tickets(raw_tickets(spark, sf, days, customers, gaps))


def agents(spark: SparkSession, sf: str, gaps: bool = False) -> DataFrame:
    """Agents from suppliers; with ``gaps`` every fourth is missing from the dimension."""
    number = F.col("s_suppkey") + 1
    known = table(spark, sf, "supplier")
    return (known.where("s_suppkey % 4 <> 1") if gaps else known).select(
        number.alias("agent_id"),
        F.col("s_name").alias("agent_name"),
        (F.pmod(number, F.lit(2)) + 4).alias("department_id"),
        listed(ROLES, number).alias("role_title"),
        F.date_sub(F.lit(FIRST_DAY), (F.pmod(number, F.lit(40)) * 100).cast("int")).alias(
            "hire_date"
        ),
        F.lit("Active").alias("status"),
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    tariff = F
    for market, name in zip(MARKETS, TARIFFS):
        tariff = tariff.when(F.col("c_mktsegment") == market, F.lit(name))
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("ACC-"), (F.col("c_custkey") + 100000).cast("string")).alias("account_no"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit("District "), (F.pmod("c_custkey", F.lit(9)) + 1).cast("string")).alias(
            "district"
        ),
        tariff.otherwise("").alias("tariff_category"),
        listed(SEGMENTS, F.col("c_nationkey")).alias("customer_segment"),
    )


def departments(spark: SparkSession) -> DataFrame:
    rows = [(n, name) for n, name in enumerate(DEPARTMENTS, start=1)]
    return spark.createDataFrame(rows, "department_id long, department_name string")


def performance_rows(
    spark: SparkSession,
    sf: str,
    days: int = DENSE_DAYS,
    every_agent: bool = True,
    gaps: bool = False,
) -> DataFrame:
    """Stored performance with the rule's own utilisation."""
    return performance.agent_daily_performance(
        tickets(spark, sf, days, gaps=gaps),
        agents(spark, sf, gaps),
        FIRST_DAY,
        FIRST_DAY + timedelta(days=days - 1),
        every_agent=every_agent,
        agent_digits=AGENT_DIGITS,
    )


def varied_performance(
    spark: SparkSession, sf: str, days: int = DENSE_DAYS, every_agent: bool = True
) -> DataFrame:
    """Performance with a utilisation that covers all label classes."""
    used = F.round(F.least(F.lit(0.98), F.lit(0.40) + F.col("total_tickets_handled") * 0.03), 2)
    return performance_rows(spark, sf, days, every_agent).withColumn("utilization_rate", used)


def scored_features(spark: SparkSession, sf: str) -> DataFrame:
    """Features of every agent-day with repeatable class probabilities."""
    rows = features.fill_numbers(features.agent_features(varied_performance(spark, sf)))
    return with_probabilities(rows.drop("is_latest"))


def with_probabilities(rows: DataFrame) -> DataFrame:
    weights = [
        F.pmod(
            F.col("agent_id") * (k + 3) + F.dayofyear("date_id") * (2 * k + 1), F.lit(10)
        )
        + 1
        for k in range(4)
    ]
    total = reduce(lambda a, b: a + b, weights)
    shared = rows.withColumn("probability", F.array(*[w / total for w in weights]))
    top = F.array_position("probability", F.array_max("probability")) - 1
    return shared.withColumn("risk_category", listed(("Critical", "High", "Low", "Medium"), top))


def usage(spark: SparkSession, sf: str, days: int = YEAR_DAYS) -> DataFrame:
    """Consumption rows with account context, one year of days or fewer."""
    context = customers(spark, sf).select("customer_id", "customer_segment", "tariff_category")
    status = (
        F.when(F.col("l_returnflag") == "A", "Paid")
        .when(F.col("l_returnflag") == "N", "Pending")
        .otherwise("Overdue")
    )
    given = lines(spark, sf, True)
    rows = given.select(
        "customer_id",
        F.col("l_orderkey").alias("billing_id"),
        service_day(days).alias("date_id"),
        (F.pmod(F.col("l_suppkey"), F.lit(7)) + 1).alias("facility_id"),
        (F.col("l_quantity") * 2).alias("base_consumption"),
        (F.lit(0.7) + F.pmod("l_partkey", F.lit(7)) / 10).alias("seasonal_factor"),
        (F.lit(0.8) + F.pmod("customer_id", F.lit(5)) / 10).alias("customer_factor"),
        (F.col("l_discount") * 2).alias("discount"),
        status.alias("payment_status"),
        F.pmod(F.col("l_suppkey"), F.lit(46)).cast("int").alias("days_late"),
        listed(PAYERS, F.col("l_linenumber")).alias("payer_class"),
        listed(METHODS, F.col("l_linenumber")).alias("payment_method"),
        *(["context"] if sf in _LINES else []),
    )
    if sf in _LINES:
        return rows.select("*", F.inline("context")).drop("context")
    return rows.join(context, "customer_id")


def facilities(spark: SparkSession) -> DataFrame:
    return facility_dimension(sample_network(spark))


def sensors(spark: SparkSession) -> DataFrame:
    return sensor_dimension(sample_network(spark))


_NETWORK = json.loads(Path(SAMPLE).read_text(encoding="utf-8"))
SENSOR_TYPES = tuple(_NETWORK["sensors"])
FACILITIES = tuple(_NETWORK["facilities"])


def readings_of(events: DataFrame, sensor_dim: DataFrame) -> DataFrame:
    """One raw reading per event row, scaled to the bounds of its sensor."""
    named = events.select(
        F.col("event_id").alias("reading_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        listed(SENSOR_TYPES, F.col("event_id")).alias("sensor_type"),
        listed(FACILITIES, F.col("user_id")).alias("facility_name"),
        "value",
    )
    span = F.col("critical_high") - F.col("critical_low")
    bounds = sensor_dim.select("sensor_type", "critical_low", "critical_high")
    raw = F.round(F.col("critical_low") + (F.col("value") - 10) / 60 * span, 2)
    scaled = named.join(bounds, "sensor_type").withColumn("raw_value", raw)
    return scaled.drop("value", "critical_low", "critical_high")


def classified(spark: SparkSession, sf: str) -> DataFrame:
    dim = sensors(spark)
    return sensor_ops.classify_readings(readings_of(table(spark, sf, "events"), dim), dim)


def calibrated(spark: SparkSession, sf: str) -> DataFrame:
    return sensor_ops.calibrate_readings(classified(spark, sf), facilities(spark))


def sensor_events(spark: SparkSession, sf: str) -> DataFrame:
    return sensor_ops.build_events(calibrated(spark, sf), facilities(spark), CYCLE)


def single_events(calibrated_rows: DataFrame) -> DataFrame:
    """Each reading as an event of its own: no aggregation, so it also runs on a stream."""
    rank = F.when(F.col("status") == "critical", 2).when(F.col("status") == "warning", 1).otherwise(0)
    reading = F.struct("value", "unit", "status", "threshold_min", "threshold_max")
    return calibrated_rows.select(
        F.col("reading_id").cast("string").alias("event_id"),
        "timestamp",
        F.struct(
            F.col("facility_name").alias("name"), F.col("facility_type").alias("type")
        ).alias("facility"),
        F.create_map("sensor_type", reading).alias("sensors"),
        F.struct(
            F.get(F.array(F.lit("operational"), F.lit("warning"), F.lit("critical")), rank).alias(
                "status"
            ),
            F.get(F.array(F.lit(0), F.lit(2), F.lit(3)), rank).alias("alert_level"),
        ).alias("operational_metrics"),
    )


PARTS = 3
# Files of a part: four, or more where these would be longer than so many rows.
FILES = 4
FILE_ROWS = 100_000
_EVENT_FOLDERS: dict[tuple[str, str, bool], tuple[str, int]] = {}


def event_files(spark: SparkSession, sf: str, in_order: bool) -> tuple[str, int]:
    """The events table in ``PARTS`` parts of equally many files, written one part after the other: thirds
    of its time, or (not ``in_order``) thirds by id, so that most rows of the later parts are older
    than the first. A part is written by all executors and read as one batch; the number of its files
    follows its rows, so that no task reads more as the table grows."""
    key = (spark.sparkContext.applicationId, sf, in_order)
    if key in _EVENT_FOLDERS:
        return _EVENT_FOLDERS[key]
    folder = fresh_folder(spark, "events")
    rows = table(spark, sf, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = (rows.agg(f(micros)).scalar() for f in (F.min, F.max))
    third = F.floor((micros - first) * PARTS / (last - first + 1))
    part = third if in_order else F.pmod("event_id", F.lit(PARTS))
    longest = rows.groupBy(part.alias("part")).count().where("part IS NOT NULL").agg(F.max("count")).first()[0] or 0
    files = max(FILES, -(-longest // FILE_ROWS))
    for n in range(PARTS):
        rows.where(part == n).repartition(files).write.mode("append").parquet(folder)
    _EVENT_FOLDERS[key] = folder, files
    return _EVENT_FOLDERS[key]


def event_stream(spark: SparkSession, sf: str, in_order: bool = True) -> DataFrame:
    """The events table as a stream of single-reading events, joined to the dimensions; a part
    is a batch."""
    schema = table(spark, sf, "events").schema
    folder, files = event_files(spark, sf, in_order)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)
    dim = sensors(spark)
    rated = sensor_ops.classify_readings(readings_of(stream, dim), dim)
    return single_events(sensor_ops.calibrate_readings(rated, facilities(spark)))


class GivenProbabilities:
    """Stands in for a trained model: the repeatable probabilities, no Critical on even days."""

    version = "v1.0_forest"

    def score(self, rows: DataFrame) -> DataFrame:
        rated = with_probabilities(rows)
        even = F.dayofmonth("date_id") % 2 == 0
        lowered = F.when(even & (F.col("risk_category") == "Critical"), "High")
        return rated.withColumn("risk_category", F.coalesce(lowered, "risk_category"))
