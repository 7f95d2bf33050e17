"""Sensor readings to facility events, and the reports over those events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywater.functions import sensing
from tallywater.operators.joins import join_keeping_nulls

CYCLE = "2 seconds"
CYCLE_SECONDS = 2
UNKNOWN_CHAIN = "Unknown"


def classify_readings(readings: DataFrame, sensors: DataFrame) -> DataFrame:
    """Readings of configured sensor types with unit, bounds and status."""
    about = sensors.select(
        "sensor_type", "unit", "threshold_min", "threshold_max", "critical_low",
        "critical_high", "analytics_category",
    )
    return readings.join(about, "sensor_type").withColumn("status", sensing.reading_status())


def calibrate_readings(classified: DataFrame, facilities: DataFrame) -> DataFrame:
    """Add the facility type and the calibrated ``value``; the status stays that of the raw one."""
    kinds = facilities.select("facility_name", "facility_type")
    placed = classified.join(kinds, "facility_name", "left")
    return placed.withColumn("value", sensing.calibrated())


def facility_status(readings: DataFrame, keys: list[str]) -> DataFrame:
    """Worst reading per event: status, alert level and number of sensors."""
    ranked = readings.groupBy(*keys).agg(
        F.max(sensing.severity()).alias("_rank"),
        F.countDistinct("sensor_type").alias("active_sensors"),
    )
    return ranked.select(
        *keys,
        sensing.facility_status(F.col("_rank")).alias("status"),
        sensing.alert_level(F.col("_rank")).alias("alert_level"),
        "active_sensors",
    )


def build_events(readings: DataFrame, facilities: DataFrame, cycle: str = CYCLE) -> DataFrame:
    """One nested event per facility and cycle from classified, calibrated readings.

    The newest reading of a sensor wins inside a cycle; ``reading_id`` may be a number
    or a text. That first step combines
    before the shuffle, and afterwards an event holds one entry per configured
    sensor type, however many readings a busy facility sent.
    """
    number = sensing.reading_number("reading_id", dict(readings.dtypes)["reading_id"])
    order = sensing.reading_order("timestamp", number)
    cycles = readings.withColumns({"_cycle": F.window("timestamp", cycle)["start"], "_order": order})
    about = ["unit", "threshold_min", "threshold_max"]
    per_sensor = cycles.groupBy("facility_name", "_cycle", "sensor_type", *about).agg(
        F.max_by("value", "_order").alias("value"),
        F.max_by(sensing.severity(), F.col("_order")).alias("_rank"),
    )
    status = sensing.reading_status_of(F.col("_rank"), F.col("value")).alias("status")
    reading = F.struct("value", "unit", status, "threshold_min", "threshold_max")
    entries = F.array_sort(F.collect_list(F.struct("sensor_type", reading.alias("reading"))))
    per_event = per_sensor.groupBy("facility_name", "_cycle").agg(
        F.map_from_entries(entries).alias("sensors"), F.max("_rank").alias("_rank")
    )
    placed = per_event.join(facilities, "facility_name", "left")
    identity = F.md5(F.concat_ws("|", "facility_name", F.col("_cycle").cast("string")))
    return placed.select(
        identity.alias("event_id"),
        F.col("_cycle").alias("timestamp"),
        F.struct(
            F.col("facility_name").alias("name"),
            F.col("facility_type").alias("type"),
            "district",
            "capacity_mld",
            F.struct("latitude", "longitude").alias("location"),
            "supply_chain",
            "upstream_facility",
            "downstream_facility",
        ).alias("facility"),
        "sensors",
        F.struct(
            sensing.facility_status(F.col("_rank")).alias("status"),
            sensing.alert_level(F.col("_rank")).alias("alert_level"),
            F.size("sensors").alias("active_sensors"),
            F.lit(None).cast("double").alias("uptime_percentage"),
        ).alias("operational_metrics"),
        F.struct(
            sensing.device_id("facility_type", "facility_name").alias("device_id"),
            F.lit(None).cast("string").alias("firmware_version"),
            F.lit(None).cast("double").alias("battery_level"),
            F.lit(None).cast("double").alias("network_signal"),
        ).alias("metadata"),
    )


def explode_sensors(events: DataFrame) -> DataFrame:
    """One row per event and sensor."""
    each = events.select(
        "event_id",
        "timestamp",
        F.col("facility.name").alias("facility_name"),
        F.col("facility.type").alias("facility_type"),
        F.explode("sensors").alias("sensor_type", "reading"),
    )
    return each.select(
        "event_id", "timestamp", "facility_name", "facility_type", "sensor_type", "reading.*"
    )


def expected_sensors(facilities: DataFrame, sensors: DataFrame) -> DataFrame:
    """Sensor types a facility should report, sorted: its priority sensors that are configured,
    or, where there are none, every configured type that fits its kind."""
    named = facilities.select(
        "facility_name", F.explode("priority_sensors").alias("sensor_type")
    ).join(sensors.select("sensor_type"), "sensor_type", "left_semi")
    kinds = sensors.select("sensor_type", F.explode("facility_types").alias("facility_type"))
    fitting = facilities.join(named, "facility_name", "left_anti").join(kinds, "facility_type")
    wanted = named.select("facility_name", "sensor_type").unionByName(
        fitting.select("facility_name", "sensor_type")
    )
    lists = wanted.groupBy("facility_name").agg(
        F.array_sort(F.collect_set("sensor_type")).alias("expected")
    )
    none = F.array().cast("array<string>")
    return facilities.select("facility_name").join(lists, "facility_name", "left").select(
        "facility_name", F.coalesce("expected", none).alias("expected")
    )


def missing_sensors(events: DataFrame, expected: DataFrame) -> DataFrame:
    """Per event the expected sensor types and those that did not report."""
    seen = events.select(
        "event_id",
        "timestamp",
        F.col("facility.name").alias("facility_name"),
        F.map_keys("sensors").alias("_seen"),
    )
    return seen.join(expected, "facility_name", "left").select(
        "event_id",
        "timestamp",
        "facility_name",
        "expected",
        F.array_intersect("expected", "_seen").alias("present"),
        F.array_except("expected", "_seen").alias("missing"),
    )


def event_status() -> Column:
    return F.col("operational_metrics.status")


def anomaly_report(events: DataFrame) -> DataFrame:
    """Facilities in warning or critical state with their offending readings as text."""
    bad = F.filter(F.map_entries("sensors"), lambda e: e["value"]["status"] != "normal")
    texts = F.transform(
        F.array_sort(bad),
        lambda e: F.concat(
            e["key"], F.lit(": "), e["value"]["value"].cast("string"), e["value"]["unit"]
        ),
    )
    return events.where(sensing.is_anomalous(event_status())).select(
        "event_id",
        "timestamp",
        F.upper(event_status()).alias("status"),
        F.col("facility.name").alias("facility_name"),
        F.col("facility.supply_chain").alias("supply_chain"),
        F.array_join(texts, ", ").alias("anomalies"),
    )


def cycle_summary(events: DataFrame, cycle: str = CYCLE) -> DataFrame:
    """Per cycle: facilities that reported and facilities in an anomalous state."""
    return (
        events.groupBy(F.window("timestamp", cycle).alias("_cycle"))
        .agg(
            F.count("*").alias("facilities"),
            F.count_if(sensing.is_anomalous(event_status())).alias("anomalous"),
        )
        .select(
            F.col("_cycle.start").alias("cycle_start"),
            F.col("_cycle.end").alias("cycle_end"),
            "facilities",
            "anomalous",
        )
    )


def stream_totals(
    events: DataFrame, cycle: str = CYCLE, cycle_seconds: float = CYCLE_SECONDS
) -> DataFrame:
    """One row: cycles, events, anomalies, anomaly percent and events per second."""
    cycles = cycle_summary(events, cycle)
    sums = cycles.agg(
        F.count("*").alias("cycles"),
        F.coalesce(F.sum("facilities"), F.lit(0)).alias("events"),
        F.coalesce(F.sum("anomalous"), F.lit(0)).alias("anomalies"),
    )
    return sums.withColumns(
        {
            "anomaly_pct": F.when(
                F.col("events") > 0, F.col("anomalies") / F.col("events") * 100
            ).otherwise(0.0),
            "events_per_second": F.when(
                F.col("cycles") > 0, F.col("events") / (F.col("cycles") * F.lit(cycle_seconds))
            ).otherwise(0.0),
        }
    )


def category_rollup(classified: DataFrame) -> DataFrame:
    """Readings and anomalies per analytics category."""
    grouped = classified.groupBy("analytics_category").agg(
        F.count("*").alias("readings"),
        F.countDistinct("sensor_type").alias("sensor_types"),
        F.count_if(F.col("status") == "warning").alias("warnings"),
        F.count_if(F.col("status") == "critical").alias("criticals"),
    )
    bad = F.col("warnings") + F.col("criticals")
    return grouped.withColumn("anomaly_pct", bad / F.col("readings") * 100)


def supply_chains(facilities: DataFrame) -> DataFrame:
    """Facilities of each chain as text, in name order."""
    line = F.concat(
        "facility_name", F.lit(" ("), "facility_type", F.lit(") - "), "district"
    )
    named = facilities.withColumn(
        "supply_chain", F.coalesce("supply_chain", F.lit(UNKNOWN_CHAIN))
    )
    return named.groupBy("supply_chain").agg(
        F.count("*").alias("facilities"),
        F.array_join(F.array_sort(F.collect_list(line)), "; ").alias("listing"),
    )


def facility_neighbours(facilities: DataFrame) -> DataFrame:
    """Each facility with the id and type of its upstream and downstream neighbour."""

    def side(name: str) -> DataFrame:
        return facilities.select(
            F.col("facility_name").alias(f"{name}_facility"),
            F.col("facility_id").alias(f"{name}_id"),
            F.col("facility_type").alias(f"{name}_type"),
        )

    return (
        facilities.select(
            "facility_id", "facility_name", "upstream_facility", "downstream_facility"
        )
        .join(side("upstream"), "upstream_facility", "left")
        .join(side("downstream"), "downstream_facility", "left")
    )


def upstream_status(events: DataFrame) -> DataFrame:
    """Each event with the status its upstream facility reported in the same cycle."""
    own = events.select(
        "event_id",
        "timestamp",
        F.col("facility.name").alias("facility_name"),
        F.col("facility.upstream_facility").alias("upstream_facility"),
        event_status().alias("status"),
    )
    other = own.select(
        "timestamp",
        F.col("facility_name").alias("upstream_facility"),
        F.col("status").alias("upstream_status"),
    )
    return own.join(other, ["timestamp", "upstream_facility"], "left")


def latest_status(events: DataFrame) -> DataFrame:
    """Newest status per facility, combined before the shuffle."""
    newest = F.max(sensing.moment("timestamp", event_status()))
    latest = events.groupBy(F.col("facility.name").alias("facility_name")).agg(
        newest.alias("_newest")
    )
    return latest.select(
        "facility_name",
        sensing.moment_status(F.col("_newest")).alias("status"),
        sensing.moment_time(F.col("_newest")).alias("since"),
    )


def status_changes(events: DataFrame, block: str = "hour") -> DataFrame:
    """Events whose status differs from the facility's previous one (first events included).

    Events follow each other by time, then severity, then id. A facility's
    history is cut into time blocks, so one busy facility does not end up in one
    task: rows are compared inside a block, and the first row of a block with the
    last status of the facility's previous block.
    """
    rows = events.select(
        "event_id",
        "timestamp",
        F.col("facility.name").alias("facility_name"),
        event_status().alias("status"),
    ).withColumns(
        {
            "_block": F.date_trunc(block, "timestamp"),
            "_moment": sensing.moment("timestamp", F.col("status")),
        }
    )
    last = rows.groupBy("facility_name", "_block").agg(F.max("_moment").alias("_last"))
    per_facility = Window.partitionBy("facility_name").orderBy("_block")
    carried = last.select(
        "facility_name",
        "_block",
        sensing.moment_status(F.lag("_last").over(per_facility)).alias("_carried"),
    )
    inside = Window.partitionBy("facility_name", "_block").orderBy("_moment", "event_id")
    joined = join_keeping_nulls(rows, carried, ["facility_name", "_block"])
    compared = joined.withColumn(
        "previous_status", F.coalesce(F.lag("status").over(inside), F.col("_carried"))
    )
    return compared.where(~F.col("status").eqNullSafe(F.col("previous_status"))).select(
        "event_id", "timestamp", "facility_name", "previous_status", "status"
    )
