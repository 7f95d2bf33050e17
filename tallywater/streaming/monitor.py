"""Structured Streaming over sensor events: summaries, rates, sessions and totals.

The functions take a streaming (or batch) DataFrame of events in
``schemas.EVENT_SCHEMA`` and return the transformed one; ``streaming.sinks``
starts them. Windows and sessions are emitted once the watermark has passed their end: those still
open when a run over available data ends are kept in the checkpoint and come with a later run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallywater.functions import sensing
from tallywater.operators import sensors

DELAY = "1 minute"


def deduplicate(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """Drop repeated sends of an event that arrive within ``delay``."""
    return events.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["event_id"])


def cycle_summary(
    events: DataFrame, cycle: str = sensors.CYCLE, delay: str = DELAY
) -> DataFrame:
    """Tumbling cycles, emitted once the watermark has passed them; later rows are dropped."""
    return sensors.cycle_summary(events.withWatermark("timestamp", delay), cycle)


def anomaly_rates(
    events: DataFrame, length: str = "1 minute", slide: str = "10 seconds", delay: str = DELAY
) -> DataFrame:
    """Share of anomalous events per facility over a sliding window."""
    bad = sensing.is_anomalous(sensors.event_status())
    rates = (
        events.withWatermark("timestamp", delay)
        .groupBy(
            F.window("timestamp", length, slide).alias("_window"),
            F.col("facility.name").alias("facility_name"),
        )
        .agg(F.count("*").alias("events"), F.count_if(bad).alias("anomalies"))
    )
    return rates.select(
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        "facility_name",
        "events",
        "anomalies",
        (F.col("anomalies") / F.col("events") * 100).alias("anomaly_pct"),
    )


def anomaly_sessions(events: DataFrame, gap: str = "10 seconds", delay: str = DELAY) -> DataFrame:
    """Runs of anomalous events of a facility with no pause of ``gap`` or more."""
    bad = events.where(sensing.is_anomalous(sensors.event_status()))
    runs = (
        bad.withWatermark("timestamp", delay)
        .groupBy(
            F.session_window("timestamp", gap).alias("_session"),
            F.col("facility.name").alias("facility_name"),
        )
        .agg(
            F.count("*").alias("events"),
            F.max("operational_metrics.alert_level").alias("alert_level"),
        )
    )
    return runs.select(
        F.col("_session.start").alias("session_start"),
        F.col("_session.end").alias("session_end"),
        "facility_name",
        "events",
        "alert_level",
    )


def running_totals(events: DataFrame) -> DataFrame:
    """One row of totals since the start, for complete mode."""
    bad = sensing.is_anomalous(sensors.event_status())
    sums = events.groupBy().agg(
        F.count("*").alias("events"),
        F.count_if(bad).alias("anomalies"),
        F.min("timestamp").alias("first_event"),
        F.max("timestamp").alias("last_event"),
    )
    seconds = F.unix_seconds("last_event") - F.unix_seconds("first_event")
    return sums.withColumns(
        {
            "anomaly_pct": F.when(
                F.col("events") > 0, F.col("anomalies") / F.col("events") * 100
            ).otherwise(0.0),
            "events_per_second": F.col("events")
            / F.greatest(F.lit(1), F.coalesce(seconds, F.lit(1))),
        }
    )


def latest_status(events: DataFrame) -> DataFrame:
    """Newest status per facility, for update or complete mode."""
    return sensors.latest_status(events)
