"""Facility and sensor dimensions from the network configuration document (JSON)."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywater.schemas import CONFIG_SCHEMA

SAMPLE = str(Path(__file__).parent.parent / "resources" / "network.json")


def read_network(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema(CONFIG_SCHEMA).json(path)


def sample_network(spark: SparkSession) -> DataFrame:
    """The packaged example network, for sessions whose executors cannot see this folder."""
    text = Path(SAMPLE).read_text(encoding="utf-8")
    document = spark.range(1).select(F.from_json(F.lit(text), CONFIG_SCHEMA).alias("doc"))
    return document.select("doc.*")


def facility_dimension(network: DataFrame) -> DataFrame:
    """One row per facility, numbered from 1 in document order."""
    listed = network.select(F.posexplode(F.map_entries("facilities")).alias("place", "entry"))
    info = "entry.value"
    return listed.select(
        (F.col("place") + 1).cast("long").alias("facility_id"),
        F.col("entry.key").alias("facility_name"),
        F.col(f"{info}.type").alias("facility_type"),
        F.col(f"{info}.district").alias("district"),
        F.col(f"{info}.location.latitude").alias("latitude"),
        F.col(f"{info}.location.longitude").alias("longitude"),
        F.col(f"{info}.capacity_mld").alias("capacity_mld"),
        F.col(f"{info}.supply_chain").alias("supply_chain"),
        F.col(f"{info}.upstream_facility").alias("upstream_facility"),
        F.col(f"{info}.downstream_facility").alias("downstream_facility"),
        F.coalesce(F.col(f"{info}.priority_sensors"), F.array().cast("array<string>")).alias(
            "priority_sensors"
        ),
    )


def sensor_dimension(network: DataFrame) -> DataFrame:
    """One row per sensor type with its unit, bounds and category."""
    listed = network.select(F.explode("sensors").alias("sensor_type", "info"))
    return listed.select(
        "sensor_type",
        "info.unit",
        F.col("info.normal_range")[0].alias("threshold_min"),
        F.col("info.normal_range")[1].alias("threshold_max"),
        "info.critical_low",
        "info.critical_high",
        "info.anomaly_chance",
        "info.facility_types",
        "info.analytics_category",
    )
