"""Sensor reading rules as column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Calibration by facility type and sensor type.
CALIBRATION = {
    ("dam", "water_level"): 1.5,
    ("pumping_station", "pressure"): 1.3,
    ("reservoir", "water_level"): 1.2,
}

# Severity rank of a reading, and facility status and alert level by rank.
RANKS = {"normal": 0, "warning": 1, "critical": 2}
FACILITY_STATUS = ("operational", "warning", "critical")
ALERT_LEVELS = (0, 2, 3)


def reading_status(value: str = "raw_value") -> Column:
    """Normal inside the range; outside it, warning until the critical bound is met."""
    v = F.col(value)
    below = F.when(v > F.col("critical_low"), "warning").otherwise("critical")
    above = F.when(v < F.col("critical_high"), "warning").otherwise("critical")
    return (
        F.when(v.between(F.col("threshold_min"), F.col("threshold_max")), "normal")
        .when(v < F.col("threshold_min"), below)
        .when(v > F.col("threshold_max"), above)
    )


def calibrated(value: str = "raw_value") -> Column:
    factor = F
    for (facility, sensor), multiplier in CALIBRATION.items():
        matches = (F.col("facility_type") == facility) & (F.col("sensor_type") == sensor)
        factor = factor.when(matches, F.lit(multiplier))
    return F.col(value) * factor.otherwise(F.lit(1.0))


def severity(status: Column | str = "status") -> Column:
    column = F.col(status) if isinstance(status, str) else status
    return F.when(column == "critical", 2).when(column == "warning", 1).otherwise(0)


def facility_status(rank: Column) -> Column:
    return F.get(F.array(*[F.lit(s) for s in FACILITY_STATUS]), rank)


def alert_level(rank: Column) -> Column:
    return F.get(F.array(*[F.lit(a) for a in ALERT_LEVELS]), rank)


def is_anomalous(status: Column) -> Column:
    return status.isin("warning", "critical")


def device_id(kind: str, name: str) -> Column:
    digest = F.conv(F.substring(F.md5(F.col(name).cast("binary")), 1, 8), 16, 10).cast("long")
    number = F.pmod(digest, F.lit(10000)).cast("string")
    return F.concat(F.lit("DEV-"), F.upper(kind), F.lit("-"), F.lpad(number, 4, "0"))


def reading_status_of(rank: Column, value: Column) -> Column:
    names = F.array(*[F.lit(name) for name in RANKS])
    return F.when(value.isNotNull(), F.get(names, rank))


def reading_order(timestamp: str, identity: Column) -> Column:
    """Time, then a whole number per reading, in one number, so that the newest reading is a
    hash aggregation too."""
    spacing = F.lit(Decimal(2 * 10**19))
    return F.unix_micros(timestamp).cast("decimal(18,0)") * spacing + identity


def reading_number(identity: str, kind: str) -> Column:
    """The id itself where it is a number; of text ids (UUIDs) the digest, which settles ties of
    time in a repeatable order."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.col(identity)
    return F.xxhash64(identity)


def moment(timestamp: str, status: Column) -> Column:
    """Time and severity in one whole number: its maximum is the newest status, the worse one
    where two fall on the same instant. A maximum of numbers is a hash aggregation."""
    return F.unix_micros(timestamp) * 4 + severity(status)


def moment_status(number: Column) -> Column:
    return facility_status(F.pmod(number, F.lit(4)).cast("int"))


def moment_time(number: Column) -> Column:
    return F.timestamp_micros(F.shiftright(number, 2))
