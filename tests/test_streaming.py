"""Streams over JSON files: totals equal batch, late rows drop, batches carry over, bad rows apart."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallywater.operators import sensors
from tallywater.schemas import EVENT_SCHEMA
from tallywater.sources import events as source
from tallywater.streaming import monitor, sinks

T0 = datetime(2025, 1, 1)


def message(n, seconds, name="Alder Reservoir", status="operational", level=0):
    return json.dumps(
        {
            "event_id": f"e{n:03d}",
            "timestamp": (T0 + timedelta(seconds=seconds)).isoformat(),
            "facility": {"name": name, "type": "reservoir", "supply_chain": None},
            "sensors": {
                "pressure": {
                    "value": 1.5, "unit": "bar", "threshold_min": 2.0, "threshold_max": 5.0,
                    "status": "normal" if status == "operational" else status,
                }
            },
            "operational_metrics": {"status": status, "alert_level": level, "active_sensors": 1},
        }
    )


def put(folder, name, lines):
    """One more file, a second younger than those before it: files are read oldest first."""
    folder.mkdir(exist_ok=True)
    at = 1_700_000_000 + len(list(folder.iterdir()))
    (folder / name).write_text("\n".join(lines))
    os.utime(folder / name, (at, at))


def stream(spark, folder):
    raw = source.read_json_files(spark, str(folder), files_per_trigger=1)
    return source.valid_events(source.parse_messages(raw))


def batch(spark, folder):
    return source.valid_events(source.parse_messages(spark.read.text(str(folder))))


def finish(spark, df, tmp_path, start=sinks.append_stream, name="out"):
    start(df, str(tmp_path / name), str(tmp_path / f"{name}-state")).awaitTermination()
    return spark.read.parquet(str(tmp_path / name))


def test_cycles_equal_batch_and_late_rows_drop(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "1.json", [message(n, n, status="warning" if n % 3 == 0 else "operational") for n in range(10)])
    put(folder, "2.json", [message(50, 300)])
    put(folder, "3.json", [message(53, 310)])
    put(folder, "4.json", [message(51, 3), message(52, 600)])
    got = finish(spark, monitor.cycle_summary(stream(spark, folder)), tmp_path)
    rows = {r["cycle_start"]: r for r in got.collect()}
    on_time = batch(spark, folder).where("event_id <> 'e051'")
    want = {r["cycle_start"]: r for r in sensors.cycle_summary(on_time).collect()}
    closed = {k: v for k, v in want.items() if k < T0 + timedelta(seconds=540)}
    assert rows == closed and len(closed) == 7


def test_running_totals_equal_batch(spark, tmp_path):
    folder = tmp_path / "in"
    for part in range(3):
        put(folder, f"{part}.json", [message(part * 10 + n, part * 10 + n, status="critical" if n == 4 else "operational") for n in range(10)])
    finish(spark, monitor.running_totals(stream(spark, folder)), tmp_path, sinks.replace_stream)
    got = sinks.read_newest(spark, str(tmp_path / "out"))
    want = monitor.running_totals(batch(spark, folder))
    assert got.collect() == want.collect()
    assert got.first()["anomaly_pct"] == 10.0


def test_repeated_sends_are_dropped(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "1.json", [message(n, n) for n in range(5)] + [message(2, 2)])
    put(folder, "2.json", [message(3, 3), message(9, 20)])
    flat = monitor.deduplicate(stream(spark, folder)).select("event_id")
    got = finish(spark, flat, tmp_path)
    assert sorted(r[0] for r in got.collect()) == ["e000", "e001", "e002", "e003", "e004", "e009"]


def test_sessions_split_at_the_gap(spark, tmp_path):
    folder = tmp_path / "in"
    times = [0, 4, 9, 30, 35]
    put(folder, "1.json", [message(n, t, status="warning", level=2) for n, t in enumerate(times)])
    put(folder, "2.json", [message(90, 900, status="critical", level=3)])
    put(folder, "3.json", [message(91, 901)])
    got = finish(spark, monitor.anomaly_sessions(stream(spark, folder)), tmp_path)
    rows = sorted((r["session_start"], r["session_end"], r["events"]) for r in got.collect())
    assert [(int((a - T0).total_seconds()), int((b - T0).total_seconds()), n) for a, b, n in rows] == [
        (0, 19, 3), (30, 45, 2),
    ]


def test_sliding_rates(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "1.json", [message(n, n * 10, status="warning" if n % 2 else "operational") for n in range(12)])
    put(folder, "2.json", [message(90, 1000)])
    got = finish(spark, monitor.anomaly_rates(stream(spark, folder)), tmp_path)
    full = got.where(F.col("window_start") == F.lit(T0)).first()
    assert (full["events"], full["anomalies"], full["anomaly_pct"]) == (6, 3, 50.0)


def test_status_changes_carry_over_batches(spark, tmp_path):
    folder = tmp_path / "in"
    states = ["operational", "operational", "warning", "warning", "critical", "operational"]
    for n, status in enumerate(states):
        put(folder, f"{n}.json", [message(n, n * 3600, status=status), message(n + 50, n * 3600, "Brook Dam")])
    query = sinks.status_stream(stream(spark, folder), str(tmp_path / "s"), str(tmp_path / "s-state"))
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "s" / "changes")).drop("batch_id")
    want = sensors.status_changes(batch(spark, folder))
    assert sorted(got.collect()) == sorted(want.collect())
    assert got.where("facility_name = 'Alder Reservoir'").count() == 4
    newest = spark.read.parquet(str(tmp_path / "s" / "latest" / "batch_id=5"))
    assert {r["facility_name"]: r["status"] for r in newest.collect()} == {
        "Alder Reservoir": "operational", "Brook Dam": "operational",
    }
    assert monitor.latest_status(batch(spark, folder)).count() == 2


def test_zones_keep_malformed_rows_apart(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "1.json", [message(1, 1), "{broken", json.dumps({"event_id": "x"}), message(2, 2, status="warning")])
    raw = source.read_json_files(spark, str(folder))
    for _ in range(2):
        sinks.zone_stream(raw, str(tmp_path / "lake")).awaitTermination()
    lake = tmp_path / "lake"
    assert spark.read.parquet(str(lake / "raw" / "sensor_events")).count() == 4
    assert spark.read.parquet(str(lake / "cleaned" / "sensor_events")).count() == 2
    bad = spark.read.parquet(str(lake / "cleaned" / "sensor_events_malformed"))
    assert sorted(r["value"] for r in bad.collect()) == ['{"event_id": "x"}', "{broken"]
    curated = spark.read.parquet(str(lake / "curated" / "sensor_events"))
    assert {(r["event_id"], r["sensor_type"], r["status"]) for r in curated.collect()} == {
        ("e001", "pressure", "normal"), ("e002", "pressure", "warning"),
    }


def test_messages_round_trip(spark):
    lines = spark.createDataFrame([(message(1, 1),)], "value string")
    events = source.valid_events(source.parse_messages(lines))
    again = source.valid_events(source.parse_messages(source.to_messages(events)))
    assert again.collect() == events.collect()
    assert events.schema.simpleString() == spark.createDataFrame([], EVENT_SCHEMA).schema.simpleString()
    assert source.to_messages(events).first()["key"] == "Alder Reservoir"


def test_kafka_settings(monkeypatch):
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "broker:9000")
    monkeypatch.setenv("KAFKA_TOPIC", "other")
    assert source.kafka_options() == {"kafka.bootstrap.servers": "broker:9000"}
    assert source.topic_name() == "other" and source.topic_name("mine") == "mine"
    assert source.kafka_options("x:1") == {"kafka.bootstrap.servers": "x:1"}


def test_late_status_events_change_nothing(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "1.json", [message(1, 0)])
    put(folder, "2.json", [message(2, 10, status="warning")])
    put(folder, "3.json", [message(3, 5, status="warning"), message(4, 20), message(5, 1, "Brook Dam")])
    sinks.status_stream(stream(spark, folder), str(tmp_path / "s"), str(tmp_path / "s-state")).awaitTermination()
    changes = spark.read.parquet(str(tmp_path / "s" / "changes"))
    got = {r["event_id"]: (r["previous_status"], r["status"]) for r in changes.collect()}
    assert got == {
        "e001": (None, "operational"), "e002": ("operational", "warning"), "e004": ("warning", "operational"),
        "e005": (None, "operational"),
    }
    late = spark.read.parquet(str(tmp_path / "s" / "late"))
    assert [r["event_id"] for r in late.collect()] == ["e003"]
    assert sorted(p.name for p in (tmp_path / "s" / "latest").iterdir()) == ["batch_id=1", "batch_id=2"]


def test_missing_status_raises(spark, tmp_path):
    """A second run that goes on from the checkpoint but finds no stored status."""
    folder = tmp_path / "in"
    put(folder, "1.json", [message(1, 0)])
    sinks.status_stream(stream(spark, folder), str(tmp_path / "s"), str(tmp_path / "state")).awaitTermination()
    put(folder, "2.json", [message(2, 10)])
    query = sinks.status_stream(stream(spark, folder), str(tmp_path / "other"), str(tmp_path / "state"))
    with pytest.raises(StreamingQueryException, match="StateLost"):
        query.awaitTermination()


def test_complete_results_keep_what_readers_opened(spark, tmp_path):
    folder = tmp_path / "in"
    for n in range(3):
        put(folder, f"{n}.json", [message(n, n)])
    totals = monitor.running_totals(stream(spark, folder))
    sinks.replace_stream(totals, str(tmp_path / "t"), str(tmp_path / "t-state")).awaitTermination()
    assert sinks.read_newest(spark, str(tmp_path / "t")).first()["events"] == 3
    assert len(list((tmp_path / "t").iterdir())) == 2
