"""Keyed state of facilities and the accounts of a stream, over JSON files read batch by batch."""

from datetime import timedelta

import pandas as pd
import pytest
from test_streaming import T0, message, put, stream

from tallywater.streaming import ledger, monitor, sinks, state

MINUTE, HOUR = timedelta(minutes=1), timedelta(hours=1)


def run(spark, tmp_path, block=MINUTE, expiry=HOUR, delay="1 minute"):
    """Process what is new; all rows so far as (seconds, facility, before, now, kind)."""
    changes = state.status_states(stream(spark, tmp_path / "in"), block, expiry, delay)
    with state.keyed_state(spark):
        query = sinks.append_stream(changes, str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    return sorted(
        ((r["timestamp"] - T0).total_seconds(), r["facility_name"], r["previous_status"] or "", r["status"] or "", r["kind"])
        for r in spark.read.schema(state.CHANGES).parquet(str(tmp_path / "out")).collect()
    )


def test_a_silent_facility_expires_and_begins_anew_after_a_restart(spark, tmp_path):
    put(tmp_path / "in", "1.json", [message(1, 0, "A"), message(2, 10, "A", "warning"), message(3, 5, "B"), message(4, 10, "A", "warning")])
    put(tmp_path / "in", "2.json", [message(5, 7200, "B")])
    # B's second event is still in the delay; A and B were silent for an hour before it.
    first = [(0, "A", "", "operational", "change"), (5, "B", "", "operational", "change"), (10, "A", "operational", "warning", "change"),
             (3605, "B", "operational", "", "silent"), (3610, "A", "warning", "", "silent")]
    assert run(spark, tmp_path) == first
    put(tmp_path / "in", "3.json", [message(6, 7300, "A", "warning"), message(7, 7500, "C")])
    assert run(spark, tmp_path) == [
        *first, (7200, "B", "", "operational", "change"), (7300, "A", "", "warning", "change"),
    ]


def test_events_of_several_batches_are_taken_in_the_order_of_their_time(spark, tmp_path):
    put(tmp_path / "in", "1.json", [message(1, 0, "A"), message(2, 50, "A", "critical", 3), message(9, 55, "B")])
    put(tmp_path / "in", "2.json", [message(3, 30, "A", "warning", 2), message(4, 50, "A", "warning", 2), message(5, 40, "A")])
    put(tmp_path / "in", "3.json", [message(6, 1000, "B")])
    got = [r[:4] for r in run(spark, tmp_path, delay="2 minutes") if r[1] == "A"]
    assert got == [
        (0, "A", "", "operational"), (30, "A", "operational", "warning"), (40, "A", "warning", "operational"),
        (50, "A", "operational", "warning"), (50, "A", "warning", "critical"),
    ]


def test_the_settings_of_the_session_are_left_as_they_were(spark):
    before = {key: spark.conf.get(key, None) for key in state.STATE_STORE}
    with pytest.raises(ZeroDivisionError), state.keyed_state(spark):
        assert all(spark.conf.get(key) == value for key, value in state.STATE_STORE.items())
        1 / 0
    assert {key: spark.conf.get(key, None) for key in state.STATE_STORE} == before


def test_accounts_hold_late_and_repeated_events(spark, tmp_path):
    put(tmp_path / "in", "1.json", [message(1, 0), message(1, 0), message(2, 600)])
    put(tmp_path / "in", "2.json", [message(3, 610), message(2, 600)])
    put(tmp_path / "in", "3.json", [message(4, 100), message(5, 620)])
    sent = ledger.counted(stream(spark, tmp_path / "in"), "sent")
    once = ledger.counted(monitor.deduplicate(sent), "passed")
    with ledger.listening(spark) as book:
        query = sinks.append_stream(once.select("event_id"), str(tmp_path / "out"), str(tmp_path / "state"))
        book.settle(query)
        totals = book.totals(spark).collect()
        again = book.table(spark).collect()
    assert [(r["sent"], r["passed"], r["late"], r["repeated"], r["balanced"]) for r in totals] == [(7, 4, 1, 2, True)]
    assert len({r["batch_id"] for r in again}) == len(again) >= 3
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["e001", "e002", "e003", "e005"]
    # Once the block is left nothing is entered any more.
    put(tmp_path / "in", "4.json", [message(6, 630)])
    sinks.append_stream(once.select("event_id"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert book.table(spark).count() == len(again)


def test_waiting_events_are_not_read_back_while_more_arrive(monkeypatch):
    """Every bundle is written beside the earlier ones of its block: work follows the rows, not their square."""
    class Value:
        def __init__(self):
            self.row = None

        def exists(self):
            return self.row is not None

        def get(self):
            return self.row

        def update(self, row):
            self.row = row

    class Waiting(dict):
        updateValue = dict.__setitem__

        def getValue(self, name):
            raise AssertionError("read back")

        def containsKey(self, name):
            return name in self

    monkeypatch.setattr(state, "BUNDLE", 4)
    one = state.StatusProcessor(1000, 10**6)
    one.current, one.bundles, one.waiting = Value(), Value(), Waiting()
    one.handle = type("Handle", (), {"registerTimer": lambda self, at: None})()
    for _ in range(2):
        parts = [pd.DataFrame({"moment": [4 * n, 4 * n + 4000], "event_id": [f"{n}a", f"{n}b"]}) for n in range(5)]
        assert list(one.handleInputRows(("A",), iter(parts), None)) == []
    assert sum(len(moments) for moments, _ in one.waiting.values()) == 20
    assert {block for block, _ in one.waiting} == {0, 1} and len(one.waiting) == 12


def test_many_bundles_give_the_changes_of_one(spark, tmp_path, monkeypatch):
    rows = [message(n, (n * 7) % 40, "A", ("operational", "warning", "critical")[n % 3], (0, 2, 3)[n % 3]) for n in range(40)]
    put(tmp_path / "in", "1.json", rows)
    put(tmp_path / "in", "2.json", [message(99, 1000, "A")])
    whole = run(spark, tmp_path)
    monkeypatch.setattr(state, "BUNDLE", 3)
    again = tmp_path / "again"
    again.mkdir()
    put(again / "in", "1.json", rows)
    put(again / "in", "2.json", [message(99, 1000, "A")])
    assert run(spark, again) == whole and len(whole) > 10
