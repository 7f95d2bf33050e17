"""Operators against brute force in pandas and on skewed or odd inputs."""

import random
from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallywater.functions import risk
from tallywater.operators import (
    billing, calendar, features, joins, labels, performance, ranking, scoring, sensors, tickets,
)
from tallywater.sources.network import facility_dimension, sample_network, sensor_dimension

PERF_DDL = (
    "date_id date, agent_id long, department_id long, total_tickets_handled int, "
    "avg_handle_time_mins double, escalation_rate double, backlog int, reopened_tickets int, "
    "utilization_rate double, sla_breaches int"
)
START = date(2025, 1, 1)


def series(agents, days, seed, keep=0.7):
    rng = random.Random(seed)
    return [
        (
            START + timedelta(days=d), a, 4, rng.randint(0, 12), round(rng.uniform(20, 300), 1),
            round(rng.uniform(0, 0.5), 3), rng.randint(0, 25), rng.randint(0, 4),
            round(rng.uniform(0.3, 0.98), 2), rng.randint(0, 8),
        )
        for a in range(1, agents + 1)
        for d in range(days)
        if rng.random() < keep
    ]


def perf_frame(spark, rows):
    return spark.createDataFrame(rows, PERF_DDL)


def expected_features(rows):
    df = pd.DataFrame(rows, columns=[c.split()[0] for c in PERF_DDL.split(", ")])
    df = df.sort_values(["agent_id", "date_id"]).reset_index(drop=True)
    by_agent = df.groupby("agent_id")
    for n in (7, 30):
        for name, column in features.MEASURES.items():
            df[f"avg_{name}_{n}d"] = by_agent[column].transform(
                lambda s, n=n: s.rolling(n, min_periods=3).mean()
            )
    for name, column in features.TRENDS.items():
        df[name] = by_agent[column].diff(7)
    return df


CHECKED = [*features.ROLLING, *features.TRENDS]


def assert_close(got, want):
    for column in CHECKED:
        pairs = zip(got[column].astype(float), want[column].astype(float))
        assert all((pd.isna(a) and pd.isna(b)) or abs(a - b) < 1e-9 for a, b in pairs), column


def test_rolling_features_with_gaps_and_nulls(spark):
    rows = series(6, 60, 1) + series(1, 2, 9, keep=1.0)[:0]
    rows[5] = (*rows[5][:4], None, *rows[5][5:8], None, rows[5][9])
    got = (
        features.agent_features(perf_frame(spark, rows))
        .orderBy("agent_id", "date_id").toPandas()
    )
    assert_close(got, expected_features(rows))
    newest = got[got["is_latest"]]
    assert (newest.groupby("agent_id").size() == 1).all()


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), keep=st.sampled_from([0.15, 0.6, 1.0]))
def test_asof_equals_one_query_per_date(spark, seed, keep):
    rows = series(4, 75, seed, keep) or series(1, 3, seed, 1.0)
    dates = [START + timedelta(days=d) for d in (0, 2, 29, 30, 31, 44, 60, 74, 90, 104, 120)]
    frame = perf_frame(spark, rows)
    wanted = spark.createDataFrame([(d,) for d in dates], "as_of date")
    got = features.asof_features(frame, wanted).toPandas()
    seen = {(r.as_of, r.agent_id): r for r in got.itertuples()}
    count = 0
    for d in dates:
        recent = [r for r in rows if d - timedelta(days=30) <= r[0] <= d]
        if not recent:
            continue
        newest = expected_features(recent).fillna(0).groupby("agent_id").tail(1)
        for want in newest.itertuples():
            have = seen[(d, want.agent_id)]
            assert have.date_id == want.date_id
            for column in CHECKED:
                assert abs(float(getattr(have, column)) - getattr(want, column)) < 1e-9, column
            count += 1
    assert count == len(seen)


def test_training_frame_drops_short_history_and_unknown_agent_keeps_zero_date(spark):
    rows = [r for r in series(2, 20, 3, 1.0)]
    frame = perf_frame(spark, rows)
    facts = spark.createDataFrame(
        [(START, 1, 4, 3.5, 0, 1)],
        "date_id date, agent_id long, total_tickets long, avg_csat double, "
        "reopened_count long, sla_breach_count long",
    )
    agents = spark.createDataFrame(
        [(1, "Agent", date(2024, 1, 1))], "agent_id long, role_title string, hire_date date"
    )
    got = features.training_frame(frame, facts, agents).toPandas()
    assert len(got) == 2 * 13
    unknown = got[got["agent_id"] == 2]
    assert set(unknown["role_title"]) == {""}
    assert set(unknown["hire_date"]) == {date(1970, 1, 1)}
    known = got[(got["agent_id"] == 1) & (got["date_id"] == START + timedelta(days=10))]
    assert list(known["tenure_months"]) == [(START + timedelta(days=10) - date(2024, 1, 1)).days // 30]


def labelled(spark, stress):
    rows = [(i % 7, START + timedelta(days=i // 7), s, "Medium") for i, s in enumerate(stress)]
    return spark.createDataFrame(
        rows, "agent_id long, date_id date, stress_index double, burnout_risk_label string"
    )


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from([0.1, 0.2, 0.2, 0.5, 0.9]), min_size=4, max_size=120))
def test_rebalance_matches_a_full_sort(spark, stress):
    frame = labelled(spark, stress)
    got = labels.rebalance_labels(frame).toPandas()
    order = got.sort_values(["stress_index", "agent_id", "date_id"], ascending=[False, True, True])
    n = len(stress)
    c, h, m = (max(int(n * s), 1) for s in (0.05, 0.12, 0.35))
    want = (["Critical"] * c + ["High"] * h + ["Medium"] * m + ["Low"] * n)[:n]
    assert list(order["burnout_risk_label"]) == want


def test_rebalance_with_fewer_rows_than_cuts(spark):
    got = labels.rebalance_labels(labelled(spark, [0.3, 0.8])).orderBy(F.desc("stress_index"))
    assert [r["burnout_risk_label"] for r in got.collect()] == ["Critical", "High"]


def test_rebalance_leaves_complete_labels_alone(spark):
    frame = labels.label_rows(features.agent_features(perf_frame(spark, series(1, 1, 0, 1.0))))
    full = spark.createDataFrame([(c,) for c in risk.SEVERITY], "burnout_risk_label string")
    assert labels.missing_labels(full).isEmpty()
    assert labels.rebalance_labels(full) is full
    assert labels.missing_labels(frame).count() == 3
    assert labels.label_check(full).first() == (4, True)


def test_split_is_exact_per_class(spark):
    rows = [(i, START, "Low" if i % 3 else "High") for i in range(1001)]
    frame = spark.createDataFrame(rows, "agent_id long, date_id date, burnout_risk_label string")
    first = labels.stratified_split(frame)
    sizes = {
        r[0]: (r[1], r[2])
        for r in first.groupBy("burnout_risk_label").agg(F.count("*"), F.sum("is_test")).collect()
    }
    assert sizes == {"Low": (667, 133), "High": (334, 67)}
    chosen = {r[0] for r in first.where("is_test = 1").select("agent_id").collect()}
    again = labels.stratified_split(frame.repartition(7))
    assert chosen == {r[0] for r in again.where("is_test = 1").select("agent_id").collect()}


def test_class_report_with_an_uncalled_class(spark):
    rows = [("Low", "Low")] * 3 + [("High", "Low")] + [("Critical", "Critical")]
    frame = spark.createDataFrame(rows, "burnout_risk_label string, risk_category string")
    report = {r["class"]: r for r in labels.class_report(frame).collect()}
    assert report["High"]["precision"] == 0 and report["High"]["f1"] == 0
    assert report["Low"]["precision"] == 0.75 and report["Low"]["recall"] == 1
    assert report["accuracy"]["f1"] == 0.8
    assert labels.accuracy(frame).first()[0] == 0.8


def test_numbers_are_dense_and_ordered(spark):
    rows = [(d, b, i) for i, (d, b) in enumerate((i % 3, i % 5) for i in range(100))]
    rows += [(9, 9, 1000 + i) for i in range(60)]
    frame = spark.createDataFrame(rows, "day int, block int, id int")
    got = ranking.number_rows(frame, [["day"], ["block"]], ["id"], "k", 10).orderBy("k").collect()
    assert [r["k"] for r in got] == list(range(11, 171))
    places = [(r["day"], r["block"], r["id"]) for r in got]
    assert places == sorted(places)
    inside = ranking.number_within(frame, ["day"], ["block"], ["id"], "k")
    for day, rows_of_day in inside.toPandas().groupby("day"):
        assert sorted(rows_of_day["k"]) == list(range(1, len(rows_of_day) + 1))


def test_numbers_keep_rows_with_null_groups(spark):
    frame = spark.createDataFrame([(None, 1), (1, 2), (None, 3)], "day int, id int")
    got = ranking.number_rows(frame.withColumn("block", F.lit(0)), [["day"], ["block"]], ["id"], "k")
    assert sorted((r["k"], r["id"]) for r in got.collect()) == [(1, 1), (2, 3), (3, 2)]


def test_readings_of_unknown_facilities_are_kept(spark):
    network = sample_network(spark)
    rows = spark.createDataFrame(
        [(1, datetime(2025, 1, 1), "pressure", "Nowhere", 900.0), (2, datetime(2025, 1, 1), "other", "Brook Dam", 1.0)],
        "reading_id long, timestamp timestamp, sensor_type string, facility_name string, raw_value double",
    )
    rated = sensors.calibrate_readings(
        sensors.classify_readings(rows, sensor_dimension(network)), facility_dimension(network)
    )
    events = sensors.build_events(rated, facility_dimension(network)).collect()
    assert [(e["facility"]["name"], e["operational_metrics"]["status"]) for e in events] == [("Nowhere", "critical")]
    assert events[0]["facility"]["type"] is None


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_lookup_with_hot_and_null_keys(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    facts = [(7 if i % 3 == 0 else (None if i % 3 == 1 else i), i) for i in range(3000)]
    frame = spark.createDataFrame(facts, "k long, v long")
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(0, 3000, 7)], "k long, name string")
    got = joins.lookup(frame, dim, "k", {"name": ""}).toPandas()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == 3000
    for row in got.itertuples():
        hit = not pd.isna(row.k) and row.k % 7 == 0
        assert row.name == (f"n{int(row.k)}" if hit else "")


def raw_day(spark, n=200):
    rng = random.Random(5)
    rows = [
        (
            i, START, rng.randint(1, 12), rng.randint(1, 30), rng.choice(["Leakage", "Billing Dispute", "No Water"]),
            rng.choice(["Phone", "Email"]), rng.uniform(0.5, 8), rng.randint(1, 15), int(rng.random() < 0.6),
        )
        for i in range(n)
    ]
    frame = spark.createDataFrame(
        rows,
        "ticket_id long, date_id date, agent_id long, customer_id long, issue_category string, "
        "issue_channel string, base_time_hrs double, base_response_mins int, "
        "resolved_in_first_contact int",
    )
    return frame.withColumns(
        {
            "reopened": F.when(F.col("resolved_in_first_contact") == 0, (F.col("ticket_id") % 4 == 0).cast("int")).otherwise(0),
            "sla_compliance": (F.col("ticket_id") % 5 != 0).cast("int"),
            "days_in_backlog": (F.col("ticket_id") % 30 + 1).cast("int"),
            "facility_id": F.lit(1).cast("long"),
        }
    )


def agent_dim(spark, n=12):
    roles = ("Agent", "Senior Agent", "Team Lead", "Supervisor")
    return spark.createDataFrame(
        [(i, f"A{i}", 4 if i <= 6 else 5, roles[i % 4], date(2020, 1, 1), "Active") for i in range(1, n + 1)],
        "agent_id long, agent_name string, department_id long, role_title string, hire_date date, status string",
    )


def test_performance_covers_agents_without_tickets(spark):
    scored = tickets.score_tickets(raw_day(spark)).where("agent_id <> 3")
    perf = performance.agent_daily_performance(scored, agent_dim(spark), START, START)
    got = {r["agent_id"]: r for r in perf.collect()}
    assert len(got) == 12
    idle = got[3]
    assert (idle["total_tickets_handled"], idle["avg_handle_time_mins"]) == (0, 0.0)
    assert idle["resolution_rate"] == 0.0 and idle["utilization_rate"] == 0.85
    assert got[1]["performance_id"] == 2025010101
    rows = scored.toPandas()
    mine = rows[rows["agent_id"] == 5]
    lost = mine[mine["resolved_in_first_contact"] == 0]
    escalated = ((lost["sla_compliance"] == 0) | (lost["reopened"] == 1)).sum()
    assert got[5]["backlog"] == len(lost)
    assert got[5]["escalation_rate"] == pytest.approx(round(escalated / len(mine), 3), abs=1e-9)
    totals = performance.day_totals(perf).first()
    assert totals["tickets"] == len(rows) and totals["agents"] == 12


def test_performance_of_agents_missing_from_the_dimension(spark):
    scored = tickets.score_tickets(raw_day(spark))
    perf = performance.agent_daily_performance(scored, agent_dim(spark, 6), every_agent=False)
    unknown = perf.where("agent_id > 6").select("department_id").distinct().collect()
    assert [r[0] for r in unknown] == [4]


def test_facility_falls_back_when_the_district_has_none(spark):
    places = spark.createDataFrame(
        [(1, "A"), (2, "A"), (3, "B")], "facility_id long, district string"
    )
    rows = spark.createDataFrame(
        [(i, d) for i, d in enumerate(["A", "A", "B", "Z", "Z", "Z", ""])], "id long, district string"
    )
    got = tickets.assign_facility(rows, places, F.col("id")).orderBy("id").collect()
    assert [r["facility_id"] for r in got] == [1, 2, 3, 1, 2, 3, 1]


def test_ensure_critical_rules(spark):
    def day(n, agents, best, has_critical=False):
        return [
            (START + timedelta(days=n), a, "Critical" if has_critical and a == 9 else "High", 1, best if a in (2, 4) else 0.1, 20, "x")
            for a in range(1, agents + 1)
        ]

    rows = day(0, 10, 0.7) + day(1, 9, 0.7) + day(2, 10, 0.6) + day(3, 10, 0.9, True)
    frame = spark.createDataFrame(
        rows,
        "date_id date, agent_id long, risk_category string, risk_category_encoded int, "
        "burnout_risk_score double, workload_reduction_pct int, recommended_action string",
    )
    got = scoring.ensure_critical(frame).where("risk_category = 'Critical'").orderBy("date_id").collect()
    assert [(r["date_id"], r["agent_id"]) for r in got] == [(START, 2), (START + timedelta(days=3), 9)]
    assert (got[0]["workload_reduction_pct"], got[0]["risk_category_encoded"]) == (35, 0)
    assert got[0]["burnout_risk_score"] == 0.7


def test_calendar(spark):
    empty = spark.createDataFrame([], "date_id date")
    rows = calendar.missing_calendar(empty, date(2025, 1, 3)).collect()
    assert [r["date_id"] for r in rows] == [date(2025, 1, d) for d in (1, 2, 3)]
    stored = spark.createDataFrame([(date(2025, 3, 30),)], "date_id date")
    more = calendar.missing_calendar(stored, date(2025, 4, 1)).collect()
    assert [(r["day"], r["month"], r["quarter"]) for r in more] == [(31, 3, 1), (1, 4, 2)]
    assert calendar.missing_calendar(stored, date(2025, 3, 30)).isEmpty()
    assert calendar.missing_calendar(stored, date(2025, 3, 1)).isEmpty()
    long = perf_frame(spark, series(1, 120, 1, 1.0))
    start, end, days = calendar.training_range(long).first()
    assert (days, (end - start).days) == (120, 90)
    short = perf_frame(spark, series(1, 50, 1, 1.0))
    assert calendar.training_range(short).first()[0] == START
    assert calendar.in_training_range(long, long).count() == 91


def test_backfill_guards(spark):
    frame = perf_frame(spark, series(2, 40, 2, 1.0))
    none = spark.createDataFrame([], "date_id date")
    dates = calendar.backfill_dates(frame, none)
    assert dates.agg(F.min("date_id")).first()[0] == START + timedelta(days=30)
    assert calendar.backfill_ready(frame, dates).count() == 10
    assert calendar.backfill_ready(frame, dates, rows=63).count() == 0


def test_billing_gates(spark):
    ddl = (
        "date_id date, base_consumption double, customer_factor double, discount double, "
        "payment_status string, days_late int, payer_class string, tariff_category string, "
        "customer_segment string"
    )
    rows = [
        (date(2025, 1, 1), 10.0, 1.0, 0.15, "Paid", 7, "reliable", "Non-Profit", "Business"),
        (date(2025, 1, 1), 10.0, 1.0, 0.15, "Paid", 8, "reliable", "Domestic", "Business"),
        (date(2025, 7, 1), 10.0, 1.0, 0.16, "Overdue", 40, "problematic", "Domestic", "Government"),
    ]
    got = billing.bill(spark.createDataFrame(rows, ddl)).collect()
    assert [r["consumption_m3"] for r in got] == [12.0, 12.0, 8.0]
    assert [r["discount_applied"] for r in got] == [0.15, 0.0, 0.16]
    assert [r["billed_amount"] for r in got] == [8.67, 6.84, 3.83]
    assert [r["days_late"] for r in got] == [7, 8, 0]
    assert [r["discount_valid"] for r in got] == [1, 1, 0]
    assert [r["lateness_valid"] for r in got] == [1, 0, 1]


def test_network_dimensions(spark):
    network = sample_network(spark)
    places = facility_dimension(network).orderBy("facility_id").collect()
    assert [r["facility_id"] for r in places] == list(range(1, 10))
    assert places[0]["upstream_facility"] is None and places[0]["facility_type"] == "reservoir"
    kinds = sensor_dimension(network)
    assert kinds.count() == 9
    empty = facility_dimension(network).withColumn("priority_sensors", F.array().cast("array<string>"))
    wanted = {r[0]: r[1] for r in sensors.expected_sensors(empty, kinds).collect()}
    assert wanted["Brook Dam"] == ["dissolved_oxygen", "pressure", "turbidity", "vibration", "water_level"]
    own = {r[0]: r[1] for r in sensors.expected_sensors(facility_dimension(network), kinds).collect()}
    assert own["Elm Wells"] == ["conductivity", "motor_temperature", "vibration"]  # names none
    assert own["Elm Lift"] == ["motor_temperature", "pressure"]  # names one that is not configured
    near = {r["facility_name"]: r for r in sensors.facility_neighbours(facility_dimension(network)).collect()}
    assert near["Brook Lift"]["upstream_id"] == 3


def test_newest_reading_of_a_cycle_wins(spark):
    network = sample_network(spark)
    at = datetime(2025, 1, 1)
    rows = spark.createDataFrame(
        [
            (5, at, "pressure", "Brook Dam", 900.0),
            (7, at, "pressure", "Brook Dam", 300.0),
            (6, at, "pressure", "Brook Dam", 100.0),
            (1, at + timedelta(seconds=1), "water_level", "Brook Dam", 10.0),
            (9, at, "water_level", "Brook Dam", 99.0),
            (3, at, "turbidity", "Brook Dam", None),
        ],
        "reading_id long, timestamp timestamp, sensor_type string, facility_name string, raw_value double",
    )
    rated = sensors.calibrate_readings(
        sensors.classify_readings(rows, sensor_dimension(network)), facility_dimension(network)
    )
    event = sensors.build_events(rated, facility_dimension(network)).collect()
    assert len(event) == 1
    got = {k: (r["value"], r["status"], r["unit"]) for k, r in event[0]["sensors"].items()}
    assert got == {
        "pressure": (300.0, "normal", "kPa"),
        "water_level": (15.0, "normal", "m"),
        "turbidity": (None, None, "NTU"),
    }
    assert event[0]["operational_metrics"]["status"] == "operational"


def test_status_changes_across_blocks(spark):
    rng = random.Random(2)
    rows, at = [], datetime(2025, 1, 1)
    for i in range(400):
        at += timedelta(minutes=rng.choice([1, 7, 50]))
        rows.append((f"e{i:04d}", at, ("hot" if i % 3 else "cold",), (rng.choice(["operational", "warning"]),)))
    frame = spark.createDataFrame(
        rows,
        "event_id string, timestamp timestamp, facility struct<name: string>, "
        "operational_metrics struct<status: string>",
    )
    got = {r["event_id"]: r["previous_status"] for r in sensors.status_changes(frame).collect()}
    want, last = {}, {}
    for event, _, (name,), (status,) in rows:
        if last.get(name) != status:
            want[event] = last.get(name)
        last[name] = status
    assert got == want


def with_gaps(spark):
    """Tickets without a flag, of unknown agents, without an agent and of a day out of range."""
    rows = [(1, START, 1, 1), (2, START, 1, 0), (3, START, 1, None), (4, START, 150, 1), (5, START, 150, None)]
    rows += [(6, START, None, 1), (7, START + timedelta(days=9), 1, 1), (8, START, 50, 0)]
    frame = spark.createDataFrame(rows, "ticket_id long, date_id date, agent_id long, resolved_in_first_contact int")
    return frame.withColumns(
        {"sla_compliance": F.lit(1), "reopened": F.when(F.col("ticket_id") != 2, 0), "resolution_time_hrs": F.lit(1.0)}
    )


def test_every_ticket_goes_one_way(spark):
    frame = with_gaps(spark)
    assert sorted(r[0] for r in tickets.resolved_tickets(frame).select("ticket_id").collect()) == [1, 4, 6, 7]
    assert sorted(r[0] for r in tickets.unresolved_tickets(frame).select("ticket_id").collect()) == [2, 3, 5, 8]


@pytest.mark.parametrize("every_agent", [True, False])
def test_performance_loses_no_ticket(spark, every_agent):
    frame = with_gaps(spark)
    days = START, START + timedelta(days=1)
    perf = performance.agent_daily_performance(frame, agent_dim(spark, 2), *days, every_agent=every_agent)
    got = perf.collect()
    assert sum(r["total_tickets_handled"] for r in got) == 8 and sum(r["backlog"] for r in got) == 4
    unknown = [r for r in got if r["agent_id"] == 150]
    assert [(r["department_id"], r["total_tickets_handled"], r["backlog"]) for r in unknown] == [(4, 2, 1)]
    ids = [r["performance_id"] for r in got]
    assert len(set(ids)) == len(ids) and 20250101150 in ids and 20250101000 in ids


def test_cuts_are_exact_with_ties(spark):
    rng = random.Random(9)
    rows = [(rng.choice([0.1, 0.5, 0.50001, 0.7]), rng.randint(1, 40), START + timedelta(days=i)) for i in range(500)]
    frame = spark.createDataFrame(rows, "x double, agent long, day date")
    keys = frame.select(F.floor(F.col("x") * 100).alias("cell"), "x", "agent", "day")
    ordered = sorted(rows)
    got = ranking.keys_at_shares(keys, [0.05, 0.12, 0.35])
    places = [25, 25 + 60, 25 + 60 + 175]
    assert [c[1:] for c in got] == [ordered[p - 1] for p in places]
    assert len(ranking.keys_at_shares(keys.limit(2), [0.05, 0.12, 0.35])) == 2


def test_asof_features_of_a_day_stored_twice(spark):
    rows = series(1, 60, 3, keep=1.0)
    frame = perf_frame(spark, [*rows, rows[40]])
    wanted = spark.createDataFrame([(START + timedelta(days=d),) for d in range(60)], "as_of date")
    got = features.asof_features(frame, wanted).collect()
    assert len(got) == 60 and all(r["as_of"] >= r["date_id"] for r in got)


def test_latest_features_of_a_look_back(spark):
    rows = series(4, 90, 5, keep=1.0)
    old = [(START, 99, 4, 1, 1.0, 0.1, 1, 1, 0.5, 1)]
    whole = features.latest_features(perf_frame(spark, rows)).orderBy("agent_id").collect()
    part = features.latest_features(perf_frame(spark, [*rows, *old]), days=30).orderBy("agent_id").collect()
    assert whole == part


def test_text_reading_ids(spark):
    network = sample_network(spark)
    at = datetime(2025, 1, 1)
    ids = ["a1f-0", "b2e-9", "c3d-5"]
    rows = [(i, at, "pressure", "Brook Dam", 300.0 + n) for n, i in enumerate(ids)]
    rows.append(("first", at - timedelta(seconds=1), "pressure", "Brook Dam", 1.0))
    frame = spark.createDataFrame(
        rows, "reading_id string, timestamp timestamp, sensor_type string, facility_name string, raw_value double"
    )
    rated = sensors.calibrate_readings(
        sensors.classify_readings(frame, sensor_dimension(network)), facility_dimension(network)
    )
    picks = {
        sensors.build_events(rated.repartition(n), facility_dimension(network), "1 day").where(
            F.col("timestamp") == F.lit(at)
        ).first()["sensors"]["pressure"]["value"]
        for n in (1, 3)
    }
    assert len(picks) == 1 and picks <= {300.0, 301.0, 302.0}
