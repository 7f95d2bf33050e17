"""Loads shown as a whole, dates from names alone, and measures kept up from changed days."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from test_jobs import FIRST, agents_frame, contacts, customers, usage

from tallywater.operators import ranking, tickets
from tallywater.plans import jobs
from tallywater.schemas import TABLES
from tallywater.sources import buckets, commits, tables

DAY = timedelta(days=1)
FACTS = ("fact_tickets", "fact_backlog", jobs.PERFORMANCE, "fact_billing")
ON = date(2026, 1, 1)


@pytest.fixture
def root(spark, tmp_path):
    root = str(tmp_path)
    tables.append_table(agents_frame(spark), root, "dim_agent")
    tables.append_table(customers(spark), root, "dim_customer")
    rows = [(4, "Customer Service", "m", 10), (5, "Billing", "m", 10)]
    tables.append_table(spark.createDataFrame(rows, TABLES["dim_department"].ddl), root, "dim_department")
    return root


def load(spark, root, day, n=60):
    return jobs.daily_load(spark, root, day, contacts(spark, day, n), usage(spark)).first()


def contents(spark, root, names=FACTS):
    return {n: sorted(map(str, tables.read_table(spark, root, n).collect())) for n in names}


def perf_rows(spark, days):
    names = TABLES[jobs.PERFORMANCE].schema
    return spark.createDataFrame([(None, d, i, 4, 5, 10.0, 0.1, 1, 0, 0.5, 0, 80.0) for d in days for i in range(3)], names)


def test_a_load_broken_between_two_tables_changes_nothing(spark, root, monkeypatch):
    load(spark, root, FIRST)
    before = contents(spark, root)

    def broken(*args):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "agent_daily_performance", broken)
        with pytest.raises(RuntimeError, match="lost"):
            load(spark, root, FIRST, 40)
        with pytest.raises(RuntimeError, match="lost"):
            load(spark, root, FIRST + DAY)
    assert contents(spark, root) == before
    assert [tables.stored_dates(spark, root, n) for n in FACTS] == [[FIRST]] * 4
    gone = commits.sweep(spark, root, list(FACTS))
    assert len(gone) == 4 and contents(spark, root) == before
    assert load(spark, root, FIRST, 40)["resolved"] < 40
    assert contents(spark, root) != before


def test_a_load_that_was_under_way_is_not_seen(spark, root):
    rows = perf_rows(spark, [FIRST])
    under_way = tables.Load(spark, root)
    under_way.put(rows, jobs.PERFORMANCE, FIRST)
    assert under_way.read(jobs.PERFORMANCE).count() == 3
    assert tables.read_table(spark, root, jobs.PERFORMANCE).isEmpty()
    assert tables.stored_dates(spark, root, jobs.PERFORMANCE) == []
    assert commits.sweep(spark, root, [jobs.PERFORMANCE], keep={under_way.id}) == []
    under_way.commit()
    assert tables.read_table(spark, root, jobs.PERFORMANCE).count() == 3


def test_an_unfinished_commit_does_not_count_and_two_at_once_conflict(spark, root, monkeypatch):
    tables.replace_dates(perf_rows(spark, [FIRST]), root, jobs.PERFORMANCE)
    log = f"{root}/{commits.LOG}"
    with open(f"{log}/{2:010d}.json", "w") as file:
        file.write('{"name": "fact_agent_performance", "day": "2025-01-01", "load": "gone", "filled": false, "commit": 2}\n')
    assert tables.stored_dates(spark, root, jobs.PERFORMANCE) == [FIRST]
    other = tables.Load(spark, root)
    other.put(perf_rows(spark, [FIRST + DAY]), jobs.PERFORMANCE, FIRST + DAY)
    with monkeypatch.context() as patch:
        patch.setattr(commits, "_numbers", lambda *args: [0])
        with pytest.raises(commits.ConflictingLoad):
            other.commit()
    assert other.commit() == 3
    assert tables.stored_dates(spark, root, jobs.PERFORMANCE) == [FIRST, FIRST + DAY]


def test_snapshots_repeat_what_is_visible(spark, root, monkeypatch):
    monkeypatch.setattr(commits, "SNAPSHOT", 4)
    days = [FIRST + n * DAY for n in range(10)]
    for n, day in enumerate(days):
        commits.commit(spark, root, [commits.Part("fact_tickets", day, f"l{n}", n % 3 > 0, 0)])
    opened = []
    read = commits._lines
    monkeypatch.setattr(commits, "_lines", lambda spark, root, n: opened.append(n) or read(spark, root, n))
    parts = commits.visible(spark, root)
    assert opened == [10, 9, 8]
    assert [(p.day, p.load, p.commit) for p in sorted(parts.values(), key=lambda p: p.day)] == [(d, f"l{n}", n + 1) for n, d in enumerate(days)]
    assert tables.stored_dates(spark, root, "fact_tickets") == [d for n, d in enumerate(days) if n % 3]


def test_dates_beside_and_in_loads(spark, root):
    days = [FIRST + n * DAY for n in range(4)]
    tables.append_table(perf_rows(spark, days[:3]), root, jobs.PERFORMANCE)
    tables.replace_day(perf_rows(spark, [days[1]]).limit(1), root, jobs.PERFORMANCE, days[1])
    tables.replace_day(perf_rows(spark, []), root, jobs.PERFORMANCE, days[2])
    tables.replace_day(perf_rows(spark, [days[3]]), root, jobs.PERFORMANCE, days[3])
    stored = tables.read_table(spark, root, jobs.PERFORMANCE).groupBy("date_id").count()
    assert {r[0]: r[1] for r in stored.collect()} == {days[0]: 3, days[1]: 1, days[3]: 3}
    assert tables.stored_dates(spark, root, jobs.PERFORMANCE) == [days[0], days[1], days[3]]
    tables.append_table(perf_rows(spark, [days[0]]), root, jobs.PERFORMANCE)
    with pytest.raises(ValueError, match="replace"):
        tables.append_table(perf_rows(spark, [days[3]]), root, jobs.PERFORMANCE)
    tables.replace_table(perf_rows(spark, [days[2]]), root, jobs.PERFORMANCE)
    assert tables.stored_dates(spark, root, jobs.PERFORMANCE) == [days[2]]
    assert tables.read_table(spark, root, jobs.PERFORMANCE).count() == 3
    with pytest.raises(ValueError):
        tables.Load(spark, root).put(perf_rows(spark, days), jobs.PERFORMANCE)


def test_due_dates_read_no_rows(spark, root):
    days = [FIRST + n * DAY for n in range(34)]
    tables.append_table(perf_rows(spark, days), root, jobs.PERFORMANCE)
    jobs_before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    assert jobs.due_dates(spark, root) == days[30:]
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs_before
    assert jobs.due_dates(spark, f"{root}/nothing") == []


def measure_rows(spark, root, names):
    return {n: sorted(tuple(r) for r in tables.read_table(spark, root, n).collect()) for n in names}


def full(spark, root, names):
    """The measures computed from all facts, as stored rows."""
    computed = jobs.measures(spark, root, ON)
    return {n: sorted(tuple(r) for r in tables.conform(computed[n], TABLES[n]).collect()) for n in names}


def same(got, want):
    for name, rows in want.items():
        assert len(got[name]) == len(rows), name
        for one, two in zip(got[name], rows):
            left, right = ([float(v) if isinstance(v, (float, int)) else v for v in r if not isinstance(v, date)] for r in (one, two))
            assert left == pytest.approx(right), name


def test_measures_follow_changed_days_alone(spark, root, monkeypatch):
    days = [FIRST + n * DAY for n in range(3)]
    for day in days:
        load(spark, root, day)
    changed = jobs.refresh_measures(spark, root, ON)
    assert all(changed[fact] == days for fact in FACTS)
    names = [n for n in TABLES if n.startswith("meas_")]
    some = ["meas_predictive", "meas_csat_drilldown"]
    assert not any(jobs.changed_dates(spark, root).values())
    # One day loaded again, with other contacts: its folders are the only facts that are read.
    load(spark, root, days[1], 35)
    read, original = [], jobs._of_dates
    monkeypatch.setattr(jobs, "_of_dates", lambda *args: read.append(original(*args)) or read[-1])
    changed = jobs.refresh_measures(spark, root, ON)
    assert all(changed[fact] == [days[1]] for fact in FACTS)
    files = [f for df in read for f in df.inputFiles()]
    assert files and all(f"date_id={days[1]}" in f for f in files)
    same(measure_rows(spark, root, names), full(spark, root, names))
    # A day without rows leaves the totals.
    empty = contacts(spark, days[2]).limit(0)
    jobs.daily_load(spark, root, days[2], empty, usage(spark).limit(0))
    jobs.refresh_measures(spark, root, ON)
    same(measure_rows(spark, root, some), full(spark, root, some))
    # Days named by the caller are summed anew, and nothing is counted twice.
    jobs.refresh_measures(spark, root, ON, days[:2])
    same(measure_rows(spark, root, some), full(spark, root, some))


def test_a_broken_refresh_changes_nothing(spark, root, monkeypatch):
    load(spark, root, FIRST)
    jobs.refresh_measures(spark, root, ON)
    names = [*jobs.TOTALS, *(t for t, _ in jobs.TOTALS.values()), "meas_predictive"]
    before = contents(spark, root, names)
    load(spark, root, FIRST + DAY)

    def broken(*args):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs.kpis, "customer_measures_of", broken)
        with pytest.raises(RuntimeError, match="lost"):
            jobs.refresh_measures(spark, root, ON)
    assert contents(spark, root, names) == before
    assert jobs.refresh_measures(spark, root, ON)["fact_tickets"] == [FIRST + DAY]
    same(measure_rows(spark, root, ["meas_predictive"]), full(spark, root, ["meas_predictive"]))


def test_sketches_stand_for_any_days(spark, root):
    for n in range(2):
        load(spark, root, FIRST + n * DAY)
    jobs.refresh_measures(spark, root, ON)
    for start, end in ((FIRST, FIRST), (FIRST, FIRST + DAY), (FIRST + 5 * DAY, FIRST + 9 * DAY)):
        got = {r["entity"]: r["estimate"] for r in jobs.distinct_entities(spark, root, start, end).collect()}
        for entity, (fact, column) in jobs.ENTITIES.items():
            rows = tables.scan_dates(tables.read_table(spark, root, fact), start, end)
            assert got.get(entity, 0) == pytest.approx(rows.select(F.countDistinct(column)).first()[0], rel=0.05, abs=0.5)


def moves(df):
    """Exchanges by a key or for the size of files in the plan of a frame, without those of its cached rows."""

    def walk(node):
        node = node.initialPlan() if node.nodeName() == "AdaptiveSparkPlan" else node
        text = node.simpleString(1000)
        below = [move for n in range(node.children().size()) for move in walk(node.children().apply(n))]
        return below + ([text] if text.startswith("Exchange") and "SinglePartition" not in text else [])

    return walk(df._jdf.queryExecution().executedPlan())


def test_tickets_of_a_day_do_not_move_once_they_are_dealt(spark, root, monkeypatch):
    plans, put = {}, tables.Load.put

    def seen(self, df, name, *args, **kwargs):
        put(self, df, name, *args, **kwargs)
        plans[name] = moves(df)

    def large(spark, root, name, **kwargs):
        """Customers as a dimension that is too large to broadcast."""
        df = tables.read_table(spark, root, name, **kwargs)
        return df.hint("merge") if name == "dim_customer" else df

    monkeypatch.setattr(tables.Load, "put", seen)
    monkeypatch.setattr(jobs, "read_table", large)
    monkeypatch.setattr(jobs, "FILE_ROWS", 20, raising=False)
    places = [(n, f"F{n}", "plant", f"District {n % 2}", 0.0, 0.0) for n in range(4)]
    tables.append_table(spark.createDataFrame(places, TABLES["dim_facility"].ddl), root, "dim_facility")
    # Without a facility, as it is then looked up by customer.
    rows = contacts(spark, FIRST).drop("facility_id")
    jobs.daily_load(spark, root, FIRST, rows, usage(spark).drop("facility_id"))
    # Counts per date may move.
    wide = ("customer_id", "agent_id", "ticket_id", "_block", "REBALANCE")
    assert [move for name in ("fact_tickets", "fact_backlog") for move in plans[name] if any(word in move for word in wide)] == []
    assert [move for move in plans["fact_billing"] if "customer_id" not in move and "district" not in move] == []
    folder = tables.read_table(spark, root, "fact_tickets").inputFiles()
    assert 1 <= len(folder) <= 3
    # Nothing is left of the rows that were dealt.
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("dealt_")]
    stored = tables.read_table(spark, root, "fact_backlog").orderBy("ticket_id").collect()
    assert [r["backlog_id"] for r in stored] == list(range(jobs.first_id(FIRST) + 1, jobs.first_id(FIRST) + 1 + len(stored)))


def test_tasks_of_a_day_follow_its_rows(spark, monkeypatch):
    monkeypatch.setattr(jobs, "FILE_ROWS", 100)
    monkeypatch.setattr(jobs, "LEAST_ROWS", 10)
    assert [jobs.day_tasks(spark.range(n)) for n in (0, 9, 25, 300, 1001, 10**6)] == [1, 1, 3, 4, 11, 1024]


def test_accounts_brought_to_the_rows_are_those_of_lookups(spark):
    rows = spark.createDataFrame(
        # Ids that come twice, lack, or aren't known.
        [(1, 1, "a"), (1, 1, "a"), (1, 1, "b"), (1, 2, "c"), (None, 2, "d"), (2, None, "e"), (3, 77, "f"), (None, None, "g"), (9, 3, "h")],
        "contact_id long, customer_id long, note string",
    )
    people = spark.createDataFrame(
        [(1, "North", "Domestic", "Home"), (2, "South", None, "Home"), (2, "North", "Trade", None), (3, None, "", "x"), (None, "South", "Trade", "y")],
        "customer_id long, district string, tariff_category string, customer_segment string",
    )
    places = spark.createDataFrame([(1, "North"), (2, "North"), (3, "South"), (4, None)], "facility_id long, district string")

    def found(some):
        return tickets.with_customer(tickets.with_facility(some, people, places, "contact_id"), people)

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    own = sorted(map(str, found(rows).collect()))
    blocked = rows.withColumn("_block", tickets.key_block("contact_id"))
    try:
        with buckets.co_partitioned(spark), buckets.in_buckets(blocked, "_block", 3) as dealt:
            met = tickets.with_accounts(dealt, people, "contact_id", 3)
            # Keys and customers by customer, and back by block; not the rows.
            assert len(moves(met)) == 3 and met.rdd.getNumPartitions() == 3
            once = sorted(map(str, found(met).drop("_block").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert once == own and len(own) == 15


def test_few_groups_give_the_same_numbers(spark):
    rows = spark.range(200).select((F.col("id") % 3).alias("day"), F.expr("nullif(id % 7, 3)").alias("block"), "id")
    one, other = (ranking.number_rows(rows, [["day"], ["block"]], ["id"], "n", 10, few=few) for few in (False, True))
    assert sorted(one.collect(), key=str) == sorted(other.select(*one.columns).collect(), key=str)
    assert sorted(r["n"] for r in other.collect()) == list(range(11, 211))
