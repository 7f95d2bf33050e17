"""Files that a predicate picks: fewer than all, never one too few."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallywater.sources import skipping, tables

NAME = "fact_tickets"
FIRST = date(2025, 1, 1)
SPEC = tables.declared(NAME)


def rows(spark, days, per_day=50):
    rnd = random.Random(days[0].toordinal())
    out = []
    for n, day in enumerate(days):
        for i in range(per_day):
            hours = None if i == 0 else float(day.day * 10 + rnd.random())
            out.append((day.toordinal() * 1000 + i, day, rnd.randrange(10_000), 1, 4, i, "Leakage" if day.day % 3 else None, "Phone", hours, 0, 1, 4.0, 3, 2.0, 1, 5))
    return spark.createDataFrame(out, SPEC.schema)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("skip"))
    days = [FIRST + timedelta(days=n) for n in range(8)]
    tables.append_table(rows(spark, days[:4]), root, NAME)
    tables.replace_dates(rows(spark, days[4:]), root, NAME)
    return root


CASES = [
    ({"issue_category": "Leakage"}, {}, 6), ({"issue_category": "Sewage"}, {}, 0), ({}, {"resolution_time_hrs": (20, 41)}, 3),
    ({}, {"resolution_time_hrs": (900, 901)}, 0), ({"ticket_id": (FIRST + timedelta(days=5)).toordinal() * 1000 + 7}, {}, 1),
    ({"issue_category": "Leakage"}, {"resolution_time_hrs": (30, 45)}, 1), ({"agent_id": 3}, {}, 8),
]


@pytest.mark.parametrize("equals, between, files", CASES)
def test_rows_are_the_same_and_files_fewer(spark, root, equals, between, files):
    skipping.index_files(spark, root, NAME)
    chosen = skipping.candidate_files(spark, root, NAME, equals, between)
    assert len(chosen) == files
    every = tables.read_table(spark, root, NAME)
    for column, value in equals.items():
        every = every.where(F.col(column) == F.lit(value))
    for column, (low, high) in between.items():
        every = every.where(F.col(column).between(low, high))
    got = skipping.read_where(spark, root, NAME, equals, between)
    assert sorted(map(str, got.collect())) == sorted(map(str, every.collect()))
    assert sorted(got.inputFiles()) == chosen


def test_blooms_miss_no_id_and_few_files_are_read_in_vain(spark, root):
    skipping.index_files(spark, root, NAME)
    holds = {}
    for r in tables.read_table(spark, root, NAME).select("customer_id", "date_id").distinct().collect():
        holds.setdefault(r[0], set()).add(str(r[1]))
    asked, vain = 0, 0
    for customer in [*sorted(holds)[:15], *range(20_000, 20_010)]:
        files = skipping.candidate_files(spark, root, NAME, {"customer_id": customer})
        found = {f.split("date_id=")[1][:10] for f in files}
        assert holds.get(customer, set()) <= found
        asked, vain = asked + 8, vain + len(found - holds.get(customer, set()))
    assert vain <= asked * 0.1


def test_new_files_are_read_before_they_are_indexed(spark, tmp_path):
    root = str(tmp_path)
    assert skipping.candidate_files(spark, root, NAME) == []
    tables.append_table(rows(spark, [FIRST]), root, NAME)
    assert len(skipping.candidate_files(spark, root, NAME, {"issue_category": "Sewage"})) == 1
    assert skipping.index_files(spark, root, NAME) == 1 and skipping.index_files(spark, root, NAME) == 0
    assert skipping.candidate_files(spark, root, NAME, {"issue_category": "Sewage"}) == []
    tables.append_table(rows(spark, [FIRST + timedelta(days=1)]), root, NAME)
    assert len(skipping.candidate_files(spark, root, NAME, {"issue_category": "Sewage"})) == 1
    assert skipping.read_where(spark, root, NAME, {"issue_category": "Leakage"}).count() == 100
    # A day that was replaced is read from its new file alone.
    skipping.index_files(spark, root, NAME)
    tables.replace_day(rows(spark, [FIRST], 3), root, NAME, FIRST)
    skipping.index_files(spark, root, NAME)
    assert skipping.read_where(spark, root, NAME, {"issue_category": "Leakage"}).count() == 53
