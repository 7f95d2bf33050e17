"""Inputs of the registered queries grow in files and tasks, not in what one of them holds."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallywater.plans import jobs
from verify import adapters as a


@pytest.fixture
def events(spark, tmp_path):
    rows = spark.range(4000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.col("id").alias("user_id"), F.lit(1.0).alias("value")
    )
    rows.write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_files_of_a_part_follow_its_rows(spark, events, monkeypatch):
    monkeypatch.setattr(a, "_EVENT_FOLDERS", {})
    monkeypatch.setattr(a, "FILE_ROWS", 100)
    folder, files = a.event_files(spark, events, True)
    held = spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()
    assert files == 14 and len(held) == 3 * files
    assert max(r["count"] for r in held) <= 110 and sum(r["count"] for r in held) == 4000
    monkeypatch.setattr(a, "_EVENT_FOLDERS", {})
    monkeypatch.setattr(a, "FILE_ROWS", 10**6)
    assert a.event_files(spark, events, False)[1] == a.FILES


def test_tasks_of_the_backfill_follow_its_rows(spark, monkeypatch):
    monkeypatch.setattr(jobs, "TASK_ROWS", 50)
    perf = spark.range(1000).select(F.lit(date(2025, 1, 1)).alias("date_id"), (F.col("id") % 300).alias("agent_id"))
    dealt = jobs.by_agent(perf)
    assert dealt.rdd.getNumPartitions() == 20
    spread = dealt.withColumn("task", F.spark_partition_id()).groupBy("agent_id").agg(F.countDistinct("task").alias("n"))
    assert spread.where("n > 1").isEmpty() and dealt.count() == 1000


def test_lines_joined_once_give_the_tickets_and_bills_of_joins_of_their_own(spark, tmp_path):
    sf = str(tmp_path)
    day = F.timestamp_seconds(F.lit(800_000_000) + F.col("id") * 86_400)
    n = F.col("id")
    lineitem = spark.range(60).select(
        (n / 4).cast("long").alias("l_orderkey"), (n % 4).cast("int").alias("l_linenumber"), (n % 11).alias("l_partkey"), (n % 5).alias("l_suppkey"),
        (n % 50).cast("double").alias("l_quantity"), (n % 10 / 100).alias("l_discount"), F.when(n % 3 == 0, "R").otherwise("N").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"), day.alias("l_shipdate"),
    )
    # Orders without a customer, with an unknown one and twice; a customer twice.
    orders = spark.createDataFrame([(k, None if k == 3 else 77 if k == 4 else k % 3) for k in [*range(14), 5]], "o_orderkey long, o_custkey long")
    customer = spark.createDataFrame(
        [(0, "A", "BUILDING", 1), (1, "B", None, 2), (1, "B2", "FURNITURE", None), (2, "C", "MACHINERY", 3), (None, "N", "BUILDING", 1)],
        "c_custkey long, c_name string, c_mktsegment string, c_nationkey long",
    )
    for name, df in {"lineitem": lineitem, "orders": orders, "customer": customer}.items():
        df.write.parquet(f"{sf}/{name}.parquet")
    own = [a.tickets(spark, sf, customers=True), a.usage(spark, sf)]
    with a.joined_lines(spark, sf):
        once = [a.tickets(spark, sf, customers=True), a.usage(spark, sf)]
    for one, other in zip(own, once):
        assert one.columns == other.columns and one.count() == other.count() > 50
        assert one.exceptAll(other).isEmpty()
    assert "Exchange" not in once[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in once[1]._jdf.queryExecution().executedPlan().toString()
