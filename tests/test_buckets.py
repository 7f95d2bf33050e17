"""Bucketed tables: no exchange in the plan, the same rows, opened again by any session."""

import pytest
from pyspark.sql import functions as F

from tallywater.plans import jobs
from tallywater.sources import buckets, tables
from verify import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def root(spark):
    return catalog._bucketed_root(spark, SF)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_joins_and_windows_need_no_exchange(spark, root):
    before = {key: spark.conf.get(key, None) for key in buckets.SETTINGS}
    with buckets.co_partitioned(spark):
        plan = final_plan(jobs.bucketed_training_frame(spark, root))
    assert plan.count("SortMergeJoin") == 2 and "Window" in plan
    # Buckets are joined in their stored order; only the window sorts again, inside its bucket.
    assert "Exchange" not in plan and plan.count("Sort [") == 1 and plan.index("Sort [") < plan.index("SortMergeJoin")
    assert {key: spark.conf.get(key, None) for key in buckets.SETTINGS} == before


def test_a_table_is_opened_again_by_what_lies_beside_it(spark, root):
    place = f"{root}/bucketed"
    rows = sorted(buckets.open_bucketed(spark, place, "performance").collect())
    spark.sql(f"DROP TABLE {buckets._registered(place, 'performance')}")
    again = buckets.open_bucketed(spark, place, "performance")
    assert sorted(again.collect()) == rows
    spec = buckets.bucket_spec(spark, place, "performance")
    assert (spec["key"], spec["sort"], spec["buckets"]) == ("agent_id", ["agent_id", "date_id"], catalog.BUCKETS)


def test_a_table_written_again_shows_its_new_rows(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("k"))
    buckets.write_bucketed(rows, root, "t", "k", ["k", "id"], 4)
    first = buckets.open_bucketed(spark, root, "t")
    assert first.count() == 100 and len(first.inputFiles()) <= 4
    buckets.write_bucketed(rows.where("id < 10"), root, "t", "k", ["k", "id"], 4)
    assert buckets.open_bucketed(spark, root, "t").count() == 10
    assert buckets.order_breaks(buckets.open_bucketed(spark, root, "t"), ["k", "id"]).first()["breaks"] == 0


def test_order_breaks_are_seen(spark, tmp_path):
    rows = spark.createDataFrame([(1,), (3,), (2,), (2,), (5,), (4,)], "id int").coalesce(1)
    rows.write.parquet(str(tmp_path / "t"))
    got = buckets.order_breaks(spark.read.parquet(str(tmp_path / "t")), ["id"]).first()
    assert tuple(got) == (1, 6, 2)
    assert tuple(buckets.order_breaks(spark.read.parquet(str(tmp_path / "t")).where("id > 9"), ["id"]).first()) == (0, 0, 0)


def test_agents_of_stored_tables_are_those_of_the_extract(spark, root):
    assert buckets.open_bucketed(spark, f"{root}/bucketed", "agents").count() == tables.read_table(spark, root, "dim_agent").count()
