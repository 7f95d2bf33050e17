"""Bucketed, sorted tables: joins and windows on the bucket key need no exchange.

A table is dealt to buckets by its key once, when it is written, one sorted file per bucket. Tables
with the same key and number of buckets then join bucket by bucket, also on further columns, and
windows per key run where the rows are. What a table is bucketed by is stored beside it, so any
session can open it again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallywater.session import fresh_folder
from tallywater.sources import commits

SPEC = "_bucketing.json"
#: A join on (key, more columns) may use that both sides are dealt by the key alone, and the order
#: inside single-file buckets is made use of.
SETTINGS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # Else Spark reads buckets of a plan as plain files where it finds only one use for them.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """Run plans over bucketed tables inside: the settings count when a plan is made."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _registered(root: str, name: str) -> str:
    return f"{name}_{md5(root.rstrip('/').encode()).hexdigest()[:12]}"


def write_bucketed(
    df: DataFrame, root: str, name: str, key: str, sort: Sequence[str], buckets: int
) -> None:
    """Write ``df`` in ``buckets`` buckets by ``key``, sorted by ``sort``, and say so beside it.

    Choose ``buckets`` so that one fits a task; all rows of a key share a bucket. Rows that were
    stored before stay readable until the new ones are complete.
    """
    spark, folder = df.sparkSession, f"{root.rstrip('/')}/{name}"
    version = commits.fresh_name()
    table = _registered(root, name)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    # Dealt as the buckets are, so that a bucket is written by one task to one file.
    rows = df.repartition(buckets, key)
    writer = rows.write.format("parquet").bucketBy(buckets, key).sortBy(*sort)
    writer.option("path", f"{folder}/{version}").saveAsTable(table)
    spec = {"version": version, "ddl": _ddl(df), "key": key, "sort": list(sort), "buckets": buckets}
    commits.write_text(spark, f"{folder}/{SPEC}", json.dumps(spec))


@contextmanager
def in_buckets(df: DataFrame, key: str, buckets: int) -> Iterator[DataFrame]:
    """The rows of ``df`` in ``buckets`` by ``key`` while a job needs them; plan it inside ``co_partitioned``.

    Every task writes its rows of a bucket to a file of its own (files: tasks times ``buckets``), so nothing
    is shuffled: wide rows take a third of the bytes as Parquet columns.
    """
    spark = df.sparkSession
    folder, table = fresh_folder(spark, "dealt"), f"dealt_{commits.fresh_name()}"
    # Columns without a type can't be stored.
    typed = df.withColumns({name: F.col(name).cast("string") for name, kind in df.dtypes if kind == "void"})
    try:
        typed.write.format("parquet").bucketBy(buckets, key).option("path", folder).saveAsTable(table)
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        commits.remove(spark, folder)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def bucket_spec(spark: SparkSession, root: str, name: str) -> dict:
    return json.loads(commits.read_text(spark, f"{root.rstrip('/')}/{name}/{SPEC}"))


def open_bucketed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table as it is bucketed; registered in this session if it isn't yet."""
    spec, table = bucket_spec(spark, root, name), _registered(root, name)
    place = f"{root.rstrip('/')}/{name}/{spec['version']}"
    if spark.catalog.tableExists(table) and spark.table(table).inputFiles() and place not in spark.table(table).inputFiles()[0]:
        spark.sql(f"DROP TABLE {table}")
    order = ", ".join(spec["sort"])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({spec['ddl']}) USING parquet "
        f"CLUSTERED BY ({spec['key']}) SORTED BY ({order}) INTO {spec['buckets']} BUCKETS LOCATION '{place}'"
    )
    return spark.table(table)


def order_breaks(rows: DataFrame, sort: Sequence[str]) -> DataFrame:
    """One row: files, rows, and rows that come before their predecessor in their file.

    ``rows`` is read from files; a file is the unit that is compared, as it was written.
    """
    placed = rows.select(
        F.struct(*sort).alias("_key"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at")
    )
    before = F.lag("_key").over(Window.partitionBy("_file").orderBy("_at"))
    return placed.withColumn("_break", F.col("_key") < before).agg(
        F.countDistinct("_file").alias("files"), F.count(F.lit(1)).alias("n"), F.count_if("_break").alias("breaks")
    )
