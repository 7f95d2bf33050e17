"""Start event streams into tables; each micro-batch may be written again safely."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywater.operators import sensors
from tallywater.sources.events import malformed_messages, parse_messages, valid_events
from tallywater.sources.tables import zone


def _start(stream: DataFrame, checkpoint: str, every: str | None):
    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def append_stream(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append finished rows to Parquet; without ``every`` what is available is processed."""
    return _start(stream, checkpoint, every).outputMode("append").format("parquet").start(path)


def replace_stream(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keep the complete result of an aggregation, a folder per batch; ``read_newest`` reads it.

    Readers keep what they opened: a batch never writes where an earlier one did, and the folder
    of the batch before stays until the one after.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_path(path, batch_id))
        _forget(batch.sparkSession, path, batch_id - 2)

    return _start(stream, checkpoint, every).outputMode("complete").foreachBatch(write).start()


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest batch of ``replace_stream``."""
    every = spark.read.parquet(path)
    newest = every.agg(F.max("batch_id")).scalar()
    return every.where(F.col("batch_id") == newest).drop("batch_id")


def _batch_path(folder: str, batch_id: int) -> str:
    return f"{folder}/batch_id={batch_id}"


def _forget(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Remove the folder of a batch that no later one reads."""
    if batch_id >= 0:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_batch_path(folder, batch_id))
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def zone_stream(
    raw: DataFrame, root: str, name: str = "sensor_events", every: str | None = None
) -> StreamingQuery:
    """Messages to the raw zone, parsed events to cleaned, one row per reading to curated.

    Malformed messages go to a side table of the cleaned zone. Each batch owns
    its folder, so a repeated batch overwrites itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Parsed once: the rows are kept with their event, and every zone takes its part.
        parsed = parse_messages(batch).persist()
        try:
            targets = {
                zone(root, "raw") + f"/{name}": parsed.drop("event", "valid"),
                zone(root, "cleaned") + f"/{name}": valid_events(parsed),
                zone(root, "cleaned") + f"/{name}_malformed": malformed_messages(parsed),
                zone(root, "curated") + f"/{name}": sensors.explode_sensors(valid_events(parsed)),
            }
            for folder, rows in targets.items():
                rows.write.mode("overwrite").parquet(_batch_path(folder, batch_id))
        finally:
            parsed.unpersist()

    checkpoint = zone(root, "checkpoints") + f"/{name}"
    return _start(raw, checkpoint, every).foreachBatch(write).start()


class StateLost(RuntimeError):
    """The status of the batch before is missing: going on would report false changes."""


def status_stream(
    events: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Status changes of every facility on event time, carried over from batch to batch.

    The newest status per facility is stored with each batch and seeds the next one. An event
    older than its facility's newest stored status is late: the changes around it are already
    written, so it is kept apart in ``late`` and changes nothing. Inside a batch events are taken
    in the order of their time. A repeated batch reads the same seed and overwrites the same
    folders; only the seeds of the last two batches are kept. Only the first batch may find no
    seed: later on a missing one raises ``StateLost``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = batch.select(
            "event_id",
            "timestamp",
            F.struct("facility.name").alias("facility"),
            F.struct("operational_metrics.status").alias("operational_metrics"),
        )
        before = _seed(spark, f"{path}/latest", batch_id - 1)
        reached = before.select(
            F.col("facility.name").alias("_name"), F.col("timestamp").alias("_reached")
        )
        placed = own.join(reached, F.col("facility.name").eqNullSafe(F.col("_name")), "left")
        is_late = F.coalesce(F.col("timestamp") < F.col("_reached"), F.lit(False))
        late = placed.where(is_late).drop("_name", "_reached")
        late.write.mode("overwrite").parquet(_batch_path(f"{path}/late", batch_id))
        rows = placed.where(~is_late).drop("_name", "_reached").unionByName(before)
        changes = sensors.status_changes(rows).where(F.col("event_id").isNotNull())
        changes.write.mode("overwrite").parquet(_batch_path(f"{path}/changes", batch_id))
        newest = sensors.latest_status(rows)
        newest.write.mode("overwrite").parquet(_batch_path(f"{path}/latest", batch_id))
        _forget(spark, f"{path}/latest", batch_id - 2)

    return _start(events, checkpoint, every).foreachBatch(write).start()


def _seed(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    """The stored newest status as events without an id; no rows before the first batch."""
    if batch_id < 0:
        stored = spark.createDataFrame([], "facility_name string, since timestamp, status string")
    else:
        try:
            stored = spark.read.parquet(_batch_path(folder, batch_id))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            raise StateLost(f"no {_batch_path(folder, batch_id)}") from error
    name = F.col("facility_name").alias("name")
    return stored.select(
        F.lit(None).cast("string").alias("event_id"),
        F.col("since").alias("timestamp"),
        F.struct(name).alias("facility"),
        F.struct("status").alias("operational_metrics"),
    )
