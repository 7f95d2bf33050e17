"""File skipping: what a stored file can hold, so that a query opens only files that matter.

For each file of a table a row tells the bounds of some columns and the set of values of others, and
Bloom filters tell which ids may be in it. The rows come from one aggregation per file and lie beside
the table; files are never changed, so only new ones are added. A predicate first picks files from
these rows and then reads the chosen ones with the same predicate: results never depend on the index,
and files that it doesn't know are always read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallywater.sources import commits
from tallywater.sources.tables import declared, read_table, table_path


@dataclass(frozen=True)
class Skipping:
    """Columns with a set of values (few distinct ones), with bounds, and with a Bloom filter."""

    sets: tuple[str, ...] = ()
    bounds: tuple[str, ...] = ()
    ids: tuple[str, ...] = ()


# Value sets of the risk category and its code, bounds of the risk score.
INDEXES = {
    "fact_agent_burnout_prediction": Skipping(
        ("risk_category", "risk_category_encoded"), ("burnout_risk_score",), ("agent_id",)
    ),
    "fact_tickets": Skipping(("issue_category",), ("resolution_time_hrs", "ticket_id"), ("customer_id",)),
    "fact_backlog": Skipping(("priority", "backlog_status"), ("days_in_backlog",), ("customer_id",)),
}
FOLDER = "_skipping"
#: A Bloom filter has this many bits per row of its file, in bitmaps of 2**15 bits, and sets this many
#: of them per id: about one file in fifty is read in vain.
BITS_PER_ROW = 8
BITMAP = 1 << 15
HASHES = 4


def _key(name: str, file: Column) -> Column:
    """A file's path below its table: folders may be reached by several paths."""
    return F.regexp_extract(file, f"/{name}/(.*)$", 1)


def _positions(value: Column, bits: Column) -> Column:
    """The bits of an id, counted from 1."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(k), value.cast("string")), bits) + 1 for k in range(HASHES)])


def _folder(root: str, name: str, part: str) -> str:
    return f"{table_path(root, name)}/{FOLDER}/{part}"


def _read(spark: SparkSession, root: str, name: str, part: str) -> DataFrame | None:
    try:
        return spark.read.parquet(_folder(root, name, part))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current_files(spark: SparkSession, root: str, name: str) -> dict[str, str]:
    """Path by key of the files that a read of the table opens now."""
    return {file.rpartition(f"/{name}/")[2]: file for file in read_table(spark, root, name).inputFiles()}


def index_files(spark: SparkSession, root: str, name: str) -> int:
    """Add the files that the index doesn't know; gives their number."""
    spec = INDEXES[name]
    known = _read(spark, root, name, "files")
    done = {r[0] for r in known.select("file").collect()} if known else set()  # one row per file
    new = {key: file for key, file in current_files(spark, root, name).items() if key not in done}
    if not new:
        return 0
    rows = _files_of(spark, root, name, new.values()).withColumn("file", _key(name, F.input_file_name()))
    about = [F.count(F.lit(1)).alias("n")]
    about += [F.array_sort(F.collect_set(F.col(c).cast("string"))).alias(f"set_{c}") for c in spec.sets]
    about += [f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in spec.bounds for n, f in (("min", F.min), ("max", F.max))]
    files = rows.groupBy("file").agg(*about)
    bits = (F.ceil(F.col("n") * BITS_PER_ROW / BITMAP) * BITMAP).cast("long")
    files = files.withColumn("bits", bits)
    if spec.ids:
        sizes = files.select("file", "bits")
        ids = rows.select("file", F.explode(F.create_map(*[x for c in spec.ids for x in (F.lit(c), F.col(c).cast("string"))])).alias("column", "id"))
        placed = (
            ids.where("id IS NOT NULL").join(sizes, "file").select("file", "column", F.explode(_positions(F.col("id"), F.col("bits"))).alias("at"))
        )
        blooms = placed.groupBy("file", "column", F.bitmap_bucket_number("at").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap")
        )
        # The filters first: a file is known once all of it is.
        blooms.write.mode("append").parquet(_folder(root, name, "blooms"))
    files.write.mode("append").parquet(_folder(root, name, "files"))
    return len(new)


def _files_of(spark: SparkSession, root: str, name: str, files: Iterable[str]) -> DataFrame:
    """The rows of some files of the table, whichever folders they lie in."""
    spec, loaded, plain = declared(name), [], []
    for file in files:
        (loaded if f"/{name}/{commits.LOADS}/" in file else plain).append(file)
    parts = []
    for some, base in ((loaded, f"{table_path(root, name)}/{commits.LOADS}"), (plain, table_path(root, name))):
        if some:
            parts.append(spark.read.schema(spec.schema).option("basePath", base).parquet(*some).select(*spec.columns))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], spec.schema)


def candidate_files(
    spark: SparkSession, root: str, name: str, equals: Mapping[str, object] = {}, between: Mapping[str, tuple] = {}
) -> list[str]:
    """Files that may hold rows where each column of ``equals`` has its value and each column of
    ``between`` lies in its closed range. Columns without an index exclude nothing."""
    spec, now = INDEXES[name], current_files(spark, root, name)
    known = _read(spark, root, name, "files")
    if known is None:
        return sorted(now.values())
    kept = known
    for column, value in equals.items():
        if column in spec.sets:
            kept = kept.where(F.array_contains(f"set_{column}", F.lit(str(value))))
        if column in spec.bounds:
            kept = kept.where(F.lit(float(value)).between(F.col(f"min_{column}"), F.col(f"max_{column}")))
        if column in spec.ids:
            kept = kept.join(_may_hold(spark, root, name, known, column, value), "file", "left_semi")
    for column, (low, high) in between.items():
        if column in spec.bounds:
            kept = kept.where((F.col(f"max_{column}") >= F.lit(float(low))) & (F.col(f"min_{column}") <= F.lit(float(high))))
    indexed = {r[0] for r in known.select("file").collect()}
    chosen = {r[0] for r in kept.select("file").collect()}  # names of files only
    return sorted(file for key, file in now.items() if key in chosen or key not in indexed)


def _may_hold(spark: SparkSession, root: str, name: str, files: DataFrame, column: str, value: object) -> DataFrame:
    """Files whose Bloom filter has all bits of an id."""
    asked = files.select("file", F.explode(_positions(F.lit(str(value)), F.col("bits"))).alias("at")).distinct()
    blooms = _read(spark, root, name, "blooms").where(F.col("column") == column)
    found = asked.withColumn("bucket", F.bitmap_bucket_number("at")).join(blooms, ["file", "bucket"])
    bit = F.bitmap_bit_position("at")
    byte = F.conv(F.hex(F.substring("bitmap", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (bit % 8).cast("int")) == 1
    whole = asked.groupBy("file").agg(F.count(F.lit(1)).alias("asked"))
    hits = found.where(is_set).groupBy("file").agg(F.count(F.lit(1)).alias("hits"))
    return whole.join(hits, "file").where("asked = hits").select("file")


def read_where(
    spark: SparkSession, root: str, name: str, equals: Mapping[str, object] = {}, between: Mapping[str, tuple] = {}
) -> DataFrame:
    """The rows that satisfy the predicates, read from the candidate files alone."""
    rows = _files_of(spark, root, name, candidate_files(spark, root, name, equals, between))
    for column, value in equals.items():
        rows = rows.where(F.col(column) == F.lit(value))
    for column, (low, high) in between.items():
        rows = rows.where(F.col(column).between(low, high))
    return rows
