"""Reading and writing the declared tables as Parquet (and CSV hand-off files)."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F

from tallywater.schemas import PARTS, TABLES, Table
from tallywater.sources import commits

FIRST_DAY = date(2025, 1, 1)
ZONES = ("raw", "cleaned", "curated", "checkpoints")


def zone(root: str, name: str) -> str:
    """Path of one of the storage zones below ``root``."""
    if name not in ZONES:
        raise ValueError(f"unknown zone {name!r}; one of {', '.join(ZONES)}")
    return f"{root.rstrip('/')}/{name}"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


class MissingTable(FileNotFoundError):
    """A table that a job needs was never written below the root."""


def declared(name: str) -> Table:
    return TABLES[name] if name in TABLES else PARTS[name]


def read_table(
    spark: SparkSession, root: str, name: str, required: bool = False, days: Collection[date] | None = None
) -> DataFrame:
    """A declared table by name; one never written reads as empty, or raises if ``required``.

    Dates that loads committed are read where the log says; other dates where ``append_table`` put
    them. With ``days`` no other date's folder is even listed.
    """
    spec = declared(name)
    parts = commits.parts_of(spark, root, name)
    if parts and not spec.partition:
        return _read_parts(spark, root, name, parts)
    if parts or days is not None:
        others = _folder_dates(spark, root, name) - {part.day for part in parts}
        if required and not parts and not others:
            raise MissingTable(f"no table {name} at {table_path(root, name)}")
        if days is not None:
            parts, others = [part for part in parts if part.day in days], others & set(days)
        loaded = _read_parts(spark, root, name, parts)
        return loaded.unionByName(_read_dates(spark, root, name, others)) if others else loaded
    try:
        return spark.read.schema(spec.schema).parquet(table_path(root, name)).select(*spec.columns)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if required:
            raise MissingTable(f"no table {name} at {table_path(root, name)}") from error
        return spark.createDataFrame([], spec.schema)


def _read_dates(spark: SparkSession, root: str, name: str, dates: Collection[date]) -> DataFrame:
    """Dates that lie in folders of their own."""
    spec, base = declared(name), table_path(root, name)
    folders = [f"{base}/{spec.partition}={day.isoformat()}" for day in sorted(dates)]
    return spark.read.schema(spec.schema).option("basePath", base).parquet(*folders).select(*spec.columns)


def _read_parts(spark: SparkSession, root: str, name: str, parts: Sequence[commits.Part]) -> DataFrame:
    spec = declared(name)
    folders = [commits.part_folder(root, name, p.load, spec.partition, p.day) for p in parts if p.filled]
    if not folders:
        return spark.createDataFrame([], spec.schema)
    reader = spark.read.schema(spec.schema).option("basePath", f"{table_path(root, name)}/{commits.LOADS}")
    return reader.parquet(*folders).select(*spec.columns)


def _folder_dates(spark: SparkSession, root: str, name: str) -> set[date]:
    """Dates that have a folder of their own, by name."""
    head = f"{declared(name).partition}="
    names = (folder for folder, is_folder in commits.listed(spark, table_path(root, name)) if is_folder)
    return {date.fromisoformat(n.removeprefix(head)) for n in names if n.startswith(head)}


def stored_dates(spark: SparkSession, root: str, name: str) -> list[date]:
    """Dates a table holds rows of, in order, from the commit log and the names of its folders: no
    row is read, and their number is bounded by the calendar."""
    parts = commits.parts_of(spark, root, name)
    plain = _folder_dates(spark, root, name) - {p.day for p in parts}
    return sorted(plain | {p.day for p in parts if p.filled})


def date_rows(spark: SparkSession, dates: Sequence[date]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in dates], "date_id date")


class Load:
    """Parts of several tables, written apart and shown together by ``commit``.

    ``with Load(spark, root) as load`` commits at the end of the block, and not at all if it raises.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.id = spark, root, commits.fresh_name()
        self.parts: list[commits.Part] = []

    def put(self, df: DataFrame, name: str, day: date | None = None, dealt: bool = False) -> None:
        """The rows of ``day``, or of the whole undated table; no rows empty it.

        Rows that are ``dealt`` to tasks of a file's size are written where they are.
        """
        spec = declared(name)
        if bool(spec.partition) != (day is not None):
            raise ValueError(f"{name} has no date partition" if day else f"{name} needs a day")
        rows = conform(df, spec)
        rows = rows.drop(spec.partition) if day else rows
        order = [column for column in spec.sort if column != spec.partition]
        folder = commits.part_folder(self.root, name, self.id, spec.partition, day)
        placed = rows if dealt else rows.hint("rebalance")
        _with_blooms(placed.sortWithinPartitions(*order).write, spec).mode("overwrite").parquet(folder)
        self._add(name, day, not self.spark.read.schema(rows.schema).parquet(folder).isEmpty())

    def put_days(self, df: DataFrame, name: str, days: Sequence[date] = ()) -> None:
        """The rows of many days in one job; of ``days`` those without rows are emptied."""
        spec = declared(name)
        folder = commits.part_folder(self.root, name, self.id)
        _writer(df, spec).mode("overwrite").parquet(folder)
        head = f"{spec.partition}="
        filled = {date.fromisoformat(n.removeprefix(head)) for n, _ in commits.listed(self.spark, folder) if n.startswith(head)}
        for day in sorted(filled | set(days)):
            self._add(name, day, day in filled)

    def _add(self, name: str, day: date | None, filled: bool) -> None:
        self.parts.append(commits.Part(name, day, self.id, filled, 0))

    def read(self, name: str) -> DataFrame:
        """What this load has put so far, before anyone else sees it."""
        return _read_parts(self.spark, self.root, name, [p for p in self.parts if p.name == name])

    def commit(self) -> int:
        return commits.commit(self.spark, self.root, self.parts)

    def __enter__(self) -> Load:
        return self

    def __exit__(self, kind, *error) -> None:
        if kind is None and self.parts:
            self.commit()


def scan_dates(df: DataFrame, start: object, end: object, columns: Sequence[str] = ()) -> DataFrame:
    """Rows with ``date_id`` in the closed range, projected; both reach the scan."""
    kept = df.where(F.col("date_id").between(start, end))
    return kept.select(*columns) if columns else kept


def conform(df: DataFrame, spec: Table) -> DataFrame:
    """Columns in declared order and type, with declared defaults for nulls and gaps."""
    missing = [c for c in spec.columns if c not in df.columns and c not in spec.defaults]
    if missing:
        raise ValueError(f"columns without a value or a default: {', '.join(missing)}")

    def value(name: str) -> Column:
        if name not in df.columns:
            return spec.default(name)
        if name in spec.defaults:
            return F.coalesce(F.col(name), spec.default(name))
        return F.col(name)

    return df.select(
        *[value(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields]
    )


def _writer(df: DataFrame, spec: Table):
    """Rows clustered by date (hot dates split, small ones merged) and sorted for skipping."""
    rows = conform(df, spec)
    if spec.partition:
        rows = rows.hint("rebalance", F.col(spec.partition))
    writer = _with_blooms(rows.sortWithinPartitions(*spec.sort).write, spec)
    return writer.partitionBy(spec.partition) if spec.partition else writer


def _with_blooms(writer: DataFrameWriter, spec: Table) -> DataFrameWriter:
    for column in spec.bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer


def append_table(df: DataFrame, root: str, name: str) -> None:
    """Add rows beside the stored ones. Dates that a load committed belong to loads: they raise."""
    spec, spark = declared(name), df.sparkSession
    parts = commits.parts_of(spark, root, name)
    if parts:
        own = [part.day for part in parts]
        if not spec.partition or not df.where(F.col(spec.partition).isin(own)).isEmpty():
            raise ValueError(f"{name} was written by loads; replace its rows instead")
    _writer(df, spec).mode("append").parquet(table_path(root, name))


def replace_dates(df: DataFrame, root: str, name: str) -> None:
    """Replace exactly the dates present in ``df``, all at once: running a load again adds nothing."""
    if not declared(name).partition:
        raise ValueError(f"{name} has no date partition")
    with Load(df.sparkSession, root) as load:
        load.put_days(df, name)


def replace_day(df: DataFrame, root: str, name: str, day: date) -> None:
    """Replace one stored date by ``df``, the rows of that date; no rows empty the date."""
    with Load(df.sparkSession, root) as load:
        load.put(df, name, day)


def replace_table(df: DataFrame, root: str, name: str) -> None:
    """Replace the whole table; ``df`` may read from it."""
    spark = df.sparkSession
    with Load(spark, root) as load:
        if declared(name).partition:
            load.put_days(df, name, stored_dates(spark, root, name))
        else:
            load.put(df, name)


def load_if_empty(df: DataFrame, root: str, name: str) -> bool:
    """Write ``df`` only when the table holds nothing; tells whether it was written."""
    if not read_table(df.sparkSession, root, name).isEmpty():
        return False
    append_table(df, root, name)
    return True


def unseen_rows(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet: the row-level form of skip-if-populated."""
    return df.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def last_key(df: DataFrame, column: str, default: int = 0) -> DataFrame:
    """One row: the largest stored key, or ``default`` on an empty table."""
    return df.agg(F.coalesce(F.max(column), F.lit(default)).cast("long").alias("last_key"))


def next_date(df: DataFrame, first: date = FIRST_DAY) -> DataFrame:
    """One row: the day after the newest stored date, or ``first`` on an empty table."""
    return df.agg(F.coalesce(F.date_add(F.max("date_id"), 1), F.lit(first)).alias("next_date"))


def read_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.option("header", True).schema(ddl).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
