"""The time dimension and date-range helpers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tallywater.operators.joins import missing_dates, one_row_per_day
from tallywater.sources.tables import FIRST_DAY, next_date

TRAINING_DAYS = 90


def calendar_row(day: str = "date_id") -> list[Column]:
    return [
        F.col(day).alias("date_id"),
        F.col(day).alias("full_date"),
        F.dayofmonth(day).cast("short").alias("day"),
        F.month(day).cast("short").alias("month"),
        F.quarter(day).cast("short").alias("quarter"),
        F.year(day).cast("int").alias("year"),
    ]


def missing_calendar(dim_time: DataFrame, target: Column | date, first: date = FIRST_DAY):
    """Rows to append so that the dimension reaches ``target``; none when it already does."""
    last = target if isinstance(target, Column) else F.lit(target)
    start = next_date(dim_time, first).withColumn("_last", last)
    due = start.where(F.col("next_date") <= F.col("_last"))
    days = due.select(F.explode(F.sequence("next_date", "_last")).alias("date_id"))
    return days.select(*calendar_row())


def coverage(df: DataFrame, entity: str = "agent_id") -> DataFrame:
    """One row: first and last day, day span, distinct days, rows, entities, rows per entity."""
    return df.agg(
        F.min("date_id").alias("first_day"),
        F.max("date_id").alias("last_day"),
        (F.datediff(F.max("date_id"), F.min("date_id")) + 1).alias("span_days"),
        F.countDistinct("date_id").alias("distinct_days"),
        F.count("*").alias("row_count"),
        F.countDistinct(entity).alias("entities"),
    ).withColumn("rows_per_entity", F.col("row_count") / F.col("entities"))


def training_range(df: DataFrame, days: int = TRAINING_DAYS) -> DataFrame:
    """One row ``start``/``end``: the last ``days`` days, or everything when there are fewer."""
    span = df.agg(
        F.min("date_id").alias("_first"),
        F.max("date_id").alias("end"),
        F.countDistinct("date_id").alias("days"),
    )
    start = F.when(F.col("days") < days, F.col("_first")).otherwise(F.date_sub("end", days))
    return span.select(start.alias("start"), "end", "days")


def in_training_range(df: DataFrame, reference: DataFrame, days: int = TRAINING_DAYS) -> DataFrame:
    """Rows of ``df`` inside the training range of ``reference``; resolved while running."""
    limits = training_range(reference, days)
    start, end = limits.select("start").scalar(), limits.select("end").scalar()
    return df.where(F.col("date_id").between(start, end))


def backfill_dates(perf: DataFrame, done: DataFrame, days: int = 30) -> DataFrame:
    """Distinct days at least ``days`` after the first one and without a stored prediction."""
    start = F.date_add(perf.agg(F.min("date_id")).scalar(), days)
    candidates = perf.where(F.col("date_id") >= start).select("date_id").distinct()
    return missing_dates(candidates, done)


def backfill_ready(
    perf: DataFrame, dates: DataFrame, days: int = 30, rows: int = 60
) -> DataFrame:
    """Dates (as ``as_of``) whose look-back holds at least ``rows`` rows.

    Rows of the look-backs are first counted per day; only the daily counts are
    repeated for the dates that look back to them.
    """
    wanted = dates.select(F.col("date_id").alias("as_of"))
    span = wanted.agg(F.struct(F.min("as_of").alias("first"), F.max("as_of").alias("last")).alias("span")).scalar()
    near = perf.where(F.col("date_id").between(F.date_sub(span["first"], days), span["last"]))
    daily = near.groupBy("date_id").agg(F.count("*").alias("_rows"))
    ahead = F.sequence("date_id", F.date_add("date_id", days))
    spread = daily.select(F.explode(ahead).alias("as_of"), "_rows")
    seen = spread.join(one_row_per_day(wanted), "as_of", "left_semi").groupBy("as_of")
    return seen.agg(F.sum("_rows").alias("lookback_rows")).where(F.col("lookback_rows") >= rows)
