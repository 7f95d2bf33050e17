"""Lookups in dimensions, joins that keep null keys, and dates not done yet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

def lookup(
    facts: DataFrame, dim: DataFrame, key: str, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Left join to a dimension holding one row per key; ``defaults`` fill the misses.

    Spark broadcasts a dimension below its size threshold and otherwise shuffles; adaptive
    execution splits the facts of a key that owns many of them. Null keys match nothing.
    """
    joined = facts.join(dim, key, "left")
    if not defaults:
        return joined
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    )


def join_keeping_nulls(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which null keys match each other, for joining back per-group results."""
    other = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    return left.join(other, same).drop(*[f"_right_{key}" for key in keys])


def one_row_per_day(days: DataFrame) -> DataFrame:
    """Broadcast a frame holding one row per date.

    Its size is bounded by the date type itself: 3.65 million days from year 1 to
    9999, some tens of megabytes, and a century of data is 36,525 rows.
    """
    return F.broadcast(days)


def required_minus_present(required: DataFrame, present: DataFrame) -> DataFrame:
    """Distinct required values not present (set difference)."""
    return required.subtract(present)


def missing_dates(candidates: DataFrame, done: DataFrame) -> DataFrame:
    """Candidate dates without a stored result."""
    stored = one_row_per_day(done.select("date_id").distinct())
    return candidates.join(stored, "date_id", "left_anti")
