"""Numbering and order statistics without pulling all rows into one task."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywater.operators.joins import join_keeping_nulls

Order = Sequence[Column | str]


def number_rows(
    df: DataFrame,
    levels: Sequence[Sequence[str]],
    order: Order,
    name: str,
    start: Column | int = 0,
    few: bool = False,
) -> DataFrame:
    """Dense numbers ``start + 1, start + 2, ...`` following ``levels`` and then ``order``.

    ``levels`` are column groups from coarse to fine, for instance
    ``[["date_id"], ["block"]]``. Only counts per group travel to the windows
    that add them up; rows are sorted inside their finest group. ``few`` says that the groups are
    so few (some thousand) that their counts may be broadcast: rows dealt by a block don't move.
    """
    return _numbered(df, [], levels, order, name, start, few)


def number_within(
    df: DataFrame, group: Sequence[str], block: Sequence[str], order: Order, name: str
) -> DataFrame:
    """Dense numbers from 1 inside each ``group``, which may be of any size.

    ``block`` columns must follow the same order as ``order`` (for an ordering
    by id: the id divided by a constant), so that blocks can be counted apart.
    """
    return _numbered(df, group, [block], order, name, 0)


def _numbered(
    df: DataFrame,
    group: Sequence[str],
    levels: Sequence[Sequence[str]],
    order: Order,
    name: str,
    start: Column | int,
    few: bool = False,
) -> DataFrame:
    finest = [*group, *[column for level in levels for column in level]]
    offsets = df.groupBy(*finest).agg(F.count("*").alias("_rows"))
    offsets = _add_before(offsets, finest[: -len(levels[-1])], levels[-1], "_rows", "_before")
    above = list(group)
    for level in levels[:-1]:
        keys = [*above, *level]
        sums = offsets.groupBy(*keys).agg(F.sum("_rows").alias("_sum"))
        step = _add_before(sums, above, level, "_sum", "_step").drop("_sum")
        offsets = join_keeping_nulls(offsets, step, keys).withColumn(
            "_before", F.col("_before") + F.col("_step")
        )
        above = keys
    inside = Window.partitionBy(*finest).orderBy(*order)
    base = F.lit(start) if isinstance(start, int) else start
    number = base + F.col("_before") + F.row_number().over(inside)
    offsets = offsets.select(*finest, "_before")
    placed = join_keeping_nulls(df, F.broadcast(offsets) if few else offsets, finest)
    return placed.withColumn(name, number.cast("long")).drop("_before")


def _add_before(
    counts: DataFrame, group: Sequence[str], order: Sequence[str], rows: str, name: str
) -> DataFrame:
    """Running total of the groups before each one."""
    window = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    earlier = window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum(rows).over(earlier), F.lit(0)))


def keys_at_shares(keys: DataFrame, shares: Sequence[float]) -> list[tuple]:
    """The key at each cumulative group size, exactly, without sorting the rows.

    ``keys`` holds the ordering columns only, ascending, not null and unique as a
    whole. Each share is worth ``max(floor(share * rows), 1)`` rows and the sizes
    are added up. Column by column the rows that agree with a cut so far are
    counted by value, and running counts tell on which value the cut falls; give
    a coarse column first (a cell of the next one) so that no level has many
    values. The driver sees one small tuple per cut and level. The result is one
    tuple per cut, or fewer when the rows run out.
    """
    columns = keys.columns
    rows, reached, cuts = keys.count(), 0, []
    for share in shares:
        reached += max(math.floor(rows * share), 1)
        if reached <= rows:
            cuts.append(((), reached))
    for depth, column in enumerate(columns):
        if not cuts:
            break
        known = columns[:depth]
        inside = _any(
            _all(F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(known, prefix)) for prefix, _ in cuts
        )
        counts = keys.where(inside).groupBy(*known, column).agg(F.count("*").alias("_rows"))
        until = Window.partitionBy(*known).orderBy(column) if known else Window.orderBy(column)
        running = counts.withColumn("_until", F.sum("_rows").over(until))
        wanted = _any(
            _all(
                [
                    *[F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(known, prefix)],
                    F.col("_until") >= place,
                    F.col("_until") - F.col("_rows") < place,
                ]
            )
            for prefix, place in cuts
        )
        found = running.where(wanted).collect()
        cuts = [
            ((*prefix, r[column]), place - (r["_until"] - r["_rows"]))
            for prefix, place in cuts
            for r in found
            if tuple(r[c] for c in known) == prefix and r["_until"] - r["_rows"] < place <= r["_until"]
        ]
    return [prefix for prefix, _ in cuts]


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(lambda x, y: x & y, conditions, F.lit(True))


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda x, y: x | y, conditions, F.lit(False))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Absolute and relative frequency of each value."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    rows = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / rows).withColumn(
        "percent", F.col("share") * 100
    )
