"""Small builders for threshold rules as native column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

COMPARE = {
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
}

Step = tuple[str, float, object]


def first_step(column: Column | str, steps: Sequence[Step], otherwise: object) -> Column:
    """Value of the first step ``(comparison, bound, value)`` that holds, else ``otherwise``."""
    subject = F.col(column) if isinstance(column, str) else column
    chosen = F
    for symbol, bound, value in steps:
        chosen = chosen.when(COMPARE[symbol](subject, F.lit(bound)), F.lit(value))
    return chosen.otherwise(F.lit(otherwise))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def count_reached(bounds: Mapping[str, float]) -> Column:
    """How many of the named columns are at or above their bound."""
    votes = [flag(F.col(name) >= F.lit(bound)) for name, bound in bounds.items()]
    return sum(votes[1:], votes[0])


def choose(column: Column | str, values: Mapping[object, object], otherwise: object) -> Column:
    """Value mapped from the column; ``otherwise`` where the key is unknown or null."""
    subject = F.col(column) if isinstance(column, str) else column
    chosen = F
    for key, value in values.items():
        chosen = chosen.when(subject == F.lit(key), F.lit(value))
    return chosen.otherwise(F.lit(otherwise))


def text_choice(column: Column | str, parts: Mapping[str, object], otherwise: object) -> Column:
    """Value of the first part contained in the text; the order of ``parts`` matters."""
    subject = F.col(column) if isinstance(column, str) else column
    chosen = F
    for part, value in parts.items():
        chosen = chosen.when(subject.contains(part), F.lit(value))
    return chosen.otherwise(F.lit(otherwise))


def clamp(column: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), column))


def ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """``part / whole * scale`` as a double; 0 where the whole is 0."""
    share = part.cast("double") / whole.cast("double") * F.lit(scale)
    return F.when(whole > 0, share).otherwise(F.lit(0.0))


UNITS = 10_000


def units(column: Column | str) -> Column:
    """A number of at most four decimals as whole ten-thousandths.

    Sums of whole numbers do not depend on the order of partial sums, and cost a
    tenth of decimal sums.
    """
    subject = F.col(column) if isinstance(column, str) else column
    return F.rint(subject * UNITS).cast("long")


def exact_sum(column: Column | str) -> Column:
    return F.sum(units(column)) / UNITS
