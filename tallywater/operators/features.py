"""Agent-day features: trailing means, seven-row differences, flags and as-of history.

Input grain is one row per agent and day (``operators.performance``), so one
agent contributes at most one row per calendar day to a window partition.
Windows count stored rows, not calendar days; a mean needs three values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F
from pyspark.sql.types import NumericType

from tallywater.functions import risk
from tallywater.operators.joins import one_row_per_day

# Measures with trailing means, window lengths and minimum counts.
MEASURES = {
    "utilization": "utilization_rate",
    "handle_time": "avg_handle_time_mins",
    "backlog": "backlog",
}
WINDOWS = (7, 30)
MIN_VALUES = 3
TREND_ROWS = 7
LOOKBACK_DAYS = 30
SERVING_TENURE = 12

# Columns of the performance extract.
EXTRACT = (
    "date_id",
    "agent_id",
    "department_id",
    "total_tickets_handled",
    "avg_handle_time_mins",
    "escalation_rate",
    "backlog",
    "reopened_tickets",
    "utilization_rate",
    "sla_breaches",
)

ROLLING = tuple(f"avg_{name}_{rows}d" for rows in WINDOWS for name in MEASURES)
TRENDS = {
    "utilization_trend": "utilization_rate",
    "escalation_trend": "escalation_rate",
    "workload_velocity": "backlog",
}


def _flags(df: DataFrame, tenure: Column) -> DataFrame:
    return df.withColumns(
        {
            "stress_index": risk.stress_index(),
            "performance_declining": risk.performance_declining(),
            "persistent_backlog": risk.persistent_backlog(),
            "tenure_months": tenure,
        }
    )


def _trailing(per_agent: WindowSpec) -> dict[str, Column]:
    """Trailing means and seven-row differences over stored rows."""
    derived: dict[str, Column] = {}
    for rows in WINDOWS:
        frame = per_agent.rowsBetween(-(rows - 1), 0)
        for name, column in MEASURES.items():
            derived[f"avg_{name}_{rows}d"] = _mean(column, frame)
    for name, column in TRENDS.items():
        derived[name] = F.col(column) - F.lag(column, TREND_ROWS).over(per_agent)
    return derived


def _mean(column: Column | str, frame: WindowSpec) -> Column:
    return F.when(F.count(column).over(frame) >= MIN_VALUES, F.avg(column).over(frame))


def agent_features(perf: DataFrame, tenure: Column | int = SERVING_TENURE) -> DataFrame:
    """Trailing means, trends and flags for every row, from one sort per agent.

    ``is_latest`` marks the newest row of each agent.
    """
    per_agent = Window.partitionBy("agent_id").orderBy("date_id")
    derived = _trailing(per_agent)
    derived["is_latest"] = F.lead("date_id").over(per_agent).isNull()
    fixed = F.lit(tenure) if isinstance(tenure, int) else tenure
    return _flags(perf.withColumns(derived), fixed)


def fill_numbers(df: DataFrame) -> DataFrame:
    """Missing numbers become 0; ids are left alone and keep their partitioning."""
    numbers = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NumericType) and not f.name.endswith("_id")
    ]
    return df.na.fill(0, subset=numbers)


def latest_features(
    perf: DataFrame, tenure: Column | int = SERVING_TENURE, days: int | None = None
) -> DataFrame:
    """Features of each agent's newest row, missing history as 0.

    With ``days`` only the rows of that many days before the newest date are read; agents
    without a row there have none in the result.
    """
    if days is not None:
        newest_day = perf.agg(F.max("date_id")).scalar()
        perf = perf.where(F.col("date_id") >= F.date_sub(newest_day, days))
    newest = agent_features(perf, tenure).where("is_latest").drop("is_latest")
    return fill_numbers(newest)


def training_frame(perf: DataFrame, tickets: DataFrame, agents: DataFrame) -> DataFrame:
    """Performance with ticket metrics and agent metadata, featured, complete rows only.

    Gaps in the inputs become 0 before the features; rows whose history is too
    short for a feature are dropped after. Unknown agents keep an empty role and
    the zero date 1970-01-01.
    """
    about = agents.select("agent_id", "role_title", "hire_date")
    joined = perf.join(tickets, ["agent_id", "date_id"], "left").join(about, "agent_id", "left")
    filled = fill_numbers(joined).withColumns(
        {
            "role_title": F.coalesce("role_title", F.lit("")),
            "hire_date": F.coalesce("hire_date", F.date_from_unix_date(F.lit(0))),
        }
    )
    return agent_features(filled, risk.tenure_months()).drop("is_latest").na.drop("any")


def _carried(perf: DataFrame, as_of: DataFrame, days: int, derive: bool) -> DataFrame:
    """Rows of ``perf`` repeated for the dates (``as_of``) on which they are their agent's newest one,
    at most ``days`` on; ``_asked`` marks the dates asked for, rows of their own date are kept.

    With ``derive`` trailing means and differences are added before.
    """
    span = as_of.agg(F.struct(F.min("as_of").alias("first"), F.max("as_of").alias("last")).alias("span")).scalar()
    # Nothing outside the look-backs of the dates asked for is read.
    perf = perf.where(F.col("date_id").between(F.date_sub(span["first"], days), span["last"]))
    per_agent = Window.partitionBy("agent_id").orderBy("date_id")
    horizon = F.date_add("date_id", days)
    until = F.least(F.date_sub(F.lead("date_id").over(per_agent), 1), horizon)
    stored = perf.withColumns({**(_trailing(per_agent) if derive else {}), "_until": until})
    # Of rows that share an agent and a day one is carried on.
    grain = stored.where(F.col("_until") >= F.col("date_id"))
    carried = grain.withColumn("as_of", F.explode(F.sequence("date_id", "_until")))
    asked = as_of.select("as_of").distinct().withColumn("_asked", F.lit(True))
    own = F.col("as_of") == F.col("date_id")
    return carried.join(one_row_per_day(asked), "as_of", "left").where(own | F.col("_asked")).drop("_until")


def agents_known(perf: DataFrame, as_of: DataFrame, days: int = LOOKBACK_DAYS) -> DataFrame:
    """(as_of, agents): how many agents ``asof_features`` has on each date, from two columns."""
    known = _carried(perf.select("agent_id", "date_id"), as_of, days, derive=False).where("_asked")
    return known.groupBy("as_of").agg(F.count("*").alias("agents"))


def asof_features(perf: DataFrame, as_of: DataFrame, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Features of every agent as known on each date of ``as_of`` (column ``as_of``).

    The newest row in ``[as_of - days, as_of]`` represents the agent, and only
    rows of that range feed its means and trends. Instead of repeating every row
    for every date that looks back to it, a row is carried forward only over the
    days on which it is the newest one; two windows per agent do the rest:

    * over stored rows: the means of the last 7 and 30 rows and the differences;
    * over the last ``days`` days: how many stored rows they hold, and their mean,
      which replaces the first where the range holds fewer rows than it needs.
    """
    marked = _carried(perf, as_of, days, derive=True)
    own = F.col("as_of") == F.col("date_id")
    day = F.unix_date("as_of")
    recent = Window.partitionBy("agent_id").orderBy(day).rangeBetween(-days, 0)
    within = {"_rows": F.count_if(own).over(recent)}
    for name, column in MEASURES.items():
        within[f"_{name}"] = _mean(F.when(own, F.col(column)), recent)
    ranged = marked.withColumns(within).where("_asked")
    enough = {
        f"avg_{name}_{rows}d": F.when(
            F.col("_rows") >= rows, F.col(f"avg_{name}_{rows}d")
        ).otherwise(F.col(f"_{name}"))
        for rows in WINDOWS
        for name in MEASURES
    }
    for name in TRENDS:
        enough[name] = F.when(F.col("_rows") > TREND_ROWS, F.col(name))
    known = ranged.withColumns(enough).drop(*within, "_asked")
    return fill_numbers(_flags(known, F.lit(SERVING_TENURE)))
