"""Batch jobs over the stored tables: export, train, predict, backfill and daily load.

Every job is one or a few lazy plans ending in writes. Single values (the newest
date, the largest key) are read to the driver so that later scans prune their
date partitions; rows never are. Jobs may be run again: stored dates are skipped
or replaced, never doubled.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallywater.functions import service
from tallywater.operators import billing, features, kpis, labels, scoring, tickets
from tallywater.operators.calendar import (
    backfill_dates,
    backfill_ready,
    in_training_range,
    missing_calendar,
)
from tallywater.operators.model import RiskModel, load_model, train_classifier
from tallywater.operators.performance import agent_daily_performance
from tallywater.operators.ranking import number_rows
from tallywater.session import stored
from tallywater.sources import commits
from tallywater.sources.buckets import co_partitioned, in_buckets, open_bucketed, write_bucketed
from tallywater.sources.evolution import check_stored
from tallywater.sources.tables import (
    Load,
    append_table,
    date_rows,
    declared,
    read_table,
    scan_dates,
    stored_dates,
    write_csv,
)

PREDICTIONS = "fact_agent_burnout_prediction"
PERFORMANCE = "fact_agent_performance"
#: What a daily load writes; all of it is shown at once.
LOADED = ("fact_tickets", "fact_backlog", PERFORMANCE, "fact_billing")
MIN_AGENTS = 10
# Ids a day has room for; the largest id of the year 9999 still fits a long.
DAY_IDS = 10**10
MIN_ROWS = 60
#: Rows of agents that one task repeats for the dates asked for: some hundred megabytes of memory.
TASK_ROWS = 100_000
#: Tickets of a day that one task numbers and writes to one file: at most, and at least if there are cores for more tasks.
FILE_ROWS = 500_000
LEAST_ROWS = 50_000


class NoData(RuntimeError):
    """The job has no input rows to work on."""


@dataclass(frozen=True)
class TrainingExtract:
    performance: DataFrame
    agents: DataFrame
    tickets: DataFrame


def export_training_data(
    spark: SparkSession, root: str, out: str | None = None, as_csv: bool = False
) -> TrainingExtract:
    """Performance, agent metadata and ticket metrics of the training range."""
    perf = read_table(spark, root, PERFORMANCE, required=True)
    facts = read_table(spark, root, "fact_tickets")
    agents = read_table(spark, root, "dim_agent", required=True)
    extract = TrainingExtract(
        in_training_range(perf, perf).select(*features.EXTRACT),
        agents.select("agent_id", "agent_name", "department_id", "role_title", "hire_date"),
        tickets.ticket_metrics(in_training_range(facts, perf)),
    )
    if out:
        for name, df in vars(extract).items():
            if as_csv:
                write_csv(df, f"{out}/{name}")
            else:
                df.write.mode("overwrite").parquet(f"{out}/{name}")
    return extract


def bucket_training_tables(spark: SparkSession, root: str, buckets: int) -> None:
    """The training extract in buckets by agent, so that its joins and windows need no exchange."""
    extract = export_training_data(spark, root)
    for name, df in vars(extract).items():
        sort = ["agent_id", "date_id"] if "date_id" in df.columns else ["agent_id"]
        write_bucketed(df, f"{root}/bucketed", name, "agent_id", sort, buckets)


def bucketed_training_frame(spark: SparkSession, root: str) -> DataFrame:
    """The training frame of the bucketed extract; run it inside ``co_partitioned``."""
    perf, metrics, agents = (open_bucketed(spark, f"{root}/bucketed", n) for n in ("performance", "tickets", "agents"))
    return features.training_frame(perf, metrics.hint("merge"), agents.hint("merge"))


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep rows while a job reads them more than once; lost parts are computed again."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def train(
    spark: SparkSession, root: str, model_path: str, kind: str = "forest", **params
) -> tuple[RiskModel, DataFrame]:
    """Fit, evaluate on the held-out fifth and save; returns the model and its report."""
    extract = export_training_data(spark, root)
    frame = features.training_frame(extract.performance, extract.tickets, extract.agents)
    with _kept(labels.label_rows(frame)) as ruled:
        with _kept(labels.stratified_split(labels.rebalance_labels(ruled))) as split:
            if split.isEmpty():
                raise NoData("no agent has enough history; run the daily load first")
            model = train_classifier(split.where("is_test = 0"), kind=kind, **params)
            model.save(model_path)
            report = labels.class_report(model.score(split.where("is_test = 1")))
            rows = spark.createDataFrame(report.collect(), report.schema)
    return model, rows


def newest_features(spark: SparkSession, root: str, days: int = features.LOOKBACK_DAYS) -> DataFrame:
    """Features of every agent seen in the ``days`` before the newest stored date: no other date's
    folder is read."""
    there = stored_dates(spark, root, PERFORMANCE)
    recent = [day for day in there if day >= there[-1] - timedelta(days=days)]
    return features.latest_features(read_table(spark, root, PERFORMANCE, days=recent))


def daily_scores(
    perf: DataFrame, model: RiskModel, as_of: date, days: int = features.LOOKBACK_DAYS
) -> DataFrame:
    """Scores and advice of one date from the rows of its look-back."""
    recent = scan_dates(perf, as_of - timedelta(days=days), as_of, features.EXTRACT)
    newest = features.latest_features(recent).withColumn("date_id", F.lit(as_of))
    return scoring.score_daily(model.score(newest))


def daily_records(scores: DataFrame, model: RiskModel) -> DataFrame:
    """Stored records of scored days; reads ``scores`` three times, so jobs keep them."""
    numbered = scoring.number_predictions(scoring.ensure_critical(scores))
    return scoring.prediction_record(numbered, model.version)


def predict_daily(
    spark: SparkSession, root: str, model: str | RiskModel, as_of: date | None = None
) -> DataFrame:
    """Score the newest date (or ``as_of``) and store it; a stored date is left as it is.

    ``model`` is a loaded model or the path of a saved one.
    """
    model = load_model(spark, model) if isinstance(model, str) else model
    perf = read_table(spark, root, PERFORMANCE, required=True)
    # Which dates there are is asked of folder names and the commit log, not of rows.
    day = as_of or max(stored_dates(spark, root, PERFORMANCE), default=None)
    if day is None:
        raise NoData("no agent performance stored; run the daily load first")
    if day not in stored_dates(spark, root, PREDICTIONS):
        with Load(spark, root) as load, _kept(daily_scores(perf, model, day)) as scores:
            load.put(daily_records(scores, model), PREDICTIONS, day)
    return read_table(spark, root, PREDICTIONS).where(F.col("date_id") == day)


def due_dates(spark: SparkSession, root: str, days: int = features.LOOKBACK_DAYS) -> list[date]:
    """Dates of agent performance without predictions, ``days`` after the first one or later."""
    there = stored_dates(spark, root, PERFORMANCE)
    done = set(stored_dates(spark, root, PREDICTIONS))
    return [day for day in there if day >= there[0] + timedelta(days=days) and day not in done]


def backfill_features(perf: DataFrame, done: DataFrame) -> DataFrame:
    """As-of features of every date that lacks predictions and has enough history."""
    return features_of_dates(perf, backfill_dates(perf, done, features.LOOKBACK_DAYS))


def features_of_dates(perf: DataFrame, dates: DataFrame) -> DataFrame:
    """As-of features of those of ``dates`` whose look-back holds enough rows and agents."""
    days = features.LOOKBACK_DAYS
    # One small row per date, read several times: kept, so that what it comes from is read once.
    ready = stored(backfill_ready(perf, dates, days, MIN_ROWS), "ready")
    agents = features.agents_known(by_agent(perf.select("agent_id", "date_id")), ready, days).where(F.col("agents") >= MIN_AGENTS)
    enough = stored(agents.select("as_of"), "enough")
    known = features.asof_features(by_agent(perf.select(*features.EXTRACT)), enough, days)
    return known.withColumnRenamed("date_id", "source_date_id").withColumnRenamed("as_of", "date_id")


def by_agent(perf: DataFrame) -> DataFrame:
    """Agents dealt to as many tasks as their rows need: the windows over them hold what a task reads,
    repeated for the days on which it is the newest, and Spark would merge tasks by their bytes alone."""
    least = int(perf.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return perf.repartition(max(least, -(-perf.count() // TASK_ROWS)), "agent_id")


def history_records(scored: DataFrame, model: RiskModel) -> DataFrame:
    """The simpler historical form: top probability, constant productivity, agent id as id."""
    history = scoring.score_history(scored).withColumn("prediction_id", F.col("agent_id"))
    return scoring.prediction_record(history, model.version)


def backfill_predictions(
    spark: SparkSession, root: str, model: str | RiskModel, mode: str = "simple"
) -> DataFrame:
    """Score and store all missing dates in one plan; running it again adds nothing.

    ``simple`` keeps the historical record, ``full`` applies the daily rules.
    """
    if mode not in ("simple", "full"):
        raise ValueError(f"unknown mode {mode!r}: simple or full")
    model = load_model(spark, model) if isinstance(model, str) else model
    perf = read_table(spark, root, PERFORMANCE, required=True)
    due = due_dates(spark, root)
    if due:
        # Only the look-backs of the dates that are due are read.
        near = scan_dates(perf, due[0] - timedelta(days=features.LOOKBACK_DAYS), due[-1])
        scored = model.score(features_of_dates(near, date_rows(spark, due)))
        with Load(spark, root) as load:
            if mode == "simple":
                load.put_days(history_records(scored, model), PREDICTIONS)
            else:
                with _kept(scoring.score_daily(scored)) as scores:
                    load.put_days(daily_records(scores, model), PREDICTIONS)
    return read_table(spark, root, PREDICTIONS)


def first_id(day: date) -> int:
    """Ids of a day's rows follow this number: the day, then ten digits for the row."""
    return int(day.strftime("%Y%m%d")) * DAY_IDS


def day_tasks(contacts: DataFrame) -> int:
    """Tasks for a day's tickets: as many as their rows need, or the cores there are if each has enough."""
    rows = contacts.count()
    least = min(contacts.sparkSession.sparkContext.defaultParallelism, -(-rows // LEAST_ROWS))
    return min(max(1, least, -(-rows // FILE_ROWS)), tickets.KEY_BLOCKS)


def daily_load(
    spark: SparkSession,
    root: str,
    day: date,
    contacts: DataFrame,
    usage: DataFrame,
) -> DataFrame:
    """Load one day: calendar, tickets, backlog, agent performance and bills.

    ``contacts`` are the day's raw tickets (see ``score_tickets``) with a
    ``contact_id``, ``usage`` its consumption rows (see ``bill``). Rows without a ``facility_id``
    get a facility of their customer's district. Tables written by date are replaced for ``day``. Ticket and backlog ids are the day and a number within it, so loading any
    day again gives its tickets the same ids and no other day is read. The tables are shown together:
    a load that breaks leaves the day as it was. Contacts are counted, then written once in buckets by
    their block, where all that follows reads them. Returns the day's totals.
    """
    agents = read_table(spark, root, "dim_agent", required=True)
    customers = read_table(spark, root, "dim_customer", required=True)
    append_table(missing_calendar(read_table(spark, root, "dim_time"), day), root, "dim_time")

    facilities = read_table(spark, root, "dim_facility")
    for name in ("dim_agent", "dim_customer", "dim_facility", *LOADED):
        check_stored(spark, root, name)

    # Joined by a shuffle whatever their size: the bills then lie in tasks of a file's size.
    payers = customers.hint("merge")
    used = tickets.with_facility(usage.withColumn("date_id", F.lit(day)), payers, facilities, "billing_id")
    known = tickets.with_customer(used, payers)
    today = contacts.withColumn("date_id", F.lit(day)).drop("ticket_id", "department_id")
    blocked, tasks = today.withColumn("_block", tickets.key_block("contact_id")), day_tasks(contacts)
    with co_partitioned(spark), in_buckets(blocked, "_block", tasks) as dealt:
        met = tickets.with_accounts(dealt, customers, "contact_id", tasks)
        staffed = tickets.with_agent(tickets.with_facility(met, customers, facilities, "contact_id"), agents)
        # Only the backlog needs its accounts further on.
        own = F.when(service.is_unresolved(), F.col(tickets.ACCOUNTS))
        with Load(spark, root) as load, _kept(staffed.withColumn(tickets.ACCOUNTS, own)) as rows:
            scored = tickets.score_tickets(rows)
            row_order = [name for name in scored.columns if name not in ("_block", tickets.ACCOUNTS)]
            numbered = number_rows(
                scored, [["_block"]], ["contact_id", F.xxhash64(*row_order, "_block")], "ticket_id", first_id(day), few=True
            )
            load.put(tickets.resolved_tickets(numbered), "fact_tickets", day, dealt=True)
            opened = tickets.unresolved_tickets(numbered)
            backlog = tickets.build_backlog(opened, customers, first_id(day), dealt=True)
            load.put(backlog, "fact_backlog", day, dealt=True)
            load.put(agent_daily_performance(scored, agents, day, day), PERFORMANCE, day)
            load.put(billing.bill(known), "fact_billing", day, dealt=True)
    return day_summary(spark, root, day)


def measures(spark: SparkSession, root: str, measured_on: date) -> dict[str, DataFrame]:
    """The nine measure tables from the stored facts, by table name."""
    perf, solved, backlog, bills, people, departments = (
        read_table(spark, root, name, required=name == PERFORMANCE or name.startswith("dim_"))
        for name in (
            PERFORMANCE,
            "fact_tickets",
            "fact_backlog",
            "fact_billing",
            "dim_customer",
            "dim_department",
        )
    )
    on = F.lit(measured_on)
    return {
        "meas_resolution_rate_drilldown": kpis.resolution_rate_drilldown(perf, departments),
        "meas_csat_drilldown": kpis.csat_drilldown(solved, departments),
        "meas_sla_compliance_drilldown": kpis.sla_drilldown(solved, backlog, departments),
        "meas_avg_resolution_time_drilldown": kpis.resolution_time_drilldown(
            solved, departments
        ),
        "meas_executive_summary": kpis.executive_summary(perf, solved, backlog, bills),
        "meas_customer_service": kpis.customer_service_measures(solved, people, on),
        "meas_agent_performance": kpis.agent_measures(perf, on),
        "meas_billing": kpis.billing_measures(bills, people, on),
        "meas_predictive": kpis.customer_measures(solved, bills, on),
    }


#: The stored sums of each fact, and of which of them totals over all days are kept.
SUMS = {
    PERFORMANCE: {
        "part_performance_department": kpis.performance_department_sums,
        "part_performance_agent": lambda df: kpis.performance_agent_sums(df, ["date_id"]),
    },
    "fact_tickets": {
        "part_tickets_department": kpis.tickets_department_sums,
        "part_tickets_customer": lambda df: kpis.tickets_customer_sums(df, ["date_id"]),
    },
    "fact_backlog": {"part_backlog_department": kpis.backlog_department_sums},
    "fact_billing": {
        "part_billing_day": kpis.billing_day_sums,
        "part_billing_customer": lambda df: kpis.billing_customer_sums(df, ["date_id"]),
    },
}
TOTALS = {
    "part_performance_agent": ("total_performance_agent", "days"),
    "part_tickets_customer": ("total_tickets_customer", "n"),
    "part_billing_customer": ("total_billing_customer", "n"),
}
#: Whose distinct numbers are kept as sketches: name, fact and column.
ENTITIES = {
    "agents": (PERFORMANCE, "agent_id"),
    "customers": ("fact_tickets", "customer_id"),
    "payers": ("fact_billing", "customer_id"),
}
#: Sketches of 2**12 registers: about 1.6 % standard error.
SKETCH_BITS = 12


def changed_dates(spark: SparkSession, root: str) -> dict[str, list[date]]:
    """Dates of each fact that were loaded after their sums, or emptied, by the commit log.

    A date written outside of loads counts once, when it has no sums yet.
    """
    shown = commits.visible(spark, root)
    out = {}
    for fact, parts in SUMS.items():
        first = next(iter(parts))
        summed = {day: part.commit for (name, day), part in shown.items() if name == first}
        loaded = {day: part.commit for (name, day), part in shown.items() if name == fact}
        loaded |= {day: 0 for day in stored_dates(spark, root, fact) if day not in loaded}
        out[fact] = sorted(day for day, at in loaded.items() if summed.get(day, -1) < at)
    return out


def _of_dates(spark: SparkSession, root: str, name: str, days: list[date]) -> DataFrame:
    """The rows of ``days``: no other date's folder is listed, if these aren't all there are."""
    every = set(days) >= set(stored_dates(spark, root, name))
    return read_table(spark, root, name, days=None if every else days)


def refresh_measures(
    spark: SparkSession, root: str, measured_on: date, days: list[date] | None = None
) -> dict[str, list[date]]:
    """Bring the measure tables up to date from the dates that changed; gives these by fact.

    Facts are read for changed dates only (``days``, or what the commit log says) and summed per day
    and key. Sums per department are few and read anew; totals per agent and customer lose the dates'
    old sums and gain the new ones, exactly, as all are whole numbers. Sums, totals and measures are
    shown by one commit: a refresh that breaks changes nothing and may run again.
    """
    for name in (PERFORMANCE, "dim_customer", "dim_department"):
        read_table(spark, root, name, required=True)
    changed = changed_dates(spark, root) if days is None else {fact: list(days) for fact in SUMS}
    with Load(spark, root) as load:
        for fact, parts in SUMS.items():
            if changed[fact]:
                rows = _of_dates(spark, root, fact, changed[fact])
                for part, sums in parts.items():
                    load.put_days(sums(rows), part, changed[fact])
                    if part in TOTALS:
                        _move_total(spark, root, load, part, changed[fact])
        sketch_entities(spark, root, load, changed)
        for name, df in _measures_of_sums(spark, root, load, changed, F.lit(measured_on)).items():
            load.put(df, name)
    return changed


def _move_total(spark: SparkSession, root: str, load: Load, part: str, days: list[date]) -> None:
    total, rows = TOTALS[part]
    sums = [f.name for f in declared(total).schema.fields if f.name not in declared(total).sort]
    before = _of_dates(spark, root, part, days).withColumns({c: -F.col(c) for c in sums})
    moved = read_table(spark, root, total).unionByName(
        load.read(part).unionByName(before).drop("date_id")
    )
    added = moved.groupBy(*declared(total).sort).agg(*[F.sum(c).alias(c) for c in sums])
    load.put(added.where(F.col(rows) != 0), total)


def sketch_entities(spark: SparkSession, root: str, load: Load, changed: dict[str, list[date]]) -> None:
    """Put the sketches of the changed dates into ``load``."""
    days = sorted({day for some in changed.values() for day in some})
    if not days:
        return
    parts = []
    for entity, (fact, column) in ENTITIES.items():
        # A date is sketched for all its entities again: a commit replaces the whole date.
        rows = _of_dates(spark, root, fact, days)
        sketch = F.hll_sketch_agg(column, SKETCH_BITS).alias("sketch")
        parts.append(rows.groupBy("date_id").agg(sketch).withColumn("entity", F.lit(entity)))
    load.put_days(parts[0].unionByName(parts[1]).unionByName(parts[2]), "part_entities", days)


def distinct_entities(spark: SparkSession, root: str, start: date, end: date) -> DataFrame:
    """(entity, estimate): distinct agents, customers and payers of any range of days.

    Sketches of the days are merged, no fact is read; estimates are within about 5 % (three standard
    errors). ``coverage`` counts exactly.
    """
    days = scan_dates(read_table(spark, root, "part_entities"), start, end)
    merged = days.groupBy("entity").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("entity", F.hll_sketch_estimate("sketch").alias("estimate"))


def _measures_of_sums(
    spark: SparkSession, root: str, load: Load, changed: dict[str, list[date]], on: Column
) -> dict[str, DataFrame]:
    """The measure tables from the stored sums, those of ``load`` in place of what they replace."""
    fact_of = {part: fact for fact, parts in SUMS.items() for part in parts}

    def now(part: str) -> DataFrame:
        days = changed[fact_of[part]]
        rows = read_table(spark, root, part)
        return rows.where(~F.col("date_id").isin(days)).unionByName(load.read(part)) if days else rows

    def total(part: str) -> DataFrame:
        name = TOTALS[part][0]
        return load.read(name) if changed[fact_of[part]] else read_table(spark, root, name)

    people, departments = (read_table(spark, root, name) for name in ("dim_customer", "dim_department"))
    perf, solved, backlog = (now(f"part_{n}_department") for n in ("performance", "tickets", "backlog"))
    by_agent, by_customer, by_payer = (total(part) for part in TOTALS)
    return {
        "meas_resolution_rate_drilldown": kpis.resolution_rate_of(perf, departments),
        "meas_csat_drilldown": kpis.csat_of(solved, departments),
        "meas_sla_compliance_drilldown": kpis.sla_of(solved, backlog, departments),
        "meas_avg_resolution_time_drilldown": kpis.resolution_time_of(solved, departments),
        "meas_executive_summary": kpis.executive_summary_of(perf, solved, backlog, now("part_billing_day")),
        "meas_customer_service": kpis.customer_service_of(by_customer, people, on),
        "meas_agent_performance": kpis.agent_measures_of(by_agent, on),
        "meas_billing": kpis.billing_measures_of(by_payer, people, on),
        "meas_predictive": kpis.customer_measures_of(by_customer, by_payer, on),
    }


def day_summary(spark: SparkSession, root: str, day: date) -> DataFrame:
    """One row: resolved tickets, backlog, agent rows and bills stored for a day."""

    def rows_of(name: str):
        return read_table(spark, root, name, days=[day]).agg(F.count("*")).scalar()

    return spark.range(1).select(
        F.lit(day).alias("date_id"),
        rows_of("fact_tickets").alias("resolved"),
        rows_of("fact_backlog").alias("backlog"),
        rows_of(PERFORMANCE).alias("agents"),
        rows_of("fact_billing").alias("bills"),
    )
