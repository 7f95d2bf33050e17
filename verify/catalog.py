"""Every registered query: the Spark callable and, where it can be said in SQL, its twin."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, IntegralType, TimestampType

from tallywater.functions import risk, service
from tallywater.operators import (
    billing, calendar, features, joins, kpis, labels, performance, ranking, scoring, sensors,
    tickets as ticket_ops,
)
from tallywater.operators.model import load_model, train_classifier
from tallywater.plans import jobs
from tallywater.session import fresh_folder, stored
from tallywater.sources import buckets, events as event_source, skipping, tables
from tallywater.streaming import ledger, monitor, sinks, state
from verify import adapters as a, oracle as o
from verify.oracle import R, big, day, sql, stamp

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Portable output types: dates and times as text, six decimals, long integers."""

    def column(field):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            return c.cast("string")
        if isinstance(field.dataType, TimestampType):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        if isinstance(field.dataType, (DoubleType, DecimalType)):
            return F.round(c.cast("double"), 6)
        if isinstance(field.dataType, IntegralType):
            return c.cast("long")
        return c

    return df.select(*[column(f).alias(f.name) for f in df.schema.fields])


def kept(df: DataFrame) -> DataFrame:
    """Keep rows that several parts of a plan read, in the shared folder."""
    return stored(df, "kept")


def register(name: str, oracle: str | None = None):
    def keep(query: Query) -> Query:
        QUERIES[name] = lambda spark, sf: plain(query(spark, sf))
        if oracle:
            ORACLES[name] = oracle
        return query

    return keep


PERF_INTS = ("total_tickets_handled", "backlog", "reopened_tickets", "sla_breaches")
PERF_DOUBLES = ("avg_handle_time_mins", "escalation_rate", "utilization_rate")
PERF_OUT = ", ".join(
    [big(c, c) for c in PERF_INTS] + [f"{R(c)} AS {c}" for c in PERF_DOUBLES]
)
DERIVED = [*o.ROLLING, "utilization_trend", "escalation_trend"]
FEATURES_OUT = ", ".join(
    [f"{R(c)} AS {c}" for c in [*DERIVED, "stress_index"]]
    + [
        big(c, c)
        for c in ("workload_velocity", "performance_declining", "persistent_backlog")
    ]
)
KEYS_OUT = f"{day('date_id')}, {big('agent_id', 'agent_id')}"
FEATURE_COLUMNS = [
    "date_id", "agent_id", *DERIVED, "stress_index", "workload_velocity",
    "performance_declining", "persistent_backlog",
]


# --- tickets to agent performance ------------------------------------------------------------


@register(
    "agent_daily_performance",
    sql(
        o.performance(varied=False, gaps=True),
        f"SELECT {big('performance_id', 'performance_id')}, {KEYS_OUT}, "
        f"{big('department_id', 'department_id')}, {PERF_OUT}, "
        f"{R('resolution_rate')} AS resolution_rate FROM perf",
    ),
)
def _agent_daily_performance(spark, sf):
    return a.performance_rows(spark, sf, gaps=True)


@register(
    "agent_days_with_tickets",
    sql(
        o.performance(days=600, every_agent=False, varied=False, gaps=True),
        f"SELECT {big('performance_id', 'performance_id')}, {KEYS_OUT}, "
        f"{big('department_id', 'department_id')}, {PERF_OUT}, "
        f"{R('resolution_rate')} AS resolution_rate FROM perf",
    ),
)
def _agent_days_with_tickets(spark, sf):
    return a.performance_rows(spark, sf, a.GAPPY_DAYS, every_agent=False, gaps=True)


@register(
    "day_totals",
    sql(
        o.performance(gaps=True),
        f"SELECT {day('date_id')}, {big('count(*)', 'tickets')}, "
        f"{big('sum(CAST(resolved_in_first_contact IS DISTINCT FROM 1 AS INT))', 'backlog')}, "
        f"{big('sum(CAST(resolved_in_first_contact IS NOT DISTINCT FROM 1 AS INT))', 'resolved')}, "
        f"{big('(SELECT count(*) FROM perf p WHERE p.date_id = t.date_id)', 'agents')} "
        "FROM tickets t GROUP BY date_id",
    ),
)
def _day_totals(spark, sf):
    """The totals of the performance rows are those of the tickets themselves."""
    return performance.day_totals(a.performance_rows(spark, sf, gaps=True))


METRICS_OUT = (
    f"{big('total_tickets', 'total_tickets')}, {R('avg_csat')} AS avg_csat, "
    f"{big('reopened_count', 'reopened_count')}, {big('sla_breach_count', 'sla_breach_count')}"
)


@register(
    "ticket_metrics",
    sql({**o.tickets(), **o.TICKET_METRICS}, f"SELECT {KEYS_OUT}, {METRICS_OUT} FROM metrics"),
)
def _ticket_metrics(spark, sf):
    return ticket_ops.ticket_metrics(a.tickets(spark, sf))


# --- features, labels, split -----------------------------------------------------------------


@register(
    "rolling_features",
    sql(o.features(), f"SELECT {KEYS_OUT}, {FEATURES_OUT} FROM features"),
)
def _rolling_features(spark, sf):
    return features.agent_features(a.varied_performance(spark, sf)).select(*FEATURE_COLUMNS)


@register(
    "latest_features",
    sql(
        o.features(filled=True, days=600, every_agent=False),
        f"SELECT {KEYS_OUT}, {PERF_OUT}, {FEATURES_OUT}, {big('tenure_months', 'tenure_months')} "
        "FROM features WHERE is_latest",
    ),
)
def _latest_features(spark, sf):
    perf = a.varied_performance(spark, sf, a.GAPPY_DAYS, every_agent=False)
    return features.latest_features(perf).select(
        *FEATURE_COLUMNS, *PERF_INTS, *PERF_DOUBLES, "tenure_months"
    )


@register(
    "newest_features",
    sql(
        {
            **o.performance(days=600, every_agent=False),
            "recent": "SELECT * FROM perf WHERE date_id >= (SELECT max(date_id) FROM perf) - 30",
            "rolled": o.rolling("recent", "agent_id"),
            "features": o.flags("rolled", filled=True),
        },
        f"SELECT {KEYS_OUT}, {PERF_OUT}, {FEATURES_OUT}, {big('tenure_months', 'tenure_months')} "
        "FROM features WHERE is_latest",
    ),
)
def _newest_features(spark, sf):
    """Tickets to stored agent days to the newest features of every agent, of which the look-back alone
    is read."""
    root = fresh_folder(spark, "warehouse")
    tables.replace_dates(a.varied_performance(spark, sf, a.GAPPY_DAYS, every_agent=False), root, jobs.PERFORMANCE)
    return jobs.newest_features(spark, root).select(*FEATURE_COLUMNS, *PERF_INTS, *PERF_DOUBLES, "tenure_months")


@register(
    "stress_index",
    sql(o.performance(), f"SELECT {KEYS_OUT}, {R(o.STRESS)} AS stress_index FROM perf"),
)
def _stress_index(spark, sf):
    perf = a.varied_performance(spark, sf)
    return perf.select("date_id", "agent_id", risk.stress_index().alias("stress_index"))


def _training(spark, sf):
    return features.training_frame(
        a.varied_performance(spark, sf),
        ticket_ops.ticket_metrics(a.tickets(spark, sf)),
        a.agents(spark, sf),
    )


@register(
    "training_frame",
    sql(
        o.training(),
        f"SELECT {KEYS_OUT}, {PERF_OUT}, {METRICS_OUT}, role_title, {day('hire_date')}, "
        f"{FEATURES_OUT}, {big('tenure_months', 'tenure_months')} FROM labelled",
    ),
)
def _training_frame(spark, sf):
    return _training(spark, sf).drop("performance_id", "department_id", "resolution_rate")


@register(
    "burnout_labels",
    sql(o.training(), f"SELECT {KEYS_OUT}, burnout_risk_label FROM labelled"),
)
def _burnout_labels(spark, sf):
    labelled = labels.label_rows(_training(spark, sf))
    return labelled.select("date_id", "agent_id", labels.LABEL)


@register(
    "label_distribution",
    sql(
        o.training(),
        f"SELECT burnout_risk_label, {big('count(*)', 'n')}, "
        f"{R('count(*) / sum(count(*)) OVER ()')} AS share, "
        f"{R('count(*) / sum(count(*)) OVER () * 100')} AS percent "
        "FROM labelled GROUP BY burnout_risk_label",
    ),
)
def _label_distribution(spark, sf):
    return labels.label_distribution(labels.label_rows(_training(spark, sf)))


@register(
    "label_check",
    sql(
        o.training(varied=False),
        f"SELECT {big('count(DISTINCT burnout_risk_label)', 'classes')}, "
        "count(DISTINCT burnout_risk_label) = 4 AS complete FROM labelled",
    ),
)
def _label_check(spark, sf):
    return labels.label_check(labels.label_rows(_rule_training(spark, sf)))


def _rule_training(spark, sf):
    """The rule's own utilisation never falls below 0.70, so no row is Low."""
    return features.training_frame(
        a.performance_rows(spark, sf),
        ticket_ops.ticket_metrics(a.tickets(spark, sf)),
        a.agents(spark, sf),
    )


@register(
    "missing_labels",
    sql(
        {
            **o.training(varied=False),
            "required": "SELECT unnest(['Low', 'Medium', 'High', 'Critical']) "
            "AS burnout_risk_label",
        },
        "SELECT burnout_risk_label FROM required EXCEPT SELECT burnout_risk_label FROM labelled",
    ),
)
def _missing_labels(spark, sf):
    return labels.missing_labels(labels.label_rows(_rule_training(spark, sf)))


REBALANCED = {
    "sizes": """
        SELECT greatest(CAST(floor(count(*) * 0.05::DOUBLE) AS BIGINT), 1) AS c,
               greatest(CAST(floor(count(*) * 0.12::DOUBLE) AS BIGINT), 1) AS h,
               greatest(CAST(floor(count(*) * 0.35::DOUBLE) AS BIGINT), 1) AS m FROM labelled""",
    "placed": """
        SELECT *, row_number() OVER (ORDER BY stress_index DESC, agent_id, date_id) AS place
        FROM labelled""",
    "rebalanced": """
        SELECT * EXCLUDE (burnout_risk_label),
               CASE WHEN place <= c THEN 'Critical' WHEN place <= c + h THEN 'High'
                    WHEN place <= c + h + m THEN 'Medium' ELSE 'Low' END AS burnout_risk_label
        FROM placed CROSS JOIN sizes""",
}


@register(
    "rebalanced_labels",
    sql(
        {**o.training(varied=False), **REBALANCED},
        f"SELECT {KEYS_OUT}, {R('stress_index')} AS stress_index, burnout_risk_label "
        "FROM rebalanced",
    ),
)
def _rebalanced_labels(spark, sf):
    balanced = labels.rebalance_labels(kept(labels.label_rows(_rule_training(spark, sf))))
    return balanced.select("date_id", "agent_id", "stress_index", labels.LABEL)


@register(
    "stratified_split",
    sql(
        {
            **o.training(),
            "placed": """
                SELECT *, row_number() OVER (PARTITION BY burnout_risk_label ORDER BY
                    md5(agent_id || '|' || CAST(date_id AS VARCHAR) || '|42')) AS place,
                    count(*) OVER (PARTITION BY burnout_risk_label) AS n FROM labelled""",
        },
        f"SELECT {KEYS_OUT}, burnout_risk_label, "
        f"{big('CAST(place <= ' + R('n * 0.2::DOUBLE', 0) + ' AS INTEGER)', 'is_test')} "
        "FROM placed",
    ),
)
def _stratified_split(spark, sf):
    split = labels.stratified_split(kept(labels.label_rows(_training(spark, sf))))
    return split.select("date_id", "agent_id", labels.LABEL, "is_test")


@register(
    "label_codes",
    sql(
        o.training(),
        f"""SELECT {KEYS_OUT}, burnout_risk_label,
        {big("CASE burnout_risk_label WHEN 'Critical' THEN 0 WHEN 'High' THEN 1 WHEN 'Low' THEN 2 ELSE 3 END", 'label_code')},
        {big("CASE burnout_risk_label WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE 3 END", 'risk_rank')},
        burnout_risk_label AS decoded FROM labelled""",
    ),
)
def _label_codes(spark, sf):
    rows = labels.label_rows(_training(spark, sf)).withColumn(
        "label_code", risk.label_code(labels.LABEL)
    )
    return rows.select(
        "date_id",
        "agent_id",
        labels.LABEL,
        "label_code",
        risk.risk_rank(labels.LABEL).alias("risk_rank"),
        risk.label_of_code("label_code").alias("decoded"),
    )


REPORT = {
    **o.scored(),
    "judged": f"SELECT {o.LABEL} AS actual, risk_category AS predicted FROM rated",
    "classes": "SELECT DISTINCT actual AS class FROM judged UNION SELECT DISTINCT predicted FROM judged",
    "counted": """
        SELECT class, count(*) FILTER (actual = class) AS support,
               count(*) FILTER (predicted = class) AS called,
               count(*) FILTER (actual = class AND predicted = class) AS hits
        FROM classes CROSS JOIN judged GROUP BY class""",
    "rates": """
        SELECT *, CASE WHEN called > 0 THEN hits / called ELSE 0 END AS precision,
               CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall FROM counted""",
    "report": """
        SELECT *, CASE WHEN precision + recall > 0
                       THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
        FROM rates""",
    "lines": """
        SELECT class, precision, recall, f1, support FROM report
        UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support),
            sum(hits) / sum(support), sum(support) FROM report
        UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM report
        UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
            sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
            FROM report""",
}


@register(
    "class_report",
    sql(
        REPORT,
        f"SELECT class, {R('precision')} AS precision, {R('recall')} AS recall, {R('f1')} AS f1, "
        f"{big('support', 'support')} FROM lines",
    ),
)
def _class_report(spark, sf):
    return labels.class_report(labels.label_rows(a.scored_features(spark, sf)))


@register(
    "confusion",
    sql(REPORT, f"SELECT actual, predicted, {big('count(*)', 'n')} FROM judged GROUP BY ALL"),
)
def _confusion(spark, sf):
    return labels.confusion(labels.label_rows(a.scored_features(spark, sf)))


@register(
    "accuracy",
    sql(REPORT, f"SELECT {R('sum(hits) / sum(support)')} AS accuracy FROM report"),
)
def _accuracy(spark, sf):
    return labels.accuracy(labels.label_rows(a.scored_features(spark, sf)))


# --- scoring -----------------------------------------------------------------------------------


@register(
    "base_risk",
    sql(
        o.scored(),
        f"SELECT {KEYS_OUT}, risk_category, {R('base_risk')} AS base_risk, "
        f"{R('confidence_score')} AS confidence_score FROM rated",
    ),
)
def _base_risk(spark, sf):
    return a.scored_features(spark, sf).select(
        "date_id",
        "agent_id",
        "risk_category",
        risk.base_risk().alias("base_risk"),
        risk.confidence().alias("confidence_score"),
    )


@register(
    "risk_factors",
    sql(
        o.scored(),
        f"SELECT {KEYS_OUT}, "
        + ", ".join(f"{R(e)} AS {n}" for n, e in o.FACTORS.items())
        + " FROM rated",
    ),
)
def _risk_factors(spark, sf):
    columns = [c.alias(n) for n, c in risk.risk_factors().items()]
    return a.scored_features(spark, sf).select("date_id", "agent_id", *columns)


@register(
    "burnout_score",
    sql(
        o.advised(),
        f"SELECT {KEYS_OUT}, {R('burnout_risk_score')} AS burnout_risk_score FROM advised",
    ),
)
def _burnout_score(spark, sf):
    score = risk.burnout_risk_score().alias("burnout_risk_score")
    return a.scored_features(spark, sf).select("date_id", "agent_id", score)


@register(
    "productivity_index",
    sql(
        o.advised(),
        f"SELECT {KEYS_OUT}, "
        + ", ".join(f"{R(e)} AS {n}" for n, e in o.PRODUCTIVITY.items())
        + f", {R('productivity_index')} AS productivity_index FROM advised",
    ),
)
def _productivity_index(spark, sf):
    parts = [c.alias(n) for n, c in risk.productivity_parts().items()]
    index = risk.productivity_index().alias("productivity_index")
    return a.scored_features(spark, sf).select("date_id", "agent_id", *parts, index)


@register(
    "workload_reduction",
    sql(
        o.advised(),
        f"SELECT {KEYS_OUT}, risk_category, {big('workload_reduction_pct', 'workload_reduction_pct')}, "
        f"{big(o.CODE, 'risk_category_encoded')} FROM advised",
    ),
)
def _workload_reduction(spark, sf):
    return a.scored_features(spark, sf).select(
        "date_id",
        "agent_id",
        "risk_category",
        risk.workload_reduction_pct().alias("workload_reduction_pct"),
        risk.label_code("risk_category").alias("risk_category_encoded"),
    )


FLAT = "CASE risk_category WHEN 'Critical' THEN 35 WHEN 'High' THEN 20 WHEN 'Medium' THEN 10 ELSE 0 END"


@register(
    "recommended_action",
    sql(
        o.advised(),
        f"SELECT {KEYS_OUT}, recommended_action AS daily_action, {o.HISTORY_ACTION} "
        f"AS history_action, {big(FLAT, 'history_reduction')} FROM advised",
    ),
)
def _recommended_action(spark, sf):
    return a.scored_features(spark, sf).select(
        "date_id",
        "agent_id",
        risk.recommended_action().alias("daily_action"),
        risk.recommended_action(texts=risk.HISTORY_ACTIONS).alias("history_action"),
        risk.flat_reduction().alias("history_reduction"),
    )


def _forced(spark, sf):
    plain_rows = features.fill_numbers(features.agent_features(a.varied_performance(spark, sf)))
    rows = a.GivenProbabilities().score(plain_rows.drop("is_latest"))
    return scoring.ensure_critical(kept(scoring.score_daily(rows)))


@register(
    "ensure_critical",
    sql(
        o.forced(),
        f"SELECT {KEYS_OUT}, risk_category, {big('risk_category_encoded', 'risk_category_encoded')}, "
        f"{big('workload_reduction_pct', 'workload_reduction_pct')}, recommended_action, "
        f"{R('burnout_risk_score')} AS burnout_risk_score FROM final",
    ),
)
def _ensure_critical(spark, sf):
    return _forced(spark, sf).select(
        "date_id", "agent_id", "risk_category", "risk_category_encoded",
        "workload_reduction_pct", "recommended_action", "burnout_risk_score",
    )


CURRENT_OUT = ", ".join(
    (f"{R(source)} AS {name}" if source in (*PERF_DOUBLES, "stress_index") else big(source, name))
    for name, source in scoring.CURRENT.items()
)


@register(
    "prediction_records",
    sql(
        o.forced(),
        f"SELECT {big('row_number() OVER (PARTITION BY date_id ORDER BY agent_id)', 'prediction_id')}, "
        f"{KEYS_OUT}, {R('burnout_risk_score')} AS burnout_risk_score, "
        f"{R('productivity_index')} AS productivity_index, risk_category, "
        f"{big('risk_category_encoded', 'risk_category_encoded')}, {CURRENT_OUT}, "
        + ", ".join(f"{R(c)} AS {c}" for c in DERIVED)
        + f", {big('performance_declining', 'performance_declining')}, "
        f"{big('persistent_backlog', 'persistent_backlog')}, "
        f"{R('workload_velocity')} AS workload_velocity, recommended_action, "
        f"{big('workload_reduction_pct', 'workload_reduction_pct')}, "
        f"'v1.0_forest' AS model_version, {R('confidence_score')} AS confidence_score FROM final",
    ),
)
def _prediction_records(spark, sf):
    return scoring.prediction_record(scoring.number_predictions(_forced(spark, sf)))


# --- as-of history and backfill ------------------------------------------------------------------


def _gappy(spark, sf):
    return a.varied_performance(spark, sf, a.GAPPY_DAYS, every_agent=False)


def _done(perf):
    """Stored predictions: every tenth day of the month."""
    return perf.where(F.dayofmonth("date_id") % 10 == 0).select("date_id").distinct()


CANDIDATES = {
    **o.performance(days=600, every_agent=False),
    "done": "SELECT DISTINCT date_id FROM perf WHERE day(date_id) % 10 = 0",
    "candidates": """
        SELECT DISTINCT date_id FROM perf
        WHERE date_id >= (SELECT min(date_id) FROM perf) + INTERVAL 30 DAY
          AND date_id NOT IN (SELECT date_id FROM done)""",
    "lookback": """
        SELECT c.date_id AS as_of, p.* FROM candidates c JOIN perf p
        ON p.date_id BETWEEN c.date_id - 30 AND c.date_id""",
    "ready": """
        SELECT as_of, count(*) AS lookback_rows FROM lookback GROUP BY as_of
        HAVING count(*) >= 60""",
}
ASOF = {
    **CANDIDATES,
    "rolled": o.rolling("lookback", "as_of, agent_id"),
    "featured": o.flags("rolled", filled=True),
    "newest": """
        SELECT * FROM featured WHERE is_latest AND as_of IN (SELECT as_of FROM ready)""",
}


HISTORY = {
    **ASOF,
    "crowded": "SELECT as_of FROM newest GROUP BY as_of HAVING count(*) >= 10",
    "features": """
        SELECT * REPLACE (as_of AS date_id) FROM newest
        WHERE as_of IN (SELECT as_of FROM crowded)""",
    **{name: o.scored()[name] for name in ("weighted", "shared", "rated")},
}


@register(
    "history_records",
    sql(
        HISTORY,
        f"""SELECT {KEYS_OUT}, {R('confidence_score')} AS burnout_risk_score,
        0.75::DOUBLE AS productivity_index, risk_category, {big(o.CODE, 'risk_category_encoded')},
        {big(FLAT, 'workload_reduction_pct')}, {o.HISTORY_ACTION} AS recommended_action,
        {R('confidence_score')} AS confidence_score, {R('stress_index')} AS stress_index
        FROM rated""",
    ),
)
def _history_records(spark, sf):
    """The historical backfill of all missing dates, with the repeatable probabilities."""
    perf = kept(_gappy(spark, sf))
    known = jobs.backfill_features(perf, _done(perf))
    return scoring.score_history(a.with_probabilities(known)).select(
        "date_id", "agent_id", "burnout_risk_score", "productivity_index", "risk_category",
        "risk_category_encoded", "workload_reduction_pct", "recommended_action",
        "confidence_score", "stress_index",
    )


@register(
    "unseen_customers",
    sql(
        {**o.tickets(), **o.CUSTOMERS},
        f"""SELECT {big('customer_id', 'customer_id')}, district FROM customers
        WHERE customer_id NOT IN (SELECT customer_id FROM tickets
            WHERE resolved_in_first_contact <> 1 AND issue_category = 'Leakage')""",
    ),
)
def _unseen_customers(spark, sf):
    """Customers without an open leakage ticket: the row-level form of skip-if-stored."""
    rows = a.raw_tickets(spark, sf, customers=True).where("issue_category = 'Leakage'")
    opened = ticket_ops.unresolved_tickets(rows)
    known = a.customers(spark, sf)
    return tables.unseen_rows(known, opened, ["customer_id"]).select("customer_id", "district")


@register("backfill_candidates", sql(CANDIDATES, f"SELECT {day('date_id')} FROM candidates"))
def _backfill_candidates(spark, sf):
    perf = _gappy(spark, sf)
    return calendar.backfill_dates(perf, _done(perf))


@register(
    "backfill_ready",
    sql(CANDIDATES, f"SELECT {day('as_of')}, {big('lookback_rows', 'lookback_rows')} FROM ready"),
)
def _backfill_ready(spark, sf):
    perf = _gappy(spark, sf)
    return calendar.backfill_ready(perf, calendar.backfill_dates(perf, _done(perf)))


@register(
    "asof_features",
    sql(
        ASOF,
        f"SELECT {day('as_of')}, {KEYS_OUT}, {PERF_OUT}, {FEATURES_OUT} FROM newest",
    ),
)
def _asof_features(spark, sf):
    perf = kept(_gappy(spark, sf))
    ready = kept(calendar.backfill_ready(perf, calendar.backfill_dates(perf, _done(perf))))
    known = features.asof_features(perf, ready)
    return known.select("as_of", *FEATURE_COLUMNS, *PERF_INTS, *PERF_DOUBLES)


@register(
    "backfill_features",
    sql(
        {
            **ASOF,
            "crowded": "SELECT as_of FROM newest GROUP BY as_of HAVING count(*) >= 10",
        },
        f"SELECT {day('as_of', 'date_id')}, {day('date_id', 'source_date_id')}, "
        f"{big('agent_id', 'agent_id')}, {R('stress_index')} AS stress_index, "
        f"{R('avg_backlog_30d')} AS avg_backlog_30d FROM newest "
        "WHERE as_of IN (SELECT as_of FROM crowded)",
    ),
)
def _backfill_features(spark, sf):
    perf = kept(_gappy(spark, sf))
    return jobs.backfill_features(perf, _done(perf)).select(
        "date_id", "source_date_id", "agent_id", "stress_index", "avg_backlog_30d"
    )


@register(
    "missing_dates",
    sql(
        CANDIDATES,
        f"SELECT DISTINCT {day('date_id')} FROM perf WHERE date_id NOT IN "
        "(SELECT date_id FROM done)",
    ),
)
def _missing_dates(spark, sf):
    perf = _gappy(spark, sf)
    return joins.missing_dates(perf.select("date_id").distinct(), _done(perf))


# --- coverage, calendar, keys ----------------------------------------------------------------------


@register(
    "coverage_summary",
    sql(
        o.performance(days=600, every_agent=False),
        f"SELECT {day('min(date_id)', 'first_day')}, {day('max(date_id)', 'last_day')}, "
        f"{big('max(date_id) - min(date_id) + 1', 'span_days')}, "
        f"{big('count(DISTINCT date_id)', 'distinct_days')}, {big('count(*)', 'row_count')}, "
        f"{big('count(DISTINCT agent_id)', 'entities')}, "
        f"{R('count(*) / count(DISTINCT agent_id)')} AS rows_per_entity FROM perf",
    ),
)
def _coverage_summary(spark, sf):
    return calendar.coverage(_gappy(spark, sf))


RANGE = {
    **o.performance(days=600, every_agent=False),
    "short": "SELECT * FROM perf WHERE day(date_id) = 1",
    "ranges": """
        SELECT 'gappy' AS source, CASE WHEN count(DISTINCT date_id) < 90 THEN min(date_id)
            ELSE max(date_id) - 90 END AS start, max(date_id) AS end_day,
            count(DISTINCT date_id) AS days FROM perf
        UNION ALL
        SELECT 'short', CASE WHEN count(DISTINCT date_id) < 90 THEN min(date_id)
            ELSE max(date_id) - 90 END, max(date_id), count(DISTINCT date_id) FROM short""",
}


@register(
    "training_range",
    sql(
        RANGE,
        f"SELECT source, {day('start')}, {day('end_day')}, {big('days', 'days')} FROM ranges",
    ),
)
def _training_range(spark, sf):
    perf = _gappy(spark, sf)
    parts = {"gappy": perf, "short": perf.where(F.dayofmonth("date_id") == 1)}
    gappy, short = (
        calendar.training_range(df).select(
            F.lit(n).alias("source"), "start", F.col("end").alias("end_day"), "days"
        )
        for n, df in parts.items()
    )
    return gappy.unionByName(short)


@register(
    "training_extract",
    sql(
        RANGE,
        f"SELECT {KEYS_OUT}, {PERF_OUT} FROM perf, ranges "
        "WHERE source = 'gappy' AND date_id BETWEEN start AND end_day",
    ),
)
def _training_extract(spark, sf):
    perf = _gappy(spark, sf)
    chosen = calendar.in_training_range(perf, perf)
    return chosen.select("date_id", "agent_id", *PERF_INTS, *PERF_DOUBLES)


@register(
    "dim_time_extension",
    sql(
        {
            "days": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_id FROM orders",
            "stored": "SELECT date_id FROM days WHERE year(date_id) < 1998",
            "appended": """
                SELECT CAST(unnest(generate_series((SELECT max(date_id) + 1 FROM stored),
                    (SELECT max(date_id) FROM days), INTERVAL 1 DAY)) AS DATE) AS date_id""",
        },
        f"SELECT {day('date_id')}, {day('date_id', 'full_date')}, {big('day(date_id)', 'day')}, "
        f"{big('month(date_id)', 'month')}, {big('quarter(date_id)', 'quarter')}, "
        f"{big('year(date_id)', 'year')} FROM appended",
    ),
)
def _dim_time_extension(spark, sf):
    days = a.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date_id"))
    stored = days.where(F.year("date_id") < 1998).distinct()
    return calendar.missing_calendar(stored, days.agg(F.max("date_id")).scalar())


@register(
    "resume_cursor",
    sql(
        o.tickets(),
        f"SELECT {day('max(date_id) + 1', 'next_date')}, "
        f"{big('coalesce(max(ticket_id), 0)', 'last_key')} FROM tickets",
    ),
)
def _resume_cursor(spark, sf):
    rows = a.tickets(spark, sf)
    key = tables.last_key(rows, "ticket_id").scalar()
    return tables.next_date(rows).withColumn("last_key", key)


@register(
    "surrogate_keys",
    sql(
        o.tickets(),
        f"""SELECT {big('1000 + row_number() OVER (ORDER BY date_id, ticket_id % 64,'
            ' ticket_id, agent_id)', 'ticket_key')},
        {KEYS_OUT}, {big('ticket_id', 'ticket_id')} FROM tickets""",
    ),
)
def _surrogate_keys(spark, sf):
    rows = a.tickets(spark, sf).withColumn("block", F.pmod("ticket_id", F.lit(64)))
    numbered = ranking.number_rows(
        rows, [["date_id"], ["block"]], ["ticket_id", "agent_id"], "ticket_key", 1000
    )
    return numbered.select("ticket_key", "date_id", "agent_id", "ticket_id")


# --- tickets, backlog, billing -----------------------------------------------------------------------


SCORES_OUT = (
    f"{R('resolution_time_hrs')} AS resolution_time_hrs, "
    f"{big('response_time_mins', 'response_time_mins')}, "
    f"{R('satisfaction_score')} AS satisfaction_score, {big('nps_score', 'nps_score')}, "
    f"{R('effort_score')} AS effort_score"
)


@register(
    "ticket_scores",
    sql(o.tickets(), f"SELECT {big('ticket_id', 'ticket_id')}, {SCORES_OUT} FROM tickets"),
)
def _ticket_scores(spark, sf):
    return a.tickets(spark, sf).select(
        "ticket_id", "resolution_time_hrs", "response_time_mins", "satisfaction_score",
        "nps_score", "effort_score",
    )


@register(
    "route_counts",
    sql(
        o.tickets(gaps=True),
        f"SELECT {day('date_id')}, CASE WHEN resolved_in_first_contact = 1 THEN 'tickets' "
        f"ELSE 'backlog' END AS target, {big('count(*)', 'n')}, "
        f"{big('sum(CAST(escalated AS INTEGER))', 'escalated')} FROM tickets GROUP BY ALL",
    ),
)
def _route_counts(spark, sf):
    rows = a.tickets(spark, sf, gaps=True)

    def count(df, target):
        return df.groupBy("date_id").agg(
            F.lit(target).alias("target"),
            F.count("*").alias("n"),
            F.count_if(service.is_escalated()).alias("escalated"),
        )

    return count(ticket_ops.resolved_tickets(rows), "tickets").unionByName(
        count(ticket_ops.unresolved_tickets(rows), "backlog")
    )


TRIAGE_OUT = (
    f"{big('ticket_id', 'ticket_id')}, {KEYS_OUT}, priority, backlog_status, backlog_reason, "
    f"backlog_age_category, {big('days_in_backlog', 'days_in_backlog')}, "
    f"{big('escalation_level', 'escalation_level')}, {big('sla_breached', 'sla_breached')}, "
    f"{day('assigned_date')}, {day('expected_resolution_date')}"
)
TRIAGE_COLUMNS = [
    "ticket_id", "date_id", "agent_id", "priority", "backlog_status", "backlog_reason",
    "backlog_age_category", "days_in_backlog", "escalation_level", "sla_breached",
    "assigned_date", "expected_resolution_date",
]


@register(
    "backlog_triage",
    sql(
        o.triaged(),
        f"SELECT {TRIAGE_OUT}, 1::BIGINT AS status_valid, 1::BIGINT AS reason_valid, "
        f"{big('CAST(escalated AS INTEGER)', 'is_escalated')} FROM triaged",
    ),
)
def _backlog_triage(spark, sf):
    rows = ticket_ops.triage(ticket_ops.unresolved_tickets(a.tickets(spark, sf)))
    return rows.select(*TRIAGE_COLUMNS, "status_valid", "reason_valid", "is_escalated")


@register(
    "backlog_given_status",
    sql(
        {
            **o.triaged(),
            "placed": "SELECT *, (['Pending', 'In Progress', 'Escalated', 'On Hold'])"
            "[ticket_id % 4 + 1] AS backlog_status FROM staged",
            "given": "SELECT *, 'Weather Delay' AS given_reason FROM reasoned",
        },
        f"""SELECT {big('ticket_id', 'ticket_id')}, {day('date_id')}, backlog_status,
        {big('CAST(list_contains(statuses, backlog_status) AS INTEGER)', 'status_valid')},
        {big('CAST(list_contains(reasons, given_reason) AS INTEGER)', 'reason_valid')}
        FROM given""",
    ),
)
def _backlog_given_status(spark, sf):
    states = ("Pending", "In Progress", "Escalated", "On Hold")
    rows = ticket_ops.unresolved_tickets(a.tickets(spark, sf)).withColumns(
        {
            "backlog_status": a.listed(states, F.col("ticket_id")),
            "backlog_reason": F.lit("Weather Delay"),
        }
    )
    return ticket_ops.triage(rows).select(
        "ticket_id", "date_id", "backlog_status", "status_valid", "reason_valid"
    )


@register(
    "backlog_records",
    sql(
        {**o.triaged(), **o.CUSTOMERS},
        f"SELECT {TRIAGE_OUT}, {big('customer_id', 'customer_id')}, customer_segment, "
        f"tariff_category, district, {big('reopened', 'reopened_count')}, "
        "1::BIGINT AS numbered_by_day "
        "FROM triaged JOIN customers USING (customer_id)",
    ),
)
def _backlog_records(spark, sf):
    rows = ticket_ops.unresolved_tickets(a.tickets(spark, sf, customers=True))
    backlog = kept(ticket_ops.build_backlog(rows, a.customers(spark, sf), 500))
    # Ids go on from 500 without a gap, day after day.
    earlier = backlog.groupBy("date_id").agg(F.count("*").alias("_n")).withColumn(
        "_until", F.sum("_n").over(Window.partitionBy(F.lit(1)).orderBy("date_id")) + 500
    )
    number = F.col("backlog_id").between(F.col("_until") - F.col("_n") + 1, F.col("_until"))
    ids = backlog.groupBy("date_id").agg(F.countDistinct("backlog_id").alias("_ids"))
    joined = backlog.join(earlier, "date_id").join(ids, "date_id")
    return joined.withColumn(
        "numbered_by_day", (number & (F.col("_ids") == F.col("_n"))).cast("int")
    ).select(
        *TRIAGE_COLUMNS, "customer_id", "customer_segment", "tariff_category", "district",
        "reopened_count", "numbered_by_day",
    )


@register(
    "customer_enrichment",
    sql(
        {**o.tickets(), **o.CUSTOMERS, "known": "SELECT * FROM customers WHERE customer_id % 10 <> 3"},
        f"""SELECT {big('ticket_id', 'ticket_id')}, {big('customer_id', 'customer_id')},
        coalesce(customer_segment, '') AS customer_segment,
        coalesce(tariff_category, '') AS tariff_category, coalesce(district, '') AS district
        FROM tickets LEFT JOIN known USING (customer_id)""",
    ),
)
def _customer_enrichment(spark, sf):
    known = a.customers(spark, sf).where("customer_id % 10 <> 3")
    rows = ticket_ops.with_customer(a.raw_tickets(spark, sf, customers=True), known)
    return rows.select(
        "ticket_id", "customer_id", "customer_segment", "tariff_category", "district"
    )


@register(
    "agent_enrichment",
    sql(
        {**o.tickets(), **o.AGENTS, "known": "SELECT * FROM agents WHERE agent_id % 10 <> 3"},
        f"""SELECT {big('ticket_id', 'ticket_id')}, {big('t.agent_id', 'agent_id')},
        {big('coalesce(k.department_id, 4)', 'department_id')},
        coalesce(role_title, '') AS role_title
        FROM tickets t LEFT JOIN known k ON k.agent_id = t.agent_id""",
    ),
)
def _agent_enrichment(spark, sf):
    known = a.agents(spark, sf).where("agent_id % 10 <> 3")
    rows = a.raw_tickets(spark, sf).drop("department_id")
    return ticket_ops.with_agent(rows, known).select(
        "ticket_id", "agent_id", "department_id", "role_title"
    )


@register(
    "facility_assignment",
    sql(
        {
            **o.tickets(),
            **o.CUSTOMERS,
            **o.NETWORK,
            "places": """
                SELECT district, facility_id, row_number() OVER (PARTITION BY district
                    ORDER BY facility_id) - 1 AS number, count(*) OVER (PARTITION BY district)
                    AS size FROM facilities""",
            "sizes": "SELECT DISTINCT district, size FROM places",
        },
        f"""SELECT {big('ticket_id', 'ticket_id')}, c.district,
        {big('coalesce(p.facility_id, f.facility_id)', 'facility_id')}
        FROM tickets t JOIN customers c USING (customer_id)
        LEFT JOIN sizes s ON s.district = c.district
        LEFT JOIN places p ON p.district = c.district AND p.number = t.ticket_id % s.size
        LEFT JOIN facilities f ON s.size IS NULL AND f.facility_id = t.ticket_id % (SELECT count(*) FROM facilities) + 1""",
    ),
)
def _facility_assignment(spark, sf):
    rows = ticket_ops.with_customer(
        a.raw_tickets(spark, sf, customers=True).drop("facility_id"), a.customers(spark, sf)
    )
    placed = ticket_ops.assign_facility(rows, a.facilities(spark), F.col("ticket_id"))
    return placed.select("ticket_id", "district", "facility_id")


@register(
    "season_bands",
    sql(
        o.usage(),
        f"SELECT {big('month(date_id)', 'month')}, season, {R('low')} AS low, {R('high')} AS high, "
        f"{big('count(*)', 'bills')}, {big('sum(season_valid)', 'valid')} FROM bills GROUP BY ALL",
    ),
)
def _season_bands(spark, sf):
    rows = billing.with_season(a.usage(spark, sf))
    return (
        rows.groupBy(
            F.month("date_id").alias("month"),
            "season",
            F.col("season_band.low").alias("low"),
            F.col("season_band.high").alias("high"),
        )
        .agg(F.count("*").alias("bills"), F.sum("season_valid").alias("valid"))
    )


@register(
    "billing",
    sql(
        o.usage(),
        f"""SELECT {big('billing_id', 'billing_id')}, {day('date_id')},
        {big('customer_id', 'customer_id')}, {R('consumption_m3')} AS consumption_m3,
        {R('rate_per_m3')} AS rate_per_m3, {R('discount_applied')} AS discount_applied,
        {R('billed_amount')} AS billed_amount, payment_status, {big('days_late', 'days_late')},
        {big('discount_valid', 'discount_valid')}, {big('lateness_valid', 'lateness_valid')},
        payment_method FROM bills""",
    ),
)
def _billing(spark, sf):
    return billing.bill(a.usage(spark, sf)).select(
        "billing_id", "date_id", "customer_id", "consumption_m3", "rate_per_m3",
        "discount_applied", "billed_amount", "payment_status", "days_late", "discount_valid",
        "lateness_valid", "payment_method",
    )


@register(
    "stored_tickets",
    sql(
        o.tickets(),
        f"SELECT {day('date_id')}, {big('count(*)', 'n')}, {big('sum(response_time_mins)', 'minutes')} "
        "FROM tickets WHERE resolved_in_first_contact = 1 GROUP BY date_id",
    ),
)
def _stored_tickets(spark, sf):
    """Write the resolved tickets by date twice (the second time replaces) and read them back."""
    root = fresh_folder(spark, "warehouse")
    rows = ticket_ops.resolved_tickets(a.tickets(spark, sf, customers=True))
    for _ in range(2):
        tables.replace_dates(rows, root, "fact_tickets")
    stored = tables.read_table(spark, root, "fact_tickets")
    return stored.groupBy("date_id").agg(
        F.count("*").alias("n"), F.sum("response_time_mins").alias("minutes")
    )


# --- sensors ---------------------------------------------------------------------------------------


@register(
    "classify_readings",
    sql(
        o.readings(),
        f"SELECT {big('reading_id', 'reading_id')}, sensor_type, {R('raw_value')} AS raw_value, "
        f"unit, status, analytics_category FROM readings",
    ),
)
def _classify_readings(spark, sf):
    return a.classified(spark, sf).select(
        "reading_id", "sensor_type", "raw_value", "unit", "status", "analytics_category"
    )


@register(
    "calibrate_readings",
    sql(
        o.readings(),
        f"SELECT {big('reading_id', 'reading_id')}, facility_name, facility_type, sensor_type, "
        f"{R('value')} AS value, status FROM readings",
    ),
)
def _calibrate_readings(spark, sf):
    return a.calibrated(spark, sf).select(
        "reading_id", "facility_name", "facility_type", "sensor_type", "value", "status"
    )


@register(
    "facility_status",
    sql(
        {
            **o.readings(),
            "hourly": """
                SELECT facility_name, date_trunc('hour', ts) AS cycle, max(rank) AS worst,
                       count(DISTINCT sensor_type) AS active_sensors
                FROM ranked_readings GROUP BY 1, 2""",
            "states": f"SELECT *, {o.LEVELS} FROM hourly",
        },
        f"SELECT facility_name, {stamp('cycle', 'cycle')}, status, "
        f"{big('alert_level', 'alert_level')}, {big('active_sensors', 'active_sensors')} FROM states",
    ),
)
def _facility_status(spark, sf):
    rows = a.calibrated(spark, sf).withColumn("cycle", F.date_trunc("hour", "timestamp"))
    return sensors.facility_status(rows, ["facility_name", "cycle"])


@register(
    "sensor_event_json",
    sql(
        o.events(),
        f"SELECT event_id, {stamp('cycle', 'timestamp')}, facility_name, facility_type, "
        f"sensor_type, {R('value')} AS value, unit, status, {R('threshold_min')} AS threshold_min, "
        f"{R('threshold_max')} AS threshold_max FROM sensor_rows",
    ),
)
def _sensor_event_json(spark, sf):
    """Events to JSON messages, parsed again and flattened to one row per sensor."""
    messages = event_source.to_messages(a.sensor_events(spark, sf))
    return sensors.explode_sensors(
        event_source.valid_events(event_source.parse_messages(messages))
    )


@register(
    "sensor_events",
    sql(
        o.events(),
        f"SELECT event_id, {stamp('cycle', 'timestamp')}, facility_name, status, "
        f"{big('alert_level', 'alert_level')}, {big('active_sensors', 'active_sensors')}, "
        "'DEV-' || upper(facility_type) || '-' || lpad(CAST(CAST('0x' || substr(md5(facility_name), 1, 8) AS BIGINT) "
        "% 10000 AS VARCHAR), 4, '0') AS device_id "
        "FROM sensor_events JOIN (SELECT facility_name, facility_type FROM facilities) USING (facility_name)",
    ),
)
def _sensor_events(spark, sf):
    return a.sensor_events(spark, sf).select(
        "event_id", "timestamp", F.col("facility.name").alias("facility_name"),
        "operational_metrics.status", "operational_metrics.alert_level",
        "operational_metrics.active_sensors", "metadata.device_id",
    )


@register(
    "missing_sensors",
    sql(
        o.events(),
        f"""SELECT event_id, {stamp('cycle', 'timestamp')}, facility_name,
        array_to_string(list_sort([s for s in expected if list_contains(seen, s)]), ',')
            AS present,
        array_to_string(list_sort([s for s in expected if NOT list_contains(seen, s)]),
            ',') AS missing
        FROM sensor_events JOIN (
            SELECT facility_name, list(sensor_type) AS expected
            FROM facilities f JOIN sensors s
            ON CASE WHEN len(list_intersect(priority_sensors,
                        (SELECT list(sensor_type) FROM sensors))) > 0
                    THEN list_contains(priority_sensors, sensor_type)
                    ELSE list_contains(facility_types, facility_type) END
            GROUP BY facility_name) USING (facility_name)""",
    ),
)
def _missing_sensors(spark, sf):
    expected = sensors.expected_sensors(a.facilities(spark), a.sensors(spark))
    rows = sensors.missing_sensors(a.sensor_events(spark, sf), expected)
    return rows.select(
        "event_id", "timestamp", "facility_name",
        F.array_join("present", ",").alias("present"),
        F.array_join("missing", ",").alias("missing"),
    )


@register(
    "anomaly_report",
    sql(
        o.events(),
        f"""SELECT event_id, {stamp('cycle', 'timestamp')}, upper(status) AS status,
        facility_name, supply_chain, anomalies
        FROM sensor_events JOIN facilities USING (facility_name) WHERE worst > 0""",
    ),
)
def _anomaly_report(spark, sf):
    return sensors.anomaly_report(a.sensor_events(spark, sf))


CYCLES = {
    **o.events(),
    "cycles": """
        SELECT cycle, count(*) AS facilities, count(*) FILTER (worst > 0) AS anomalous
        FROM sensor_events GROUP BY cycle""",
}


@register(
    "cycle_summary",
    sql(
        CYCLES,
        f"SELECT {stamp('cycle', 'cycle_start')}, "
        f"{stamp('cycle + INTERVAL 1 HOUR', 'cycle_end')}, {big('facilities', 'facilities')}, "
        f"{big('anomalous', 'anomalous')} FROM cycles",
    ),
)
def _cycle_summary(spark, sf):
    return sensors.cycle_summary(a.sensor_events(spark, sf), a.CYCLE)


@register(
    "stream_totals",
    sql(
        CYCLES,
        f"""SELECT {big('count(*)', 'cycles')}, {big('sum(facilities)', 'events')},
        {big('sum(anomalous)', 'anomalies')},
        {R('sum(anomalous) / sum(facilities) * 100')} AS anomaly_pct,
        {R('sum(facilities) / (count(*) * 3600)')} AS events_per_second FROM cycles""",
    ),
)
def _stream_totals(spark, sf):
    return sensors.stream_totals(a.sensor_events(spark, sf), a.CYCLE, a.CYCLE_SECONDS)


@register(
    "category_rollup",
    sql(
        o.readings(),
        f"""SELECT analytics_category, {big('count(*)', 'readings')},
        {big('count(DISTINCT sensor_type)', 'sensor_types')},
        {big("count(*) FILTER (status = 'warning')", 'warnings')},
        {big("count(*) FILTER (status = 'critical')", 'criticals')},
        {R("count(*) FILTER (status <> 'normal') / count(*) * 100")} AS anomaly_pct
        FROM readings GROUP BY analytics_category""",
    ),
)
def _category_rollup(spark, sf):
    return sensors.category_rollup(a.classified(spark, sf))


@register(
    "facilities_by_chain",
    sql(
        {
            **o.events(),
            "chains": """
                SELECT coalesce(supply_chain, 'Unknown') AS supply_chain, count(*) AS facilities,
                       string_agg(facility_name || ' (' || facility_type || ') - ' || district,
                           '; ' ORDER BY facility_name) AS listing
                FROM facilities GROUP BY 1""",
            "counts": """
                SELECT supply_chain, count(*) AS events, count(*) FILTER (worst > 0) AS anomalous
                FROM sensor_events JOIN facilities USING (facility_name) GROUP BY 1""",
        },
        f"""SELECT supply_chain, {big('facilities', 'facilities')}, listing,
        {big('events', 'events')}, {big('anomalous', 'anomalous')}
        FROM chains JOIN counts USING (supply_chain)""",
    ),
)
def _facilities_by_chain(spark, sf):
    counts = a.sensor_events(spark, sf).groupBy("facility.supply_chain").agg(
        F.count("*").alias("events"),
        F.count_if(sensors.event_status() != "operational").alias("anomalous"),
    )
    return sensors.supply_chains(a.facilities(spark)).join(counts, "supply_chain")


@register(
    "facility_neighbours",
    sql(
        {
            **o.readings(),
            "loads": "SELECT facility_name, count(*) AS readings FROM readings GROUP BY 1",
        },
        f"""SELECT {big('f.facility_id', 'facility_id')}, f.facility_name,
        {big('u.facility_id', 'upstream_id')}, u.facility_type AS upstream_type,
        {big('d.facility_id', 'downstream_id')}, d.facility_type AS downstream_type,
        {big('own.readings', 'readings')}, {big('up.readings', 'upstream_readings')}
        FROM facilities f
        LEFT JOIN facilities u ON u.facility_name = f.upstream_facility
        LEFT JOIN facilities d ON d.facility_name = f.downstream_facility
        LEFT JOIN loads own ON own.facility_name = f.facility_name
        LEFT JOIN loads up ON up.facility_name = f.upstream_facility""",
    ),
)
def _facility_neighbours(spark, sf):
    loads = a.calibrated(spark, sf).groupBy("facility_name").agg(F.count("*").alias("readings"))
    upstream = loads.select(
        F.col("facility_name").alias("upstream_facility"),
        F.col("readings").alias("upstream_readings"),
    )
    near = sensors.facility_neighbours(a.facilities(spark))
    return (
        near.join(loads, "facility_name", "left")
        .join(upstream, "upstream_facility", "left")
        .select(
            "facility_id", "facility_name", "upstream_id", "upstream_type", "downstream_id",
            "downstream_type", "readings", "upstream_readings",
        )
    )


@register(
    "upstream_status",
    sql(
        o.events(),
        f"""SELECT e.event_id, {stamp('e.cycle', 'timestamp')}, e.facility_name,
        f.upstream_facility, e.status, u.status AS upstream_status
        FROM sensor_events e JOIN facilities f USING (facility_name)
        LEFT JOIN sensor_events u ON u.cycle = e.cycle
            AND u.facility_name = f.upstream_facility""",
    ),
)
def _upstream_status(spark, sf):
    return sensors.upstream_status(a.sensor_events(spark, sf))


@register(
    "latest_status",
    sql(
        o.events(),
        f"""SELECT facility_name, status, {stamp('cycle', 'since')} FROM (
            SELECT *, row_number() OVER (PARTITION BY facility_name ORDER BY cycle DESC) AS place
            FROM sensor_events) WHERE place = 1""",
    ),
)
def _latest_status(spark, sf):
    return sensors.latest_status(a.sensor_events(spark, sf))


CHANGES_OUT = """previous_status, status FROM (
    SELECT *, lag(status) OVER (PARTITION BY facility_name ORDER BY {order}) AS previous_status
    FROM {source}) WHERE status IS DISTINCT FROM previous_status"""


@register(
    "status_changes",
    sql(
        o.events(),
        f"SELECT event_id, {stamp('cycle', 'timestamp')}, facility_name, "
        + CHANGES_OUT.format(order="cycle", source="sensor_events"),
    ),
)
def _status_changes(spark, sf):
    return sensors.status_changes(a.sensor_events(spark, sf), block="day")


# --- KPI measures ----------------------------------------------------------------------------------


def _drilldown_oracle(parts: dict[str, str], parent: str) -> str:
    """``parts`` ends in a table ``part_rows`` of date_id, department_id, part and whole."""
    return sql(
        {
            **parts,
            **o.DEPARTMENT_ROWS,
            "levels": """
                SELECT date_id, department_id, sum(part) AS part, sum(whole) AS whole
                FROM part_rows GROUP BY 1, 2
                UNION ALL SELECT date_id, 0, sum(part), sum(whole) FROM part_rows GROUP BY 1""",
            "valued": f"""
                SELECT *, CAST({R('CASE WHEN whole > 0 THEN CAST(part AS DOUBLE) / whole ELSE 0 END', 4)}
                    AS DOUBLE) AS measure_value,
                    row_number() OVER (ORDER BY date_id, department_id) AS measure_id FROM levels""",
        },
        f"""SELECT {big('measure_id', 'measure_id')}, {big('v.department_id', 'department_id')},
        CASE WHEN v.department_id = 0 THEN 'Overall' ELSE coalesce(department_name, '') END
            AS department_name, measure_value, {day('date_id', 'measure_date')},
        '{parent}' AS parent_kpi
        FROM valued v LEFT JOIN departments d ON d.department_id = v.department_id""",
    )


def _split_facts(spark, sf):
    rows = a.tickets(spark, sf)
    backlog = ticket_ops.triage(ticket_ops.unresolved_tickets(rows))
    return ticket_ops.resolved_tickets(rows), backlog


def whole(column: str) -> str:
    return f"sum(CAST({column} AS DECIMAL(18,4)))"


def exact(column: str) -> str:
    return f"CAST({whole(column)} AS DOUBLE)"


RESOLVED = "SELECT * FROM tickets WHERE resolved_in_first_contact = 1"
OPEN = "SELECT * FROM tickets WHERE resolved_in_first_contact <> 1"
RATE_PARTS = """
    SELECT date_id, department_id, sum(total_tickets_handled - backlog) * 100 AS part,
           sum(total_tickets_handled) AS whole FROM perf GROUP BY 1, 2"""
CSAT_PARTS = f"""
    SELECT date_id, department_id, {whole('satisfaction_score')} AS part, count(*) AS whole
    FROM resolved GROUP BY 1, 2"""
SLA_PARTS = """
    SELECT date_id, department_id, sum(met) * 100 AS part, count(*) AS whole FROM (
        SELECT date_id, department_id, sla_compliance AS met FROM resolved
        UNION ALL SELECT date_id, department_id,
            1 - CAST(days_in_backlog > 7 OR sla_compliance = 0 AS INTEGER) FROM open_tickets)
    GROUP BY 1, 2"""
TIME_PARTS = f"""
    SELECT date_id, department_id, {whole('resolution_time_hrs')} AS part, count(*) AS whole
    FROM resolved GROUP BY 1, 2"""
SPLIT = {**o.tickets(), "resolved": RESOLVED, "open_tickets": OPEN}


@register(
    "kpi_resolution_rate",
    _drilldown_oracle(
        {**o.performance(varied=False), "part_rows": RATE_PARTS}, "Overall Resolution Rate %"
    ),
)
def _kpi_resolution_rate(spark, sf):
    return kpis.resolution_rate_drilldown(a.performance_rows(spark, sf), a.departments(spark))


@register(
    "kpi_csat", _drilldown_oracle({**SPLIT, "part_rows": CSAT_PARTS}, "Overall CSAT Score")
)
def _kpi_csat(spark, sf):
    resolved, _ = _split_facts(spark, sf)
    return kpis.csat_drilldown(resolved, a.departments(spark))


@register(
    "kpi_sla", _drilldown_oracle({**SPLIT, "part_rows": SLA_PARTS}, "Overall SLA Compliance %")
)
def _kpi_sla(spark, sf):
    return kpis.sla_drilldown(*_split_facts(spark, sf), a.departments(spark))


@register(
    "kpi_resolution_time",
    _drilldown_oracle({**SPLIT, "part_rows": TIME_PARTS}, "Overall Avg Resolution Time"),
)
def _kpi_resolution_time(spark, sf):
    resolved, _ = _split_facts(spark, sf)
    return kpis.resolution_time_drilldown(resolved, a.departments(spark))


def _long_oracle(table: str, ids: str, measures: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, '{name}' AS measure_name, CAST({expr} AS DOUBLE) AS measure_value FROM {table}"
        for name, expr in measures.items()
    )


def _overall(parts: str, name: str) -> str:
    return (
        f"SELECT date_id, '{name}' AS measure_name, CAST(sum(part) AS DOUBLE) / sum(whole) "
        f"AS measure_value FROM ({parts}) GROUP BY 1"
    )


@register(
    "executive_summary",
    sql(
        {
            **o.performance(varied=False),
            **o.usage(),
            "resolved": RESOLVED,
            "open_tickets": OPEN,
            "measures": " UNION ALL ".join(
                [
                    _overall(RATE_PARTS, "Resolution Rate %"),
                    _overall(CSAT_PARTS, "CSAT Score"),
                    _overall(SLA_PARTS, "SLA Compliance %"),
                    _overall(TIME_PARTS, "Avg Resolution Time"),
                    "SELECT date_id, 'NPS', avg(nps_score) FROM resolved GROUP BY 1",
                    "SELECT date_id, 'Ticket Count', count(*) FROM resolved GROUP BY 1",
                    f"SELECT date_id, 'Total Billed', {exact('billed_amount')} FROM bills GROUP BY 1",
                ]
            ),
        },
        f"""SELECT {big('row_number() OVER (ORDER BY date_id, measure_name)', 'measure_id')},
        measure_name, {R('measure_value')} AS measure_value, {day('date_id', 'measure_date')}
        FROM measures""",
    ),
)
def _executive_summary(spark, sf):
    bills = billing.bill(a.usage(spark, sf))
    return kpis.executive_summary(
        a.performance_rows(spark, sf), *_split_facts(spark, sf), bills
    )


MEASURED_ON = f"'{a.MEASURED_ON}'"


@register(
    "customer_service_measures",
    sql(
        {
            **o.tickets(),
            **o.CUSTOMERS,
            "grouped": f"""
                SELECT district, issue_category, {exact('satisfaction_score')} AS csat,
                       sum(resolved_in_first_contact) AS first, sum(sla_compliance) AS met,
                       sum(nps_score) AS nps, {exact('effort_score')} AS effort,
                       sum(response_time_mins) AS response, count(*) AS n
                FROM tickets JOIN customers USING (customer_id) GROUP BY 1, 2""",
            "measures": _long_oracle(
                "grouped",
                "district, issue_category",
                {
                    "CSAT Score": "csat / n",
                    "First Contact Resolution %": "first / n * 100",
                    "SLA Compliance %": "met / n * 100",
                    "NPS": "nps / n",
                    "Effort Score": "effort / n",
                    "Response Time Mins": "response / n",
                },
            ),
        },
        f"""SELECT {big('row_number() OVER (ORDER BY district, issue_category, measure_name)',
                        'measure_id')}, measure_name, {R('measure_value')} AS measure_value,
        {MEASURED_ON} AS measure_date, district, issue_category FROM measures""",
    ),
)
def _customer_service_measures(spark, sf):
    return kpis.customer_service_measures(
        a.tickets(spark, sf, customers=True), a.customers(spark, sf), F.lit(a.MEASURED_ON)
    )


@register(
    "agent_measures",
    sql(
        {
            **o.performance(),
            "grouped": f"""
                SELECT agent_id, sum(total_tickets_handled) AS n,
                       {exact('avg_handle_time_mins * total_tickets_handled')} AS minutes,
                       {exact('escalation_rate * total_tickets_handled')} AS escalated,
                       sum(total_tickets_handled - backlog) AS resolved,
                       {exact('utilization_rate')} / count(*) AS used
                FROM perf GROUP BY 1""",
            "measures": _long_oracle(
                "grouped",
                "agent_id",
                {
                    "Avg Handle Time Mins": "minutes / n",
                    "Utilization Rate": "used",
                    "Resolution Rate %": "resolved / n * 100",
                    "Escalation Rate": "escalated / n",
                },
            ),
        },
        f"""SELECT {big('row_number() OVER (ORDER BY agent_id, measure_name)', 'measure_id')},
        {big('agent_id', 'agent_id')}, measure_name, {R('measure_value')} AS measure_value,
        {MEASURED_ON} AS measure_date FROM measures""",
    ),
)
def _agent_measures(spark, sf):
    return kpis.agent_measures(a.varied_performance(spark, sf), F.lit(a.MEASURED_ON))


@register(
    "billing_measures",
    sql(
        {
            **o.usage(),
            "grouped": f"""
                SELECT customer_segment, {exact('billed_amount')} AS billed,
                       {exact('consumption_m3')} AS consumption,
                       {exact("CASE WHEN payment_status = 'Paid' THEN billed_amount ELSE 0 END")} AS paid,
                       {exact("CASE WHEN payment_status = 'Overdue' THEN billed_amount ELSE 0 END")} AS overdue,
                       {exact('discount_applied')} AS discount, count(*) AS n
                FROM bills GROUP BY 1""",
            "measures": _long_oracle(
                "grouped",
                "customer_segment",
                {
                    "Total Billed": "billed",
                    "Total Consumption": "consumption",
                    "Collection Rate %": "paid / billed * 100",
                    "Overdue %": "overdue / billed * 100",
                    "Avg Discount": "discount / n",
                },
            ),
        },
        f"""SELECT {big('row_number() OVER (ORDER BY customer_segment, measure_name)', 'measure_id')},
        measure_name, {R('measure_value')} AS measure_value, {MEASURED_ON} AS measure_date,
        customer_segment FROM measures""",
    ),
)
def _billing_measures(spark, sf):
    return kpis.billing_measures(
        billing.bill(a.usage(spark, sf)), a.customers(spark, sf), F.lit(a.MEASURED_ON)
    )


@register(
    "customer_measures",
    sql(
        {
            **o.tickets(),
            **o.usage(),
            "contacts": f"""
                SELECT customer_id, count(*) AS n, {exact('satisfaction_score')} / count(*) AS csat
                FROM tickets GROUP BY 1""",
            "paid": """
                SELECT customer_id, avg(days_late) AS late FROM bills
                WHERE payment_status = 'Paid' GROUP BY 1""",
            "measures": _long_oracle("contacts", "customer_id", {"Ticket Count": "n", "Mean CSAT": "csat"})
            + " UNION ALL "
            + _long_oracle("paid", "customer_id", {"Mean Days Late": "late"}),
        },
        f"""SELECT {big('row_number() OVER (ORDER BY customer_id, measure_name)', 'measure_id')},
        {big('customer_id', 'customer_id')}, measure_name, {R('measure_value')} AS measure_value,
        {MEASURED_ON} AS prediction_date FROM measures""",
    ),
)
def _customer_measures(spark, sf):
    return kpis.customer_measures(
        a.tickets(spark, sf, customers=True),
        billing.bill(a.usage(spark, sf)),
        F.lit(a.MEASURED_ON),
    )


BUCKETS = 8


def _bucketed_root(spark, sf):
    root = fresh_folder(spark, "warehouse")
    tables.append_table(a.varied_performance(spark, sf), root, jobs.PERFORMANCE)
    tables.append_table(a.tickets(spark, sf, customers=True), root, "fact_tickets")
    tables.append_table(a.agents(spark, sf), root, "dim_agent")
    jobs.bucket_training_tables(spark, root, BUCKETS)
    return root


@register("bucketed_training_frame", ORACLES["training_frame"])
def _bucketed_training_frame(spark, sf):
    """The training frame from tables bucketed and sorted by agent: no exchange."""
    root = _bucketed_root(spark, sf)
    with buckets.co_partitioned(spark):
        frame = kept(jobs.bucketed_training_frame(spark, root))
    return frame.drop("performance_id", "department_id", "resolution_rate")


@register(
    "stored_order",
    sql(
        {**o.performance(), "files": "SELECT date_id FROM perf GROUP BY 1"},
        f"""SELECT 'fact_agent_performance' AS name, {big('count(DISTINCT date_id)', 'files')}, {big('count(*)', 'n')},
            0::BIGINT AS breaks FROM perf
        UNION ALL SELECT 'fact_tickets', count(DISTINCT date_id), count(*), 0 FROM tickets
        UNION ALL SELECT 'performance', NULL, count(*), 0 FROM perf""",
    ),
)
def _stored_order(spark, sf):
    """Rows of stored files in the declared order: none comes before its predecessor; a date is
    one file here, a bucket at most one."""
    root = _bucketed_root(spark, sf)
    parts = [
        buckets.order_breaks(spark.read.schema(tables.declared(name).schema).parquet(f"{root}/{name}"), tables.declared(name).sort)
        .withColumn("name", F.lit(name))
        for name in (jobs.PERFORMANCE, "fact_tickets")
    ]
    bucketed = buckets.open_bucketed(spark, f"{root}/bucketed", "performance")
    dealt = buckets.order_breaks(bucketed, ["agent_id", "date_id"]).withColumns(
        # More files than buckets would show here; how many hold rows depends on the ids.
        {"name": F.lit("performance"), "files": F.when(F.col("files") > BUCKETS, F.col("files"))}
    )
    return parts[0].unionByName(parts[1]).unionByName(dealt)


# Stored facts are all tickets (not only the resolved ones), the backlog of the open ones, and bills.
KEPT_UP = {
    "meas_resolution_rate_drilldown": "kpi_resolution_rate", "meas_csat_drilldown": "kpi_csat",
    "meas_sla_compliance_drilldown": "kpi_sla", "meas_avg_resolution_time_drilldown": "kpi_resolution_time",
    "meas_executive_summary": "executive_summary", "meas_customer_service": "customer_service_measures",
    "meas_agent_performance": "agent_measures", "meas_billing": "billing_measures", "meas_predictive": "customer_measures",
}
CHANGED_DAYS = (9, 19, 29)


def _kept_up_oracle(query: str) -> str:
    """The measure over all tickets, and over bills of as many days as there are of tickets."""
    text = ORACLES[query].replace(RESOLVED, "SELECT * FROM tickets")
    return text.replace(o.service_day(a.YEAR_DAYS), o.service_day(a.DENSE_DAYS))


@register(
    "measures_kept_up",
    " UNION ALL ".join(
        [
            f"SELECT '{table}' AS name, measure_id, measure_value FROM ({_kept_up_oracle(query)})"
            for table, query in KEPT_UP.items()
        ]
        + [f"SELECT 'changed {fact}', NULL, {len(CHANGED_DAYS)}::DOUBLE" for fact in jobs.SUMS]
    ),
)
def _measures_kept_up(spark, sf):
    """All measure tables after three days changed: the sums of those days alone are read again."""
    root = fresh_folder(spark, "warehouse")
    with a.joined_lines(spark, sf):
        rows = a.tickets(spark, sf, customers=True)
        opened = ticket_ops.unresolved_tickets(rows)
        facts = {
            jobs.PERFORMANCE: a.varied_performance(spark, sf),
            "fact_tickets": rows,
            "fact_backlog": ticket_ops.build_backlog(opened, a.customers(spark, sf)),
            "fact_billing": billing.bill(a.usage(spark, sf, a.DENSE_DAYS)),
        }
    facts = {name: tables.conform(df, tables.declared(name)) for name, df in facts.items()}
    # Tickets and bills are a projection of the stored lines; what takes a shuffle is kept.
    facts |= {name: kept(facts[name]) for name in (jobs.PERFORMANCE, "fact_backlog")}
    tables.replace_table(tables.conform(a.customers(spark, sf), tables.declared("dim_customer")), root, "dim_customer")
    named = a.departments(spark).withColumns({"manager_name": F.lit(""), "team_size": F.lit(0)})
    tables.replace_table(named, root, "dim_department")
    days = [a.FIRST_DAY + timedelta(days=n) for n in CHANGED_DAYS]
    early = F.col("date_id").isin(days)
    # At first the days lack half of their agents and customers, and the last of them all rows.
    with tables.Load(spark, root) as load:
        for name, df in facts.items():
            key = "agent_id" if name == jobs.PERFORMANCE else "customer_id"
            partly = (F.col(key) % 2 == 0) & (F.col("date_id") != F.lit(days[-1]))
            load.put_days(df.where(~early | partly), name)
    jobs.refresh_measures(spark, root, a.MEASURED_ON)
    with tables.Load(spark, root) as load:
        for name, df in facts.items():
            load.put_days(df.where(early), name)
    changed = jobs.refresh_measures(spark, root, a.MEASURED_ON)
    parts = [
        tables.read_table(spark, root, name).select(F.lit(name).alias("name"), "measure_id", F.col("measure_value").cast("double"))
        for name in KEPT_UP
    ]
    counts = spark.createDataFrame(
        [(f"changed {fact}", None, float(len(some))) for fact, some in changed.items()], "name string, measure_id long, measure_value double"
    )
    return reduce(lambda one, other: one.unionByName(other), [*parts, counts])


DAY_RANGES = ((1, 2), (5, 60), (61, 300))
SKETCHED = {
    **o.performance(),
    **o.usage(),
    "seen": """SELECT 'agents' AS entity, date_id, agent_id AS id FROM perf
        UNION ALL SELECT 'customers', date_id, customer_id FROM tickets
        UNION ALL SELECT 'payers', date_id, customer_id FROM bills""",
    "ranges": f"SELECT * FROM (VALUES {', '.join(map(str, DAY_RANGES))}) r(first, last)",
}


@register(
    "distinct_by_sketch",
    sql(
        SKETCHED,
        f"""SELECT {big('first', 'first')}, {big('last', 'last')}, entity, {big('count(DISTINCT id)', 'exact')},
        1::BIGINT AS close FROM ranges JOIN seen
            ON date_id BETWEEN DATE '2025-01-01' + CAST(first - 1 AS INTEGER) AND DATE '2025-01-01' + CAST(last - 1 AS INTEGER)
        GROUP BY first, last, entity""",
    ),
)
def _distinct_by_sketch(spark, sf):
    """Distinct agents, customers and payers of ranges of days from merged sketches, within 5 % of the
    exact count, which is computed beside."""
    root = fresh_folder(spark, "warehouse")
    with a.joined_lines(spark, sf):
        facts = {
            jobs.PERFORMANCE: a.varied_performance(spark, sf), "fact_tickets": a.tickets(spark, sf, customers=True),
            "fact_billing": billing.bill(a.usage(spark, sf)),
        }
    with tables.Load(spark, root) as load:
        for name, df in facts.items():
            load.put_days(df, name)
    with tables.Load(spark, root) as load:
        jobs.sketch_entities(spark, root, load, jobs.changed_dates(spark, root))
    seen = reduce(
        lambda one, other: one.unionByName(other),
        [
            tables.read_table(spark, root, fact).select(F.lit(entity).alias("entity"), "date_id", F.col(column).alias("id"))
            for entity, (fact, column) in jobs.ENTITIES.items()
        ],
    )
    parts = []
    for first, last in DAY_RANGES:
        start, end = (a.FIRST_DAY + timedelta(days=n - 1) for n in (first, last))
        counted = tables.scan_dates(seen, start, end).groupBy("entity").agg(F.countDistinct("id").alias("exact"))
        off = F.abs(F.col("estimate") - F.col("exact"))
        parts.append(
            jobs.distinct_entities(spark, root, start, end).join(counted, "entity").select(
                F.lit(first).alias("first"), F.lit(last).alias("last"), "entity", "exact",
                (off <= F.greatest(F.lit(1.0), F.col("exact") * 0.05)).cast("int").alias("close"),
            )
        )
    return reduce(lambda one, other: one.unionByName(other), parts)


@register("due_by_folder", sql(CANDIDATES, f"SELECT {day('date_id')} FROM candidates"))
def _due_by_folder(spark, sf):
    """Dates to be predicted, from the folders of stored performance and predictions: no row is read."""
    root = fresh_folder(spark, "warehouse")
    perf = kept(_gappy(spark, sf))
    tables.append_table(perf, root, jobs.PERFORMANCE)
    spec = tables.declared(jobs.PREDICTIONS)
    done = _done(perf).select(
        "date_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema.fields if f.name != "date_id"]
    )
    tables.replace_dates(done, root, jobs.PREDICTIONS)
    return tables.date_rows(spark, jobs.due_dates(spark, root))


# --- streaming -------------------------------------------------------------------------------------


def _finished(spark: SparkSession, stream: DataFrame, start=sinks.append_stream) -> str:
    """Run a stream over what is available and give the folder of its result."""
    folder = fresh_folder(spark, "stream")
    start(stream, f"{folder}/result", f"{folder}/checkpoint").awaitTermination()
    return f"{folder}/result"


# Events arrive in several batches, in the order of their time; a window is final once the watermark, the newest time
# less the delay, has passed its end.
WATERMARK = "(SELECT max(ts) - INTERVAL 1 MINUTE FROM events)"


@register(
    "stream_cycle_summary",
    sql(
        o.singles(),
        f"""SELECT {stamp('cycle', 'cycle_start')},
        {stamp('cycle + INTERVAL 1 HOUR', 'cycle_end')}, {big('count(*)', 'facilities')},
        {big('count(*) FILTER (worst > 0)', 'anomalous')}
        FROM (SELECT *, date_trunc('hour', ts) AS cycle FROM singles) GROUP BY cycle
        HAVING cycle + INTERVAL 1 HOUR <= {WATERMARK}""",
    ),
)
def _stream_cycle_summary(spark, sf):
    summary = monitor.cycle_summary(a.event_stream(spark, sf), a.CYCLE)
    path = _finished(spark, summary)
    return spark.read.parquet(path)


@register(
    "stream_anomaly_rates",
    sql(
        {
            **o.singles(),
            "slides": """
                SELECT *, unnest(generate_series(date_trunc('hour', ts) - INTERVAL 3 HOUR,
                    date_trunc('hour', ts), INTERVAL 1 HOUR)) AS window_start FROM singles""",
        },
        f"""SELECT {stamp('window_start', 'window_start')},
        {stamp('window_start + INTERVAL 4 HOUR', 'window_end')}, facility_name,
        {big('count(*)', 'events')}, {big('count(*) FILTER (worst > 0)', 'anomalies')},
        {R('count(*) FILTER (worst > 0) / count(*) * 100')} AS anomaly_pct
        FROM slides GROUP BY window_start, facility_name
        HAVING window_start + INTERVAL 4 HOUR <= {WATERMARK}""",
    ),
)
def _stream_anomaly_rates(spark, sf):
    rates = monitor.anomaly_rates(a.event_stream(spark, sf), "4 hours", "1 hour")
    path = _finished(spark, rates)
    return spark.read.parquet(path)


@register(
    "stream_anomaly_sessions",
    sql(
        {
            **o.singles(),
            "bad": "SELECT * FROM singles WHERE worst > 0",
            "marked": """
                SELECT *, CASE WHEN lag(ts) OVER w >= ts - INTERVAL 1 HOUR AND
                    lag(ts) OVER w + INTERVAL 1 HOUR > ts THEN 0 ELSE 1 END AS starts
                FROM bad WINDOW w AS (PARTITION BY facility_name ORDER BY ts)""",
            "runs": """
                SELECT *, sum(starts) OVER (PARTITION BY facility_name ORDER BY ts) AS run
                FROM marked""",
            "ended": """
                SELECT facility_name, run, min(ts) AS first, max(ts) + INTERVAL 1 HOUR AS last,
                       count(*) AS events, max(alert_level) AS alert_level
                FROM runs GROUP BY 1, 2""",
        },
        f"""SELECT {stamp('first', 'session_start')}, {stamp('last', 'session_end')}, facility_name,
        {big('events', 'events')}, {big('alert_level', 'alert_level')} FROM ended
        WHERE last <= (SELECT max(ts) - INTERVAL 1 MINUTE FROM bad)""",
    ),
)
def _stream_anomaly_sessions(spark, sf):
    runs = monitor.anomaly_sessions(a.event_stream(spark, sf), "1 hour")
    path = _finished(spark, runs)
    return spark.read.parquet(path)


@register(
    "stream_running_totals",
    sql(
        o.singles(),
        f"""SELECT {big('count(*)', 'events')}, {big('count(*) FILTER (worst > 0)', 'anomalies')},
        {stamp('min(ts)', 'first_event')}, {stamp('max(ts)', 'last_event')},
        {R('count(*) FILTER (worst > 0) / count(*) * 100')} AS anomaly_pct,
        {R("count(*) / greatest(1, CAST(floor(epoch(max(ts))) - floor(epoch(min(ts))) AS BIGINT))")}
            AS events_per_second FROM singles""",
    ),
)
def _stream_running_totals(spark, sf):
    totals = monitor.running_totals(a.event_stream(spark, sf))
    return sinks.read_newest(spark, _finished(spark, totals, sinks.replace_stream))


@register(
    "stream_status_changes",
    sql(
        {**o.singles(), "ordered": "SELECT *, CAST(reading_id AS VARCHAR) AS event_id FROM singles"},
        f"SELECT event_id, {stamp('ts', 'timestamp')}, facility_name, "
        + CHANGES_OUT.format(order="ts, worst, event_id", source="ordered"),
    ),
)
def _stream_status_changes(spark, sf):
    path = _finished(spark, a.event_stream(spark, sf), sinks.status_stream)
    return spark.read.parquet(f"{path}/changes").drop("batch_id")


BATCHES = {
    **o.singles(),
    "dealt": """SELECT *, CAST(reading_id AS VARCHAR) AS event_id, reading_id % 3 AS batch
        FROM singles""",
    "taken0": "SELECT * FROM dealt WHERE batch = 0",
    "reached0": "SELECT facility_name, max(ts) AS reached FROM taken0 GROUP BY 1",
    "taken1": """SELECT d.* FROM dealt d LEFT JOIN reached0 r USING (facility_name)
        WHERE batch = 1 AND (reached IS NULL OR ts >= reached)""",
    "reached1": """SELECT facility_name, max(ts) AS reached
        FROM (SELECT * FROM taken0 UNION ALL SELECT * FROM taken1) GROUP BY 1""",
    "taken2": """SELECT d.* FROM dealt d LEFT JOIN reached1 r USING (facility_name)
        WHERE batch = 2 AND (reached IS NULL OR ts >= reached)""",
    "taken": """SELECT * FROM taken0 UNION ALL SELECT * FROM taken1 UNION ALL
        SELECT * FROM taken2""",
}


@register(
    "stream_late_status",
    sql(
        BATCHES,
        f"""SELECT * FROM (SELECT event_id, facility_name, status, 'change' AS kind FROM (
            SELECT *, lag(status) OVER (PARTITION BY facility_name ORDER BY ts, worst, event_id)
                AS previous FROM taken) WHERE status IS DISTINCT FROM previous
        UNION ALL SELECT event_id, facility_name, status, 'late' FROM dealt
        WHERE event_id NOT IN (SELECT event_id FROM taken))""",
    ),
)
def _stream_late_status(spark, sf):
    """Later batches hold older events: they change nothing and are kept apart."""
    path = _finished(spark, a.event_stream(spark, sf, in_order=False), sinks.status_stream)
    changes = spark.read.parquet(f"{path}/changes")
    late = spark.read.parquet(f"{path}/late").select(
        "event_id", F.col("facility.name").alias("facility_name"), "operational_metrics.status"
    )
    changed = changes.select("event_id", "facility_name", "status", F.lit("change").alias("kind"))
    return changed.unionByName(late.withColumn("kind", F.lit("late")))


SILENCE = timedelta(hours=2)
FRONTIER = f"date_trunc('hour', {WATERMARK})"


@register(
    "stream_state_changes",
    sql(
        {
            **o.singles(),
            "ready": f"SELECT *, CAST(reading_id AS VARCHAR) AS event_id FROM singles WHERE ts < {FRONTIER}",
            "followed": """
                SELECT *, lag(ts) OVER w AS before, lag(status) OVER w AS last_status, lead(ts) OVER w AS after
                FROM ready WINDOW w AS (PARTITION BY facility_name ORDER BY ts, worst, event_id)""",
            "begun": """
                SELECT *, CASE WHEN before + INTERVAL 2 HOUR > ts THEN last_status END AS previous_status
                FROM followed""",
        },
        f"""SELECT {stamp('ts', 'timestamp')}, facility_name, event_id, previous_status, status, 'change' AS kind
        FROM begun WHERE status IS DISTINCT FROM previous_status
        UNION ALL SELECT {stamp('ts + INTERVAL 2 HOUR', 'timestamp')}, facility_name, NULL, status, NULL, 'silent'
        FROM followed WHERE ts + INTERVAL 2 HOUR <= coalesce(after, {FRONTIER})""",
    ),
)
def _stream_state_changes(spark, sf):
    """Keyed state over several batches: every change once, and facilities silent for two hours."""
    changes = state.status_states(a.event_stream(spark, sf), timedelta(hours=1), SILENCE)
    with state.keyed_state(spark):
        path = _finished(spark, changes)
    return spark.read.parquet(path)


# Of the parts by id the last one is compared with the newest time of the first: Spark drops a row that the watermark
# of the batch before had passed.
LATE_AFTER = "INTERVAL 12 DAY"


@register(
    "stream_accounts",
    sql(
        {
            "dealt": "SELECT ts, event_id % 3 AS batch FROM events",
            "judged": f"""
                SELECT *, batch = 2 AND ts < (SELECT max(ts) FROM dealt WHERE batch = 0) - {LATE_AFTER} AS is_late
                FROM dealt""",
            "ends": f"SELECT max(ts) FILTER (NOT is_late) - {LATE_AFTER} AS watermark FROM judged",
        },
        f"""SELECT {big('2 * count(*)', 'sent')}, {big('count(*) FILTER (NOT is_late)', 'passed')},
        {big('2 * count(*) FILTER (is_late)', 'late')}, {big('count(*) FILTER (NOT is_late)', 'repeated')}, TRUE AS balanced,
        {big("count(*) FILTER (NOT is_late AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= watermark)", 'delivered')}
        FROM judged, ends GROUP BY ALL""",
    ),
)
def _stream_accounts(spark, sf):
    """Every event sent twice, most of the last part late: what was sent is what was let through, dropped
    as late and dropped as repeated; what was let through and whose hour is over is delivered."""
    sent = a.event_stream(spark, sf, in_order=False)
    sent = ledger.counted(sent.union(a.event_stream(spark, sf, in_order=False)), "sent")
    once = ledger.counted(monitor.deduplicate(sent, "12 days"), "passed")
    hours = once.groupBy(F.window("timestamp", "1 hour")).agg(F.count("*").alias("events"))
    folder = fresh_folder(spark, "accounts")
    with ledger.listening(spark) as book:
        book.settle(sinks.append_stream(hours.select("window", "events"), f"{folder}/result", f"{folder}/checkpoint"))
        totals = book.totals(spark)
    delivered = spark.read.parquet(f"{folder}/result").agg(F.coalesce(F.sum("events"), F.lit(0)))
    return totals.drop("query_id").withColumn("delivered", delivered.scalar())


@register(
    "stream_deduplicated",
    sql(
        o.singles(),
        "SELECT CAST(reading_id AS VARCHAR) AS event_id, facility_name, status FROM singles",
    ),
)
def _stream_deduplicated(spark, sf):
    """The stream sent twice: every event is kept once."""
    events = a.event_stream(spark, sf)
    once = monitor.deduplicate(events.union(a.event_stream(spark, sf)))
    flat = once.select(
        "event_id", F.col("facility.name").alias("facility_name"), "operational_metrics.status"
    )
    return spark.read.parquet(_finished(spark, flat))


@register(
    "stream_zones",
    sql(
        o.readings(),
        f"""SELECT CAST(reading_id AS VARCHAR) AS event_id, facility_name, sensor_type,
        {R('value')} AS value, status FROM readings""",
    ),
)
def _stream_zones(spark, sf):
    """JSON messages through raw and cleaned to the curated zone."""
    root = fresh_folder(spark, "zones")
    events = a.event_stream(spark, sf)
    message = F.to_json(F.struct("event_id", "timestamp", "facility", "sensors", "operational_metrics"))
    sinks.zone_stream(events.select(message.alias("value")), root).awaitTermination()
    curated = spark.read.parquet(tables.zone(root, "curated") + "/sensor_events")
    return curated.select("event_id", "facility_name", "sensor_type", "value", "status")


# --- model -----------------------------------------------------------------------------------------


TRAINED = {
    **o.training(),
    "sizes": """SELECT burnout_risk_label AS class, count(*) AS n,
        CAST(round(count(*) * 0.2::DOUBLE) AS BIGINT) AS test_rows FROM labelled GROUP BY 1""",
}


@register(
    "train_and_score",
    sql(
        TRAINED,
        "SELECT class, test_rows, test_rows AS distinct_keys, 1::BIGINT AS sums_to_one, "
        "1::BIGINT AS beats_largest_class, 1::BIGINT AS same_after_load FROM sizes "
        "WHERE test_rows > 0",
    ),
)
def _train_and_score(spark, sf):
    """Fit the forest on four fifths of the labelled rows and score the rest, before and after
    saving: rows and keys per class, and what must hold of the scores."""
    balanced = labels.rebalance_labels(kept(labels.label_rows(_training(spark, sf))))
    split = kept(labels.stratified_split(kept(balanced)))
    model = train_classifier(split.where("is_test = 0"))
    test = split.where("is_test = 1")
    scored = kept(model.score(test).select("date_id", "agent_id", labels.LABEL, "risk_category", "probability"))
    path = fresh_folder(spark, "model")
    model.save(path)
    again = load_model(spark, path).score(test).select(
        "date_id", "agent_id", F.col("probability").alias("_again")
    )
    right = scored.agg(F.avg((F.col("risk_category") == F.col(labels.LABEL)).cast("int"))).scalar()
    largest = scored.groupBy(labels.LABEL).count().agg(F.max("count")).scalar()
    total = F.aggregate("probability", F.lit(0.0), lambda x, y: x + y)
    return (
        scored.join(again, ["date_id", "agent_id"])
        .groupBy(F.col(labels.LABEL).alias("class"))
        .agg(
            F.count("*").alias("test_rows"),
            F.countDistinct("date_id", "agent_id").alias("distinct_keys"),
            F.min((F.abs(total - 1) < 1e-9).cast("int")).alias("sums_to_one"),
            F.min((F.col("probability") == F.col("_again")).cast("int")).alias("same_after_load"),
        )
        .withColumn("beats_largest_class", (right > largest / scored.count()).cast("int"))
    )


@register(
    "train_boosted",
    sql(
        TRAINED,
        "SELECT class, test_rows, 1::BIGINT AS sums_to_one, 1::BIGINT AS beats_largest_class, 1::BIGINT AS same_after_load "
        "FROM sizes WHERE test_rows > 0",
    ),
)
def _train_boosted(spark, sf):
    """The boosted kind, one model per class: fitted, saved, loaded and scored like the forest."""
    balanced = labels.rebalance_labels(kept(labels.label_rows(_training(spark, sf))))
    split = kept(labels.stratified_split(kept(balanced)))
    model = train_classifier(split.where("is_test = 0"), kind="boosted", rounds=4, depth=3)
    test = split.where("is_test = 1")
    scored = kept(model.score(test).select("date_id", "agent_id", labels.LABEL, "risk_category", "probability"))
    path = fresh_folder(spark, "model")
    model.save(path)
    again = load_model(spark, path).score(test).select("date_id", "agent_id", F.col("probability").alias("_again"))
    right = scored.agg(F.avg((F.col("risk_category") == F.col(labels.LABEL)).cast("int"))).scalar()
    largest = scored.groupBy(labels.LABEL).count().agg(F.max("count")).scalar()
    total = F.aggregate("probability", F.lit(0.0), lambda x, y: x + y)
    return (
        scored.join(again, ["date_id", "agent_id"])
        .groupBy(F.col(labels.LABEL).alias("class"))
        .agg(
            F.count("*").alias("test_rows"),
            F.min((F.abs(total - 1) < 1e-9).cast("int")).alias("sums_to_one"),
            F.min((F.col("probability") == F.col("_again")).cast("int")).alias("same_after_load"),
        )
        .withColumn("beats_largest_class", (right > largest / scored.count()).cast("int"))
    )


# --- jobs over stored tables -----------------------------------------------------------------------

LOAD_DAYS = 3


@register(
    "daily_load_tables",
    sql(
        {
            **o.tickets(days=LOAD_DAYS, gaps=True),
            **o.usage(LOAD_DAYS),
            **o.NETWORK,
            "places": """
                SELECT district, facility_id, row_number() OVER (PARTITION BY district ORDER BY facility_id) - 1 AS number,
                       count(*) OVER (PARTITION BY district) AS size FROM facilities""",
            "sizes": "SELECT DISTINCT district, size FROM places",
            "placed": """
                SELECT t.*, coalesce(p.facility_id, f.facility_id) AS place FROM tickets t
                JOIN customers c USING (customer_id) LEFT JOIN sizes s ON s.district = c.district
                LEFT JOIN places p ON p.district = c.district AND p.number = t.ticket_id % s.size
                LEFT JOIN facilities f ON s.size IS NULL AND f.facility_id = t.ticket_id % (SELECT count(*) FROM facilities) + 1""",
            "billed": """
                SELECT b.*, coalesce(p.facility_id, f.facility_id) AS place FROM bills b
                JOIN customers c USING (customer_id) LEFT JOIN sizes s ON s.district = c.district
                LEFT JOIN places p ON p.district = c.district AND p.number = b.billing_id % s.size
                LEFT JOIN facilities f ON s.size IS NULL AND f.facility_id = b.billing_id % (SELECT count(*) FROM facilities) + 1""",
        },
        f"""SELECT 'fact_tickets' AS name, {day('date_id')}, {big('count(*)', 'n')},
            {big('count(*)', 'ids')}, {R('sum(resolution_time_hrs)', 3)} AS amount,
            {big('sum(place)', 'places')}, 1::BIGINT AS same_ids
        FROM placed WHERE resolved_in_first_contact = 1 GROUP BY date_id
        UNION ALL SELECT 'fact_backlog', {day('date_id')}, count(*), max(n), NULL, sum(place), 1
        FROM (SELECT *, row_number() OVER (PARTITION BY date_id) AS n FROM placed
              WHERE resolved_in_first_contact IS DISTINCT FROM 1) GROUP BY date_id
        UNION ALL SELECT 'fact_agent_performance', {day('date_id')}, sum(n), count(*), NULL, NULL, 1
        FROM (SELECT date_id, agent_id, count(*) AS n FROM tickets GROUP BY ALL) GROUP BY date_id
        UNION ALL SELECT 'fact_billing', {day('date_id')}, count(*), count(DISTINCT billing_id),
            {R('sum(CAST(billed_amount AS DECIMAL(18,2)))', 2)}, sum(place * (billing_id % 1000)), 1 FROM billed GROUP BY date_id""",
    ),
)
def _daily_load_tables(spark, sf):
    """All order lines as the contacts and bills of three days, loaded by the job, the first day once
    more: every ticket and bill is stored once with a facility of its customer's district, backlog ids
    are dense, and a reload keeps all ids."""
    root = fresh_folder(spark, "warehouse")
    tables.append_table(a.agents(spark, sf, gaps=True), root, "dim_agent")
    tables.append_table(a.customers(spark, sf), root, "dim_customer")
    tables.append_table(a.facilities(spark), root, "dim_facility")
    with a.joined_lines(spark, sf):
        raw = a.raw_tickets(spark, sf, LOAD_DAYS, customers=True, gaps=True).drop("facility_id")
        contacts = raw.withColumnRenamed("ticket_id", "contact_id")
        bills = a.usage(spark, sf, LOAD_DAYS).drop("customer_segment", "tariff_category", "facility_id")
    days = [a.FIRST_DAY + timedelta(days=n) for n in range(LOAD_DAYS)]

    def load(when):
        own, used = (df.where(F.col("date_id") == F.lit(when)).drop("date_id") for df in (contacts, bills))
        jobs.daily_load(spark, root, when, own, used)

    def tickets_of(name):
        return tables.read_table(spark, root, name).select("date_id", "ticket_id")

    for when in days:
        load(when)
    before = kept(tickets_of("fact_tickets").unionByName(tickets_of("fact_backlog")))
    load(days[0])
    after = tickets_of("fact_tickets").unionByName(tickets_of("fact_backlog"))
    moved = before.join(after, ["date_id", "ticket_id"], "full_outer").groupBy("date_id").agg(
        F.count("*").alias("_all")
    )
    same = moved.join(before.groupBy("date_id").agg(F.count("*").alias("_before")), "date_id").select(
        "date_id", (F.col("_all") == F.col("_before")).cast("int").alias("same_ids")
    )
    none = F.lit(None)

    def different(name, key):
        """Counted apart: beside other sums each of the keys would carry them through the shuffle."""
        return tables.read_table(spark, root, name).select("date_id", key).distinct().groupBy("date_id").agg(F.count(key).alias("ids"))

    solved = tables.read_table(spark, root, "fact_tickets").groupBy("date_id").agg(
        F.count("*").alias("n"),
        F.round(F.sum("resolution_time_hrs"), 3).alias("amount"), F.sum("facility_id").alias("places"),
    ).join(different("fact_tickets", "ticket_id"), "date_id").select("date_id", "n", "ids", "amount", "places")
    number = F.col("backlog_id") % jobs.DAY_IDS
    opened = tables.read_table(spark, root, "fact_backlog").groupBy("date_id").agg(
        F.count("*").alias("n"), F.when(F.min(number) == 1, F.max(number)).alias("ids"),
        none.cast("double").alias("amount"), F.sum("facility_id").alias("places"),
    )
    perf = tables.read_table(spark, root, jobs.PERFORMANCE)
    worked = perf.where("total_tickets_handled > 0").groupBy("date_id").agg(
        F.sum("total_tickets_handled").alias("n"), F.countDistinct("performance_id").alias("ids"),
        none.cast("double").alias("amount"), none.cast("long").alias("places"),
    )
    billed = tables.read_table(spark, root, "fact_billing").groupBy("date_id").agg(
        F.count("*").alias("n"),
        F.round(F.sum(F.col("billed_amount").cast("decimal(18,2)")).cast("double"), 2).alias("amount"),
        F.sum(F.col("facility_id") * (F.col("billing_id") % 1000)).alias("places"),
    ).join(different("fact_billing", "billing_id"), "date_id").select("date_id", "n", "ids", "amount", "places")
    named = {"fact_tickets": solved, "fact_backlog": opened, jobs.PERFORMANCE: worked, "fact_billing": billed}
    parts = [df.withColumn("name", F.lit(name)) for name, df in named.items()]
    return reduce(lambda one, other: one.unionByName(other), parts).join(same, "date_id")


PREDICTED_OUT = (
    f"{KEYS_OUT}, {R('burnout_risk_score')} AS burnout_risk_score, "
    f"{R('productivity_index')} AS productivity_index, risk_category, "
    f"{big('workload_reduction_pct', 'workload_reduction_pct')}, recommended_action, "
    f"'v1.0_forest' AS model_version"
)
PREDICTED = [
    "prediction_id", "date_id", "agent_id", "burnout_risk_score", "productivity_index",
    "risk_category", "workload_reduction_pct", "recommended_action", "model_version",
]


@register(
    "predict_daily_records",
    sql(
        o.forced(),
        f"""SELECT {big('row_number() OVER (ORDER BY agent_id)', 'prediction_id')}, {PREDICTED_OUT}
        FROM final WHERE date_id = (SELECT max(date_id) FROM perf)""",
    ),
)
def _predict_daily_records(spark, sf):
    """The daily job over a stored performance table, run twice: the day is stored once."""
    root = fresh_folder(spark, "warehouse")
    tables.append_table(a.varied_performance(spark, sf), root, jobs.PERFORMANCE)
    for _ in range(2):
        jobs.predict_daily(spark, root, a.GivenProbabilities())
    return tables.read_table(spark, root, jobs.PREDICTIONS).select(*PREDICTED)


@register(
    "backfill_stored",
    sql(
        {
            **HISTORY,
            "candidates": """
                SELECT DISTINCT date_id FROM perf
                WHERE date_id >= (SELECT min(date_id) FROM perf) + INTERVAL 30 DAY""",
            "lowered": """
                SELECT * REPLACE (CASE WHEN risk_category = 'Critical' AND day(date_id) % 2 = 0
                    THEN 'High' ELSE risk_category END AS risk_category) FROM rated""",
        },
        f"""SELECT {big('agent_id', 'prediction_id')}, {KEYS_OUT},
        {R('confidence_score')} AS burnout_risk_score, 0.75::DOUBLE AS productivity_index,
        risk_category, {big(FLAT, 'workload_reduction_pct')},
        {o.HISTORY_ACTION} AS recommended_action, 'v1.0_forest' AS model_version FROM lowered""",
    ),
)
def _backfill_stored(spark, sf):
    """The backfill job over a stored performance table, run twice: nothing is stored twice."""
    root = fresh_folder(spark, "warehouse")
    tables.append_table(_gappy(spark, sf), root, jobs.PERFORMANCE)
    for _ in range(2):
        jobs.backfill_predictions(spark, root, a.GivenProbabilities())
    return tables.read_table(spark, root, jobs.PREDICTIONS).select(*PREDICTED)


EXPORTED_AGENTS = f"{big('agent_id', 'agent_id')}, agent_name, {big('department_id', 'department_id')}, role_title, {day('hire_date')}"


def _exported(spark, sf, name):
    """One output of the export job over stored tables, written as CSV and read back."""
    root = fresh_folder(spark, "warehouse")
    tables.append_table(a.varied_performance(spark, sf), root, jobs.PERFORMANCE)
    tables.append_table(a.tickets(spark, sf, customers=True), root, "fact_tickets")
    tables.load_if_empty(a.agents(spark, sf), root, "dim_agent")
    tables.load_if_empty(a.agents(spark, sf), root, "dim_agent")
    extract = jobs.export_training_data(spark, root, f"{root}/export", as_csv=True)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in getattr(extract, name).schema.fields)
    return tables.read_csv(spark, f"{root}/export/{name}", ddl)


@register(
    "exported_metrics",
    sql(
        {**o.tickets(), **o.TICKET_METRICS},
        f"SELECT {KEYS_OUT}, {METRICS_OUT} FROM metrics",
    ),
)
def _exported_metrics(spark, sf):
    """Ticket metrics of the training range."""
    return _exported(spark, sf, "tickets")


@register(
    "exported_performance",
    sql(o.performance(), f"SELECT {KEYS_OUT}, {big('department_id', 'department_id')}, {PERF_OUT} FROM perf"),
)
def _exported_performance(spark, sf):
    """Agent days of the training range."""
    return _exported(spark, sf, "performance")


@register("exported_agents", sql(o.AGENTS, f"SELECT {EXPORTED_AGENTS} FROM agents"))
def _exported_agents(spark, sf):
    """Agent metadata beside the training range."""
    return _exported(spark, sf, "agents")


@register(
    "stored_defaults",
    """SELECT s_suppkey AS measure_id, s_name AS measure_name, round(s_acctbal, 6) AS measure_value,
       CAST(current_date AS VARCHAR) AS measure_date, '' AS customer_segment FROM supplier""",
)
def _stored_defaults(spark, sf):
    """Rows stored without a date and a segment: today and the empty text take their place."""
    root = fresh_folder(spark, "warehouse")
    given = a.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("measure_id"), F.col("s_name").alias("measure_name"), F.col("s_acctbal").alias("measure_value"),
        F.lit(None).cast("string").alias("customer_segment"),
    )
    tables.append_table(given, root, "meas_billing")
    return tables.read_table(spark, root, "meas_billing")


# --- file skipping ---------------------------------------------------------------------------------

SKIPPED = {
    "issue_category": ({"issue_category": "Leakage"}, {}, "issue_category = 'Leakage'"),
    "resolution_time_hrs": ({}, {"resolution_time_hrs": (7.2, 7.4)}, "resolution_time_hrs BETWEEN 7.2::DOUBLE AND 7.4::DOUBLE"),
    "ticket_id": ({"ticket_id": 9}, {}, "ticket_id = 9"),
    "customer_id": ({"customer_id": 41}, {}, "customer_id = 41"),
}


@register(
    "skipped_files",
    sql(
        {**o.tickets(), "placed": "SELECT * FROM tickets"},
        " UNION ALL ".join(
            f"SELECT '{name}' AS predicate, {big('count(*)', 'n')}, {big('coalesce(sum(ticket_id), 0)', 'ids')}, 1::BIGINT AS fewer "
            f"FROM placed WHERE {condition}"
            for name, (_, _, condition) in SKIPPED.items()
        ),
    ),
)
def _skipped_files(spark, sf):
    """Tickets stored by category and customer, read by predicates: the rows are whole, the files fewer."""
    root = fresh_folder(spark, "warehouse")
    rows = kept(a.tickets(spark, sf, customers=True))
    # One load per category and a few more by customer, so that files differ in what they hold.
    for category in a.CATEGORIES:
        tables.append_table(rows.where(F.col("issue_category") == category), root, "fact_tickets")
    skipping.index_files(spark, root, "fact_tickets")
    every = len(skipping.current_files(spark, root, "fact_tickets"))
    parts = []
    for name, (equals, between, _) in SKIPPED.items():
        files = len(skipping.candidate_files(spark, root, "fact_tickets", equals, between))
        found = skipping.read_where(spark, root, "fact_tickets", equals, between)
        parts.append(
            found.agg(F.count("*").alias("n"), F.coalesce(F.sum("ticket_id"), F.lit(0)).alias("ids")).select(
                F.lit(name).alias("predicate"), "n", "ids", F.lit(int(files < every)).alias("fewer")
            )
        )
    return reduce(lambda one, other: one.unionByName(other), parts)
