"""Tables and jobs: defaults, repeat runs, backfill against daily prediction, model files."""

import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallywater.operators import model as models, scoring
from tallywater.plans import jobs
from tallywater.schemas import TABLES
from tallywater.sources import tables

FIRST = date(2025, 1, 1)
DAYS = 45


def agents_frame(spark, n=14):
    roles = ("Agent", "Senior Agent", "Team Lead", "Supervisor")
    rows = [(i, f"A{i}", 4 + i % 2, roles[i % 4], date(2022, 1, 1) + timedelta(days=40 * i)) for i in range(1, n + 1)]
    return spark.createDataFrame(
        rows, "agent_id long, agent_name string, department_id long, role_title string, hire_date date"
    )


def contacts(spark, day, n=60):
    rng = random.Random(day.toordinal())
    rows = []
    for i in range(n):
        solved = int(rng.random() < 0.6)
        rows.append(
            (
                day.toordinal() * 1000 + i, rng.randint(1, 14), rng.randint(1, 30), rng.randint(1, 7),
                rng.choice(["Leakage", "Water Quality", "Tour Booking"]), rng.choice(["Phone", "Letter"]),
                round(rng.uniform(0.5, 8), 2), rng.randint(1, 15), solved,
                int(not solved and rng.random() < 0.3), int(rng.random() < 0.8), rng.randint(1, 30), 4.0,
            )
        )
    return spark.createDataFrame(
        rows,
        "contact_id long, agent_id long, customer_id long, facility_id long, issue_category string, "
        "issue_channel string, base_time_hrs double, base_response_mins int, "
        "resolved_in_first_contact int, reopened int, sla_compliance int, days_in_backlog int, "
        "low_effort double",
    )


def usage(spark, n=10):
    rows = [(i, i + 1, 1, 10.0 + i, 1.0, 0.1, "Paid", 3, "reliable", "Cash") for i in range(n)]
    return spark.createDataFrame(
        rows,
        "billing_id long, customer_id long, facility_id long, base_consumption double, "
        "customer_factor double, discount double, payment_status string, days_late int, "
        "payer_class string, payment_method string",
    )


def customers(spark):
    rows = [(i, f"ACC-{i}", f"C{i}", "District 1", "Domestic") for i in range(1, 31)]
    return spark.createDataFrame(
        rows,
        "customer_id long, account_no string, customer_name string, district string, "
        "tariff_category string",
    )


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """Dimensions, two loaded days, and a longer performance history written at once."""
    root = str(tmp_path_factory.mktemp("warehouse"))
    tables.append_table(agents_frame(spark), root, "dim_agent")
    tables.append_table(customers(spark), root, "dim_customer")
    return root


def history(spark):
    rng = random.Random(11)
    rows = []
    for d in range(DAYS):
        for a in range(1, 15):
            load = rng.choice([0.45, 0.6, 0.7, 0.8, 0.97])
            rows.append(
                (
                    0, FIRST + timedelta(days=d), a, 4, rng.randint(0, 12), round(rng.uniform(50, 250), 1),
                    rng.choice([0.0, 0.05, 0.1, 0.15, 0.3]), rng.randint(0, 14), rng.randint(0, 2), load,
                    rng.randint(0, 5), 80.0,
                )
            )
    names = TABLES["fact_agent_performance"].schema
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("history"))
    tables.append_table(agents_frame(spark), root, "dim_agent")
    tables.append_table(history(spark), root, "fact_agent_performance")
    path = root + "/model"
    _, report = jobs.train(spark, root, path, rounds=5, depth=3)
    assert {"accuracy", "macro avg", "weighted avg"} <= {r["class"] for r in report.collect()}
    return root, path


def test_conform_fills_defaults_and_rejects_gaps(spark):
    row = spark.createDataFrame([(1, "acc", "n", "d", "t", None)], TABLES["dim_customer"].ddl)
    spec = TABLES["dim_customer"]
    assert tables.conform(row, spec).first()["customer_segment"] == "Residential"
    short = tables.conform(row.drop("customer_segment"), spec)
    assert short.first()["customer_segment"] == "Residential"
    measure = spark.createDataFrame([(1, "n", 2.0)], "measure_id long, measure_name string, measure_value double")
    dated = tables.conform(measure, TABLES["meas_executive_summary"])
    assert dated.select(F.col("measure_date") == F.current_date()).first()[0]
    with pytest.raises(ValueError, match="district"):
        tables.conform(row.drop("district"), spec)


def test_all_tables_declared():
    assert len(TABLES) == 19
    for spec in TABLES.values():
        assert set(spec.sort) | set(spec.defaults) <= {
            c.strip().split()[0] for c in spec.ddl.replace("decimal(18,4)", "decimal").split(",")
        }


def test_load_if_empty_and_unseen_rows(spark, tmp_path):
    root = str(tmp_path)
    frame = spark.createDataFrame([(1, "Billing", "m", 3)], TABLES["dim_department"].ddl)
    assert tables.read_table(spark, root, "dim_department").isEmpty()
    assert tables.load_if_empty(frame, root, "dim_department")
    assert not tables.load_if_empty(frame, root, "dim_department")
    more = frame.union(spark.createDataFrame([(2, "Engineering", "m", 3)], frame.schema))
    stored = tables.read_table(spark, root, "dim_department")
    assert [r[0] for r in tables.unseen_rows(more, stored, ["department_id"]).collect()] == [2]
    assert tables.last_key(stored, "department_id").first()[0] == 1
    assert tables.last_key(stored.limit(0), "department_id").first()[0] == 0


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "agents")
    frame = agents_frame(spark)
    tables.write_csv(frame, path)
    back = tables.read_csv(spark, path, "agent_id long, agent_name string, department_id long, role_title string, hire_date date")
    assert sorted(back.collect()) == sorted(frame.collect())


def test_zones():
    assert tables.zone("/data/", "raw") == "/data/raw"
    with pytest.raises(ValueError):
        tables.zone("/data", "gold")


def test_daily_load_is_repeatable(spark, warehouse):
    assert tables.next_date(tables.read_table(spark, warehouse, "fact_agent_performance")).first()[0] == FIRST
    for day in (FIRST, FIRST + timedelta(days=1)):
        totals = jobs.daily_load(spark, warehouse, day, contacts(spark, day), usage(spark)).first()
        assert totals["resolved"] + totals["backlog"] == 60
        assert (totals["agents"], totals["bills"]) == (14, 10)
    names = ("fact_tickets", "fact_backlog", "fact_agent_performance", "fact_billing", "dim_time")

    def contents():
        return {n: sorted(map(str, tables.read_table(spark, warehouse, n).collect())) for n in names}

    before = contents()
    day = FIRST + timedelta(days=1)
    jobs.daily_load(spark, warehouse, day, contacts(spark, day), usage(spark))
    assert contents() == before
    ids = [r[0] for n in ("fact_tickets", "fact_backlog") for r in tables.read_table(spark, warehouse, n).select("ticket_id").collect()]
    days = [FIRST, FIRST + timedelta(days=1)]
    assert sorted(ids) == [jobs.first_id(d) + n for d in days for n in range(1, 61)]
    backlog = tables.read_table(spark, warehouse, "fact_backlog")
    for d in days:
        own = sorted(r[0] for r in backlog.where(F.col("date_id") == F.lit(d)).select("backlog_id").collect())
        assert own == [jobs.first_id(d) + n for n in range(1, len(own) + 1)]
    assert backlog.where("customer_segment <> 'Residential'").count() == 0
    assert tables.next_date(tables.read_table(spark, warehouse, "dim_time")).first()[0] == FIRST + timedelta(days=2)
    jobs.daily_load(spark, warehouse, FIRST, contacts(spark, FIRST), usage(spark))
    assert contents() == before


def test_reload_without_rows_empties_the_day(spark, tmp_path):
    root = str(tmp_path)
    tables.append_table(agents_frame(spark), root, "dim_agent")
    tables.append_table(customers(spark), root, "dim_customer")
    jobs.daily_load(spark, root, FIRST, contacts(spark, FIRST), usage(spark))
    none = contacts(spark, FIRST).limit(0)
    totals = jobs.daily_load(spark, root, FIRST, none, usage(spark).limit(0)).first()
    assert tuple(totals)[1:] == (0, 0, 14, 0)


def test_measures_are_replaced(spark, warehouse):
    if tables.read_table(spark, warehouse, "fact_tickets").isEmpty():
        jobs.daily_load(spark, warehouse, FIRST, contacts(spark, FIRST), usage(spark))
    tables.load_if_empty(
        spark.createDataFrame([(4, "Customer Service", "m", 10), (5, "Billing", "m", 10)], TABLES["dim_department"].ddl),
        warehouse,
        "dim_department",
    )
    for _ in range(2):
        jobs.refresh_measures(spark, warehouse, date(2026, 1, 1))
    for name in [n for n in TABLES if n.startswith("meas_")]:
        rows = tables.read_table(spark, warehouse, name).orderBy("measure_id").collect()
        assert [r["measure_id"] for r in rows] == list(range(1, len(rows) + 1)), name
        assert rows, name
    overall = tables.read_table(spark, warehouse, "meas_csat_drilldown").where("department_id = 0")
    mean = tables.read_table(spark, warehouse, "fact_tickets").where(F.col("date_id") == F.lit(FIRST))
    want = round(mean.agg(F.avg("satisfaction_score")).first()[0], 4)
    first = overall.where(F.col("measure_date") == F.lit(FIRST)).first()
    assert float(first["measure_value"]) == pytest.approx(want, abs=1e-4)
    assert (first["department_name"], first["parent_kpi"]) == ("Overall", "Overall CSAT Score")


def test_export_writes_three_files(spark, warehouse, tmp_path):
    day = FIRST
    if tables.read_table(spark, warehouse, "fact_tickets").isEmpty():
        jobs.daily_load(spark, warehouse, day, contacts(spark, day), usage(spark))
    extract = jobs.export_training_data(spark, warehouse, str(tmp_path), as_csv=True)
    assert extract.agents.columns == ["agent_id", "agent_name", "department_id", "role_title", "hire_date"]
    assert spark.read.option("header", True).csv(str(tmp_path / "performance")).count() == extract.performance.count()
    assert (tmp_path / "tickets").exists()


def test_missing_model(spark, tmp_path):
    with pytest.raises(models.ModelNotFound, match="run the training job"):
        models.load_model(spark, str(tmp_path / "nothing"))
    with pytest.raises(models.ModelNotFound):
        jobs.predict_daily(spark, str(tmp_path), str(tmp_path / "nothing"))


def test_predict_without_data(spark, trained, tmp_path):
    with pytest.raises(tables.MissingTable):
        jobs.predict_daily(spark, str(tmp_path), trained[1])


def test_predict_then_backfill(spark, trained):
    root, path = trained
    day = FIRST + timedelta(days=DAYS - 1)
    first = jobs.predict_daily(spark, root, path).orderBy("agent_id").collect()
    assert {r["date_id"] for r in first} == {day}
    assert [r["prediction_id"] for r in first] == list(range(1, 15))
    assert all(0 <= r["burnout_risk_score"] <= 1 and 0 <= r["productivity_index"] <= 1 for r in first)
    assert {r["model_version"] for r in first} == {"v1.0_forest"}
    assert jobs.predict_daily(spark, root, path).count() == 14

    fitted = models.load_model(spark, path)
    perf = tables.read_table(spark, root, "fact_agent_performance")
    other = day - timedelta(days=3)
    done = perf.select("date_id").distinct().where(F.col("date_id") != F.lit(other))
    known = fitted.score(jobs.backfill_features(perf, done))
    full = jobs.daily_records(scoring.score_daily(known), fitted)
    backfilled = full.orderBy("agent_id").collect()
    scores = jobs.daily_scores(perf, fitted, other)
    direct = jobs.daily_records(scores, fitted).orderBy("agent_id").collect()
    assert len(direct) == 14
    for one, two in zip(backfilled, direct):
        assert one.asDict() == pytest.approx(two.asDict())

    stored = jobs.backfill_predictions(spark, root, path)
    dates = stored.select("date_id").distinct().count()
    assert dates == DAYS - 30
    history_rows = stored.where(F.col("date_id") < F.lit(day))
    assert history_rows.where("productivity_index <> 0.75 or prediction_id <> agent_id").isEmpty()
    assert history_rows.where("burnout_risk_score <> confidence_score").isEmpty()
    assert jobs.backfill_predictions(spark, root, path).count() == stored.count()
    with pytest.raises(ValueError):
        jobs.backfill_predictions(spark, root, path, "other")


def test_full_backfill_is_repeatable(spark, trained, tmp_path):
    root = str(tmp_path)
    tables.append_table(history(spark), root, "fact_agent_performance")
    stored = jobs.backfill_predictions(spark, root, trained[1], "full")
    assert stored.count() == 14 * (DAYS - 30)
    assert jobs.backfill_predictions(spark, root, trained[1], "full").count() == stored.count()
    per_day = stored.groupBy("date_id").agg(F.min("prediction_id"), F.max("prediction_id"))
    assert {(r[1], r[2]) for r in per_day.collect()} == {(1, 14)}


def test_few_agents_are_not_backfilled(spark, trained):
    perf = tables.read_table(spark, trained[0], "fact_agent_performance")
    none = perf.limit(0).select("date_id")
    assert jobs.backfill_features(perf.where("agent_id <= 9"), none).isEmpty()
    assert not jobs.backfill_features(perf.where("agent_id <= 10"), none).isEmpty()


def test_boosted_model_probabilities(spark, trained):
    root, _ = trained
    from tallywater.operators import features, labels

    extract = jobs.export_training_data(spark, root)
    frame = features.training_frame(extract.performance, extract.tickets, extract.agents)
    labelled = labels.label_rows(frame)
    fitted = models.train_classifier(labelled, kind="boosted", rounds=2, depth=2)
    row = fitted.score(labelled).select("probability", "risk_category").first()
    assert len(row[0]) == 4 and sum(row[0]) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        models.train_classifier(labelled, kind="linear")


def test_a_mistyped_root_raises(spark, tmp_path):
    root = str(tmp_path / "nowhere")
    with pytest.raises(tables.MissingTable, match="dim_agent"):
        jobs.daily_load(spark, root, FIRST, contacts(spark, FIRST), usage(spark))
    with pytest.raises(tables.MissingTable):
        jobs.export_training_data(spark, root)
    with pytest.raises(tables.MissingTable):
        jobs.measures(spark, root, FIRST)


def test_backfill_of_one_day_prunes_the_stored_table(spark, trained):
    root, _ = trained
    perf = tables.read_table(spark, root, "fact_agent_performance")
    done = perf.where(F.col("date_id") != F.lit(FIRST + timedelta(days=40))).select("date_id").distinct()
    known = jobs.backfill_features(perf, done)
    assert {r[0] for r in known.select("date_id").distinct().collect()} == {FIRST + timedelta(days=40)}
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*date_id[^]]*>= .*ubquery", plan)
