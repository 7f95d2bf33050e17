"""Training labels: rules, forced balance, split and class report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywater.functions import risk
from tallywater.functions.steps import flag, ratio
from tallywater.operators.joins import required_minus_present
from tallywater.operators.ranking import keys_at_shares, value_counts

LABEL = "burnout_risk_label"

# Forced shares of the labels below the top; the rest is Low.
FORCED_SHARES = (("Critical", 0.05), ("High", 0.12), ("Medium", 0.35))
TEST_SHARE = 0.2
SEED = 42

# Cells of the stress index in which rows are counted first.
STRESS_CELLS = 10_000


def label_rows(features: DataFrame) -> DataFrame:
    return features.withColumn(LABEL, risk.burnout_label())


def missing_labels(labelled: DataFrame) -> DataFrame:
    """Classes without a single row."""
    spark = labelled.sparkSession
    required = spark.createDataFrame([(name,) for name in risk.SEVERITY], f"{LABEL} string")
    return required_minus_present(required, labelled.select(LABEL))


def label_check(labelled: DataFrame) -> DataFrame:
    """One row: how many classes occur and whether all do."""
    found = labelled.agg(F.countDistinct(LABEL).alias("classes"))
    return found.withColumn("complete", F.col("classes") == len(risk.SEVERITY))


def label_distribution(labelled: DataFrame) -> DataFrame:
    return value_counts(labelled, LABEL).orderBy(LABEL)


def rebalance_labels(labelled: DataFrame, force: bool = False) -> DataFrame:
    """When a class is missing, relabel by stress: top 5% / 12% / 35% / rest.

    Ties on stress are broken by agent and date. Rows are only counted, by cell
    of the index first, to find the three cut rows; the wide rows are compared
    with those.
    """
    if not force and missing_labels(labelled).isEmpty():
        return labelled
    falling = (-F.col("stress_index")).alias("_falling")
    place = F.struct(falling, "agent_id", "date_id")
    cell = F.floor(falling * STRESS_CELLS).alias("_cell")
    cuts = keys_at_shares(
        labelled.select(cell, falling, "agent_id", "date_id"),
        [share for _, share in FORCED_SHARES],
    )
    chosen = F
    for (name, _), (_, stress, agent, day) in zip(FORCED_SHARES, cuts):
        bound = F.struct(
            F.lit(stress).alias("_falling"),
            F.lit(agent).cast("long").alias("agent_id"),
            F.lit(day).alias("date_id"),
        )
        chosen = chosen.when(place <= bound, F.lit(name))
    if len(cuts) < len(FORCED_SHARES):
        return labelled.withColumn(LABEL, chosen.otherwise(FORCED_SHARES[len(cuts)][0]))
    return labelled.withColumn(LABEL, chosen.otherwise("Low"))


def stratified_split(
    labelled: DataFrame,
    key: Sequence[str] = ("agent_id", "date_id"),
    share: float = TEST_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Add ``is_test``: exactly ``round(share * n)`` rows of each class, reproducibly.

    Rows are drawn in the order of a hash of their unique key. Counts per class
    and hash slice show in which slice the quota of a class runs out; only rows
    of that slice are sorted. Each class then has one cut (one row per class is
    broadcast), and the wide rows are compared with it without a shuffle.
    """
    draw = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed))))
    drawn = labelled.withColumn("_draw", draw)
    narrow = drawn.select(LABEL, "_draw", F.substring("_draw", 1, 4).alias("_slice"))
    slices = narrow.groupBy(LABEL, "_slice").agg(F.count("*").alias("_rows"))
    per_class = Window.partitionBy(LABEL)
    earlier = per_class.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    quota = F.round(F.sum("_rows").over(per_class) * share).cast("long")
    left = quota - F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    plan = slices.withColumn("_left", left).where("_left > 0")

    whole = plan.where("_left >= _rows").select(
        LABEL, F.concat("_slice", F.lit("g")).alias("_cut")
    )
    inside = Window.partitionBy(LABEL, "_slice").orderBy("_draw")
    split = plan.where("_left < _rows").select(LABEL, "_slice", "_left")
    partial = (
        narrow.join(F.broadcast(split), [LABEL, "_slice"])
        .withColumn("_place", F.row_number().over(inside))
        .where("_place = _left")
        .select(LABEL, F.col("_draw").alias("_cut"))
    )
    cuts = whole.unionByName(partial).groupBy(LABEL).agg(F.max("_cut").alias("_cut"))
    compared = drawn.join(F.broadcast(cuts), LABEL, "left")
    taken = flag(F.col("_draw") <= F.col("_cut"))
    return compared.withColumn("is_test", taken).drop("_draw", "_cut")


def confusion(scored: DataFrame, actual: str = LABEL, predicted: str = "risk_category"):
    return scored.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def accuracy(scored: DataFrame, actual: str = LABEL, predicted: str = "risk_category"):
    hits = F.count_if(F.col(actual) == F.col(predicted))
    return scored.agg(ratio(hits, F.count("*")).alias("accuracy"))


def class_report(
    scored: DataFrame, actual: str = LABEL, predicted: str = "risk_category"
) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted means."""
    cells = confusion(scored, actual, predicted)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    none, rows = F.lit(0), F.col("n")

    def side(name: str, support: Column, called: Column, hits: Column) -> DataFrame:
        return cells.select(
            F.col(name).alias("class"),
            support.alias("support"),
            called.alias("called"),
            hits.alias("hits"),
        )

    sides = side("actual", rows, none, hit).unionByName(side("predicted", none, rows, none))
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "called", "hits")])
    precision = ratio(F.col("hits"), F.col("called"))
    recall = ratio(F.col("hits"), F.col("support"))
    per_class = sums.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )

    def summary(name: str, measure) -> DataFrame:
        return per_class.agg(
            *[measure(F.col(c)).alias(c) for c in ("precision", "recall", "f1")],
            F.sum("support").alias("support"),
        ).select(F.lit(name).alias("class"), "precision", "recall", "f1", "support")

    def weighted(c: Column) -> Column:
        return F.sum(c * F.col("support")) / F.sum("support")

    def overall(_: Column) -> Column:
        return ratio(F.sum("hits"), F.sum("support"))

    report = per_class.select("class", "precision", "recall", "f1", "support")
    return (
        report.unionByName(summary("accuracy", overall))
        .unionByName(summary("macro avg", F.avg))
        .unionByName(summary("weighted avg", weighted))
    )
