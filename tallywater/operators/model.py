"""The burnout classifier on Spark ML: fit, score, save and load."""

from __future__ import annotations

import json
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywater.functions import risk
from tallywater.operators.labels import LABEL

# Feature order and training parameters.
FEATURES = (
    "utilization_rate",
    "avg_handle_time_mins",
    "escalation_rate",
    "backlog",
    "sla_breaches",
    "reopened_tickets",
    "total_tickets_handled",
    "avg_utilization_7d",
    "avg_utilization_30d",
    "avg_handle_time_7d",
    "avg_handle_time_30d",
    "avg_backlog_7d",
    "avg_backlog_30d",
    "utilization_trend",
    "escalation_trend",
    "stress_index",
    "performance_declining",
    "persistent_backlog",
    "workload_velocity",
    "tenure_months",
)
MAX_DEPTH = 5
ROUNDS = 100
LEARNING_RATE = 0.1
SEED = 42


class ModelNotFound(FileNotFoundError):
    """No trained model at the given path."""


@dataclass(frozen=True)
class RiskModel:
    """A fitted pipeline with the feature list and the kind of trees inside."""

    pipeline: PipelineModel
    kind: str
    features: tuple[str, ...] = FEATURES

    @property
    def version(self) -> str:
        return f"v1.0_{self.kind}"

    def score(self, features: DataFrame) -> DataFrame:
        """Add ``probability`` (array in code order) and ``risk_category``; extra columns stay."""
        ready = features.na.fill(0, subset=list(self.features))
        out = self.pipeline.transform(ready)
        if self.kind == "forest":
            probability = vector_to_array("_probability")
        else:
            one_by_one = [vector_to_array(f"_probability_{n}")[1] for n in range(len(risk.CODES))]
            total = sum(one_by_one[1:], one_by_one[0])
            probability = F.array(*[p / total for p in one_by_one])
        keep = [F.col(c) for c in ready.columns]
        scored = out.select(*keep, probability.alias("probability"))
        top = F.array_position("probability", F.array_max("probability")).cast("int") - 1
        return scored.withColumn("risk_category", risk.label_of_code(top))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        about = json.dumps({"kind": self.kind, "features": self.features})
        spark = SparkSession.active()
        spark.createDataFrame([(about,)], "value string").write.mode("overwrite").text(
            f"{path}/about"
        )


def load_model(spark: SparkSession, path: str) -> RiskModel:
    try:
        about = json.loads(spark.read.text(f"{path}/about").first()["value"])
        pipeline = PipelineModel.load(f"{path}/pipeline")
    except Exception as error:
        if _is_missing(error):
            raise ModelNotFound(f"no trained model at {path}; run the training job first") from error
        raise
    return RiskModel(pipeline, about["kind"], tuple(about["features"]))


def _is_missing(error: Exception) -> bool:
    condition = getattr(error, "getCondition", lambda: None)()
    text = str(error)
    return condition == "PATH_NOT_FOUND" or (
        isinstance(error, (Py4JJavaError, OSError)) and "does not exist" in text
    )


def train_classifier(
    labelled: DataFrame,
    kind: str = "forest",
    rounds: int = ROUNDS,
    depth: int = MAX_DEPTH,
    seed: int = SEED,
) -> RiskModel:
    """Fit four classes on the feature columns.

    ``forest`` is one multi-class random forest. ``boosted`` is one
    gradient-boosted binary model per class whose probabilities are normalised,
    closer to softmax boosting but ``4 * rounds`` trees fitted in sequence.
    """
    if kind not in ("forest", "boosted"):
        raise ValueError(f"unknown kind {kind!r}: forest or boosted")
    codes = range(len(risk.CODES))
    rows = labelled.na.fill(0, subset=list(FEATURES)).select(
        *FEATURES, risk.label_code(LABEL).cast("double").alias("_label")
    )
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    common = {"featuresCol": "_features", "maxDepth": depth, "seed": seed}
    if kind == "forest":
        stages = [
            RandomForestClassifier(
                labelCol="_label",
                numTrees=rounds,
                probabilityCol="_probability",
                rawPredictionCol="_raw",
                predictionCol="_prediction",
                **common,
            )
        ]
    else:
        rows = rows.withColumns(
            {f"_is_{n}": (F.col("_label") == n).cast("double") for n in codes}
        )
        stages = [
            GBTClassifier(
                labelCol=f"_is_{n}",
                maxIter=rounds,
                stepSize=LEARNING_RATE,
                predictionCol=f"_prediction_{n}",
                **common,
            )
            .setProbabilityCol(f"_probability_{n}")
            .setRawPredictionCol(f"_raw_{n}")
            for n in codes
        ]
    return RiskModel(Pipeline(stages=[assemble, *stages]).fit(rows), kind)
