"""The corpus pipeline: documents in, a training mix out, in five stages of the text operators.

Each stage takes all that its predecessor kept and returns the columns of documents; the last one
returns a row per copy of the mix, with the copy's number. Every stage's rows are written below
``spark.checkpoint.dir`` and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywater.llm import decontamination, jaccard, line_dedup, mixing, toxicity
from tallywater.llm.shared import source, stored, unused


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores 0.5 or more go."""
    machine = toxicity.train(docs, source(spark, sf_dir, "labels"))
    score = unused(docs, "toxicity")
    return toxicity.score(docs, machine).where(F.col(score) < 0.5).drop(score)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that equal or nearly equal an earlier line go, short ones if they equal it; the documents stay."""
    out = unused(docs, "lines")
    kept = line_dedup.dedup_lines(docs, exact_from=1)
    fresh = {"text": F.col(f"{out}.text"), "n_chars": F.length(f"{out}.text").cast("long")}
    return kept.select(*[fresh[c].alias(c) if c in fresh else F.col(f"`{c}`") for c in docs.columns])


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates stays."""
    return jaccard.one_per_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    hit = unused(docs, "hit")
    return decontamination.judge(docs, source(spark, sf_dir, "benchmark")).where(F.col(hit).isNull()).drop(hit)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources mixed to their target weights, a row per copy."""
    return mixing.materialised(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_similar),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
]

#: The first stage learns a model by a random start: there is no SQL for it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last one's rows are read where they are written."""
    docs = source(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-').lower()}")
    return docs
