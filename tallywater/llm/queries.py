"""The registered queries of the text operators and, where SQL can say it, their twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from tallywater.llm import (
    conversation_trie, decontamination, embeddings, jaccard, line_dedup, mixing, pii, runs, token_counts, toxicity, url_model,
    vector_search, warc,
)
from tallywater.llm import oracles as sql_twins
from tallywater.llm.shared import CASED_SEPARATORS, source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Fixed values of the URL contract: verdict, host, path.
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def tokenizer_path(name: str) -> str:
    """The place of a public vocabulary file on the driver; its tables travel with the tasks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


@register
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole document: base spans, and what the trees add."""
    found = pii.find_personal_data(source(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [pii.count_of(F.col("base"), name).alias(f"n_{name}") for name in pii.KINDS]
    return found.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(pii.joined_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.joined_spans(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


@register
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside a window of ten words of a benchmark item."""
    docs = source(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontamination.judge(docs, source(spark, sf_dir, "benchmark"))
    # Counted without lower-casing: A to Z are letters of a word here.
    parts = F.split(F.coalesce("text", F.lit("")), CASED_SEPARATORS)
    n_words = F.size(parts) - (parts[0] == "").cast("int") - ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")
    n_hit = F.coalesce(F.col("hit.n_hit"), F.lit(0)).cast("long")
    return judged.select(
        "doc_id", n_words.cast("long").alias("n_words"), n_hit.alias("n_hit"),
        F.coalesce(F.size("hit.items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("hit.items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@register
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back as a capture."""
    captures = warc.archived(source(spark, sf_dir, "pages"))
    return captures.select(
        "page_id", "response.payload_bytes", "response.payload_digest", F.col("response.type").alias("record_type"), "refers_to"
    )


@register
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every URL judged by the rules, else by the ratio of the two character models."""
    judged = url_model.judge_urls(source(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict", F.round("judged.score", 9).alias("score"))


@register
def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 5, 2, 1 of their sources, at most three copies each."""
    mixed = mixing.mix(source(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id", "mix.size", "mix.source_size", F.round("mix.target", 6).alias("target"), (F.col("mix.size") * F.col("mix.copies")).alias("taken")
    )


@register
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a factorization machine learned outside the held-out fifth."""
    docs = source(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.train(docs, source(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, machine)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


@register
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate class and its links at a similarity of 0.8 or more."""
    found = jaccard.group_documents(source(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), "class_id", "n_links", "copy_of", (F.col("id") == F.col("class_id")).alias("kept")
    )


@register
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document for the 32k piece vocabulary."""
    docs = source(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, tokenizer_path("piece_bpe_32k.model"))
    return counted.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.col("tokens").alias("n_tokens"), (F.col("tokens") > 4096).alias("over_limit"),
    )


@register
def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors of a label at a cosine of 0.93 or more."""
    return embeddings.near_vectors(source(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


@register
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left in every document, without those that equal or nearly equal an earlier line."""
    kept = line_dedup.dedup_lines(source(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", "lines.n_lines", "lines.n_dropped", F.length("lines.text").cast("long").alias("chars_left"),
        F.sha2(F.col("lines.text").cast("binary"), 256).alias("text_sha256"),
    )


@register
def op11_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vector whose id is divisible by 20."""
    vectors = source(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = vector_search.build_index(vectors, k=20)
    return vector_search.search(index, vectors.where("vec_id % 20 = 0"), k=20)


@register
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all conversations, rebuilt with shared openings."""
    turns = conversation_trie.sequences(source(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(conversation_trie.with_shared_openings(turns))


@register
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document, the longest one, and the text with one period of each."""
    docs = source(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.find_runs(docs, prepare=runs.with_periodic_tail).select("doc_id", "runs.runs", "runs.collapsed")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    # Longest first, then by start and period.
    by_length = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("short"), r["start"].alias("start"), r["period"].alias("period"))))
    longest = F.get(by_length, F.lit(0))
    return found.withColumn("_longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_longest.start").alias("start"), (-F.col("_longest.short")).alias("length"),
        F.col("_longest.period").alias("period"), F.expr("(-1000 * _longest.short) div _longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Query]:
    return {**QUERIES, "pipeline": corpus_pipeline.run}


def oracles() -> dict[str, str]:
    """The SQL twins there are; the other queries are tested against brute force."""
    twins = sql_twins.oracles(URL_RULES)
    return twins | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
