"""The stages on odd rows and on planted cases."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"
FIRST = 1_000_000
STAGES = dict(corpus_pipeline.STAGES)


def prose(rnd, n=80):
    return " ".join(rnd.choice(["river", "stone", "cloud", "lamp", "paper", "wind"]) + str(rnd.randrange(400)) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark):
    """Clean prose, odd rows, and cases for every stage."""
    rnd = random.Random(6)
    rows = [(i, prose(rnd), "en", f"s{i % 4}") for i in range(40)]
    passage = prose(rnd, 60)
    rows += [(100 + i, f"{prose(rnd)}\n{passage}\n{prose(rnd)}", "en", "s0") for i in range(3)]
    near = rows[5][1].split()
    near[40] = "changed"
    rows += [(200, " ".join(near), "en", "s1"), (201, rows[6][1], "en", "s1")]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows += [(300, f"{prose(rnd)}\n{item}\n{prose(rnd)}", "en", "s2")]
    rows += [(400, None, None, None), (401, "", "en", "s3"), (None, prose(rnd), "en", "s3"), (402, "w " * 30_000, "en", "s3"), (401, "", "en", "s3")]
    # Ids above those of the labels.
    rows = [(None if i is None else i + FIRST, *rest) for i, *rest in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.withColumns({c: F.lit(1) for c in ("mix", "lines", "hit", "toxicity", "_key", "copy")})


def ids(df):
    return [r[0] if r[0] is None else r[0] - FIRST for r in df.select("doc_id").collect()]


@pytest.mark.parametrize("name", STAGES)
def test_columns_and_empty_input(spark, planted, name):
    out = STAGES[name](spark, planted, SF)
    last = name == corpus_pipeline.STAGES[-1][0]
    assert out.columns[: len(planted.columns)] == planted.columns and len(out.columns) == len(planted.columns) + last
    assert STAGES[name](spark, planted.where("false"), SF).count() == 0


def test_stages_catch_what_is_planted_and_keep_the_rest(spark, planted):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").select("doc_id")
    kept = STAGES["toxicity"](spark, given.unionByName(planted.select(*given.columns)), SF)
    assert kept.where(F.col("doc_id").isNull() | (F.col("doc_id") >= FIRST)).count() == planted.count()
    assert kept.join(toxic, "doc_id").count() <= 0.3 * toxic.count()
    lines = {r["doc_id"] - FIRST: r for r in STAGES["line dedup"](spark, planted, SF).collect() if r["doc_id"] is not None}
    assert [len(lines[100 + i]["text"].split("\n")) for i in range(3)] == [3, 2, 2]
    assert all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in lines.values())
    similar = ids(STAGES["n-gram Jaccard join"](spark, planted, SF))
    assert {200, 201} & set(similar) == set() and {5, 6, 400, 401, 402, None} <= set(similar)
    assert len(similar) == len(ids(planted)) - 2
    clean = ids(STAGES["benchmark decontamination"](spark, planted, SF))
    assert 300 not in clean and len(clean) == len(ids(planted)) - 1
    mix = STAGES["mixing sources to target weights"](spark, planted, SF)
    assert mix.groupBy("doc_id", "_copy").count().where("count > 1").count() == 0
    assert set(ids(mix)) <= set(ids(planted)) - {400, 401}
