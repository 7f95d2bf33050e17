"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tallywater.llm import decontamination, embeddings, graph, jaccard, line_dedup, mixing, pii, token_counts, toxicity, url_model, warc
from tallywater.llm.queries import URL_RULES, tokenizer_path
from tallywater.llm.shared import ascii_lower, document_key, unused

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today\nshort\nThe quick brown fox jumps over the lazy dog", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today\nshort\nThe quick brown fix jumps over the lazy dog", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today\nshort\nThe quick brown fix jumps over the lazy dog", "a"),
    (3, None, None), (4, "", "b"), (5, "   \n\n \t", "b"), (6, "Ünïcödé ÉCOLE straße 中文 😀 é", None), (None, "a text without an id", "a"),
    (7, LONG, "c"), (8, LONG + " tail", "c"), (9, "one", ""),
]
CLASHING = ["key", "row", "mix", "lines", "hit", "toxicity", "tokens", "copy", "_text", "_key", "_u", "_size", "doc", "group", "n", "id", "label"]
SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(TEXTS, SCHEMA)
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def own(rows):
    return all(r[c] == f"own {c}" for r in rows for c in CLASHING)


def test_lower_case_is_ascii_only(spark):
    df = spark.createDataFrame([("AbÉ",), ("ABC",), (None,)], "t string").select(ascii_lower(F.col("t")))
    assert [r[0] for r in df.collect()] == ["abÉ", "abc", None]


def test_unused_names_ignore_case(spark):
    assert unused(spark.createDataFrame([(1, 2)], "MIX int, _mix int"), "mix") == "__mix"


def test_personal_data(docs, none):
    text = "mail a.b@c.org or call +1 (555) 010-9999, card 4111 1111 1111 1111; 10.0.0.1 not 10.0.0.999"
    more = docs.select("doc_id", "text").union(docs.sparkSession.createDataFrame([(20, text), (21, text)], "doc_id long, text string"))
    found = {r["id"]: r for r in pii.find_personal_data(more).collect()}
    assert [(pii.KINDS[k], text[s:e]) for k, s, e in sorted(found[20]["base"])] == [
        ("email", "a.b@c.org"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 010-9999"),
    ]
    assert found[3]["spans"] == found[4]["spans"] == [] and len(found) == 12
    assert pii.find_personal_data(none).count() == 0
    assert {r["text"] for r in pii.redacted(more.where("doc_id >= 20")).collect()} == {
        "mail [email] or call [phone], card [card]; [ip] not 10.0.0.999"
    }


def test_base_spans_follow_the_patterns():
    import re

    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    rnd = random.Random(4)
    parts = ["a", "Z", "9", "12", "255", "300", "@", "@", ".", ".", "-", "+", "_", " ", "(", ")", "é", "x@y.z", "4111111111111111", "4111 1111 1111 1111", "+1 (555) 555-1234", "1.2.3.4"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        want = []
        for k, p in enumerate(patterns):
            for m in re.finditer(p, text):
                d = pii.digits_of(m[0])
                if k == 1 and max(map(int, m[0].split("."))) > 255 or k == 2 and not (16 <= len(d) <= 19 and pii.luhn(d)) or k == 3 and not 8 <= len(d) <= 15:
                    continue
                want.append((k, m.start(), m.end()))
        assert pii.base_spans(text) == want


def test_trees_add_the_cards_of_a_longer_chain(spark):
    def card(rnd, good):
        digits = "4" + "".join(rnd.choice("0123456789") for _ in range(14))
        last = next(d for d in "0123456789" if pii.luhn(digits + d))
        return digits + (last if good else str((int(last) + 1) % 10))

    rnd = random.Random(1)
    rows = [(i, f"text {card(rnd, i % 2 == 0)} and more") for i in range(200)]
    two = f"{card(rnd, True)} {card(rnd, True)}"
    df = spark.createDataFrame([*rows, (999, two)], "doc_id long, text string")
    found = {r["id"]: r for r in pii.find_personal_data(df).collect()}
    assert found[999]["base"] == [] and [(s, e) for _, s, e in sorted(found[999]["spans"])] == [(0, 16), (17, 33)]
    assert found[1]["spans"] == [] and len(found[0]["spans"]) == 1


def test_trees_choose_among_look_alikes_of_every_kind(spark):
    """Loose forms of personal data are added, look-alikes are not; each kind by its own threshold."""
    rnd = random.Random(7)

    def digits(n, first="23456789"):
        return rnd.choice(first) + "".join(rnd.choice("0123456789") for _ in range(n - 1))

    def card():
        some = digits(15)
        return some + next(d for d in "0123456789" if pii.luhn(some + d))

    def word():
        return "".join(rnd.choice("abcdefghilmnorstu") for _ in range(rnd.randint(4, 8)))

    rows = []
    for i in range(400):
        kind = [f"{word()}.{word()}@{word()}.org", f"10.{rnd.randrange(256)}.{rnd.randrange(256)}.7", card(), f"+1 ({digits(3)}) {digits(3)}-{digits(4)}"][i % 4]
        rows.append((i, f"{word()} {word()} {kind} {word()}"))
    good = [f"{word()} {word()} (at) {word()}.org and", f"call ({digits(3)}) {digits(3)}-{digits(4)} now", f"number {card()} {digits(4)} here"]
    bad = [f"{word()} {word()} (at) {word()} and", "on 2024-01-30 we", "chapter 1.2.3.4.5 says", "amount 12.345.678 paid", f"serial {'12' * 9}7 here"]
    df = spark.createDataFrame(rows + [(1000 + i, t) for i, t in enumerate(good)] + [(2000 + i, t) for i, t in enumerate(bad)], "doc_id long, text string")
    found = {r["id"]: r for r in pii.find_personal_data(df).collect()}
    added = {i: [s for s in r["spans"] if s not in r["base"]] for i, r in found.items()}
    assert [len(added[1000 + i]) for i in range(len(good))] == [1, 1, 1]
    assert [added[2000 + i] for i in range(len(bad))] == [[]] * len(bad)
    assert [s["kind"] for i in range(len(good)) for s in added[1000 + i]] == [0, 3, 2]
    assert sum(len(added[i]) for i in range(400)) <= 4


@pytest.fixture(scope="module")
def bench(spark):
    items = [(1, "quick brown fox jumps over the lazy dog near the RIVER"), (2, "ÉCOLE straße"), (3, None), (4, ""), (5, "never seen at all"), (2, "ÉCOLE straße")]
    return spark.createDataFrame(items, "item_id long, text string")


def test_decontamination(docs, none, bench):
    rows = decontamination.judge(docs, bench).collect()
    hits = [(r["doc_id"], r["_hit"] and (r["_hit"]["n_hit"], r["_hit"]["items"])) for r in rows]
    assert sorted((x for x in hits if x[1]), key=str) == [(1, (11, ["1"])), (2, (11, ["1"])), (2, (11, ["1"])), (6, (2, ["2"]))]
    assert len(rows) == len(TEXTS) and own(rows)
    assert decontamination.judge(none, bench).count() == 0
    assert decontamination.judge(docs, bench.where("false")).where("_hit IS NOT NULL").count() == 0


def test_index_of_all_terms_and_proximity(docs, bench):
    read = docs.where("doc_id = 1").select("doc_id", "text")
    index = decontamination.build_index(read, "doc_id", "text")
    assert index.count() == 24
    item = decontamination.tokens(docs.sparkSession.createDataFrame([("x", "fox quick lazy")], "item string, text string"), "item", "text")
    item = item.select("item", "position", F.xxhash64("term").alias("term_id"))
    spans = {(r["start"], r["stop"]) for r in decontamination.near_matches(index, item, 7).collect()}
    assert spans == {(1, 8), (16, 23)}
    assert decontamination.near_matches(index, item, 6).count() == 0


def test_archive(spark):
    header = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    html = [(1, "http://a/", None), (2, "http://a/", ""), (3, None, "x" * 300_000), (9, "u\r\nv", "x" * 300_000), (4, "http://b?q", header), (5, "http://c", "é\r\n\r\n"), (7, "", "é\r\n\r\n"), (7, "", "é\r\n\r\n")]
    pages = spark.createDataFrame(html, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    got = warc.archived(pages, payloads=True).collect()
    texts = {r["page_id"]: bytes(r["response"]["payload"]).decode() for r in got if r["response"]["type"] == "response"}
    assert texts == {1: "", 3: "x" * 300_000, 4: header, 5: "é\r\n\r\n"}
    assert sorted((r["page_id"], r["refers_to"]) for r in got if r["response"]["type"] == "revisit") == [(2, 1), (7, 5), (7, 5), (9, 3)]
    assert all(len(r["requests"]) >= 1 and len(r["metadata"]) >= 1 for r in got)
    assert {r["page_id"]: r["response"]["payload_bytes"] for r in got}[9] == 300_000
    assert warc.archived(pages.where("false")).count() == 0
    plain = warc.archived(pages, least=5).where("response.type = 'revisit'").select("page_id").collect()
    assert sorted(r[0] for r in plain) == [7, 7, 9]


def test_url_filter(spark):
    urls = [(i, f"http://shop{i % 7}.example.org/item/{i}") for i in range(60)] + [(100 + i, f"https://casino.example.com/de/win{i}?x={i}") for i in range(60)]
    urls += [(200, None), (201, ""), (202, "no scheme"), (203, "HTTP://UP.Example.ORG"), (204, "http://x.net/casino/win99"), (205, "http://x.net/item/5"), (205, "http://x.net/item/5")]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumns({"host": F.lit("h"), "score": F.lit(1), "gram": F.lit("g")})
    rows = url_model.judge_urls(pages, URL_RULES).collect()
    got = {r["page_id"]: r["judged"] for r in rows}
    assert len(rows) == len(urls) and all(r["host"] == "h" for r in rows)
    assert (got[200]["host"], got[200]["path"], got[202]["host"]) == ("", "", "")
    assert (got[203]["host"], got[203]["path"], got[203]["rule"]) == ("up.example.org", "", None)
    assert got[204]["verdict"] == "block" and got[205]["verdict"] == "allow" and got[204]["score"] < got[205]["score"]
    assert url_model.judge_urls(pages.where("false"), URL_RULES).count() == 0
    assert {r["judged"]["verdict"] for r in url_model.judge_urls(pages, []).collect()} == {"allow"}


def test_url_model_is_witten_bell(spark):
    """Scores against a plain recursion over counts."""
    import hashlib
    import math
    from collections import Counter

    urls = [(f"http://a{i}.b/{i * 7 % 11}", i % 2) for i in range(60)] + [("http://zz.q/~", None)]
    scores, _ = url_model.score_urls(spark.createDataFrame(urls, "url string, label int"), order=2)
    counts = [Counter(), Counter()]
    for url, label in urls:
        if label is not None and int(hashlib.md5(url.encode()).hexdigest()[:8], 16) % 5:
            text = url_model.START * 2 + url + url_model.END
            for i in range(2, len(text)):
                for k in range(3):
                    counts[label][text[i - k : i + 1]] += 1

    def probability(c, context, char):
        p = 1 / url_model.ALPHABET
        for k in range(len(context) + 1):
            tail = context[len(context) - k :]
            seen = {g: n for g, n in c.items() if len(g) == k + 1 and g[:k] == tail}
            if seen:
                p = (seen.get(tail + char, 0) + len(seen) * p) / (sum(seen.values()) + len(seen))
        return p

    for r in scores.collect():
        text = url_model.START * 2 + r["url"] + url_model.END
        want = sum(math.log(probability(counts[1], text[i - 2 : i], text[i]) / probability(counts[0], text[i - 2 : i], text[i])) for i in range(2, len(text)))
        assert math.isclose(r["score"], want / (len(text) - 2), rel_tol=1e-9, abs_tol=1e-12)


def test_mix(docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(TEXTS) and own(rows)
    sizes = {r["doc_id"]: r["_mix"]["size"] for r in rows}
    assert sizes[3] == sizes[4] == sizes[5] == 0 and sizes[7] == 30_000
    assert all(0 <= r["_mix"]["copies"] <= 3 for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    assert mixing.mix(none).count() == 0
    assert own(mixing.materialised(docs).collect())


def test_many_rows_without_ids_meet_their_target(spark):
    """Each draws its own number by its text; a text that reads like an id is not that id."""
    rows = [(None, f"w{i} " + "w " * 24, "a") for i in range(500)] + [(i, "v " * 25, "b") for i in range(500)]
    mixed = mixing.mix(spark.createDataFrame(rows, SCHEMA)).groupBy("source").agg(
        F.max("mix.target").alias("t"), F.sum(F.col("mix.size") * F.col("mix.copies")).alias("n"), F.max("mix.size").alias("longest")
    ).collect()
    assert all(abs(r["n"] - r["t"]) <= r["longest"] for r in mixed)
    ids = spark.createDataFrame([(None, "5"), ("5", None), ("5", "x")], "i string, t string")
    u = [r[0] for r in ids.select(mixing.uniform(F.col("i"), F.col("t"), 0)).collect()]
    assert u[0] != u[1] == u[2]


def test_sizes_count_words(spark):
    texts = [None, "", "  \t\n", "a", " a b\x0bc ", "w w\u00a0w é\u3000ü", "\x0c\r x", "\x1c\x1f", "a" * 5000]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.size_of(F.col("t"))).collect()
    assert [r[0] for r in got] == [0, 0, 0, 1, 3, 3, 1, 1, 1]


def test_mix_is_near_its_targets_at_any_inclusion(spark):
    rnd = random.Random(5)
    rows = [(i, "w " * min(2000, int(rnd.paretovariate(1.2) * 10)), rnd.choice("aabcdefg")) for i in range(4000)]
    mixed = mixing.mix(spark.createDataFrame(rows, SCHEMA)).groupBy("source").agg(
        F.max("mix.target").alias("t"), F.sum(F.col("mix.size") * F.col("mix.copies")).alias("n"), F.max("mix.size").alias("longest"),
        F.countDistinct("mix.copies").alias("kinds"),
    ).collect()
    assert all(abs(r["n"] - r["t"]) <= r["longest"] for r in mixed) and max(r["kinds"] for r in mixed) > 1


def test_toxicity(spark, docs, none):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(["sun", "tree", "house", "river", "stone"]) for _ in range(20)) + (" nasty vermin" if i % 4 == 0 else ""), "a") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (5, None), (7, 0)], "doc_id long, toxic int")
    machine = toxicity.train(df, labels)
    scored = toxicity.score(df, machine).collect()
    assert all((r["toxicity"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in scored)
    rows = toxicity.score(docs, machine).collect()
    assert len(rows) == len(TEXTS) and own(rows) and all(0 <= r["_toxicity"] <= 1 for r in rows)
    assert toxicity.score(none, machine).count() == 0
    assert toxicity.score(df, toxicity.train(df, labels.where("false"))).agg(F.max("toxicity")).first()[0] < 1e-6
    assert toxicity.score(df, toxicity.train(none, labels)).count() == 400


def test_toxic_pairs_count_more_than_their_parts(spark):
    """An insult beside a group's name is toxic, either alone is not: no additive weights say that."""
    rows, labels = [], []
    for i in range(800):
        insult, group = i % 2, i // 2 % 2
        rows.append((i, "plain words here" + " scum" * insult + " foreigners" * group, "a"))
        labels.append((i, insult * group))
    df, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = toxicity.score(df, toxicity.train(df, labels)).collect()
    assert all((r["toxicity"] >= 0.5) == (r["doc_id"] % 4 == 3) for r in scored)


def test_the_fit_agrees_with_the_one_of_spark(spark):
    """The same rows and values through Spark's factorization machine: nearly the same scores."""
    from pyspark.ml.classification import FMClassifier
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(8)
    value = rng.uniform(0.1, 1, 12)
    rows = [np.flatnonzero(rng.random(12) < 0.4) for _ in range(600)]
    label = np.array([float((0 in r and 1 in r) or 2 in r) for r in rows])
    intercept, linear, factors = toxicity.fit(label, np.repeat(np.arange(600), [len(r) for r in rows]), np.concatenate(rows), value)
    machine = toxicity.Machine(np.arange(12), intercept, linear * value, factors * value[:, None])
    vectors = spark.createDataFrame([(y, Vectors.sparse(12, r, value[r])) for y, r in zip(label.tolist(), rows)], ["label", "features"])
    model = FMClassifier(
        factorSize=toxicity.FACTORS, maxIter=toxicity.ROUNDS, stepSize=toxicity.STEP, regParam=toxicity.DECAY, initStd=toxicity.SPREAD, seed=7, solver="adamW"
    ).fit(vectors.coalesce(1))
    theirs = [r[0] for r in model.transform(vectors.coalesce(1)).select(vector_to_array("probability")[1]).collect()]

    def score(r):
        v = machine.factors[r]
        return 1 / (1 + np.exp(-(intercept + machine.linear[r].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum()))))

    ours = np.array([score(r) for r in rows])
    assert np.abs(ours - theirs).mean() < 0.02 and ((ours >= 0.5) == (np.array(theirs) >= 0.5)).mean() > 0.98
    assert ((ours >= 0.5) == label).mean() > 0.98
    # Their own parameters give their scores by our rule.
    machine = toxicity.Machine(np.arange(12), model.intercept, model.linear.toArray() * value, model.factors.toArray() * value[:, None])
    intercept = model.intercept
    assert np.abs([score(r) for r in rows] - np.array(theirs)).max() < 1e-9


def test_the_training_rows_are_bounded_by_their_terms(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(10)), "a") for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    some = toxicity.training_rows(df, labels, 30, 100, "doc_id", "text").collect()
    assert 0 < sum(len(r["terms"]) for r in some) <= 100
    every = toxicity.training_rows(df, labels, 30, 10**6, "doc_id", "text").collect()
    assert len(every) == 30 and {r["digest"] for r in some} == set(sorted(r["digest"] for r in every)[: len(some)])


def test_a_neutral_partner_among_many_terms_counts(spark):
    """A group's name is in a half of the toxic rows and of the others; only beside "scum" it tells."""
    rnd = random.Random(4)
    cases = ["scum foreigners", "vermin", "foreigners", "foreigners", "foreigners", "scum", "", ""]
    fillers = [f"f{rnd.randrange(10**6)}" for _ in range(4000)]
    # Every tenth text is long: chance terms by the thousand, ahead of a neutral one in any ranking.
    rows = [(i, " ".join([cases[i // 5 % 8], *rnd.sample(fillers, 120 if i % 10 == 3 else 0)]), "a") for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i // 5 % 8 < 2)) for i in range(2000)], "doc_id long, toxic int")
    machine = toxicity.train(df, labels)
    assert len(machine.linear) > 4000
    scored = toxicity.score(df.where("doc_id % 10 <> 3 AND text LIKE '%scum%'"), machine).collect()
    assert scored and all((r["toxicity"] >= 0.5) == ("foreigners" in r["text"]) for r in scored)


def test_jaccard_groups(docs, none):
    rows = jaccard.group_documents(docs.select("doc_id", "text", "key")).collect()
    got = {r["id"]: (r["class_id"], r["n_links"]) for r in rows}
    assert len(rows) == len(TEXTS)
    assert got[2] == (2, 1) and got[7] == (7, 1) and got[8] == (7, 1)
    assert got[3] == (3, 0) and got[4] == (4, 0) and got[5] == (5, 0) and got[None] == (None, 0)
    kept = jaccard.one_per_group(docs).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == sorted("1 2 3 4 5 6 7 9 None".split()) and own(kept)
    assert jaccard.group_documents(none).count() == 0 and jaccard.one_per_group(none).count() == 0


def test_jaccard_finds_every_link_of_a_large_group(spark):
    """Near copies of one text in blocks and deeper levels, against plain sets."""
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(160)]
    texts = []
    for i in range(700):
        w = list(base)
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(160)] = f"v{rnd.randrange(500)}"
        texts.append((i, " ".join(w)))
    got = {r["id"]: r["n_links"] for r in jaccard.group_documents(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    sets = [{tuple(t.split()[i : i + 5]) for i in range(156)} for _, t in texts]
    want = {i: sum(j != i and len(a & b) >= 0.8 * len(a | b) - 1e-9 for j, b in enumerate(sets)) for i, a in enumerate(sets)}
    assert got == want


def test_jaccard_splits_equal_nodes_apart(spark):
    """One-word variants of a long text share nearly all tokens: a single draw per level loses this group whole."""
    word = lambda i: F.when(i == F.col("doc_id") * 60, "changed").otherwise(F.concat(F.lit("w3x"), i))
    texts = spark.range(300).select(F.col("id").alias("doc_id")).withColumn("text", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(19_999)), word), " "))
    got = {(r["class_id"], r["n_links"]) for r in jaccard.group_documents(texts).collect()}
    assert got == {(0, 299)}


def test_runs_follow_the_recall():
    assert jaccard.runs_for(0.9, 1) < jaccard.runs_for(0.999, 1) < jaccard.runs_for(0.999, 3)


@pytest.fixture(scope="module")
def counter():
    path = tokenizer_path("piece_bpe_32k.model")
    return token_counts.Counter(token_counts.Merges.of_model(path)), sentencepiece.SentencePieceProcessor(model_file=path)


def test_token_counts_of_every_prefix(counter):
    own_, library = counter
    rnd = random.Random(1)
    parts = ["a", "b", "e", "the", "ing", " ", "  ", "\n", "\t", "é", "ß", "中文", "😀", "​", "▁", "1", "00", "--", "    ", "tion", "<s>", "Ab", "\x00", "́"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(400)]
    for text in [*texts, "ab" * 60, " " * 77, " " * 40 + "x", "=-" * 90]:
        want = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        assert token_counts.prefix_counts(own_, text).tolist() == want
        assert token_counts.totals(own_, {}, set(), [text]) == want[-1:]


def test_token_count_columns(docs, none, counter):
    _, library = counter
    path = tokenizer_path("piece_bpe_32k.model")
    rows = token_counts.count_tokens(docs, path).collect()
    assert [r["_tokens"] for r in rows] == [len(library.encode(r["text"] or "")) for r in rows] and own(rows)
    assert token_counts.count_tokens(none, path).count() == 0
    table = token_counts.prefix_table(docs.where("doc_id < 7 OR doc_id IS NULL"), path)
    for r in token_counts.within_budget(table, 10).join(docs.select("doc_id", "text").distinct(), F.col("id") == F.col("doc_id")).collect():
        text = r["text"] or ""
        counts = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        best = max(i for i, n in enumerate(counts) if n <= 10)
        assert (r["code_points"], r["tokens"]) == (best, counts[best])
        assert token_counts.longest_within(np.array(counts), 10) == best


def brute_links(rows, cosine):
    links, least = {}, {}
    usable = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    neighbours = {i: [] for i in range(len(rows))}
    for i in usable:
        for j in usable:
            a, b = np.array(rows[i][1]), np.array(rows[j][1])
            if i != j and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                neighbours[i].append(j)
    for i in range(len(rows)):
        seen, stack = {i}, [i]
        while stack:
            for j in neighbours[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        links[rows[i][0]], least[rows[i][0]] = len(neighbours[i]), min(rows[j][0] for j in seen)
    return {k: (links[k], least[k]) for k in links}


def test_near_vectors(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 6))
    rows = [(i, (centres[i % 12] + rng.normal(size=6) * rng.choice([0.05, 0.4])).tolist(), i % 2) for i in range(400)]
    rows += [(1000, None, 0), (1001, [0.0] * 6, 0), (1002, [1.0, None] + [0.0] * 4, 0), (1003, [float("nan")] * 6, 0), (1004, [float("inf")] * 6, 0)]
    rows += [(1005, rows[0][1], None), (1006, rows[0][1], 0), (1007, rows[0][1], 0), (1008, [2 * x for x in rows[0][1]], 0), (1009, [1.0, 2.0], 0), (1010, [1.0, 2.0], 0), (1011, [], 0)]
    rows += [(1012, [x * 1e200 for x in rows[0][1]], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"cell": F.lit("c"), "rep": F.lit("r")})
    want = brute_links(rows[:-1], 0.93)
    for sizes in ({}, {"cell": 20, "block": 15, "probes": 40}):
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_vectors(df.where("vec_id < 1012"), **sizes).collect()}
        assert got == want
    huge = {r["vec_id"]: r["n_links"] for r in embeddings.near_vectors(df).collect()}
    assert huge[1012] == want[0][0] + 1
    assert embeddings.near_vectors(df.where("false")).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (5, 5), (7, 8), (8, 7)]
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}


def test_line_dedup(docs, none):
    rows = line_dedup.dedup_lines(docs).collect()
    got = {(r["doc_id"], r["text"]): r["_lines"] for r in rows}
    first, second = (got[i, TEXTS[i - 1][1]] for i in (1, 2))
    assert (first["n_lines"], first["n_dropped"]) == (3, 0)
    assert (second["n_dropped"], second["text"]) == (2, "short")  # an equal line, and one an edit away
    assert got[3, None]["text"] is None and got[3, None]["n_lines"] == 0 and got[4, ""]["n_lines"] == 1
    assert len(rows) == len(TEXTS) and own(rows)
    assert got[8, LONG + " tail"]["n_dropped"] == 0 and line_dedup.dedup_lines(none).count() == 0


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_line_pairs(spark, edits):
    """The join and the bit-parallel distance against Spark's own function on all pairs."""
    rnd = random.Random(edits)
    lines = set()
    while len(lines) < 150:
        line = [rnd.choice("abcé") for _ in range(rnd.randint(8, 30))]
        for _ in range(3):
            lines.add("".join(line))
            for _ in range(rnd.randint(1, 3)):
                line[rnd.randrange(len(line))] = rnd.choice(["", "x", "yy"])
            line = list("".join(line)) or ["a"]
    rows = [(n, line, len(line)) for n, line in enumerate(sorted(lines)) if len(line) >= 4]
    df = spark.createDataFrame(rows, "place long, line string, chars int").select(
        "*", F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(1)).alias("h2")
    )
    got = {(r["earlier"]["place"], r["later"]["place"]) for r in line_dedup.close_pairs(df, edits, 4).collect()}
    both = df.alias("x").join(df.alias("y"), F.col("x.place") < F.col("y.place")).where(F.levenshtein("x.line", "y.line") <= edits)
    want = {(r[0], r[1]) for r in both.select("x.place", "y.place").collect()}
    assert got == want and want


# Documents that a careless key would take for one another.
ODD = [(None, "123"), ("123", None), ("123", ""), ("", "123"), (None, ""), ("", None), (None, None), ("12", "3"), ("1", "23")]


def test_document_keys_stay_apart(spark):
    rows = spark.createDataFrame(ODD, "i string, t string").select(document_key(F.col("i"), F.col("t")).alias("k"))
    keys = {bytes(r[0]) for r in rows.collect()}
    assert len(keys) == len(ODD) and all(len(k) == 16 for k in keys)


def test_a_null_id_beside_an_id_that_reads_like_its_text(spark):
    """(null, "123") and ("123", null) are two documents for every operator that keys them."""
    text = "123 " + " ".join(f"w{i}" for i in range(12))
    df = spark.createDataFrame([(None, "123"), (123, None), (None, text), (5, text)], "doc_id long, text string")
    links = {(r["id"], r["n_links"], r["class_id"]) for r in jaccard.group_documents(df).collect()}
    assert (123, 0, 123) in links and (5, 1, 5) in links
    bench = spark.createDataFrame([("x", "123")], "item_id string, text string")
    hits = sorted((r["doc_id"] or 0, r["hit"] is not None) for r in decontamination.judge(df, bench).collect())
    assert hits == [(0, True), (0, True), (5, True), (123, False)]
    lines = [(r["doc_id"], r["text"], r["lines"]["n_lines"]) for r in line_dedup.dedup_lines(df).collect()]
    assert sorted(n for i, t, n in lines if t is None) == [0] and sorted(n for i, t, n in lines if t is not None) == [1, 1, 1]
    found = pii.find_personal_data(spark.createDataFrame([(None, "a@b.cd"), ("a@b.cd", None)], "doc_id string, text string")).collect()
    assert sorted(len(r["base"]) for r in found) == [0, 1]


def test_items_without_an_id_are_sought_too(spark):
    docs = spark.createDataFrame([(1, "x alpha beta gamma delta y"), (2, "alpha beta")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "alpha beta gamma delta"), (None, "alpha beta gamma delta"), ("i", "beta gamma")], "item_id string, text string")
    got = {r["doc_id"]: r["hit"] for r in decontamination.judge(docs, bench).collect()}
    assert got[2] is None and got[1]["n_hit"] == 4 and got[1]["items"] == ["i"]
    only = decontamination.judge(docs, bench.where("item_id IS NULL")).where("doc_id = 1").first()["hit"]
    assert only["n_hit"] == 4 and only["items"] == []


def test_lines_of_documents_without_whole_numbers_as_ids(spark):
    line = "a line of more than twenty characters"
    for ids in ([None, None, None], ["b", "a", "c"], ["7", None, "x"], [3, 3, 3]):
        kind = "long" if isinstance(ids[0], int) else "string"
        df = spark.createDataFrame([(i, f"own {n}\n{line}") for n, i in enumerate(ids)], f"doc_id {kind}, text string")
        rows = line_dedup.dedup_lines(df).collect()
        assert sorted(r["lines"]["n_dropped"] for r in rows) == [0, 1, 1], ids
    assert [r["lines"]["n_dropped"] for r in rows if r["doc_id"] == "7"] == []
    first = line_dedup.dedup_lines(spark.createDataFrame([("x", line), ("7", line)], "doc_id string, text string"))
    assert {r["doc_id"]: r["lines"]["n_dropped"] for r in first.collect()} == {"x": 1, "7": 0}
    assert jaccard.group_documents(spark.createDataFrame([("x", line), ("y", line)], "doc_id string, text string")).count() == 2


def test_exact_copies_of_short_lines(spark):
    texts = ["yes\n\nno\na line of more than twenty characters", "yes\nnow\n\nyes\na line of more than twenty charakters", "no"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["lines"]["text"] for r in line_dedup.dedup_lines(df, exact_from=1).collect()}
    assert got == {0: texts[0], 1: "now\n", 2: ""}
    longer = {r["doc_id"]: r["lines"]["text"] for r in line_dedup.dedup_lines(df, exact_from=3).collect()}
    assert longer == {0: texts[0], 1: "now\n", 2: "no"}


def test_every_known_span_is_learned_from(spark):
    """More examples than any sample held: all of them count, and the threshold is of the whole held-out fifth."""
    rows = spark.range(30_000).select(
        F.col("id").cast("string").cast("binary").alias("key"), F.lit(3).alias("kind"), F.lit(0).alias("s"), F.lit(9).alias("e"),
        (F.col("id") % 2 == 0).alias("base"), (F.col("id") % 2 == 0).cast("int").alias("truth"),
        F.array(F.pmod("id", F.lit(2)).cast("double"), F.pmod("id", F.lit(7)).cast("double")).alias("x"),
    )
    got = pii.examples(rows).groupBy("label").agg(F.sum("weight").alias("n"), F.count("*").alias("distinct")).collect()
    assert {r["label"]: r["n"] for r in got} == {0.0: 15_000, 1.0: 15_000}
    assert all(r["distinct"] == 14 for r in got)
    open_ = rows.limit(4).withColumns({"truth": F.lit(None).cast("int"), "s": F.lit(20), "e": F.lit(29), "base": F.lit(False)})
    accepted = pii.accepted(rows.unionByName(open_)).count()
    assert accepted == open_.where("x[0] = 0").count()
