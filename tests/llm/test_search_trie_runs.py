"""Vector search, the prefix trie and periodic runs: brute force, odd rows, many small shards."""

import hashlib
import math
import random
from collections import defaultdict
from zlib import crc32

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallywater.llm import conversation_trie, runs, vector_search

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"
TURNS = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Vector search


def nearest(rows, k):
    """The exact answer for every query among (id, vector)."""
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            scored = [(-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in rows if i != q and len(w) == len(v)]
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def recall(found, want):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(len(w) for w in want.values())


def answers(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return dict(out)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_search_query_finds_the_nearest(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"/root/testdata/{sf}/embeddings.parquet").to_pylist()]
    want = nearest(rows, 20)
    got = answers(entry.queries()["op11_vector_search"](spark, f"/root/testdata/{sf}"))
    assert set(got) == set(want) and all(len(got[q]) == len(w) for q, w in want.items())
    assert recall(got, want) >= 0.98
    known = dict(rows)
    for q, found in got.items():
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        assert all(abs(s - np.dot(np.float64(known[q]), np.float64(known[i]))) < 1e-12 for i, s in found)


def test_search_over_many_shards_chunks_and_lengths_of_vectors(spark):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(12, 16)) * rnd.uniform(0.2, 4, size=(12, 1))
    rows = [(i, (centres[i % 12] + rnd.normal(size=16) * 0.4).astype(np.float32).tolist(), 0) for i in range(1500)]
    rows += [(2000 + i, rnd.normal(size=5).astype(np.float32).tolist(), None) for i in range(60)]
    df = spark.createDataFrame(rows, VECTORS)
    index = vector_search.build_index(df, k=20, shard=200)
    assert index.groupBy("size").count().where("size = 16").first()["count"] >= 7
    want = nearest([(i, v) for i, v, _ in rows], 20)
    got = answers(vector_search.search(index, df.where("vec_id % 20 = 0"), k=20, chunk=20))
    assert set(got) == set(want) and recall(got, want) >= 0.95
    again = vector_search.build_index(df.repartition(3, "vec_id"), k=20, shard=200)
    assert answers(vector_search.search(again, df.where("vec_id % 20 = 0"), k=20)) == got


def test_search_on_odd_rows(spark):
    v = [1.0, 2.0, 0.5]
    rows = [(i, v, 1) for i in range(45)]  # copies: ties go to the smaller id
    rows += [(100, [2.0, 4.0, 1.0], 1), (100, [2.0, 4.0, 1.0], 1), (101, None, 1), (102, [], 1), (103, [0.0, 0.0, 0.0], 1)]
    rows += [(104, [1.0, None, 1.0], 1), (120, [float("nan"), 1.0, 1.0], 1), (106, [float("inf"), 1.0, 1.0], 1), (None, v, 1), (140, [5.0], 1)]
    df = spark.createDataFrame(rows, VECTORS).select("*", F.lit(1).alias("shard"), F.lit(2).alias("id"), F.lit(3).alias("rank"))
    got = answers(vector_search.search(vector_search.build_index(df, k=20), df.where("vec_id % 20 = 0"), k=20))
    assert set(got) == {0, 20, 40, 100}
    assert [i for i, _ in got[20]] == [100, *range(19)] and got[20][0][1] == 10.5 and got[20][1][1] == 5.25
    assert [i for i, _ in got[0]] == [100, *range(1, 20)] and [i for i, _ in got[100]] == list(range(20))
    none = df.where("false")
    index = vector_search.build_index(none, k=20)
    assert vector_search.search(index, df, k=20).count() == vector_search.search(vector_search.build_index(df, k=20), none, k=20).count() == 0
    one = vector_search.build_index(df.where("vec_id = 140"), k=20)
    assert vector_search.search(one, df.where("vec_id = 140"), k=20).count() == 0


def test_graph_reaches_every_cluster():
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(150, 24))[np.arange(3000) % 150] * 3 + rnd.normal(size=(3000, 24)) * 0.05
    order, graph = vector_search.build_graph(x)
    assert [len(layer) for layer in graph.layers] == sorted((len(layer) for layer in graph.layers), reverse=True)
    assert all(layer.shape[1] == (32 if i == 0 else 16) and layer.max() < len(layer) for i, layer in enumerate(graph.layers))
    found = graph.search(np.concatenate([x[:200], np.zeros((200, 1))], 1).astype(np.float32), 64)
    products = x[:200] @ x[order].T
    best = np.argsort(-products, axis=1)[:, :10]
    assert np.mean([len(set(f) & set(b)) / 10 for f, b in zip(found, best)]) > 0.98


# Prefix trie


def trie(rows):
    """The contract, said plainly."""
    own, rebuilt, nodes = defaultdict(list), {}, defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 9
        rebuilt[c] = (*own.get(c - int(math.fmod(c, 5)), [])[:h], *turns[h:])
        for d in range(len(rebuilt[c]) + 1):
            nodes[rebuilt[c][:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in nodes:
        if node:
            children[node[:-1]] += 1
    for node, members in nodes.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(members) - 1) * len(node[-1][1].encode()) if node else 0
            leaves[node[:d]] += not children[node]
    return sorted(
        (
            min(m), len(x), min(nodes[x[:-1]]) if x else -1, len(m), children[x], leaves[x], saved[x],
            sha(",".join(map(str, sorted(c for c in m if rebuilt[c] == x)))),
        )
        for x, m in nodes.items()
    )


def plain(df):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in df.columns) for r in df.collect())


@pytest.fixture(scope="module")
def odd_turns(spark):
    rnd = random.Random(2)
    rows = [
        (rnd.choice([None, *range(-7, 60)]), rnd.choice([None, 1, 2, 3, 3]), rnd.choice(["u", None, ""]), rnd.choice(["a", "", "bé", None]))
        for _ in range(300)
    ]
    rows += [(c, i, "u", "same") for c in range(100, 160) for i in range(5)]  # many copies of one
    rows += [(200, i, "u", str(i % 3)) for i in range(200)] + [(205, i, "u", str(i % 3)) for i in range(150)]  # very long ones
    rows += [(301, 1, "ab", "c"), (302, 1, "a", "bc"), (300, 1, "x" * 50_000, "y" * 100_000)]
    df = spark.createDataFrame(rows, TURNS).select("*", *[F.lit("own").alias(c) for c in ("turns", "sequence", "key", "depth", "kind")])
    return rows, df


@pytest.mark.parametrize("shard", [10_000, 13, 2, 1])
def test_trie_is_the_same_in_any_shards(odd_turns, shard):
    rows, df = odd_turns
    turns = conversation_trie.with_shared_openings(conversation_trie.sequences(df))
    assert plain(conversation_trie.prefix_trie(turns, shard=shard)) == trie(rows)


def test_trie_query(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/conversations.parquet").to_pylist()]
    got = entry.queries()["op12_prefix_trie"](spark, SF)
    assert plain(got) == trie(rows)
    assert got.where("depth = 0").count() == 1


def test_trie_twin_on_odd_rows(odd_turns):
    rows, _ = odd_turns
    import pandas as pd

    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    found = duckdb.sql(entry.oracle_sql()["op12_prefix_trie"]).fetchall()
    assert sorted(tuple(-1 if v is None else v for v in r) for r in found) == trie(rows)


def test_trie_without_conversations(odd_turns):
    _, df = odd_turns
    assert conversation_trie.prefix_trie(conversation_trie.sequences(df.where("false"))).count() == 0
    assert conversation_trie.prefix_trie(conversation_trie.sequences(df.where("conv_id IS NULL"))).count() == 0


def test_ends_of_many_pieces_are_hashed_in_order(spark):
    rows = [(c, 0, "u", "same") for c in range(1, 3000)]
    df = spark.createDataFrame(rows, TURNS)
    nodes = conversation_trie.prefix_trie(conversation_trie.sequences(df), shard=1200).collect()
    leaf = max(nodes, key=lambda r: r["depth"])
    assert len(nodes) == 2 and leaf["n_convs"] == 2999 and leaf["ends_sha256"] == sha(",".join(map(str, range(1, 3000))))


# Periodic runs


def plain_runs(w, least=6, exponent=4):
    """All maximal stretches of every period; of those with equal bounds the smallest period counts."""
    best = {}
    for q in range(len(w) // exponent, 0, -1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                best[(i, j + q - i)] = q
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rnd, total = random.Random(1), 0
    for _ in range(6000):
        letters, words = rnd.choice([1, 2, 2, 3]), []
        for _ in range(rnd.randint(0, 9)):
            unit = [rnd.randrange(letters) for _ in range(rnd.randint(1, 9))]
            words += (unit * rnd.randint(1, 6))[: rnd.randint(1, 60)]
        want = plain_runs(words)
        total += len(want)
        assert runs.runs_of(words) == want
        some = runs.SquareCatcher()
        for i in range(0, len(words), 7):
            some.extend(words[i : i + 7])
            assert some.runs() == plain_runs(words[: i + 7])
    assert total > 5000


def test_runs_query(spark):
    got = {r["doc_id"]: r.asDict() for r in entry.queries()["op13_periodic_runs"](spark, SF).collect()}
    docs, found = pq.read_table(f"{SF}/documents.parquet").to_pylist(), 0
    for d in docs:
        words = runs.with_periodic_tail(d["doc_id"], (d["text"] or "").encode().split())
        h = crc32(str(d["doc_id"]).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + math.floor((n - a) / (3 + g % 8))
            original = (d["text"] or "").encode().split()
            assert words == [original[i] if i < a else original[a + (i - a) % p] for i in range(n)]
        want = plain_runs(words)
        top = min(want, key=lambda r: (-r[1], r[0], r[2]), default=None)
        dropped = {i for s, n, q in want for i in range(s + q, s + n)}
        row = got[d["doc_id"]]
        assert row["n_runs"] == len(want)
        assert (row["start"], row["length"], row["period"]) == (top or (None, None, None))
        assert row["exponent_milli"] == (1000 * top[1] // top[2] if top else None)
        assert row["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in want))
        assert row["collapsed_sha256"] == sha(b" ".join(w for i, w in enumerate(words) if i not in dropped).decode())
        found += len(want)
    assert found and len(got) == len(docs)


def test_runs_on_odd_rows(spark):
    texts = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "é " * 6), (4, "é " * 6), (None, "a b " * 4), (6, "a\u00a0b " * 5 + "x"),
        (7, "w " * 200_000), (8, " ".join(f"w{i % 5000}" for i in range(60_000))), (9, "a b c a b c a b c"),
    ]
    clashing = ["runs", "_runs", "found", "start", "length", "period", "collapsed", "n_words"]
    df = spark.createDataFrame(texts, "doc_id long, text string").select("*", *[F.lit(f"own {c}").alias(c) for c in clashing])
    got = runs.find_runs(df)
    assert got.columns == [*df.columns, "__runs"]
    rows = got.collect()
    assert all(r[c] == f"own {c}" for r in rows for c in clashing)
    by_id = {r["doc_id"]: r["__runs"] for r in rows}
    assert [by_id[i]["n_words"] for i in (1, 2, 3)] == [0, 0, 0] and by_id[3]["collapsed"] == ""
    assert {i: [tuple(x) for x in v["runs"]] for i, v in by_id.items() if v["runs"]} == {
        4: [(0, 6, 1)], None: [(0, 8, 2)], 7: [(0, 200_000, 1)], 8: [(0, 60_000, 5000)],
    }
    assert by_id[None]["collapsed"] == "a b" and by_id[7]["collapsed"] == "w" and by_id[6]["runs"] == [] and len(rows) == 10
    assert runs.find_runs(df.where("false")).count() == 0
