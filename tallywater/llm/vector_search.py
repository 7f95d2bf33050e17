"""Approximate nearest neighbours by largest inner product: a small-world graph per shard.

Equal vectors are one class. The classes are dealt by digest to shards of bounded size, and every
shard builds a hierarchical navigable small-world graph, stored as one row: the vectors, the classes'
ids and a flat neighbour array per layer. A search replicates the queries, in chunks, over the shards
of their length; a chunk and a shard meet in one task, descend from the top layer and widen to a beam
in the lowest one. The best of all shards are merged per query.

Inner product is no metric, so graphs are built on vectors extended by one component that gives all
of a shard the same length; then the nearest by distance is the largest by product. Inside a task
whole batches of points are inserted, and whole blocks of queries searched, in step. Products of the
candidates that a beam ends with are computed in double precision on the original vectors.

Defined results: rows with a null id and vectors that are null, empty, zero or hold null or
non-finite components take no part; vectors are compared with those of their length only; candidates
with the query's own id are left out; repeated rows count once; ties go to the smaller id; a product
that is no number (an overflow) counts as the least. The graphs depend on the rows alone, not on
their order: reruns agree. Any number of columns may be beside those that are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tallywater.llm.embeddings import usable
from tallywater.llm.shared import ship, stored

ship(__name__)

#: Vectors and components of a shard, queries that meet a shard in one task.
SHARD = 16_384
SHARD_VALUES = 1 << 22
CHUNK = 4096
#: Neighbours of a node above the lowest layer, twice as many in it; widths of the beams.
LINKS = 16
BUILD_WIDTH = 64
SEARCH_WIDTH = 256
DESCENT_WIDTH = 8
#: Points inserted at once; queries searched at once; nodes that a beam expands in one step.
BATCH = 1024
TOGETHER = 256
STEP = 4

INDEX = "size int, n int, shard int, vectors binary, members array<long>, ends array<int>, layers array<array<int>>"


def _beam(points: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nodes found closest to every query (-1 for none) and their products, unordered."""
    n, rows = len(links), len(queries)
    ids = np.full((rows, width), -1, np.int64)
    close = np.full((rows, width), -np.inf, np.float32)
    fresh = np.zeros((rows, width), bool)
    seen = np.zeros(rows * n, bool)

    def admit(live: np.ndarray, nodes: np.ndarray) -> None:
        keys = (live[:, None] * n + nodes)[nodes >= 0]
        keys = np.unique(keys[~seen[keys]])
        if not len(keys):
            return
        seen[keys] = True
        row, node = keys // n, keys % n
        counts = np.bincount(row, minlength=rows)
        place = np.arange(len(keys)) - (np.cumsum(counts) - counts)[row]
        touched = np.flatnonzero(counts)
        at = np.searchsorted(touched, row)
        more = counts.max()
        new_ids = np.full((len(touched), width + more), -1, np.int64)
        new_close = np.full((len(touched), width + more), -np.inf, np.float32)
        new_fresh = np.zeros((len(touched), width + more), bool)
        new_ids[:, :width], new_close[:, :width], new_fresh[:, :width] = ids[touched], close[touched], fresh[touched]
        new_ids[at, width + place] = node
        new_close[at, width + place] = np.einsum("ij,ij->i", points[node], queries[row])
        new_fresh[at, width + place] = True
        best = np.argpartition(-new_close, width - 1, axis=1)[:, :width]
        ids[touched] = np.take_along_axis(new_ids, best, 1)
        close[touched] = np.take_along_axis(new_close, best, 1)
        fresh[touched] = np.take_along_axis(new_fresh, best, 1)

    admit(np.arange(rows), entries)
    step = min(STEP, width)
    while True:
        live = np.flatnonzero(fresh.any(1))
        if not len(live):
            return ids, close
        open_ = np.where(fresh[live], close[live], -np.inf)
        chosen = np.argpartition(-open_, step - 1, axis=1)[:, :step]
        real = np.take_along_axis(open_, chosen, 1) > -np.inf
        nodes = np.where(real, np.take_along_axis(ids[live], chosen, 1), -1)
        fresh[live[:, None], chosen] = False
        around = np.where(real[:, :, None], links[nodes], -1)
        admit(live, around.reshape(len(live), -1))


def _diverse(points: np.ndarray, own: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of ``nodes`` (-1 for none) as neighbours of each point of ``own``.

    In the order of closeness a node is taken if no node taken before is closer to it than the point
    is; places that stay free go to the closest of the others.
    """
    out = np.full((len(own), most), -1, np.int64)
    for first in range(0, len(own), TOGETHER):
        part = slice(first, first + TOGETHER)
        vectors = points[nodes[part]]
        close = np.where(nodes[part] >= 0, np.einsum("bcd,bd->bc", vectors, points[own[part]]), -np.inf)
        order = np.argsort(-close, axis=1, kind="stable")
        close = np.take_along_axis(close, order, 1)
        ranked = np.take_along_axis(nodes[part], order, 1)
        vectors = np.take_along_axis(vectors, order[:, :, None], 1)
        between = vectors @ vectors.transpose(0, 2, 1)
        taken = np.zeros(close.shape, bool)
        for c in range(close.shape[1]):
            hidden = (taken[:, :c] & (between[:, c, :c] > close[:, c, None])).any(1)
            taken[:, c] = (ranked[:, c] >= 0) & ~hidden & (taken.sum(1) < most)
        preferred = np.argsort(~taken, axis=1, kind="stable")[:, :most]
        out[part, : preferred.shape[1]] = np.take_along_axis(ranked, preferred, 1)
    return out


def _link_back(points: np.ndarray, links: np.ndarray, own: np.ndarray, chosen: np.ndarray) -> None:
    """Every chosen node gets the point that chose it as a neighbour; full nodes choose anew."""
    most = links.shape[1]
    source, target = np.repeat(own, chosen.shape[1]), chosen.ravel()
    source, target = source[target >= 0], target[target >= 0]
    if not len(target):
        return
    close = np.einsum("ij,ij->i", points[source], points[target])
    order = np.lexsort([-close, target])
    source, target = source[order], target[order]
    hubs, first, counts = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(first, counts)
    near = place < 2 * most
    offered = np.full((len(hubs), min(2 * most, counts.max())), -1, np.int64)
    offered[np.searchsorted(hubs, target[near]), place[near]] = source[near]
    for begin in range(0, len(hubs), BATCH):
        part = slice(begin, begin + BATCH)
        old, new = links[hubs[part]], offered[part]
        new = np.where((new[:, :, None] == old[:, None, :]).any(2), -1, new)
        links[hubs[part]] = _diverse(points, hubs[part], np.concatenate([old, new], 1), most)


@dataclass
class Graph:
    """Nodes in the order of their layers: layer l holds the first ``len(layers[l])`` of them."""

    points: np.ndarray
    layers: list[np.ndarray]

    def enter(self, queries: np.ndarray, above: int, known: int) -> np.ndarray:
        """Entry nodes below ``known`` for a beam in the layer under layer ``above``."""
        entries = np.zeros((len(queries), 1), np.int64)
        for links in reversed(self.layers[above:]):
            entries, _ = _beam(self.points, links, queries, entries, DESCENT_WIDTH)
        entries = np.where(entries < known, entries, -1)
        return np.concatenate([entries, np.zeros((len(queries), 1), np.int64)], 1)

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        return _beam(self.points, self.layers[0], queries, self.enter(queries, 1, len(self.points)), width)[0]

    def grow(self, links: np.ndarray, width: int) -> None:
        """Insert the nodes of a new lowest layer, batch after batch, each as large as what is there."""
        done, n = 0, len(links)
        while done < n:
            own = np.arange(done, min(n, done + min(BATCH, max(32, done))))
            among = self.points[own] @ self.points[own].T
            np.fill_diagonal(among, -np.inf)
            best = np.argsort(-among, axis=1, kind="stable")[:, : min(width // 2, len(own) - 1)]
            nodes = [own[best]]
            if done:
                for first in range(0, len(own), TOGETHER):
                    queries = self.points[own[first : first + TOGETHER]]
                    nodes.append(_beam(self.points, links[:done], queries, self.enter(queries, 0, done), width)[0])
                nodes = [nodes[0], np.concatenate(nodes[1:])]
            links[own] = _diverse(self.points, own, np.concatenate(nodes, 1), links.shape[1])
            _link_back(self.points, links, own, links[own])
            done += len(own)


def build_graph(vectors: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, seed: int = 11) -> tuple[np.ndarray, Graph]:
    """The order in which a shard's vectors become nodes, and their graph."""
    draws = np.random.default_rng(seed).random(len(vectors))
    heights = np.floor(-np.log(1 - draws) / math.log(links)).astype(np.int64)
    order = np.argsort(-heights, kind="stable")
    graph = Graph(extended(vectors[order]), [])
    for height in range(heights.max(), -1, -1):
        n = int((heights >= height).sum())
        flat = np.full((n, links if height else 2 * links), -1, np.int64)
        graph.grow(flat, width)
        graph.layers.insert(0, flat)
    return order, graph


def extended(vectors: np.ndarray) -> np.ndarray:
    """Vectors scaled and extended by a component that makes their lengths equal."""
    x = vectors / np.abs(vectors).max()
    squares = np.einsum("ij,ij->i", x, x)
    return np.concatenate([x, np.sqrt(np.maximum(squares.max() - squares, 0))[:, None]], 1).astype(np.float32)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def _build(group: pd.DataFrame) -> pd.DataFrame:
    group = group.assign(least=[m[0] for m in group["members"]]).sort_values(["least", "digest"], kind="stable")
    vectors = _matrix(group["vector"])
    order, graph = build_graph(vectors)
    members = [np.sort(np.asarray(m, np.int64)) for m in group["members"].to_numpy()[order]]
    return pd.DataFrame(
        {
            "size": [vectors.shape[1]], "n": [len(order)], "shard": [group["shard"].iloc[0]], "vectors": [vectors[order].tobytes()],
            "members": [np.concatenate(members)], "ends": [np.cumsum([len(m) for m in members]).astype(np.int32)],
            "layers": [[layer.ravel().astype(np.int32) for layer in graph.layers]],
        }
    )


def build_index(vectors: DataFrame, *, k: int, id_col: str = "vec_id", vector_col: str = "embedding", shard: int = SHARD) -> DataFrame:
    """One row per shard (see ``INDEX``), stored. Classes keep their ``k`` + 1 smallest ids, all a search can return."""
    rows = _rows(vectors, id_col, vector_col)
    smallest = Window.partitionBy("vector").orderBy("id")
    classes = stored(
        rows.withColumn("_place", F.row_number().over(smallest))
        .where(F.col("_place") <= k + 1)
        .groupBy("vector")
        .agg(F.collect_list("id").alias("ids"))
        .select("vector", F.sort_array("ids").alias("members"), F.size("vector").alias("size"), F.xxhash64("vector").alias("digest")),
        "search-classes",
    )
    n, values = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    shards = max(1, math.ceil(n / shard), math.ceil(values / SHARD_VALUES))
    dealt = classes.withColumn("shard", F.pmod("digest", F.lit(shards)).cast("int"))
    return stored(dealt.groupBy("size", "shard").applyInPandas(_build, INDEX), "search-index")


def _rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """The distinct (id, vector) that take part."""
    vector = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double"))
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), vector.alias("vector"))
    return rows.where(F.col("id").isNotNull() & usable(F.col("vector"))).distinct()


def _answers(queries: pd.DataFrame, index: pd.DataFrame, k: int, width: int) -> pd.DataFrame:
    """The best ``k`` candidates of a shard for every query of a chunk."""
    found = []
    if len(index) and len(queries):
        row = index.iloc[0]
        vectors = np.frombuffer(row["vectors"], np.float64).reshape(row["n"], -1)
        layers = [np.asarray(flat, np.int64) for flat in row["layers"]]
        sizes = [2 * LINKS, *[LINKS] * (len(layers) - 1)]
        graph = Graph(extended(vectors), [flat.reshape(-1, m) for flat, m in zip(layers, sizes)])
        members, ends = np.asarray(row["members"], np.int64), np.asarray(row["ends"], np.int64)
        counts = np.diff(ends, prepend=0)
        for first in range(0, len(queries), TOGETHER):
            part = queries.iloc[first : first + TOGETHER]
            own = _matrix(part["vector"])
            scaled = own / np.abs(own).max(1, keepdims=True)
            beams = graph.search(np.concatenate([scaled, np.zeros((len(own), 1))], 1).astype(np.float32), width)
            at, node = np.repeat(np.arange(len(own)), width), beams.ravel()
            at, node = at[node >= 0], node[node >= 0]
            with np.errstate(over="ignore", invalid="ignore"):
                score = (vectors[node] * own[at]).sum(1)
            score = np.where(np.isnan(score), -np.inf, score)
            # Classes to their ids: each pair as often as the class has ids.
            copies = counts[node]
            place = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
            ids = members[np.repeat(ends[node] - copies, copies) + place]
            at, score = np.repeat(at, copies), np.repeat(score, copies)
            other = ids != part["id"].to_numpy(np.int64)[at]
            at, score, ids = at[other], score[other], ids[other]
            order = np.lexsort([ids, -score, at])
            at, score, ids = at[order], score[order], ids[order]
            starts = np.searchsorted(at, np.arange(len(own)))
            best = np.arange(len(at)) - starts[at] < k
            found.append(
                pd.DataFrame(
                    {"query_id": part["id"].to_numpy()[at[best]], "digest": part["digest"].to_numpy()[at[best]], "vec_id": ids[best], "score": score[best]}
                )
            )
    if not found:
        return pd.DataFrame({"query_id": [], "digest": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "digest": "int64", "vec_id": "int64"})
    return pd.concat(found, ignore_index=True)


def search(
    index: DataFrame, queries: DataFrame, *, k: int, width: int = SEARCH_WIDTH, chunk: int = CHUNK,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found in ``index`` of every row of ``queries``."""
    asked = _rows(queries, id_col, vector_col).select("id", "vector", F.size("vector").alias("size"), F.xxhash64("vector").alias("digest"))
    asked = stored(asked, "search-queries")
    chunks = max(1, math.ceil(asked.count() / chunk))
    # The rows' numbers alone are read for these two bounds.
    last = index.agg(F.coalesce(F.max("shard"), F.lit(0))).first()[0]
    spread = asked.withColumn("chunk", F.pmod(F.xxhash64("id", "digest"), F.lit(chunks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(last)))
    )
    repeated = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    keys = ["size", "shard", "chunk"]

    def answers(some: pd.DataFrame, graph: pd.DataFrame) -> pd.DataFrame:
        return _answers(some, graph, k, width)

    found = spread.groupBy(*keys).cogroup(repeated.groupBy(*keys)).applyInPandas(answers, "query_id long, digest long, vec_id long, score double")
    best = Window.partitionBy("query_id", "digest").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
