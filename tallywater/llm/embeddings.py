"""Near-duplicate vectors by an exact metric range join on pivots.

The angle between vectors is a metric. Pivots, a bounded sample, partition each label's vectors into
cells (nearest pivot). If two vectors are within the radius r, then a vector x reaches into cell q
only if its angle to pivot q is at most its angle to its own pivot plus 2r, and at most the cell's
largest angle plus r (both by the triangle inequality). So x is sent to those cells alone, and cells
join independently and exactly. Cells are joined in blocks of bounded size: neither a label nor a
heap of copies nor of near copies meets in one task.

Exact copies are one class; a block returns counts and a forest of links, never all pairs.

Defined results: links need equal labels that are not null; vectors that are null, empty, zero or
hold null or non-finite components link with nothing, vectors of different length neither; repeated
rows are vectors of their own; a vector without an id counts among its neighbours' links, while its own
row has none and neither component nor ``kept``, as nothing could name it. Any number of columns may be beside the three that are read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywater.llm.graph import components
from tallywater.llm.shared import ship, stored

ship(__name__)

#: All pivots together; they are broadcast with the tasks.
PIVOTS = 2048
CELL = 1000
BLOCK = 2000
PROBES = 8000
#: Angles are rounded; bounds are widened by this much.
SLACK = 1e-6


def usable(vector: Column) -> Column:
    """Whether a vector can link: it has components, all finite, and not all are zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pd.Series) -> np.ndarray:
    """Unit vectors in double precision; scaled by the largest component first, against overflow."""
    x = np.array(column.tolist(), dtype=np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ pivots.T, -1.0, 1.0))


def _forest(pairs: np.ndarray, n: int) -> np.ndarray:
    """(node, root) links that connect what ``pairs`` connects."""
    parent = np.arange(n)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    roots = np.array([find(i) for i in range(n)])
    moved = np.flatnonzero(roots != np.arange(n))
    return np.stack([moved, roots[moved]], 1)


def classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Distinct usable vectors per label: (rep, label, vector, copies), stored. ``rep`` is the smallest id."""
    vector = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double"))
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), vector.alias("vector"))
    # Lengths must agree to be compared: they become part of the label.
    rows = rows.where(F.col("label").isNotNull() & usable(F.col("vector")))
    return rows.groupBy(F.struct("label", F.size("vector").alias("n")).alias("label"), "vector").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )


def choose_pivots(rows: DataFrame, pivots: int, cell: int) -> dict[tuple, np.ndarray]:
    """Pivots of the labels with more than a cell of vectors, by share; at most ``pivots`` in all."""
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = rows.count()
    share = F.floor(F.col("n") * min(1 / cell, pivots / max(total, 1)))
    large = sizes.where(share >= 2).select("label", "n", share.alias("k"))
    # A label's rows with the smallest digests: about k of n, then exactly the k smallest.
    low = F.pmod(F.xxhash64("vector"), F.lit(1 << 40)) / float(1 << 40)
    order = Window.partitionBy("label").orderBy("_low", "rep")
    chosen = (
        rows.join(F.broadcast(large), "label")
        .withColumn("_low", low)
        .where(F.col("_low") < (2 * F.col("k") + 20) / F.col("n"))
        .withColumn("_place", F.row_number().over(order))
        .where("_place <= k")
        .select("label", "vector")
        .toPandas()  # at most ``pivots`` vectors
    )
    return {(k[0], k[1]): _matrix(g["vector"]) for k, g in chosen.groupby(chosen["label"].map(tuple))} if len(chosen) else {}


def link_counts(rows: DataFrame, cosine: float, *, pivots: int = PIVOTS, cell: int = CELL, block: int = BLOCK, probes: int = PROBES) -> DataFrame:
    """(a, b, n): class ``a`` is linked with ``n`` vectors of other classes, and belongs with ``b``."""
    radius = math.acos(cosine)
    chosen = rows.sparkSession.sparkContext.broadcast(choose_pivots(rows, pivots, cell))
    schema = rows.select("label", "rep", "copies", "vector").schema.simpleString()[7:-1]

    def by_label(batch: pd.DataFrame):
        keys = [(x["n"], x["label"]) if isinstance(x, dict) else (x[1], x[0]) for x in batch["label"]]
        for key, at in pd.Series(range(len(batch))).groupby(pd.Series(keys, index=range(len(batch)))):
            yield chosen.value.get((key[1], key[0])), batch.iloc[at.to_numpy()].reset_index(drop=True)

    def assign(batches):
        for batch in batches:
            for own, part in by_label(batch):
                if own is None:
                    yield part.assign(cell=0, angle=0.0)
                else:
                    angles = _angles(_matrix(part["vector"]), own)
                    yield part.assign(cell=angles.argmin(1), angle=angles.min(1))

    placed = stored(rows.select("label", "rep", "copies", "vector").mapInPandas(assign, f"{schema}, cell int, angle double"), "cells")
    cells = placed.groupBy("label", "cell").agg(F.max("angle").alias("reach"), F.count(F.lit(1)).alias("members"))
    reach: dict[tuple, np.ndarray] = {}
    for r in cells.where(F.col("members") > 0).join(F.broadcast(cells.where("cell > 0").select("label").distinct()), "label").select("label", "cell", "reach").collect():
        key = (r["label"]["label"], r["label"]["n"])  # labels that have pivots: at most ``pivots`` cells
        if key in chosen.value:
            reach.setdefault(key, np.full(len(chosen.value[key]), -10.0))[r["cell"]] = r["reach"]
    bounds = rows.sparkSession.sparkContext.broadcast(reach)

    def send(batches):
        """Every vector to the cells that may hold a neighbour; of two cells, to the later one."""
        for batch in batches:
            for own, part in by_label(batch):
                if own is None or len(part) == 0:
                    yield part.drop(columns="angle").assign(to=part["cell"])
                    continue
                first = part["label"].iloc[0]
                key = (first["label"], first["n"]) if isinstance(first, dict) else (first[0], first[1])
                angles, cell_of = _angles(_matrix(part["vector"]), own), part["cell"].to_numpy()
                limit = np.full(len(own), 10.0) if key not in bounds.value else bounds.value[key]
                near = (angles <= part["angle"].to_numpy()[:, None] + 2 * radius + SLACK) & (angles <= limit[None] + radius + SLACK)
                near &= np.arange(len(own))[None] >= cell_of[:, None]
                near[np.arange(len(part)), cell_of] = True
                who, to = np.nonzero(near)
                for at in range(0, len(who), 5000):
                    yield part.drop(columns="angle").iloc[who[at : at + 5000]].assign(to=to[at : at + 5000])

    sent = placed.mapInPandas(send, f"{schema}, cell int, to int")
    # Blocks: a cell's members in parts of at most about ``block``, its probes in chunks.
    parts = stored(cells.select("label", F.col("cell").alias("to"), F.ceil(F.col("members") / block).cast("int").alias("parts")), "blocks")
    sent = stored(sent, "probes")
    chunks = sent.groupBy("label", "to").agg(F.ceil(F.count(F.lit(1)) / probes).cast("int").alias("chunks"))
    grid = parts.join(chunks, ["label", "to"])
    spot = lambda n: F.pmod(F.xxhash64("rep"), n)
    asks = sent.join(grid, ["label", "to"]).select(
        "label", "to", spot(F.col("chunks")).cast("int").alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        "rep", "copies", "vector", (F.col("cell") == F.col("to")).alias("same"), F.lit(True).alias("probe"),
    )
    holds = placed.select("label", F.col("cell").alias("to"), "rep", "copies", "vector").join(grid, ["label", "to"]).select(
        "label", "to", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), spot(F.col("parts")).cast("int").alias("part"),
        "rep", "copies", "vector", F.lit(True).alias("same"), F.lit(False).alias("probe"),
    )

    def join_block(frame: pd.DataFrame) -> pd.DataFrame:
        members, asking = frame[~frame["probe"]], frame[frame["probe"]]
        if not len(members) or not len(asking):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
        m, ids, copies = _matrix(members["vector"]), members["rep"].to_numpy(), members["copies"].to_numpy()
        out, pairs = [], []
        ask_ids, ask_copies, same = asking["rep"].to_numpy(), asking["copies"].to_numpy(), asking["same"].to_numpy()
        vectors = asking["vector"]
        gained = np.zeros(len(ids), np.int64)
        for at in range(0, len(asking), 1000):
            part = slice(at, at + 1000)
            linked = (_matrix(vectors.iloc[part]) @ m.T) >= cosine
            linked &= ask_ids[part][:, None] != ids[None]
            out.append(pd.DataFrame({"a": ask_ids[part], "b": ask_ids[part], "n": linked @ copies}))
            # Probes of another cell are not asked by it in turn, so the members count them here.
            gained += ask_copies[part] @ (linked & ~same[part][:, None])
            # A probe ties its members to the first of them; equal ties are made once.
            x, y = np.nonzero(linked)
            first = linked.argmax(1)
            some = np.flatnonzero(linked.any(1))
            pairs.append(np.stack([some + at + len(ids), first[some]], 1))
            ties = np.unique(y * len(ids) + first[x])
            pairs.append(np.stack([ties // len(ids), ties % len(ids)], 1))
        out.append(pd.DataFrame({"a": ids, "b": ids, "n": gained}))
        names = np.concatenate([ids, ask_ids])
        tree = _forest(np.concatenate(pairs), len(names))
        out.append(pd.DataFrame({"a": names[tree[:, 0]], "b": names[tree[:, 1]], "n": 0}))
        result = pd.concat(out)
        return result[(result["n"] > 0) | (result["a"] != result["b"])]

    return asks.unionByName(holds).groupBy("label", "to", "part", "chunk").applyInPandas(join_block, "a long, b long, n long")


def near_vectors(
    vectors: DataFrame, *, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **sizes: int
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row; ids are integers."""
    rows = stored(classes(vectors, id_col, vector_col, label_col), "vectors")
    found = stored(link_counts(rows, cosine, **sizes), "vector-links")
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    joined = components(found.where("a <> b").select("a", "b"))
    per_class = (
        rows.join(counts, "rep", "left")
        .join(joined, F.col("rep") == F.col("id"), "left")
        .select("label", "vector", "copies", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    vector = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double"))
    fits = F.col("_label").isNotNull() & usable(F.col("_vector"))
    every = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("_label"), vector.alias("_vector"))
    every = every.select("vec_id", F.when(fits, F.struct(F.col("_label").alias("label"), F.size("_vector").alias("n"))).alias("label"), F.when(fits, F.col("_vector")).alias("vector"))
    out = every.join(per_class, ["label", "vector"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
