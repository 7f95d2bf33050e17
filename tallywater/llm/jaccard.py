"""Chosen-path join: documents whose sets of five-word shingles are similar.

Every set is embedded as ``TOKENS`` minhash tokens. A run splits the sets recursively: a node keeps
a token with probability 1 / (similarity * TOKENS), decided by a hash of the node and the token, and
every set that has a kept token goes to that child. Two similar sets keep one token in common on
average at every level, dissimilar ones part. Nodes of few sets are compared by brute force; larger
ones are split again, and after ``DEPTH`` levels compared in blocks, so no set is dropped. Runs are
repeated until a pair at the threshold is found with the target recall.

Comparing tokens (a margin below the threshold) ties candidates to groups; a group's sets are then
intersected exactly, block by block. Blocks return counts and a forest of links, never all pairs.
Texts with equal shingle sets are one class from the start.

Defined results: words are runs of letters, digits and non-ASCII characters in lower case (A to Z);
fewer than five words are one shingle; null and wordless texts have none and link with nothing; rows
that repeat an id and text are copies like others. Group ids are the smallest doc_id of the group.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tallywater.llm.graph import components
from tallywater.llm.shared import document_key, ship, stored, unused

ship(__name__)

SHINGLE = 5
SIMILARITY = 0.8
TOKENS = 64
RECALL = 0.999
DEPTH = 3
#: A node of at most so many sets is compared by brute force; the side of a block beyond that.
SMALL = 200
BLOCK = 400
#: Rows that one call of Python compares: tokens have a fixed size, sets the size of their text.
TOKEN_BUNDLE = 4000
SET_BUNDLE = 500
#: Tokens estimate a similarity with a standard error of 0.05; this is four of them.
MARGIN = 0.2
#: Keys up to this number are broadcast (16 bytes each), more are shuffled.
BROADCAST_KEYS = 1_000_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
REMEMBERED = 2_000_000


class Words(dict):
    """64-bit digests of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: Words, size: int) -> np.ndarray:
    """The distinct shingles of a text as sorted digests."""
    found = WORD.findall(text if text.islower() else text.translate(LOWER)) if text else []
    if not found:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    out = np.zeros(max(1, len(w) - size + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(size, len(w))):
            out = out * np.uint64(0x9E3779B97F4A7C15) + w[k : k + len(out)]
    return np.unique(mixed(out))


def multipliers(tokens: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(2 * tokens, dtype=np.uint64))
    return (seeds[:tokens] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (seeds[tokens:] >> np.uint64(32)).astype(np.uint32)


def embedded(sets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest value of every permutation over a set, 4096 shingles at a time."""
    low = (sets ^ (sets >> np.uint64(32))).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 4096):
        np.minimum(out, (low[at : at + 4096, None] * a + b).min(0), out=out)
    return out


def runs_for(recall: float, depth: int) -> int:
    """Runs until a pair at the threshold is found with this probability, also at full depth.

    At each level such a pair keeps a Poisson number of common tokens with mean 1.
    """
    found = 1.0
    for _ in range(depth):
        found = 1 - math.exp(-found)
    return math.ceil(math.log(1 - recall) / math.log(1 - found))


def embed(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, key, set_id, n, tokens) per row with words; ``set_id`` is equal for equal sets. Stored."""
    a, b = multipliers(TOKENS)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            sets = [shingles(t, words, size) for t in batch["text"]]
            some = [len(s) > 0 for s in sets]
            kept = [s for s in sets if len(s)]
            yield pd.DataFrame({
                "id": batch["id"][some], "key": batch["key"][some],
                "set_id": np.array([int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) for s in kept], np.int64),
                "n": np.array([len(s) for s in kept], np.int32), "tokens": [embedded(s, a, b).tobytes() for s in kept],
            })

    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").try_cast("long").alias("id"), document_key(F.col(f"`{id_col}`"), text).alias("key"), text.alias("text"))
    return stored(rows.mapInPandas(work, "id long, key binary, set_id long, n int, tokens binary"), "jaccard-embedded")


def _tokens(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(len(column), TOKENS)


def kept_tokens(seed: np.ndarray, tokens: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Which rows keep which token at a node, and the child's number: (row, node)."""
    with np.errstate(over="ignore"):
        named = mixed(tokens.astype(np.uint64) + (np.arange(TOKENS, dtype=np.uint64)[None] << np.uint64(32)))
        drawn = mixed(named ^ mixed(seed)[:, None])
    row, at = np.nonzero(drawn < np.uint64(int(2.0**64 / (similarity * TOKENS))))
    return row, mixed(drawn[row, at] + np.uint64(1)).view(np.int64)


def first_nodes(sets: DataFrame, runs: int, similarity: float) -> DataFrame:
    """(node, set_id): every run's first split."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens, ids = _tokens(batch["tokens"]), batch["set_id"].to_numpy()
            for run in range(runs):
                row, node = kept_tokens(np.full(len(ids), run + 1, np.uint64), tokens, similarity)
                yield pd.DataFrame({"node": node, "set_id": ids[row]})

    return sets.select("set_id", "tokens").mapInPandas(split, "node long, set_id long")


def next_nodes(members: DataFrame, similarity: float) -> DataFrame:
    """(node, set_id): the children of nodes, from (node, set_id, tokens)."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["set_id"].to_numpy()
            row, node = kept_tokens(batch["node"].to_numpy().view(np.uint64), _tokens(batch["tokens"]), similarity)
            yield pd.DataFrame({"node": node, "set_id": ids[row]})

    return members.mapInPandas(split, "node long, set_id long")


def distinct_nodes(nodes: DataFrame, purpose: str, last: bool) -> tuple[DataFrame, DataFrame]:
    """Members (node, set_id) of nodes of two or more sets, and (node, size).

    Of equal nodes that are compared one stays. Those still to be split all stay: each splits under its
    own number, and these are the independent repeats that the recall counts on.
    """
    nodes = stored(nodes.distinct(), purpose)
    sizes = nodes.groupBy("node").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("set_id")).alias("x"), F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("y")
    )
    split = F.lit(None).cast("long") if last else F.when(F.col("size") > SMALL, F.col("node"))
    once = sizes.where("size > 1").groupBy("size", "x", "y", split.alias("split")).agg(F.min("node").alias("node")).select("node", "size")
    once = stored(once, f"{purpose}-sizes")
    return nodes.join(once, "node"), once


def tied(pairs: list[np.ndarray], names: np.ndarray) -> pd.DataFrame:
    """A forest (a, b) over what ``pairs`` of positions connect."""
    parent = list(range(len(names)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in np.concatenate(pairs) if pairs else ():
        i, j = find(int(i)), find(int(j))
        if i != j:
            parent[max(i, j)] = min(i, j)
    roots = np.array([find(i) for i in range(len(names))], np.int64)
    moved = np.flatnonzero(roots != np.arange(len(names)))
    return pd.DataFrame({"a": names[moved], "b": names[roots[moved]]})


def ties_of(linked: np.ndarray) -> np.ndarray:
    """From a matrix of links, pairs of (row, first column) and (column, first column of a row)."""
    x, y = np.nonzero(linked)
    if not len(x):
        return np.zeros((0, 2), np.int64)
    first, width = linked.argmax(1), linked.shape[1]
    some = np.flatnonzero(linked.any(1))
    ties = np.unique(y * width + first[x])
    rows = np.stack([some, first[some] + linked.shape[0]], 1)
    return np.concatenate([rows, np.stack([ties // width, ties % width], 1) + linked.shape[0]])


def in_blocks(members: DataFrame, key: str, size: str, block: int, small: int) -> DataFrame:
    """``members`` with ``i``, ``j`` and ``side``: every pair of a group's blocks gets both blocks' rows.

    A group of at most ``small`` rows is one block with itself.
    """
    blocks = F.when(F.col(size) <= small, F.lit(1)).otherwise(F.ceil(F.col(size) / block)).cast("int")
    placed = members.withColumn("_blocks", blocks).withColumn("_own", F.pmod(F.xxhash64("set_id"), F.col("_blocks")).cast("int"))
    return placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        *members.columns,
        F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), (F.col("_own") <= F.col("_other")).alias("left"),
    )


def bundled(blocked: DataFrame, key: str, rows: int, each: int) -> DataFrame:
    """``blocked`` with ``bundle``: whole pairs of blocks together, about ``each`` rows, so that many
    small groups cost one call. ``rows`` is how many there are."""
    bundles = max(1, math.ceil(rows / each))
    return blocked.withColumn("bundle", F.pmod(F.xxhash64(key, "i", "j"), F.lit(bundles)))


def pairs_of_blocks(frame: pd.DataFrame, key: str) -> Iterator[tuple[slice | np.ndarray, slice | np.ndarray, bool]]:
    """The rows of both sides of every pair of blocks in a bundle, and whether they are one block."""
    order = np.lexsort((frame["j"], frame["i"], frame[key]))
    named = frame[[key, "i", "j"]].to_numpy()[order]
    starts = np.flatnonzero(np.r_[True, (named[1:] != named[:-1]).any(1)])
    left = frame["left"].to_numpy()
    for start, stop in zip(starts, np.r_[starts[1:], len(order)]):
        rows = order[start:stop]
        if named[start, 1] == named[start, 2]:
            yield rows, rows, True
        else:
            yield rows[left[rows]], rows[~left[rows]], False


def rows_in_blocks(sizes: DataFrame) -> int:
    """How many rows ``in_blocks`` makes of groups of these ``size``s."""
    blocks = F.when(F.col("size") <= SMALL, 1).otherwise(F.ceil(F.col("size") / BLOCK))
    return int(sizes.agg(F.coalesce(F.sum(F.col("size") * blocks), F.lit(0))).first()[0])


def candidate_groups(members: DataFrame, rows: int, threshold: float) -> DataFrame:
    """(a, b): sets of a node whose tokens agree in a share of ``threshold``, as a forest per block."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        tokens, sizes, ids = _tokens(frame["tokens"]), frame["n"].to_numpy(), frame["set_id"].to_numpy()
        out = []
        for left, right, _ in pairs_of_blocks(frame, "node"):
            if not len(left) or not len(right):
                continue
            nx, ny = sizes[left][:, None], sizes[right][None]
            # Sets whose sizes differ too much can't be similar.
            near = np.minimum(nx, ny) >= (threshold + MARGIN) * np.maximum(nx, ny) - 1e-9
            near &= ids[left][:, None] != ids[right][None]
            for k in np.flatnonzero(near.any(1)):
                near[k] &= (tokens[left[k]] == tokens[right]).mean(1) >= threshold
            if near.any():
                out.append(tied([ties_of(near)], np.concatenate([ids[left], ids[right]])))
        forest = pd.concat(out) if out else pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        return forest[forest["a"] != forest["b"]]

    blocked = bundled(in_blocks(members, "node", "size", BLOCK, SMALL), "node", rows, TOKEN_BUNDLE)
    return blocked.groupBy("bundle").applyInPandas(compare, "a long, b long")


def overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections, by matrix products over 4096 shared shingles at a time."""
    def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])

    (vx, rx), (vy, ry) = flat(x), flat(y)
    shared = np.intersect1d(vx, vy)
    out = np.zeros((len(x), len(y)), np.float64)
    cx, cy = np.searchsorted(shared, vx), np.searchsorted(shared, vy)
    hx, hy = np.isin(vx, shared), np.isin(vy, shared)
    cx, rx, cy, ry = cx[hx], rx[hx], cy[hy], ry[hy]
    ox, oy = np.argsort(cx, kind="stable"), np.argsort(cy, kind="stable")
    cx, rx, cy, ry = cx[ox], rx[ox], cy[oy], ry[oy]
    for at in range(0, len(shared), 4096):
        a, b = np.zeros((len(x), 4096), np.float32), np.zeros((len(y), 4096), np.float32)
        sx, sy = slice(*np.searchsorted(cx, [at, at + 4096])), slice(*np.searchsorted(cy, [at, at + 4096]))
        a[rx[sx], cx[sx] - at] = 1
        b[ry[sy], cy[sy] - at] = 1
        out += a @ b.T
    return out


def exact_links(members: DataFrame, rows: int, similarity: float) -> DataFrame:
    """(a, b, n): set ``a`` is similar to ``n`` documents of other sets and belongs with ``b``."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, np.uint64) for x in frame["shingles"]]
        lengths = np.array([len(x) for x in sets])
        ids, copies = frame["set_id"].to_numpy(), frame["copies"].to_numpy()
        out = [pd.DataFrame({"a": ids[:0], "b": ids[:0], "n": ids[:0]})]
        for left, right, inside in pairs_of_blocks(frame, "grp"):
            if not len(left) or not len(right):
                continue
            both = overlaps([sets[k] for k in left], [sets[k] for k in right])
            linked = both >= similarity * (lengths[left][:, None] + lengths[right][None] - both) - 1e-9
            linked &= ids[left][:, None] != ids[right][None]
            out.append(pd.DataFrame({"a": ids[left], "b": ids[left], "n": linked @ copies[right]}))
            if not inside:
                out.append(pd.DataFrame({"a": ids[right], "b": ids[right], "n": copies[left] @ linked}))
            out.append(tied([ties_of(linked)], np.concatenate([ids[left], ids[right]])).assign(n=0))
        result = pd.concat(out)
        return result[(result["n"] > 0) | (result["a"] != result["b"])].astype("int64")

    blocked = bundled(in_blocks(members, "grp", "size", BLOCK, SMALL), "grp", rows, SET_BUNDLE)
    return blocked.groupBy("bundle").applyInPandas(compare, "a long, b long, n long")


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(key, shingles) of the documents whose key is wanted."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "shingles": [shingles(t, words, size).tobytes() for t in batch["text"]]})

    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(document_key(F.col(f"`{id_col}`"), text).alias("key"), text.alias("text"))
    few = wanted.count() <= BROADCAST_KEYS
    rows = rows.join(F.broadcast(wanted) if few else wanted, "key", "left_semi")
    return rows.mapInPandas(work, "key binary, shingles binary").dropDuplicates(["key"])


def similar_sets(
    docs: DataFrame, *, similarity: float = SIMILARITY, size: int = SHINGLE, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(key, id, set_id, component, n_links, group, least): per row with words.

    ``n_links`` counts the other documents at the similarity or above, copies included; ``group`` is
    the smallest id of the component and ``least`` that of the rows with equal sets.
    """
    rows = embed(docs, id_col, text_col, size)
    sets = stored(
        rows.groupBy("set_id").agg(
            F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"), F.min_by(F.struct("key", "n", "tokens"), "key").alias("_any")
        ).select("set_id", "copies", "least", "_any.*"),
        "jaccard-sets",
    )
    found, nodes = [], first_nodes(sets, runs_for(recall, DEPTH), similarity)
    for level in range(1, DEPTH + 1):
        members, sizes = distinct_nodes(nodes, f"jaccard-nodes-{level}", level == DEPTH)
        members = members.join(sets.select("set_id", "tokens", "n"), "set_id")
        compared = F.lit(True) if level == DEPTH else F.col("size") <= SMALL
        ties = candidate_groups(members.where(compared), rows_in_blocks(sizes.where(compared)), similarity - MARGIN)
        found.append(stored(ties, f"jaccard-ties-{level}"))
        if level < DEPTH:
            nodes = next_nodes(members.where(F.col("size") > SMALL).select("node", "set_id", "tokens"), similarity)
    ties = found[0]
    for more in found[1:]:
        ties = ties.union(more)
    groups = stored(components(ties).select(F.col("id").alias("set_id"), F.col("component").alias("grp")), "jaccard-groups")
    sizes = groups.groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
    members = stored(groups.join(sizes, "grp").join(sets.select("set_id", "copies", "key"), "set_id"), "jaccard-members")
    texts = shingle_sets(docs, members.select("key"), id_col, text_col, size)
    members = members.join(texts, "key").select("grp", "size", "set_id", "copies", "shingles")
    links = stored(exact_links(members, rows_in_blocks(sizes), similarity), "jaccard-links")
    counts = links.groupBy(F.col("a").alias("set_id")).agg(F.sum("n").alias("n"))
    joined = components(links.where("a <> b").select("a", "b")).select(F.col("id").alias("set_id"), "component")
    per_set = sets.select("set_id", "copies", "least").join(counts, "set_id", "left").join(joined, "set_id", "left")
    per_set = per_set.withColumn("component", F.coalesce("component", "set_id"))
    named = per_set.groupBy("component").agg(F.min("least").alias("group"))
    per_set = per_set.join(named, "component").select("set_id", "component", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "group", "least")
    return rows.select("key", "id", "set_id").join(per_set, "set_id")


def group_documents(docs: DataFrame, **options) -> DataFrame:
    """(id, class_id, copy_of, n_links): one row per row of ``docs``.

    ``class_id`` is the smallest doc_id of the group that links connect, ``copy_of`` that of the
    documents with the same shingles; both are the row's own id where it has no words.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    found = similar_sets(docs, **options).select("key", "n_links", "group", "least").distinct()
    own = docs.select(F.col(f"`{id_col}`").alias("id"), document_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")).alias("key"))
    return own.join(found, "key", "left").select(
        "id", F.coalesce("group", "id").alias("class_id"), F.coalesce("least", "id").alias("copy_of"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )


def one_per_group(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of every group: the one of the smallest id.

    Rows without words stay. Of rows that repeat the kept document whole, one stays; a group whose
    ids are all null keeps one document, of the smallest key.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    found = similar_sets(docs, **options)
    # Sums first: a group of any size is one row of ``best``, and the rows of a hot one are split.
    best = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("_first"))
    found = stored(found.join(best, "component"), "jaccard-kept")
    drop = found.where(F.col("_first.key") != F.col("key")).select("key").distinct()
    repeats = found.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    mark = unused(docs, "_key")
    keyed = docs.withColumn(mark, document_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")))
    few = drop.count() <= BROADCAST_KEYS
    drop = drop.withColumnRenamed("key", mark)
    kept = keyed.join(F.broadcast(drop) if few else drop, mark, "left_anti")
    if repeats.isEmpty():
        return kept.drop(mark)
    # Of rows that repeat a document one stays; they are reduced where they are read.
    again = repeats.withColumnRenamed("key", mark)
    once = kept.join(again, mark, "left_semi").dropDuplicates([mark])
    return kept.join(again, mark, "left_anti").unionByName(once).drop(mark)
