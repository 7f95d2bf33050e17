"""The prefix trie of conversations, from padded matrices of turn ids.

A turn's id is a digest of 128 bits of its role and text; a conversation is the sequence of its ids.
Conversations are dealt by range of (sequence, id) to shards of bounded size. A shard lays its
sequences into padded matrices, sorts them with ``lexsort`` and compares each row with the row above;
the change masks, OR-accumulated along the columns, mark where the nodes of every depth start, and
``reduceat`` sums up the members of each. Matrices are cut into blocks of columns that hold only the
rows that reach them, so one very long conversation pads no other.

Nodes that hold neither the first nor the last row of a shard lie in it whole and are done. The
others, a path along the first row and one along the last, may go on in a neighbour: each shard passes
on these two rows with what it summed up at every depth, and the same step runs over all such rows,
in ever fewer shards, until one is left. So a prefix that a third of all conversations share, or as
many copies of one, are spread like any others.

Defined results: turns are in the order of ``turn``, null first, ties by digest; a null role or text
is empty; rows with a null conversation id take no part; repeated rows are turns of their own;
without conversations there are no nodes. Any number of columns may be beside those that are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallywater.llm.shared import ship, stored

ship(__name__)

#: Conversations and turns of a shard; columns of a matrix; ids in one piece of a list of ends.
SHARD = 4096
SHARD_TURNS = 1 << 18
COLUMNS = 32
PIECE = 500
NO_ONE = np.iinfo(np.int64).max
NO_ENDS = hashlib.sha256(b"").hexdigest()

#: What a shard emits: ``kind`` is node (done), path (passed on) or ends (ids of a path's node).
SHARD_ROWS = (
    "kind string, key string, parent_key string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, ends string, "
    "sequence string, sizes array<long>, n array<long>, least array<long>, children array<long>, leaves array<long>, saved array<long>"
)


def sequences(
    conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, turns): every conversation's turns in order, as digest and UTF-8 length of the text."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    turn = F.struct(
        F.col(f"`{turn_col}`").isNotNull().alias("known"), F.col(f"`{turn_col}`").alias("turn"),
        # The length keeps role and text apart.
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    rows = conversations.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("conv_id"), turn.alias("turn"))
    ordered = F.sort_array(F.collect_list("turn"))
    return rows.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns")
    )


def with_shared_openings(turns: DataFrame) -> DataFrame:
    """Fixed rule of the contract: a conversation opens with up to 8 turns of the first of its five."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(9)).cast("int")
    heads = turns.where("conv_id % 5 = 0").select(F.col("conv_id").alias("first"), F.slice("turns", 1, 8).alias("head"))
    here = turns.withColumns({"first": F.col("conv_id") - F.col("conv_id") % 5, "h": h}).join(heads, "first", "left")
    none = F.array().cast("array<struct<digest:string,size:bigint>>")
    opening = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return here.select("conv_id", F.concat(opening, rest).alias("turns"))


def _blocks(flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first column, rows that reach it, padded matrix of their ids) for every block of columns."""
    for first in range(0, int(lengths.max(initial=0)), COLUMNS):
        rows = np.flatnonzero(lengths > first)
        width = int(min(COLUMNS, lengths[rows].max() - first))
        at = offsets[rows, None] + first + np.arange(width)
        inside = first + np.arange(width) < lengths[rows, None]
        yield first, rows, np.where(inside[..., None], flat[np.where(inside, at, 0)], 0)


def _sorted(flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The order of the rows by their ids, shorter before longer, then by ``last``."""
    rank = np.zeros(len(lengths), np.int64)
    for _, rows, matrix in _blocks(flat, offsets, lengths):
        columns = [matrix[:, c, half] for c in range(matrix.shape[1]) for half in (0, 1)]
        order = np.lexsort([*columns[::-1], rank[rows]])
        ordered = matrix[order]
        change = (ordered[1:] != ordered[:-1]).any((1, 2)) | (rank[rows][order][1:] != rank[rows][order][:-1])
        place = np.zeros(len(rank), np.int64)
        place[rows[order]] = np.concatenate([[0], np.cumsum(change)]) + 1
        rank = np.unique(rank * (len(rank) + 1) + place, return_inverse=True)[1]
    return np.lexsort([last, rank])


def _shared_depths(flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many first turns every row shares with the row above it; 0 for the first."""
    shared = np.zeros(len(lengths), np.int64)
    going = np.ones(len(lengths), bool)
    going[:1] = False
    for first, rows, matrix in _blocks(flat, offsets, lengths):
        # A row that has ended differs from its neighbour in every further column.
        above = np.flatnonzero(np.diff(rows, prepend=-2) == 1)
        width = matrix.shape[1]
        differs = np.ones((len(rows), width), bool)
        differs[above] = (matrix[above] != matrix[above - 1]).any(2)
        inside = first + np.arange(width) < lengths[rows, None]
        before = first + np.arange(width) < np.roll(lengths, 1)[rows, None]
        changed = np.logical_or.accumulate(differs | ~inside | ~before | ~going[rows, None], axis=1)
        shared[rows] += (~changed).sum(1)
        still = np.zeros(len(lengths), bool)
        still[rows] = ~changed[:, -1]
        going = still
    return shared


class _Shard:
    """The nodes of one shard's sorted rows, by depth."""

    def __init__(self, rows: pd.DataFrame, merging: bool):
        ids = [np.frombuffer(bytes.fromhex(s), ">u8").astype(np.uint64).reshape(-1, 2) for s in rows["sequence"]]
        lengths = np.array([len(i) for i in ids], np.int64)
        offsets = np.cumsum(lengths) - lengths
        flat = np.concatenate([*ids, np.zeros((1, 2), np.uint64)])
        conv = rows["conv_id"].to_numpy(np.int64)
        order = _sorted(flat, offsets, lengths, conv)
        self.flat, self.offsets, self.lengths = flat, offsets[order], lengths[order]
        self.conv = conv[order]
        self.sequence = rows["sequence"].to_numpy()[order]
        self.sizes = rows["sizes"].to_numpy()[order]
        self.size_at = np.concatenate([*rows["sizes"], [0]]).astype(np.int64)
        self.shared = _shared_depths(self.flat, self.offsets, self.lengths)
        self.merging = merging
        if merging:
            # One entry more than turns: depths count from the root.
            self.carried = {c: np.concatenate(rows[c].to_list()).astype(np.int64) for c in ("n", "least", "children", "leaves", "saved")}
            starts = np.cumsum(lengths + 1) - (lengths + 1)
            self.carried_at = starts[order]

    def depths(self) -> list[dict[str, np.ndarray]]:
        """For every depth its nodes: first row and what their members carry or add up to."""
        out = []
        alive = np.arange(len(self.lengths))
        for depth in range(int(self.lengths.max(initial=0)) + 1):
            alive = alive[self.lengths[alive] >= depth]
            starts = np.flatnonzero((self.shared[alive] < depth) | (alive == 0))
            level = {"alive": alive, "starts": starts, "row": alive[starts], "last": alive[np.append(starts[1:], len(alive)) - 1]}
            if self.merging:
                at = self.carried_at[alive] + depth
                level["n"] = np.add.reduceat(self.carried["n"][at], starts)
                level["least"] = np.minimum.reduceat(self.carried["least"][at], starts)
                for name in ("children", "leaves", "saved"):
                    level[name] = np.add.reduceat(self.carried[name][at], starts)
            else:
                level["n"] = np.add.reduceat(np.ones(len(alive), np.int64), starts)
                level["least"] = np.minimum.reduceat(self.conv[alive], starts)
                level |= {name: np.zeros(len(starts), np.int64) for name in ("children", "leaves", "saved")}
            # The last turn's bytes: those of any member's turn at this depth.
            level["bytes"] = self.size_at[self.offsets[level["row"]] + depth - 1] if depth else np.zeros(1, np.int64)
            out.append(level)
        return out

    def key(self, row: int, depth: int) -> str:
        """A name for the node of ``row`` at ``depth`` that all shards agree on."""
        return hashlib.blake2b(self.sequence[row][: 32 * depth].encode(), digest_size=16).hexdigest()

    def ends(self, level: dict[str, np.ndarray], depth: int, node: int) -> np.ndarray:
        """The ids of the node's members that end in it, ascending."""
        row = level["row"][node]
        stop = level["last"][node] + 1
        # Rows that end here sort before the node's longer ones.
        count = np.searchsorted(self.lengths[row:stop] > depth, True)
        return self.conv[row : row + count]


def _joined(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def _reduce(rows: pd.DataFrame, merging: bool, whole: bool) -> Iterator[dict]:
    """The rows that one shard emits; in a ``whole`` one all nodes are done."""
    shard = _Shard(rows, merging)
    levels = shard.depths()
    last_row = len(shard.lengths) - 1
    for depth, level in enumerate(levels):
        level["path"] = np.zeros(len(level["row"]), bool)
        if not whole:
            level["path"] = (level["row"] == 0) | (level["last"] == last_row)
        if depth:
            above = levels[depth - 1]
            level["parent"] = np.searchsorted(above["row"], level["row"], side="right") - 1
    for depth in range(len(levels) - 1, -1, -1):
        level, done = levels[depth], ~levels[depth]["path"]
        level["leaves"] = np.where(done & (level["children"] == 0), 1, level["leaves"])
        level["saved"] = level["saved"] + np.where(done, (level["n"] - 1) * level["bytes"], 0)
        if depth:
            # Nodes of a path count where the paths are merged.
            above, parent = levels[depth - 1], level["parent"]
            np.add.at(above["children"], parent[done], 1)
            np.add.at(above["leaves"], parent[done], level["leaves"][done])
            np.add.at(above["saved"], parent[done], level["saved"][done])
    for depth, level in enumerate(levels):
        for node in range(len(level["row"])):
            row = level["row"][node]
            path = level["path"][node]
            name = shard.key(row, depth) if path or merging else None
            if not merging and path:
                ids = shard.ends(level, depth, node)
                for first in range(0, len(ids), PIECE):
                    yield {"kind": "ends", "key": name, "conv_id": int(ids[first]), "ends": _joined(ids[first : first + PIECE])}
            if path:
                continue
            node_row = {
                "kind": "node", "key": name, "conv_id": int(level["least"][node]), "depth": depth, "n_convs": int(level["n"][node]),
                "n_children": int(level["children"][node]), "n_leaves": int(level["leaves"][node]), "saved_tokens": int(level["saved"][node]),
            }
            if not merging:
                node_row["ends_sha256"] = hashlib.sha256(_joined(shard.ends(level, depth, node)).encode()).hexdigest()
            if depth:
                above, parent = levels[depth - 1], level["parent"][node]
                if above["path"][parent]:
                    node_row["parent_key"] = shard.key(row, depth - 1)
                else:
                    node_row["parent_conv_id"] = int(above["least"][parent])
            yield node_row
    if not whole and last_row >= 0:
        yield from _paths(shard, levels, last_row)


def _paths(shard: _Shard, levels: list[dict[str, np.ndarray]], last_row: int) -> Iterator[dict]:
    """The first and last row with the sums of their nodes; nodes on both paths count with the first."""
    common = 0
    if last_row:
        for depth in range(1, int(min(shard.lengths[0], shard.lengths[last_row])) + 1):
            if levels[depth]["row"][0] != 0 or levels[depth]["last"][0] != last_row:
                break
            common = depth
    for row in sorted({0, last_row}):
        if row and common == shard.lengths[0] == shard.lengths[row]:
            return
        sums: dict[str, list[int]] = {c: [] for c in ("n", "least", "children", "leaves", "saved")}
        for depth in range(int(shard.lengths[row]) + 1):
            level = levels[depth]
            node = 0 if not row else len(level["row"]) - 1
            counted = not row or depth > common
            for name, values in sums.items():
                values.append(int(level[name][node]) if counted else NO_ONE if name == "least" else 0)
        yield {"kind": "path", "conv_id": int(shard.conv[row]), "sequence": shard.sequence[row], "sizes": shard.sizes[row], **sums}


def _in_shards(rows: DataFrame, merging: bool, shards: int) -> DataFrame:
    """All that the shards of ``rows`` emit, stored."""
    whole = shards == 1
    names = [f.split()[0] for f in SHARD_ROWS.split(", ")]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]  # a shard's rows: its size is bounded
        if parts:
            found = []
            for row in _reduce(pd.concat(parts, ignore_index=True), merging, whole):
                found.append(row)
                if len(found) == 2000:
                    yield _frame(found, names)
                    found = []
            yield _frame(found, names)

    dealt = rows.coalesce(1) if whole else rows.repartitionByRange(shards, "sequence", "conv_id")
    return stored(dealt.mapInPandas(work, SHARD_ROWS), "trie-shards")


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    """Columns of plain objects: a missing number or list is null."""
    return pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype=object) for n in names})


def _shards(rows: DataFrame, shard: int, turns: Column) -> int:
    n, n_turns = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(turns), F.lit(0))).first()
    return max(1, math.ceil(n / shard), math.ceil(n_turns / SHARD_TURNS))


def _hashed_ends(pieces: DataFrame) -> DataFrame:
    """(key, ends_sha256) of lists of ids that came in pieces, read in order and hashed as they come."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for batch in batches:
            done = []
            for name, ends in zip(batch["key"], batch["ends"]):
                if name != key:
                    if state:
                        done.append((key, state.hexdigest()))
                    key, state = name, hashlib.sha256()
                    state.update(ends.encode())
                else:
                    state.update(b"," + ends.encode())
            yield pd.DataFrame(done, columns=["key", "ends_sha256"])
        if state:
            yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "ends_sha256"])

    ordered = pieces.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ends")
    return ordered.mapInPandas(work, "key string, ends_sha256 string")


def prefix_trie(turns: DataFrame, *, shard: int = SHARD) -> DataFrame:
    """One row per node of the trie over ``turns`` (conv_id, turns), as ``sequences`` returns them."""
    rows = stored(
        turns.select(
            "conv_id", F.array_join(F.transform("turns", lambda t: t["digest"]), "").alias("sequence"),
            F.transform("turns", lambda t: t["size"]).alias("sizes"),
        ),
        "trie-sequences",
    )
    n_turns = F.size("sizes") + 1
    count = _shards(rows, shard, n_turns)
    first = _in_shards(rows, False, count)
    nodes = first.where("kind = 'node'")
    columns = ("key", "parent_key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    if count == 1:
        return _result(nodes.select(*columns))
    merged, paths = None, first
    while count > 1:
        paths = paths.where("kind = 'path'").select("conv_id", "sequence", "sizes", "n", "least", "children", "leaves", "saved")
        # Every shard passes on two rows at most: there are ever fewer.
        count = min(_shards(paths, shard, n_turns), max(1, count // 2))
        paths = _in_shards(paths, True, count)
        here = paths.where("kind = 'node'").select(*columns)
        merged = here if merged is None else merged.unionByName(here)
    ends = _hashed_ends(first.where("kind = 'ends'").select("key", "conv_id", "ends"))
    merged = merged.drop("ends_sha256").join(ends, "key", "left").fillna({"ends_sha256": NO_ENDS})
    merged = stored(merged, "trie-paths")
    every = nodes.select(*columns).unionByName(merged)
    named = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_named"))
    pending = every.where("parent_key IS NOT NULL").join(named, "parent_key").withColumn("parent_conv_id", F.col("_named")).drop("_named")
    return _result(every.where("parent_key IS NULL").unionByName(pending))


def _result(nodes: DataFrame) -> DataFrame:
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
