"""Exact token counts of every prefix by dynamic programming, for a piece BPE with byte fallback.

The tokenizer writes a space as the marker ``▁`` (and one in front of the text) and merges the pair
with the best score until none is left. Two facts make every prefix countable without encoding it:

* the last token of a prefix follows from shorter prefixes: of the pieces that end there, exactly one
  may stand behind the last token of the prefix before it, so ``count[i] = count[i - len] + 1``;
* no piece has a marker behind another character, so texts fall into units that start at a marker,
  and a text's prefix counts are running sums over units.

Whether one token may stand behind another is decided by the merges along their touching edges, from
a table of every piece's last merge; it never needs the text. Units are solved many at a time with
numpy, and a task keeps each distinct unit's counts. Runs of markers merge after everything else, so
their counts are a table by length.

Defined results: null and empty texts have no tokens; characters without a piece count as their
UTF-8 bytes; the tokenizer's special strings are ordinary text; a text of any length is counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallywater.llm.shared import ship, unused

ship(__name__)

MARK = "▁"
#: The base of the rolling hash that names strings; checked to keep the pieces of a model apart.
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Longer units are solved one character after the other instead of in a matrix.
LONG = 48
NEVER = np.int64(2**40)


def hashes(codes: np.ndarray) -> np.ndarray:
    """Rolling hashes of all prefixes of every row; column 0 is the empty one."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(codes.shape[1]):
            out[:, i + 1] = out[:, i] * BASE + codes[:, i] + np.uint64(1)
    return out


def powers(n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out[i + 1] = out[i] * BASE
    return out


def codes_of(texts: list[str], width: int) -> np.ndarray:
    return np.frombuffer("".join(t.ljust(width, "\0") for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(texts), width).astype(np.uint64)


@dataclass
class Merges:
    """What the counting needs of a model, as plain arrays (about 2 MB, sent with the task)."""

    pieces: list[str]
    rank: np.ndarray  # of the merge that makes a piece; characters have -1
    left: np.ndarray  # the two parts of a piece's last merge; -1 for characters
    right: np.ndarray
    runs: list[int]  # tokens of a run of n markers; longer runs repeat the longest piece
    longest_run: int

    @classmethod
    def of_model(cls, path: str) -> "Merges":
        """Reads a sentencepiece model; raises if its pieces don't have the form the method needs."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        pieces = [sp.id_to_piece(i) for i in plain]
        score = {p: sp.get_score(i) for p, i in zip(pieces, plain)}
        runs = {p for p in pieces if set(p) == {MARK} and len(p) > 1}
        pieces = [p for p in pieces if p not in runs]
        if any(MARK in p[1:] for p in pieces) or any(score[r] >= min(score[p] for p in pieces if len(p) > 1) for r in runs):
            raise ValueError("pieces with a marker behind other characters are not supported")
        order = {p: k for k, p in enumerate(sorted((p for p in pieces if len(p) > 1), key=lambda p: -score[p]))}
        if len({score[p] for p in order}) != len(order):
            raise ValueError("two merges share a score")
        number = {p: k for k, p in enumerate(pieces)}
        rank = np.array([order.get(p, -1) for p in pieces], np.int64)
        left, right = np.full(len(pieces), -1, np.int64), np.full(len(pieces), -1, np.int64)
        for k, p in enumerate(pieces):
            if len(p) > 1:
                a, b = _last_merge(p, order)
                if a is None:  # the merges never make this piece
                    rank[k] = NEVER
                else:
                    left[k], right[k] = number[a], number[b]
                    if max(rank_of(order, a), rank_of(order, b)) >= order[p]:
                        raise ValueError("a merge comes before its parts")
        longest = max((len(r) for r in runs), default=1)
        counts = [0] + [len(sp.encode(" " * (n - 1) + "\n")) - 1 for n in range(1, 4 * longest + 1)]
        return cls(pieces, rank, left, right, counts, longest)

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted hashes of the pieces, their numbers, and every piece's own hash and length."""
        width = max(map(len, self.pieces))
        length = np.array([len(p) for p in self.pieces], np.int64)
        own = hashes(codes_of(self.pieces, width))[np.arange(len(self.pieces)), length]
        usable = np.flatnonzero(self.rank < NEVER)
        order = usable[np.argsort(own[usable], kind="stable")]
        if len(np.unique(own)) != len(own):
            raise ValueError("two pieces share a hash")
        return own[order], order, own, length

    @cached_property
    def power(self) -> np.ndarray:
        return powers(2 * max(map(len, self.pieces)))

    @cached_property
    def tops(self) -> np.ndarray:
        """Which leading 20 bits the pieces' hashes have: most strings are no piece by that alone."""
        seen = np.zeros(1 << 20, bool)
        seen[self.table[0] >> np.uint64(44)] = True
        return seen

    def number(self, wanted: np.ndarray) -> np.ndarray:
        """The pieces that have these hashes, -1 for none."""
        keys, order, _, _ = self.table
        out = np.full(len(wanted), -1, np.int64)
        maybe = np.flatnonzero(self.tops[wanted >> np.uint64(44)])
        wanted = wanted[maybe]
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        out[maybe] = np.where(keys[at] == wanted, order[at], -1)
        return out

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges leave tokens ``a`` and ``b`` side by side.

        Walks both touching edges from the tokens down to characters. At every step the part that
        was made later is undone; if the pair before it is a piece that is made earlier than what
        consumes either part, the merges would have joined across the edge. Of equal merges the left
        one comes first.
        """
        _, _, own, length = self.table
        a, b = a.copy(), b.copy()
        ok = np.ones(len(a), bool)
        before_a, before_b = np.full(len(a), NEVER), np.full(len(a), NEVER)  # the merges that consume a and b
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            with np.errstate(over="ignore"):
                joined = self.number(own[x] * self.power[length[y]] + own[y])
            made = np.where(joined >= 0, self.rank[joined], NEVER)
            crossed = (made < before_a[live]) & (made <= before_b[live]) & (made < NEVER)
            ok[live[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            undo_a = rx > ry
            undo_b = ~undo_a & (ry >= 0)
            before_a[live[undo_a]] = rx[undo_a]
            a[live[undo_a]] = self.right[x[undo_a]]
            before_b[live[undo_b]] = ry[undo_b]
            b[live[undo_b]] = self.left[y[undo_b]]
            live = live[~crossed & (undo_a | undo_b)]
        return ok


def rank_of(order: dict[str, int], piece: str) -> int:
    return order.get(piece, -1)


def _last_merge(piece: str, order: dict[str, int]) -> tuple[str | None, str | None]:
    """The two parts of ``piece`` when its characters are merged by rank, or nothing if they stop early."""
    parts = list(piece)
    while len(parts) > 2:
        ranks = [order.get(x + y, NEVER) for x, y in zip(parts, parts[1:])]
        at = min(range(len(ranks)), key=ranks.__getitem__)
        if ranks[at] == NEVER:
            return None, None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else (None, None)


class Counter:
    """Prefix counts of units, kept for the life of a task."""

    def __init__(self, merges: Merges) -> None:
        self.m = merges
        self.width = max(map(len, merges.pieces))
        self.known_keys = np.zeros(0, np.int64)
        self.known = np.zeros(0, bool)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``may_follow`` with a memory of the pairs that were asked before."""
        keys = a * len(self.m.pieces) + b
        distinct, back = np.unique(keys, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known_keys, distinct), max(len(self.known_keys) - 1, 0))
        new = distinct if not len(self.known_keys) else distinct[self.known_keys[at] != distinct]
        if len(new):
            got = self.m.may_follow(new // len(self.m.pieces), new % len(self.m.pieces))
            where = np.searchsorted(self.known_keys, new)
            self.known_keys, self.known = np.insert(self.known_keys, where, new), np.insert(self.known, where, got)
            at = np.searchsorted(self.known_keys, distinct)
        return self.known[at][back]

    def solve(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For units of at most ``LONG`` characters: counts of all prefixes, and whether the first
        token of the prefix is its first character alone. Row per unit, column per prefix length."""
        n = max(map(len, units))
        codes = codes_of(units, n)
        prefix, power, m = hashes(codes), powers(self.width), self.m
        size = len(units)
        last = np.full((size, n + 1), -2, np.int64)  # -2: nothing, or bytes; any piece may follow
        count = np.zeros((size, n + 1), np.int64)
        alone = np.zeros((size, n + 1), bool)
        lengths = np.array([len(u) for u in units])
        for i in range(1, n + 1):
            open_ = np.flatnonzero(lengths >= i)
            for k in range(min(self.width, i), 0, -1):
                if not len(open_):
                    break
                with np.errstate(over="ignore"):
                    tok = m.number(prefix[open_, i] - prefix[open_, i - k] * power[k])
                rows = open_[tok >= 0]
                tok = tok[tok >= 0]
                before = last[rows, i - k]
                fits = before == -2
                ask = np.flatnonzero(~fits)
                if len(ask):
                    fits[ask] = self.pairs(before[ask], tok[ask])
                rows, tok = rows[fits], tok[fits]
                last[rows, i] = tok
                count[rows, i] = count[rows, i - k] + 1
                alone[rows, i] = (k == 1) if i == k else alone[rows, i - k]
                open_ = np.setdiff1d(open_, rows, assume_unique=True)
            if len(open_):  # no piece: the character's bytes
                c = codes[open_, i - 1]
                count[open_, i] = count[open_, i - 1] + 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
                alone[open_, i] = True if i == 1 else alone[open_, i - 1]
        return count, alone

    def solve_long(self, unit: str) -> tuple[np.ndarray, np.ndarray]:
        """The same for one unit of any length, character after character."""
        number = self.numbers
        last, count, alone = [-2], [0], [False]
        for i in range(1, len(unit) + 1):
            for k in range(min(self.width, i), 0, -1):
                tok = number.get(unit[i - k : i])
                if tok is not None and (last[i - k] == -2 or self.follows(last[i - k], tok)):
                    last.append(tok)
                    count.append(count[i - k] + 1)
                    alone.append(k == 1 if i == k else alone[i - k])
                    break
            else:
                last.append(-2)
                count.append(count[i - 1] + len(unit[i - 1].encode("utf-8", "surrogatepass")))
                alone.append(True if i == 1 else alone[i - 1])
        return np.array(count), np.array(alone)

    @cached_property
    def numbers(self) -> dict[str, int]:
        return {p: k for k, p in enumerate(self.m.pieces) if self.m.rank[k] < NEVER}

    @cached_property
    def asked(self) -> dict[tuple[int, int], bool]:
        return {}

    def follows(self, a: int, b: int) -> bool:
        if (a, b) not in self.asked:
            self.asked[a, b] = bool(self.m.may_follow(np.array([a]), np.array([b]))[0])
        return self.asked[a, b]

    def run(self, n: int) -> int:
        """Tokens of ``n`` markers in a row, before a character that they don't join."""
        m = self.m
        if n < len(m.runs):
            return m.runs[n]
        whole = (n - len(m.runs) + m.longest_run) // m.longest_run
        return whole + m.runs[n - whole * m.longest_run]

    def batch(self, units: list[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """(unit, counts of its prefixes 0 to n, alone); each unit opens with at most one marker."""
        short = sorted((u for u in units if len(u) <= LONG), key=len)
        for at in range(0, len(short), 20_000):
            part = short[at : at + 20_000]
            count, alone = self.solve(part)
            yield from zip(part, count, alone)
        for u in units:
            if len(u) > LONG:
                yield (u, *self.solve_long(u))


def totals(counter: Counter, memory: dict[str, int], apart: set[str], texts: list[str | None]) -> list[int]:
    """The tokens of whole texts: the count at the last prefix of every unit, summed.

    ``memory`` and ``apart`` are filled: counts of units, and units that leave their marker alone.
    """
    split = [t.replace(MARK, " ").split(" ") if t else [] for t in texts]
    new = set().union(*split).difference(memory)
    new.discard("")
    for unit, count, alone in counter.batch([MARK + u for u in new]):
        memory[unit[1:]] = int(count[len(unit)])
        if alone[len(unit)]:
            apart.add(unit[1:])
    out = []
    for units in split:
        if "" not in units:
            out.append(sum(map(memory.__getitem__, units)))
            continue
        total = markers = 0
        for u in units:
            markers += 1
            if u:
                total += memory[u]
                if markers > 1:
                    total += counter.run(markers) - 1 if u in apart else counter.run(markers - 1)
                markers = 0
        out.append(total + counter.run(markers))
    return out


def prefix_counts(counter: Counter, text: str | None) -> np.ndarray:
    """The token count of every prefix of ``text``, by code points; entry 0 is the empty prefix's."""
    if not text:
        return np.zeros(1, np.int64)
    units = text.replace(MARK, " ").split(" ")
    solved = {u[1:]: (c, a) for u, c, a in counter.batch(list({MARK + u for u in units if u}))}
    out, total, markers = [0], 0, 0
    for k, u in enumerate(units):
        markers += 1
        if k:
            out.append(total + counter.run(markers))
        if u:
            count, alone = solved[u]
            count, alone = count[2 : len(u) + 2], alone[2 : len(u) + 2]
            if markers > 1:
                count = count + np.where(alone, counter.run(markers) - 1, counter.run(markers - 1))
            out.extend((total + count).tolist())
            total = out[-1]
            markers = 0
    return np.array(out)


def longest_within(counts: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix with at most ``budget`` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1]) if budget >= 0 else 0


#: Distinct units that a task remembers; beyond that it starts afresh.
REMEMBERED = 1_000_000


def count_tokens(docs: DataFrame, model: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``tokens`` (long): the count at the last prefix of each text."""
    merges, out = Merges.of_model(model), unused(docs, "tokens")

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter, memory, apart = Counter(merges), {}, set()
        for texts in batches:
            if len(memory) > REMEMBERED:
                memory, apart = {}, set()
            yield pd.Series(totals(counter, memory, apart, texts.tolist()), dtype="int64")

    return docs.withColumn(out, F.pandas_udf(count, "long")(F.col(f"`{text_col}`").cast("string")))


def prefix_table(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, counts): the exact count at every prefix, to be stored and asked by ``within_budget``."""
    merges = Merges.of_model(model)

    def table(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(merges)
        for texts in batches:
            yield pd.Series([prefix_counts(counter, t).astype(np.int32) for t in texts])

    counts = F.pandas_udf(table, "array<int>")(F.col(f"`{text_col}`").cast("string"))
    return docs.select(F.col(f"`{id_col}`").alias("id"), counts.alias("counts"))


def within_budget(table: DataFrame, budget: int) -> DataFrame:
    """(id, code_points, tokens): the longest prefix within ``budget``, read from the stored counts."""
    fits = F.filter(F.transform("counts", lambda n, i: F.struct(i.alias("i"), n.alias("n"))), lambda p: p["n"] <= budget)
    last = F.element_at(fits, -1)
    return table.select("id", last["i"].alias("code_points"), last["n"].alias("tokens"))
