"""Periodic runs of words, found online by catchers over completed power-of-two blocks.

Words are appended one after the other. At every moment each level k has one live catcher: the block
of 2**k words that was completed last before the current one. It waits for its first word to come
again at a distance from 2**k up to 2**(k+1) - 1. Then the distance is a suspected period: the match
is extended to the left once, and every appended word advances its suffix comparison by one step,
until a word differs. What was matched is a chain of squares, merged as it grows: a distance that is
already followed is not followed twice, and a multiple of a period that covers the block is the same
run. A run of period q and at least 4q words holds a whole aligned block of the largest power of two
up to q and that block's copy q words later, so no run is missed.

Texts are independent: they are read in Arrow batches, nothing is shuffled, and the memory of a
text's state is its words.

Defined results: a null or empty text has no words and no runs; words are separated by spaces, tabs
and line breaks (ASCII); repeated rows get equal results; a null id passes through. Other columns
pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallywater.llm.shared import ship, unused

ship(__name__)

LEAST = 6
EXPONENT = 4
#: Rewrites a text's words by its id before runs are sought.
Prepare = Callable[[object, list[bytes]], list[bytes]]


class SquareCatcher:
    """Runs of at least ``least`` words and ``exponent`` periods in a growing list of words."""

    def __init__(self, least: int = LEAST, exponent: int = EXPONENT):
        if exponent < 4:
            raise ValueError("blocks are only sure to lie in runs of four periods or more")
        self.least, self.exponent = least, exponent
        self.words: list[Hashable] = []
        #: By level, the first word of the live catcher's block.
        self.firsts: list[Hashable] = []
        #: Periods that hold up to the last word, with the start of what they hold for.
        self.active: dict[int, int] = {}
        self.found: list[tuple[int, int, int]] = []

    def extend(self, words: Iterable[Hashable]) -> None:
        """Append words: close the periods that they break, follow the distances that they suggest."""
        text, firsts, active = self.words, self.firsts, self.active
        x = len(text)
        for word in words:
            if active:
                for q in [q for q in active if text[x - q] != word]:
                    self._close(q, x)
            text.append(word)
            if x:
                low = x & -x
                if low == x:
                    firsts.append(text[0])
                # The blocks that end before x: they are the live ones of their levels from now on.
                step = 1
                for level in range(low.bit_length()):
                    firsts[level] = text[x - step]
                    step += step
                if word in firsts:
                    for level, first in enumerate(firsts):
                        if first == word:
                            q = x - (((x >> level) - 1) << level)
                            if q not in active:
                                self._follow(q, x)
            x += 1

    def _follow(self, q: int, x: int) -> None:
        text, start = self.words, x - q
        if any(q % p == 0 and s <= start for p, s in self.active.items()):
            return
        while start and text[start - 1] == text[start - 1 + q]:
            start -= 1
        self.active[q] = start

    def _close(self, q: int, end: int) -> None:
        start = self.active.pop(q)
        if end - start >= max(self.least, self.exponent * q) and self._primitive(start, q):
            self.found.append((start, end - start, q))

    def _primitive(self, start: int, q: int) -> bool:
        period = self.words[start : start + q]
        return not any(q % d == 0 and period[d:] == period[:-d] for d in range(1, q // 2 + 1))

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs of the words so far, by start, then period."""
        still = [
            (s, len(self.words) - s, q)
            for q, s in self.active.items()
            if len(self.words) - s >= max(self.least, self.exponent * q) and self._primitive(s, q)
        ]
        return sorted(self.found + still, key=lambda r: (r[0], r[2]))


def numbered(words: list[bytes]) -> list[int]:
    """A number per word, equal for equal words: numbers are faster to compare."""
    known: dict[bytes, int] = {}
    return [known.setdefault(w, len(known)) for w in words]


def runs_of(words: list[bytes], least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    catcher = SquareCatcher(least, exponent)
    catcher.extend(numbered(words))
    return catcher.runs()


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    kept = bytearray(b"\x01") * len(words)
    for start, length, period in runs:
        kept[start + period : start + length] = bytes(length - period)
    return [w for w, k in zip(words, kept) if k]


def with_periodic_tail(doc_id: object, words: list[bytes]) -> list[bytes]:
    """Fixed rule of the contract: one text in ten repeats a part of itself up to its end."""
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a : a + p]
    return words[:a] + (tail * ((n - a) // p + 1))[: n - a]


def find_runs(
    docs: DataFrame, *, least: int = LEAST, exponent: int = EXPONENT, prepare: Prepare | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` with the column ``runs``: n_words, runs (start, length, period) and the collapsed text.

    A run is a stretch of at least ``least`` words and ``exponent`` times its smallest period that
    can't be extended; the collapsed text keeps one period of each, its words joined by one space.
    """

    def found(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in batches:
            rows = []
            for doc_id, text in zip(ids, texts):
                # Bytes are split at ASCII blanks only.
                words = text.encode("utf-8", "surrogatepass").split() if text else []
                if prepare:
                    words = prepare(doc_id, words)
                runs = runs_of(words, least, exponent)
                left = b" ".join(collapsed(words, runs)).decode("utf-8", "surrogatepass")
                rows.append((len(words), *([r[i] for r in runs] for i in range(3)), left))
            yield pd.DataFrame(rows, columns=["n_words", "start", "length", "period", "collapsed"])

    types = "n_words long, start array<long>, length array<long>, period array<long>, collapsed string"
    out, raw = unused(docs, "runs"), unused(docs, "found")
    # As text, a null id stays null and a whole number stays whole.
    here = F.pandas_udf(found, types)(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").cast("string"))
    result = F.struct(
        F.col(f"{raw}.n_words"), F.arrays_zip(F.col(f"{raw}.start"), F.col(f"{raw}.length"), F.col(f"{raw}.period")).alias("runs"),
        F.col(f"{raw}.collapsed"),
    )
    return docs.withColumn(raw, here).select(*[F.col(f"`{c}`") for c in docs.columns], result.alias(out))
