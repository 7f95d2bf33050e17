"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words and the five-letter beginnings of longer words, hashed. All
terms of at least ``least_rows`` training rows enter a factorization machine: besides a weight per
term it learns a factor vector per term, and the product of two vectors weighs the pair, so an insult
beside a group's name can count for more than the two alone. A term enters with a value between
``FLOOR`` and 1 that grows with how well it tells the classes apart by itself: a term that is neutral
alone still learns its pairs, and the many chance terms don't drown the few telling ones.

Training takes at most ``most_rows`` labelled rows (chosen by checksum of the id) and, of these, as
many as hold ``most_terms`` terms: a documented bound, so one task fits the machine by full-batch
AdamW, as Spark's ``FMClassifier`` does, without eighty rounds of jobs on the driver. The vocabulary
comes from the same rows. Scoring covers every whole text in Arrow batches: two gathers and a sum per
text.

Defined results: null and empty texts have no terms and get the score of the intercept; without both
classes among the labelled rows every score is the share of the class there is, or 0 without labels;
labels with a null id or class are left out, repeated labels of an id count as toxic if one is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywater.llm.shared import ship, stored, unused

ship(__name__)

BITS = 20
MOST_ROWS = 20_000
MOST_TERMS = 6_000_000
LEAST_ROWS = 4
#: The least value of a term, and how slowly the value grows with a term's standard errors.
FLOOR = 0.02
ERRORS = 3
FACTORS = 4
#: Rounds, step, weight decay and the spread of the first factors.
ROUNDS = 80
STEP = 0.1
DECAY = 1e-4
SPREAD = 0.01
PREFIX = 5
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets(text: str | None) -> np.ndarray:
    """The distinct hashed terms of a text."""
    words = set(WORD.findall(text.lower())) if text else set()
    starts = {w[:PREFIX] + "*" for w in words if len(w) > PREFIX}
    hashed = [crc32(w.encode("utf-8", "surrogatepass")) for w in words | starts]
    return np.unique(np.array(hashed, np.uint32) >> np.uint32(32 - BITS)).astype(np.int32)


@dataclass
class Machine:
    """A trained machine: ``place`` maps buckets to rows of the parameters, -1 for other buckets."""

    place: np.ndarray
    intercept: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, text: str | None) -> float:
        at = self.place[buckets(text)]
        at = at[at >= 0]
        v = self.factors[at]
        pairs = 0.5 * float((v.sum(0) ** 2 - (v**2).sum(0)).sum())
        return float(1 / (1 + np.exp(-np.clip(self.intercept + self.linear[at].sum() + pairs, -60, 60))))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: the checksum of its id is a multiple of 5. A null id isn't."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most_rows: int, most_terms: int, id_col: str, text_col: str) -> DataFrame:
    """(digest, label, terms) of the labelled rows that may be learned from, stored."""
    digest = F.xxhash64("_id")
    chosen = (
        labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("label"))
        .where(F.col("_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.max("label").cast("double").alias("label"))
        .orderBy(digest, "_id")
        .limit(most_rows)
        .withColumn("digest", digest)
    )

    @F.pandas_udf("array<int>")
    def terms(texts: pd.Series) -> pd.Series:
        return pd.Series([buckets(t) for t in texts])

    # The chosen rows are at most ``most_rows`` ids and labels.
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text")).join(F.broadcast(chosen), "_id")
    rows = stored(rows.select("digest", "label", terms("_text").alias("terms")), "toxic-rows")
    # Two numbers for each of the bounded rows: the first digest beyond the bound on terms.
    so_far = F.sum(F.size("terms")).over(Window.partitionBy(F.lit(1)).orderBy("digest"))
    last = rows.select("digest", so_far.alias("n")).where(F.col("n") > most_terms).agg(F.min("digest")).first()[0]
    return rows if last is None else rows.where(F.col("digest") < last)


def valued_terms(rows: DataFrame, n_toxic: int, n_rows: int, least_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """All buckets of ``least_rows`` rows or more, and the value that each enters with.

    The value follows the distance of a bucket's share of toxic rows from the average, in standard errors.
    """
    expected = F.col("n") * (n_toxic / n_rows)
    spread = F.sqrt(expected * (1 - n_toxic / n_rows))
    found = (
        rows.select("label", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic"))
        .where(F.col("n") >= least_rows)
        .select("term", (F.abs(F.col("toxic") - expected) / spread).alias("errors"))
        .toArrow()  # at most 2 ** BITS pairs of numbers
        .sort_by("term")
    )
    errors = found["errors"].to_numpy()
    return found["term"].to_numpy(), np.maximum(FLOOR, (errors / (errors + ERRORS)) ** 4)


def fit(
    label: np.ndarray, row: np.ndarray, term: np.ndarray, value: np.ndarray, *, factors: int = FACTORS, rounds: int = ROUNDS, seed: int = 7
) -> tuple[float, np.ndarray, np.ndarray]:
    """Intercept, weights and factors of a machine for the entries (row, term), by full-batch AdamW.

    A term has the same value in every row, so entries are summed with parameters that are scaled
    once: a row's score is its weights' sum and half of the squares of its factors' sums, less the
    sum of the squares. Each column is one weighted count over the entries.
    """
    n, m = len(label), len(value)
    weights = np.zeros((1 + factors, m))
    weights[1:] = np.random.default_rng(seed).normal(0, SPREAD, (factors, m))
    intercept, state = 0.0, [np.zeros((1 + factors, m)), np.zeros((1 + factors, m)), 0.0, 0.0]
    for t in range(1, rounds + 1):
        scaled = weights * value
        alone = scaled[0] - 0.5 * (scaled[1:] ** 2).sum(0)
        sums = [np.bincount(row, scaled[f][term], n) for f in range(1, 1 + factors)]
        raw = intercept + np.bincount(row, alone[term], n) + 0.5 * sum(s**2 for s in sums)
        error = (1 / (1 + np.exp(-np.clip(raw, -60, 60))) - label) / n
        total = np.bincount(term, error[row], m)
        gradient = np.empty_like(weights)
        gradient[0] = value * total
        for f in range(1, 1 + factors):
            gradient[f] = value * (np.bincount(term, (error * sums[f - 1])[row], m) - scaled[f] * total)
        slope = error.sum()
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.999 * state[1] + 0.001 * gradient**2
        state[2], state[3] = 0.9 * state[2] + 0.1 * slope, 0.999 * state[3] + 0.001 * slope**2
        first, second = 1 - 0.9**t, 1 - 0.999**t
        weights = weights - STEP * (state[0] / first / (np.sqrt(state[1] / second) + 1e-8) + DECAY * weights)
        intercept -= STEP * (state[2] / first / (np.sqrt(state[3] / second) + 1e-8) + DECAY * intercept)
    return intercept, weights[0], weights[1:].T


def train(
    docs: DataFrame, labels: DataFrame, *, most_rows: int = MOST_ROWS, most_terms: int = MOST_TERMS, least_rows: int = LEAST_ROWS,
    id_col: str = "doc_id", text_col: str = "text", seed: int = 7,
) -> Machine:
    """Fit a machine on the labelled rows outside the held-out fold."""
    rows = training_rows(docs, labels, most_rows, most_terms, id_col, text_col)
    n_rows, n_toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    place = np.full(1 << BITS, -1, np.int32)
    if n_toxic in (0, n_rows):
        share = 0.0 if not n_rows else min(max(n_toxic / n_rows, 1e-9), 1 - 1e-9)
        base = -60.0 if share <= 0 else float(np.log(share / (1 - share)))
        return Machine(place, base, np.zeros(0), np.zeros((0, FACTORS)))
    chosen, values = valued_terms(rows, n_toxic, n_rows, least_rows)
    if not len(chosen):
        return Machine(place, float(np.log(n_toxic / (n_rows - n_toxic))), np.zeros(0), np.zeros((0, FACTORS)))
    place[chosen] = np.arange(len(chosen), dtype=np.int32)
    sent = docs.sparkSession.sparkContext.broadcast((place, values))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # One task reads the bounded rows; in the order of their digests, sums don't depend on the files.
        own, value = sent.value
        parts = [(d, y, own[np.asarray(t, np.int64)]) for batch in batches for d, y, t in batch[["digest", "label", "terms"]].itertuples(index=False)]
        if not parts:
            return
        parts.sort(key=lambda p: p[:2])
        kept = [p[2][p[2] >= 0] for p in parts]
        row = np.repeat(np.arange(len(parts)), [len(k) for k in kept])
        label = np.array([p[1] for p in parts])
        del parts
        intercept, linear, factors = fit(label, row, np.concatenate(kept).astype(np.int64), value, seed=seed)
        yield pd.DataFrame({"intercept": [intercept], "linear": [linear.tobytes()], "factors": [np.ascontiguousarray(factors).tobytes()]})

    found = stored(rows.coalesce(1).mapInPandas(learn, "intercept double, linear binary, factors binary"), "toxic-machine").first()
    sent.destroy()
    linear, factors = np.frombuffer(found["linear"]), np.frombuffer(found["factors"]).reshape(-1, FACTORS)
    # Values are part of the parameters from here on.
    return Machine(place, float(found["intercept"]), linear * values, factors * values[:, None])


def score(docs: DataFrame, machine: Machine, *, text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``toxicity``, from 0 to 1."""
    sent = docs.sparkSession.sparkContext.broadcast((machine.place, machine.intercept, machine.linear, machine.factors))

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Machine(*sent.value)
        for texts in batches:
            yield pd.Series([own.score(t) for t in texts], dtype="float64")

    return docs.withColumn(unused(docs, "toxicity"), F.pandas_udf(scores, "double")(F.col(f"`{text_col}`").cast("string")))
