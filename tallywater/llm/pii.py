"""Personal data: candidate spans by high-recall generators, chosen by gradient-boosted trees.

Fixed patterns find the base spans, which always stay. Beside them, looser generators propose
overlapping candidates: addresses written with "(at)" or without a top-level domain, dotted numbers
inside longer ones, card-like windows of a longer chain of digits, telephone numbers without a plus
sign. A candidate's format (length, digits, groups, separators, checksum, ranges, neighbours) and
context (words in front of it) are features of boosted trees (Spark's ``GBTClassifier``). There are no
labels, so they learn from what the base rules decide: base spans, candidates that fail a check,
candidates that belong to a span of another kind, and views of base spans where they stand: loosened
ones that stay personal data (an address with "(at)", a number without its plus, a card in a longer
chain) and look-alikes that are none (a domain without a dot, a date, an amount, a section number).
The threshold of each kind is calibrated on a held-out fifth: the lowest one with the wanted precision.

Every example of every whole text counts: four fifths train the trees, spread over tasks, and all of the
other fifth calibrate the thresholds. Every candidate that the base rules leave open is scored.

Defined results: null and empty texts have no spans; offsets count code points, ends are exclusive;
an added span overlaps neither a base span nor a better added one of the same document; without both
truths among the candidates nothing is added. Rows that repeat are judged alike.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywater.llm.shared import document_key, ship, stored

ship(__name__)

#: Fixed values of the contract: the kinds in their order and the base patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Every span, base or proposed, needs one of these; texts without them are skipped.
HINT = re.compile(r"[0-9@)\]}]")
DIGIT = re.compile(r"[0-9]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOOSE_AT = re.compile(r"[ ]?(?:[(\[{][ ]?at[ ]?[)\]}]|@)[ ]?", re.IGNORECASE)
LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|[ ]?[(\[{][ ]?dot[ ]?[)\]}][ ]?)[A-Za-z0-9-]{1,63}){0,8}", re.IGNORECASE)
DOTTED = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3,}")
LOOSE_PHONE = re.compile(r"(?<![0-9+])(?:00[1-9]|\(?[0-9])[0-9]{1,5}(?:[\x20().-]{1,2}[0-9]{2,5}){1,5}(?![0-9])")
#: Words that stand in front of personal data, one feature per kind.
HINTS = (
    re.compile(r"e-?mail|contact|write|mailto|address", re.IGNORECASE),
    re.compile(r"\bip\b|host|server|login|client", re.IGNORECASE),
    re.compile(r"card|visa|credit|payment|account", re.IGNORECASE),
    re.compile(r"phone|call|tel|mobile|fax|cell", re.IGNORECASE),
)
VERSION = re.compile(r"version|release|\bv\b|section|chapter", re.IGNORECASE)

PRECISION = 0.95
#: Examples that one task learns from.
TASK_ROWS = 50_000
#: Added spans that one call of Python compares.
BUNDLE = 2000


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d)
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the base patterns, in the order of kind and start."""
    if not text:
        return []
    out = []
    if "@" in text:
        end = 0
        at = text.find("@")
        while at >= 0:
            # The longest run of local characters that reaches the sign and starts behind the last match.
            start = at
            while start > end and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
                start -= 1
            found = DOMAIN.match(text, at + 1) if start < at else None
            if found:
                out.append((0, start, found.end()))
                end = found.end()
                at = text.find("@", end)
            else:
                end = max(end, at + 1) if start == at else end
                at = text.find("@", at + 1)
    if not DIGIT.search(text):
        return out
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = digits_of(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(digits_of(m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def proposals(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of the loose generators; spans may overlap."""
    if any(sign in text for sign in "@)]}"):
        for m in LOOSE_AT.finditer(text):
            left, right = LOCAL.search(text, max(0, m.start() - 64), m.start()), LOOSE_DOMAIN.match(text, m.end())
            if left and right:
                yield 0, left.start(), right.end()
    if not DIGIT.search(text):
        return
    if "." in text:
        for m in DOTTED.finditer(text):
            parts = [(p.start(), p.end()) for p in re.finditer(r"[0-9]+", m[0])]
            for a, b in zip(parts, parts[3:]):
                yield 1, m.start() + a[0], m.start() + b[1]
    for m in CARD.finditer(text):
        if m.end() - m.start() < 13:
            continue
        groups = [(g.start(), g.end()) for g in re.finditer(r"[0-9]+", m[0])]
        for k, (start, _) in enumerate(groups):
            held = 0
            for a, b in groups[k : k + 19]:
                held += b - a
                if held > 19:
                    break
                if held >= 13:
                    yield 2, m.start() + start, m.start() + b
    for pattern in (PHONE, LOOSE_PHONE):
        for m in pattern.finditer(text):
            if 7 <= len(digits_of(m[0])) <= 15:
                yield 3, m.start(), m.end()


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a candidate, the same numbers for every kind."""
    span, before, after = text[start:end], text[max(0, start - 32) : start], text[end : end + 1]
    digits = digits_of(span)
    groups = re.findall(r"[0-9]+", span)
    numbers = [min(int(g[:6]), 999_999) for g in groups]
    domain = re.split(r"@|[(\[{]", span)[-1]
    return [
        *[float(kind == k) for k in range(4)],
        float(len(span)), float(len(digits)), float(len(groups)), float(len(span) - len(digits)),
        float(max(map(len, groups), default=0)), float(min(map(len, groups), default=0)), float(max(numbers, default=0)),
        float(bool(digits) and luhn(digits)), float(len(set(digits))), float(digits[:1] or -1),
        float(span.startswith("+")), float(domain.count(".")), float(len(domain.rpartition(".")[2])), float("@" in span),
        float(before[-1:].isalnum()), float(after.isalnum()), float(before[-1:] in "._-") if before else 0.0,
        float(after in "._-") if after else 0.0,
        float(HINTS[kind].search(before) is not None), float(VERSION.search(before) is not None),
    ]


SPANS = "key binary, kind int, s int, e int, base boolean, truth int, x array<double>"


def views(text: str, kind: int, start: int, end: int) -> Iterator[tuple[list[float], int]]:
    """(features, truth) of what a base span could look like in its place."""
    before, span, after = text[max(0, start - 40) : start], text[start:end], text[end : end + 8]
    digits, forms = digits_of(span), []
    if kind == 0:
        local, _, domain = span.rpartition("@")
        sign = (" (at) ", "[at]", " @ ")[len(span) % 3]
        forms = [("", local + sign + domain, "", 1), ("", local + sign + domain.partition(".")[0], "", 0)]
    elif kind == 1:
        # In a longer chain of numbers it is a section or a version.
        forms = [(f"{digits[:1]}.", span, "", 0), ("", span, f".{digits[-1:]}", 0)]
    elif kind == 2:
        other = digits[1:] + digits[:1]
        forms = [("", span, f" {digits[:4]}", 1), (f"{digits[-4:]} ", span, "", 1)] + ([] if luhn(other) else [("", other, "", 0)])
    elif kind == 3:
        date, amount = f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}", f"{digits[:2]}.{digits[2:5]}.{digits[5:8]}"
        forms = [("", span[1:], "", 1), ("", span.partition(" ")[2], "", 1), ("", date, "", 0), ("", amount, "", 0)]
    for head, form, tail, truth in forms:
        if form:
            at = len(before) + len(head)
            yield features(before + head + form + tail + after, kind, at, at + len(form)), truth


def spans_of(docs: DataFrame, text_col: str) -> DataFrame:
    """Base spans and candidates of ``docs`` (key, text): one row each.

    ``truth`` is 1 for base spans, 0 for candidates that a base pattern met and a check refused or that
    lie on a span of another kind, and null where the base rules don't decide. Views of base spans come
    beside, at their place, with a truth: they are learned from and never found.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["key"], batch[text_col]):
                if not text or not HINT.search(text):
                    continue
                base = base_spans(text)
                known = set(base)
                refused = {
                    (k, m.start(), m.end())
                    for k, p in ((1, IP), (2, CARD), (3, PHONE)) for m in p.finditer(text) if m.end() - m.start() >= 7
                } - known
                for k, s, e in base:
                    rows.append((key, k, s, e, True, 1, features(text, k, s, e)))
                    rows.extend((key, k, s, e, False, truth, x) for x, truth in views(text, k, s, e))
                for k, s, e in set(proposals(text)) - known:
                    touched = {b[0] for b in base if b[1] < e and s < b[2]}
                    if k in touched:
                        continue  # a part of a base span, or around one: it can't be added
                    truth = 0 if touched or (k, s, e) in refused else None
                    rows.append((key, k, s, e, False, truth, features(text, k, s, e)))
                if len(rows) > 5000:
                    yield frame(rows)
                    rows = []
            if rows:
                yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["key", "kind", "s", "e", "base", "truth", "x"])
        return out.astype({"truth": "Int32", "kind": "int32", "s": "int32", "e": "int32"})

    return docs.mapInPandas(work, SPANS)


def examples(spans: DataFrame) -> DataFrame:
    """What the trees learn from and are calibrated on: every span whose truth is known, with its number
    of rows. Spans with equal features, kind and truth are one weighted row, so that trees are grown on few.
    """
    held = F.pmod(F.xxhash64("key", "kind", "s", "e"), F.lit(5)) == 0
    known = spans.where("truth IS NOT NULL").select("kind", "x", F.col("truth").cast("double").alias("label"), held.alias("held"))
    return known.groupBy("kind", "x", "label", "held").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def accepted(spans: DataFrame, *, precision: float = PRECISION, seed: int = 5) -> DataFrame:
    """The candidates that the trees accept: (key, kind, s, e, p)."""
    vector = array_to_vector("x").alias("features")
    # Dealt and ordered by what they hold: the same rows meet in the same tasks.
    tasks, order = -(-spans.where("truth IS NOT NULL").count() // TASK_ROWS), ["x", "label", "held", "kind"]
    dealt = examples(spans).repartition(max(1, tasks), *order).sortWithinPartitions(*order)
    known = stored(dealt.select("kind", vector, "label", "held", "weight"), "pii-examples")
    empty = spans.where("false").select("key", "kind", "s", "e", F.lit(0.0).alias("p"))
    split = {(r["held"], r["label"]): r["count"] for r in known.groupBy("held", "label").count().collect()}
    if min(split.get((False, 0.0), 0), split.get((False, 1.0), 0), split.get((True, 1.0), 0)) == 0:
        return empty
    trees = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.3, seed=seed, weightCol="weight").fit(known.where("NOT held"))
    chance = vector_to_array("probability")[1]
    cells = (
        trees.transform(known.where("held"))
        .groupBy("kind", F.floor(chance * 1000).alias("cell"))
        .agg(F.sum("weight").alias("n"), F.sum(F.col("label") * F.col("weight")).alias("right"))
    )
    above = Window.partitionBy("kind").orderBy(F.desc("cell"))
    cut = cells.withColumns({"n": F.sum("n").over(above), "right": F.sum("right").over(above)}).where(
        (F.col("right") >= precision * F.col("n")) & (F.col("right") > 0)
    )
    thresholds = {r["kind"]: r["cell"] / 1000 for r in cut.groupBy("kind").agg(F.min("cell").alias("cell")).collect()}
    if not thresholds:
        return empty
    least = F.element_at(F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair]), F.col("kind"))
    # What a base rule refused is decided; the rest is judged. Few bytes, much work: spread by hand.
    open_ = spans.where("truth IS NULL").repartition(int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    scored = trees.transform(open_.withColumn("features", array_to_vector("x")))
    # A kind without a threshold has a null one and adds nothing.
    return scored.select("key", "kind", "s", "e", chance.alias("p")).where(F.col("p") >= least)


def without_overlaps(found: pd.DataFrame) -> pd.DataFrame:
    """Of every document's spans the added ones that stay: the likeliest first, and none that overlaps a
    base span or one taken before."""
    order = found.sort_values(["key", "base", "p", "s", "e"], ascending=[True, False, False, True, True])
    key, taken, keep = None, [], []
    for row in order.itertuples(index=False):
        if row.key != key:
            key, taken = row.key, []
        at = bisect.bisect_left(taken, (row.s, row.e))
        free = (at == 0 or taken[at - 1][1] <= row.s) and (at == len(taken) or taken[at][0] >= row.e)
        if row.base or free:
            bisect.insort(taken, (row.s, row.e))
            if not row.base:
                keep.append((row.key, row.kind, row.s, row.e))
    return pd.DataFrame(keep, columns=["key", "kind", "s", "e"]).astype({"kind": "int32", "s": "int32", "e": "int32"})


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` in the order of kind and start, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(F.sort_array(spans), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == KINDS.index(kind))).cast("long")


def find_personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, key, base, spans): arrays of (kind, s, e) per row of ``docs``."""
    text = F.col(f"`{text_col}`").cast("string")
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), document_key(F.col(f"`{id_col}`"), text).alias("key"), text.alias("text"))
    found = stored(spans_of(keyed.select("key", "text"), "text"), "pii-spans").distinct()
    added = stored(accepted(found, **options), "pii-added")
    base = found.where("base").select("key", "kind", "s", "e")
    # Only documents with something added are looked at whole, many in one call.
    bundles = max(1, math.ceil(added.count() / BUNDLE))
    close = (
        added.withColumn("base", F.lit(False))
        .unionByName(base.join(added.select("key").distinct(), "key", "left_semi").withColumns({"base": F.lit(True), "p": F.lit(1.0)}))
        .withColumn("bundle", F.pmod(F.xxhash64("key"), F.lit(bundles)))
        .groupBy("bundle")
        .applyInPandas(without_overlaps, "key binary, kind int, s int, e int")
    )
    span = F.struct("kind", "s", "e")
    every = base.withColumn("base", F.lit(True)).unionByName(close.withColumn("base", F.lit(False)))
    per_doc = every.groupBy("key").agg(F.collect_list(F.when(F.col("base"), span)).alias("base"), F.collect_list(span).alias("spans"))
    none = F.array().cast("array<struct<kind:int,s:int,e:int>>")
    return keyed.select("id", "key").join(per_doc, "key", "left").select("id", "key", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def apart(spans: Column) -> Column:
    """Spans (s, e, kind) in order of their start, with those that overlap made one of the first kind."""
    ordered = F.sort_array(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    none = F.array().cast("array<struct<s:int,e:int,kind:int>>")

    def add(done: Column, x: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"), last["kind"].alias("kind"))
        return F.when((F.size(done) > 0) & (last["e"] > x["s"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
            F.concat(done, F.array(x))
        )

    return F.aggregate(ordered, none, add)


def redacted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, text): every chosen span replaced by its kind in brackets; null texts are empty."""
    text = F.col(f"`{text_col}`").cast("string")
    found = find_personal_data(docs, id_col=id_col, text_col=text_col, **options)
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), document_key(F.col(f"`{id_col}`"), text).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    rows = keyed.join(found.select("key", "spans").distinct(), "key").withColumn("spans", apart(F.col("spans")))
    # What stands before every span, the span's name, and what is left behind the last one.
    pieces = F.transform(
        "spans",
        lambda x, i: F.concat(
            F.substring(F.col("text"), F.coalesce(F.get(F.col("spans"), i - 1)["e"], F.lit(0)) + 1, x["s"] - F.coalesce(F.get(F.col("spans"), i - 1)["e"], F.lit(0))),
            F.get(names, x["kind"]),
        ),
    )
    end = F.coalesce(F.get(F.col("spans"), F.size("spans") - 1)["e"], F.lit(0))
    return rows.select("id", F.concat(F.array_join(pieces, ""), F.substring(F.col("text"), end + 1, F.length("text"))).alias("text"))
