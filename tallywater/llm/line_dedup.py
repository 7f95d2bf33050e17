"""Line deduplication by a segment-partition edit join (DataFrame operations only).

Lines that equal an earlier line, or differ from one by at most ``edits`` edits, go. Distinct lines
are joined as in Pass-Join: a line is split into ``edits + 1`` segments, one of which a similar line
holds unchanged; a longer (or equally long) line probes, for every length it may match, those of its
substrings that the multi-match-aware bounds leave. Index and probes meet on one digest of length,
segment number and segment, and keep no text. Lines that meet are compared block by block: their
letters must agree but for two per edit, what both start and end with is left out, the inside of the
rest must occur in the other line, and a banded bit-parallel edit distance of the rest decides. Only
the later line of a pair comes out.

"Earlier" is by doc_id, then line number; documents whose id is null or no whole number come last, by
a digest. Copies of a line count by their first one. A line goes if any earlier distinct line is that close, also one that goes itself.

Nothing is grouped by line content beyond sums: copies are counted with partial sums, and a line
takes part in the join once. The table of lines to drop is broadcast while it has at most
``BROADCAST_LINES`` rows; beyond that it is joined by shuffle.

Defined results: lines end at ``\\n``; empty lines stay, and lines of fewer than ``least``
characters unless their exact copies are asked for (``exact_from``); null texts stay
null and have no lines; a text that loses all lines is empty; rows that repeat an id and text lose
the same lines; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallywater.llm.shared import document_key, stored, unused

EDITS = 2
LEAST = 20
PIECES = 4
#: Lines of a block when lines that share a segment are compared.
BLOCK = 64
BROADCAST_LINES = 500_000


def lines_of(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """(key, line_no, line, chars, h1, h2, place): ``place`` orders all lines, with no ties but of rows
    that repeat an id and text."""
    text, doc_id = F.col(f"`{text_col}`").cast("string"), F.col(f"`{id_col}`")
    rows = docs.select(document_key(doc_id, text).alias("key"), doc_id.cast("string").try_cast("decimal(19,0)").alias("doc"), text.alias("text"))
    # Ids that are no whole numbers follow all that are, in the order of a digest of their texts.
    spread = lambda n: F.pmod(F.xxhash64("text"), F.lit(n)).cast("decimal(20,0)")
    doc = F.coalesce("doc", spread(10**18) + F.lit("2" + "0" * 19).cast("decimal(20,0)")).cast("decimal(20,0)")
    # The numbers of a document are wide; they are multiplied once, its lines only add to them.
    rows = rows.withColumn("start", ((doc * 4294967296).cast("decimal(30,0)") * 100000000 + spread(10**8)).cast("decimal(38,0)"))
    each = rows.select("key", "start", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return each.withColumn("chars", F.length("line")).where(F.col("chars") >= least).select(
        "key", "line_no", "line", "chars", F.xxhash64("line").alias("h1"), F.xxhash64("line", F.lit(1)).alias("h2"),
        (F.col("start") + (F.col("line_no").cast("long") * 100000000).cast("decimal(20,0)")).cast("decimal(38,0)").alias("place"),
    )


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (from stored tables) marked for broadcast while it has at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def segment(chars: Column, parts: int, i: Column) -> tuple[Column, Column]:
    """Start (from 1) and length of segment ``i`` of a line; the last ones are one longer if need be."""
    short = F.floor(chars / parts).cast("int")
    long_from = F.lit(parts) - F.pmod(chars, F.lit(parts)).cast("int")
    return 1 + i * short + F.greatest(i - long_from, F.lit(0)), short + (i >= long_from).cast("int")


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(shorter by, segment, shift) of the substrings that the multi-match-aware bounds leave."""
    return [
        (less, i, shift)
        for less in range(edits + 1)
        for i in range(edits + 1)
        for shift in range(max(-i, less - (edits - i)), min(i, less + edits - i) + 1)
    ]


def index_rows(lines: DataFrame, edits: int) -> DataFrame:
    """(b, probe): a digest of length, number and text of every segment of every line."""
    each = lines.select(F.col("h1").alias("b"), "line", "chars", F.explode(F.array(*[F.lit(i) for i in range(edits + 1)])).alias("i"))
    start, length = segment(F.col("chars"), edits + 1, F.col("i"))
    return each.select("b", F.xxhash64("chars", "i", F.col("line").substr(start, length)).alias("probe"))


def probe_rows(lines: DataFrame, edits: int, least: int) -> DataFrame:
    """(a, probe): what to look up for every length from ``chars - edits`` to ``chars``."""
    specs = F.array(*[F.struct(F.lit(a).alias("less"), F.lit(i).alias("i"), F.lit(s).alias("shift")) for a, i, s in probes(edits)])
    each = lines.select(F.col("h1").alias("a"), "line", "chars", F.inline(specs))
    each = each.withColumn("other", F.col("chars") - F.col("less")).where(F.col("other") >= least)
    start, length = segment(F.col("other"), edits + 1, F.col("i"))
    each = each.withColumns({"start": start + F.col("shift"), "length": length})
    each = each.where((F.col("start") >= 1) & (F.col("start") + F.col("length") - 1 <= F.col("chars")))
    return each.select("a", F.xxhash64("other", "i", F.col("line").substr(F.col("start"), F.col("length"))).alias("probe"))


def meetings(lines: DataFrame, edits: int, least: int) -> DataFrame:
    """(probe, h1, asks): who meets another line on a probed segment, as index or as probe, stored.

    Two semi-joins over the same shuffles: a line makes one row per segment or substring, whatever the
    number of lines that it meets.
    """
    asked, index = probe_rows(lines, edits, least), index_rows(lines, edits)
    other = (asked["probe"] == index["probe"]) & (asked["a"] != index["b"])
    asks = asked.join(index, other, "left_semi").select("probe", F.col("a").alias("h1"), F.lit(True).alias("asks"))
    holds = index.join(asked, other, "left_semi").select("probe", F.col("b").alias("h1"), F.lit(False).alias("asks"))
    return stored(asks.union(holds).distinct(), "line-meetings")


def inside_fits(x: Column, y: Column, edits: int) -> Column:
    """What must hold of two texts that neither start nor end alike, if ``edits`` edits part them.

    Unless they are single characters, one edit is at the start and one at the end: but for a character
    on either side, ``x`` occurs in ``y``, or all but ``edits - 2`` of its pieces do.
    """
    if edits < 2:
        return F.greatest(F.length(x), F.length(y)) <= edits
    inner, pieces = F.length(x) - 2, max(1, PIECES * (edits - 2))
    size = F.floor(inner / pieces).cast("int")
    held = [F.contains(y, x.substr(2 + i * size, size if pieces > 1 else inner)).cast("int") for i in range(pieces)]
    return (inner < pieces) | (reduce(lambda n, h: n + h, held) >= pieces - (edits - 2))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def letters(line: Column) -> Column:
    """A bit per character class (code modulo 64), set if the line has an odd number of its characters.

    An edit changes two bits at most, so lines within e edits differ in at most 2e bits.
    """
    one = F.lit(1).cast("long")
    return F.aggregate(
        F.split(line, ""), F.lit(0).cast("long"),
        lambda bits, c: bits.bitwiseXOR(F.call_function("shiftleft", one, F.ascii(c).bitwiseAND(F.lit(63)))),
    )


def common_start(a: Column, b: Column, longest: int = 1 << 20) -> Column:
    """Characters that both lines start with, by doubling steps."""
    shorter = F.least(F.length(a), F.length(b))
    steps, step = [], longest
    while step:
        steps.append(step)
        step //= 2

    def go(at: Column, step: Column) -> Column:
        fits = (at + step <= shorter) & (a.substr(at + 1, step) == b.substr(at + 1, step))
        return at + F.when(fits, step).otherwise(0)

    few = F.filter(F.array(*[F.lit(x) for x in steps]), lambda x: x <= shorter)
    return F.aggregate(few, F.lit(0), go)


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether the edit distance of two lines is at most ``edits``; what they start and end with alike
    does not count and is left out."""
    lead = common_start(a, b)

    def middle(parts: Column) -> Column:
        x, y = parts["x"], parts["y"]
        tail = common_start(F.reverse(x), F.reverse(y))
        short = lambda t, cut: t.substr(F.lit(1), F.length(t) - cut)
        return _let(tail, lambda cut: F.struct(short(x, cut).alias("x"), short(y, cut).alias("y")))

    def distance(parts: Column) -> Column:
        x, y = parts["x"], parts["y"]
        apart = F.when(F.length(x) >= F.length(y), edit_distance(x, y, edits)).otherwise(edit_distance(y, x, edits))
        return inside_fits(x, y, edits) & (apart <= edits)

    rest = _let(lead, lambda cut: F.struct(a.substr(cut + 1, F.length(a)).alias("x"), b.substr(cut + 1, F.length(b)).alias("y")))
    return (F.abs(F.length(a) - F.length(b)) <= edits) & _let(_let(rest, middle), distance)


def edit_distance(long: Column, short: Column, edits: int) -> Column:
    """The edit distance where it is at most ``edits``, else a larger number; ``long`` is not shorter.

    Myers' bit vectors on the band around the main diagonal: bit k of column j stands for row
    j - edits + k. Per column the vertical differences move down one bit, the matches of the column's
    character in the band are gathered, and the cell on the diagonal costs one more unless its
    diagonal step is free. Rows above the first continue the matrix so that row 0 counts columns.
    """
    width = 2 * edits + 1
    every, top = (1 << width) - 1, 1 << (width - 1)

    def inverted(x: Column) -> Column:
        return x.bitwiseXOR(F.lit(every))

    def column(text: Column, state: Column, j: Column) -> Column:
        c = F.get(text["columns"], j - 1)
        matches = [F.when(F.get(text["rows"], j - 1 - edits + k) == c, 1 << k).otherwise(0) for k in range(width)]
        vp = F.shiftright(state["vp"], 1).bitwiseOR(F.lit(top))
        vn = F.shiftright(state["vn"], 1)
        start = F.struct(vp.alias("vp"), vn.alias("vn"), sum(matches[1:], matches[0]).bitwiseOR(vn).alias("x"))

        def free(s: Column) -> Column:
            carried = (s["x"].bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"]).bitwiseOR(s["x"]).bitwiseAND(F.lit(every))
            return F.struct(s["vp"].alias("vp"), s["vn"].alias("vn"), carried.alias("d0"))

        def across(s: Column) -> Column:
            up = s["vn"].bitwiseOR(inverted(s["d0"].bitwiseOR(s["vp"])))
            down = s["d0"].bitwiseAND(s["vp"])
            return F.struct(
                s["d0"].alias("d0"), F.shiftleft(up, 1).bitwiseOR(F.lit(1)).bitwiseAND(F.lit(every)).alias("hp"),
                F.shiftleft(down, 1).bitwiseAND(F.lit(every)).alias("hn"),
            )

        def result(s: Column) -> Column:
            step = 1 - F.shiftright(s["d0"], edits).bitwiseAND(F.lit(1))
            return F.struct(
                s["hn"].bitwiseOR(inverted(s["d0"].bitwiseOR(s["hp"]))).alias("vp"), s["d0"].bitwiseAND(s["hp"]).alias("vn"),
                (state["d"] + step).alias("d"),
            )

        return _let(_let(_let(start, free), across), result)

    first = F.struct(
        F.lit(every - ((1 << (edits + 1)) - 1)).alias("vp"), F.lit((1 << (edits + 1)) - 1).alias("vn"), F.lit(0).alias("d")
    )
    more = F.length(long) - F.length(short)

    def finish(state: Column) -> Column:
        # From the diagonal down to the last row of the longer line.
        extra = [
            F.when(more > k, F.shiftright(state["vp"], edits + 1 + k).bitwiseAND(F.lit(1)) - F.shiftright(state["vn"], edits + 1 + k).bitwiseAND(F.lit(1))).otherwise(0)
            for k in range(edits)
        ]
        return state["d"] + sum(extra, F.lit(0))

    # Results of a lambda are copied, what it refers to is not: the characters stay outside the state.
    texts = F.struct(F.split(long, "").alias("rows"), F.split(short, "").alias("columns"))
    walked = _let(
        texts, lambda text: F.aggregate(F.sequence(F.lit(1), F.length(short)), first, lambda state, j: column(text, state, j), finish)
    )
    return F.when(more > edits, edits + 1).when(F.length(short) == 0, more).otherwise(walked)


def blocks_that_meet(lines: DataFrame, edits: int, least: int) -> DataFrame:
    """(asking, holding): arrays of lines (h1, h2, line, chars, place, letters), about ``BLOCK`` each.

    All lines that ask for a segment are paired with all that hold it, block by block: a segment that
    many lines share makes a row per pair of blocks, not per pair of lines.
    """
    met = meetings(lines, edits, least)
    wanted = met.select("h1").distinct()
    texts = stored(lines.join(bounded(wanted, BROADCAST_LINES), "h1", "left_semi").select("h1", "h2", "line", "chars", "place", letters(F.col("line")).alias("letters")), "line-texts")
    sizes = met.groupBy("probe", "asks").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    placed = met.join(sizes, ["probe", "asks"]).withColumn("block", F.pmod(F.xxhash64("h1"), F.col("blocks")))
    full = placed.join(texts, "h1").groupBy("probe", "asks", "block").agg(F.collect_list(F.struct("h1", "h2", "line", "chars", "place", "letters")).alias("held"))
    asking = full.where("asks").select("probe", F.col("held").alias("asking"))
    return asking.join(full.where("NOT asks").select("probe", F.col("held").alias("holding")), "probe").select("asking", "holding")


def close_in_blocks(edits: int) -> Column:
    """The pairs (earlier, later) of ``asking`` and ``holding`` within ``edits`` edits, by digest."""
    def named(x: Column) -> Column:
        return F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["place"].alias("place"))

    def pairs_of(x: Column) -> Column:
        def near_to(y: Column) -> Column:
            # Lines of one length ask each other: one of the two will do.
            turn = (x["chars"] > y["chars"]) | ((x["chars"] == y["chars"]) & (x["h1"] < y["h1"]))
            alike = F.bit_count(x["letters"].bitwiseXOR(y["letters"])) <= 2 * edits
            return turn & alike & within(x["line"], y["line"], edits)

        near = F.filter(F.col("holding"), near_to)
        return F.transform(
            near,
            lambda y: F.when(x["place"] < y["place"], F.struct(named(x).alias("earlier"), named(y).alias("later"))).otherwise(
                F.struct(named(y).alias("earlier"), named(x).alias("later"))
            ),
        )

    return F.flatten(F.transform("asking", pairs_of))


def close_pairs(lines: DataFrame, edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """(earlier, later) of all distinct ``lines`` within ``edits`` edits, each pair once."""
    found = blocks_that_meet(lines, edits, least).select(F.explode(close_in_blocks(edits)).alias("pair"))
    return found.select("pair.*").distinct()


def later_lines(lines: DataFrame, edits: int, least: int) -> DataFrame:
    """(h1, h2) of the distinct ``lines`` that an earlier one is close to."""
    later = F.array_distinct(F.transform(close_in_blocks(edits), lambda p: F.struct(p["later"]["h1"].alias("h1"), p["later"]["h2"].alias("h2"))))
    return blocks_that_meet(lines, edits, least).select(F.explode(later).alias("line")).select("line.*").distinct()


def lines_to_drop(docs: DataFrame, *, edits: int, least: int, exact_from: int, id_col: str, text_col: str) -> DataFrame:
    """(key, dropped): the line numbers that go, per document that loses any."""
    lines = lines_of(docs, id_col, text_col, max(1, min(least, exact_from)))
    copies = lines.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = stored(copies.where("n > 1").select("h1", "h2", "first"), "line-copies")
    first = lines.join(bounded(copies, BROADCAST_LINES), ["h1", "h2"], "left").where("first IS NULL OR first = place").drop("first")
    near = stored(later_lines(first.where(F.col("chars") >= least), edits, least), "line-near")
    gone = copies.join(near, ["h1", "h2"], "left_anti").unionByName(near.withColumn("first", F.lit(None).cast("decimal(38,0)")))
    hit = lines.drop("line").join(bounded(gone, BROADCAST_LINES), ["h1", "h2"]).where("first IS NULL OR place > first")
    return hit.groupBy("key").agg(F.collect_set("line_no").alias("dropped"))


def dedup_lines(
    docs: DataFrame, *, edits: int = EDITS, least: int = LEAST, exact_from: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the column ``lines``: n_lines, n_dropped and the text that is left.

    Lines of ``least`` characters or more go if an earlier one is near; from ``exact_from`` characters
    on (``least`` unless given) a line goes if it equals an earlier one.
    """
    drops = lines_to_drop(
        docs, edits=edits, least=least, exact_from=least if exact_from is None else exact_from, id_col=id_col, text_col=text_col
    )
    kept, out = unused(docs, "row"), unused(docs, "lines")
    text = F.col(f"`{text_col}`").cast("string")
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(kept), text.alias("_text"), document_key(F.col(f"`{id_col}`"), text).alias("_key"))
    joined = wide.join(drops.withColumnRenamed("key", "_key"), "_key", "left").withColumn("_lines", F.split("_text", "\n"))
    n = F.size("_lines")
    left = F.array_except(F.sequence(F.lit(0), n - 1), F.col("dropped"))
    text_left = F.when(F.col("dropped").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(F.col("_lines"), i)), "\n")
    )
    return joined.select(
        f"{kept}.*",
        F.struct(
            F.when(F.col("_text").isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
            F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), text_left.alias("text"),
        ).alias(out),
    )
