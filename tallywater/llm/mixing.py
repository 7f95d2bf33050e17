"""Mixing sources to target weights by Pareto order sampling (DataFrame operations only).

Every source gets a target in words. Inside a source a document's expected number of copies falls
gently with its length class; the whole part of it is certain, the rest is the inclusion
probability of one more copy. Documents are ranked by random odds divided by inclusion odds
(Rosén's Pareto order sampling) and taken in that order until the words that the whole copies leave
open are used. The size that is fixed is counted in words, so a source misses its target by less
than one document.

The cut of a source is found from two histograms of the rank and the few rows of one cell; no
source is sorted. A row's copies follow from its own columns and the plan of its source, so texts
are never shuffled. The classes of a source are at most 64, so a source's sums are brought into one
row before targets are set.

Nulls and ties: a null text has size 0; a null source is a source of its own and sorts last; rows
with equal doc_id share their random number, rows without one draw theirs by their text; rows with
equal rank are taken or left together. An empty table gives an empty result. Other columns pass
through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywater.llm.shared import stored, unused

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
#: How much less a document of the next length class is repeated.
TILT = 0.125
CELLS = 4096
#: Fixed value: a run of anything but space, tab and the line breaks \n \v \f \r is a word.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """The words of a text: each becomes one letter, the blanks go. No list of them is built."""
    letters = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "w")
    return F.length(F.translate(letters, BLANKS, "")).cast("long")


def uniform(doc_id: Column, text: Column, seed: int) -> Column:
    """A repeatable number strictly between 0 and 1; a null id is told from any other."""
    own = F.coalesce(doc_id.cast("string"), F.concat(F.lit("?"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), own).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(16**12)


def water_fill(df: DataFrame, by: list[Column], weight: str, cap: str, total: str, out: str) -> DataFrame:
    """Share ``total`` by ``weight`` in each group, nobody above ``cap``; the excess is reshared.

    In the order of cap / weight the capped rows come first; the level that the others share is the
    largest of the levels that any row would give.
    """
    order = [F.col(cap) / F.col(weight), F.col(weight), F.col(cap)]
    window = Window.partitionBy(*by).orderBy(*order)
    before = F.coalesce(F.sum(cap).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum(weight).over(window.rowsBetween(0, Window.unboundedFollowing))
    level = F.max((F.col(total) - F.col("_before")) / F.col("_rest")).over(Window.partitionBy(*by))
    return (
        df.withColumns({"_before": before, "_rest": rest})
        .withColumn("_level", level)
        .withColumn(out, F.least(F.col(cap), F.greatest(F.col("_level"), F.lit(0.0)) * F.col(weight)))
        .drop("_before", "_rest", "_level")
    )


def _keyed(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    """The columns that a row's copies follow from."""
    return {
        "_source": F.when(F.col(source_col).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(source_col).cast("string"))),
        "_size": size_of(F.col(text_col)),
        "_u": uniform(F.col(id_col), F.col(text_col), seed),
    }


def _rank(df: DataFrame) -> DataFrame:
    """Random odds divided by inclusion odds, mapped to (0, 1), and its two cells."""
    odds = F.col("_u") / (1 - F.col("_u")) * (1 - F.col("_chance")) / F.col("_chance")
    rank = F.when(F.col("_chance") > 0, odds / (1 + odds))
    cell = F.floor(F.col("_rank") * CELLS)
    return df.withColumn("_rank", rank).withColumns(
        {"_cell": cell, "_fine": F.floor((F.col("_rank") * CELLS - cell) * CELLS)}
    )


def _shares(rows: DataFrame, weights: tuple[float, ...], most: float, tilt: float) -> DataFrame:
    """One row per source and length class: target, certain copies, chance of one more, words left open."""
    classes = rows.groupBy("_source", "_class").agg(F.sum("_size").alias("_words"))
    every = F.lit(1)
    place = F.row_number().over(Window.partitionBy(every).orderBy("_source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    sources = (
        classes.groupBy("_source")
        .agg(F.sum("_words").alias("_source_size"), F.collect_list(F.struct("_class", "_words")).alias("_classes"))
        .withColumns(
            {"_weight": weight, "_total": F.sum("_source_size").over(Window.partitionBy(every)).cast("double"), "_cap": most * F.col("_source_size")}
        )
    )
    sources = water_fill(sources, [every], "_weight", "_cap", "_total", "_target")
    # The sources were in one place to be ranked; their classes are dealt again.
    shares = sources.select("_source", "_source_size", "_target", "_classes").repartition("_source")
    shares = shares.select("_source", "_source_size", "_target", F.inline("_classes")).withColumns(
        {"_part": F.greatest(F.col("_words"), F.lit(1)) / (1 + tilt * F.col("_class")), "_cap": most * F.col("_words")}
    )
    shares = water_fill(shares, [F.col("_source")], "_part", "_cap", "_target", "_given")
    copies = F.when(F.col("_words") > 0, F.col("_given") / F.col("_words")).otherwise(0.0)
    # A share within 1e-9 of a whole number of copies is that number.
    shares = shares.withColumn("_copies", copies).withColumn("_whole", F.floor(F.col("_copies") + 1e-9))
    chance = F.greatest(F.col("_copies") - F.col("_whole"), F.lit(0.0))
    shares = shares.withColumn("_chance", F.when(chance > 1e-9, chance).otherwise(0.0))
    certain = F.sum(F.col("_whole") * F.col("_words")).over(Window.partitionBy("_source"))
    return shares.select("_source", "_class", "_source_size", "_target", "_whole", "_chance", (F.col("_target") - certain).alias("_open"))


def _cut(ranked: DataFrame, at: str, name: str) -> DataFrame:
    """(source, cell, words left open before it) of the first cell that ends beyond the words still open.

    A source has at most ``CELLS`` cells: they are one array, walked in order.
    """
    cells = ranked.groupBy("_source", F.col(at).alias("_at")).agg(F.sum("_size").alias("_words"), F.first("_open").alias("_open"))
    sources = cells.groupBy("_source").agg(
        F.first("_open").alias("_open"), F.sort_array(F.collect_list(F.struct("_at", "_words"))).alias("_cells")
    )

    def step(state: Column, cell: Column) -> Column:
        beyond = state["_at"].isNull() & (state["spent"] + cell["_words"] > F.col("_open"))
        return F.struct(
            F.when(state["_at"].isNull() & ~beyond, state["spent"] + cell["_words"]).otherwise(state["spent"]).alias("spent"),
            F.when(beyond, cell["_at"]).otherwise(state["_at"]).alias("_at"),
        )

    start = F.struct(F.lit(0).cast("long").alias("spent"), F.lit(None).cast("long").alias("_at"))
    walked = sources.withColumn("_end", F.aggregate("_cells", start, step))
    return walked.where("_end._at IS NOT NULL").select(
        "_source", F.col("_end._at").alias(name), (F.col("_open") - F.col("_end.spent")).alias("_left")
    )


def mixing_plan(rows: DataFrame, weights: tuple[float, ...], most: float, tilt: float) -> DataFrame:
    """One row per source and length class: target, certain copies, chance of one more, and the cut."""
    rows = rows.withColumn("_class", F.floor(F.log2(F.col("_size") + 1.0)).cast("int"))
    shares = stored(_shares(rows, weights, most, tilt), "mixing-shares")
    ranked = _rank(rows.join(shares, ["_source", "_class"])).where("_chance > 0")
    ranked = stored(ranked.select("_source", "_size", "_open", "_rank", "_cell", "_fine"), "mixing-ranked")
    coarse = stored(_cut(ranked, "_cell", "_cut"), "mixing-coarse")
    inside = ranked.drop("_open").join(coarse, "_source").where(F.col("_cell") == F.col("_cut"))
    fine = stored(_cut(inside.withColumnRenamed("_left", "_open"), "_fine", "_fine_cut"), "mixing-fine")
    last = inside.drop("_left").join(fine, "_source").where(F.col("_fine") == F.col("_fine_cut"))
    order = Window.partitionBy("_source").orderBy("_rank").rangeBetween(Window.unboundedPreceding, 0)
    final = (
        last.withColumn("_spent", F.sum("_size").over(order))
        .where(F.col("_spent") - F.col("_size") / 2 <= F.col("_left"))
        .groupBy("_source")
        .agg(F.max("_rank").alias("_last_rank"))
    )
    cuts = coarse.select("_source", "_cut").join(fine.select("_source", "_fine_cut"), "_source").join(final, "_source", "left")
    return stored(shares.drop("_open").join(cuts, "_source", "left"), "mixing-plan")


def mix(
    docs: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, tilt: float = TILT, seed: int = 0,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``docs`` with the column ``mix``: size, source_size, target and copies of every row."""
    keyed = _keyed(docs, seed, id_col, text_col, source_col)
    rows = stored(docs.select(*[c.alias(n) for n, c in keyed.items()]), "mixing-rows")
    plan = mixing_plan(rows, weights, most, tilt)
    kept, out = unused(docs, "row"), unused(docs, "mix")
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(kept), *[c.alias(n) for n, c in keyed.items()])
    wide = wide.withColumn("_class", F.floor(F.log2(F.col("_size") + 1.0)).cast("int"))
    here = _rank(wide.join(plan, ["_source", "_class"], "left"))
    before = (F.col("_cell") < F.col("_cut")) | ((F.col("_cell") == F.col("_cut")) & (F.col("_fine") < F.col("_fine_cut")))
    at = (F.col("_cell") == F.col("_cut")) & (F.col("_fine") == F.col("_fine_cut")) & (F.col("_rank") <= F.col("_last_rank"))
    extra = (F.col("_chance") > 0) & (F.col("_cut").isNull() | before | F.coalesce(at, F.lit(False)))
    copies = F.col("_whole") + F.when(extra, 1).otherwise(0)
    result = F.struct(
        F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        copies.cast("long").alias("copies"),
    )
    return here.select(f"{kept}.*", result.alias(out))


def materialised(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row per copy, with the columns of ``docs`` and ``copy`` counting from 1."""
    out, copy = unused(docs, "mix"), unused(docs, "copy")
    mixed = mix(docs, **options)
    return mixed.where(F.col(f"{out}.copies") > 0).select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.explode(F.sequence(F.lit(1), F.col(f"{out}.copies").cast("int"))).alias(copy),
    )
