"""Benchmark decontamination by a positional inverted index (DataFrame operations only).

The index holds a posting (term, document, position) for every training token whose term occurs in
the tests, written as a table; ``wanted=None`` stores the postings of all terms. A search takes each
phrase's rarest term, turns its postings into offset-adjusted starts, keeps those where the
second-rarest term's adjusted list has the same start, and then intersects the adjusted lists of all
remaining terms on the surviving alignments. Windows that cover the same passage share one alignment
of the item with the document, so work follows the matched words.

The terms wanted are broadcast only while their count is below ``BROADCAST_TERMS``; beyond that
Spark shuffles the join.

Defined results: null or wordless texts have no words and no hits; an item of fewer words than the
window is one window; an item without an id is sought like any other and only not named; rows that
repeat a document's id and text count as one document; empty tables give rows without hits, or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywater.llm.shared import document_key, stored, unused, word_list

WINDOW = 10
#: Terms have at most 255 bytes here (longer ones are hashed), so the broadcast stays below 100 MB.
BROADCAST_TERMS = 200_000


def term(word: Column) -> Column:
    """A word as its key in the index: itself, or a digest of a very long one."""
    return F.when(F.octet_length(word) <= 255, word).otherwise(F.concat(F.lit("\u0001"), F.sha2(word, 256)))


def tokens(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, position, term) of every word."""
    words = texts.select(key, F.posexplode(word_list(F.col(text))).alias("position", "word"))
    return words.where("word != ''").select(key, "position", term(F.col("word")).alias("term"))


def vocabulary(items: DataFrame) -> DataFrame:
    """The distinct terms of ``items`` (term, term_id)."""
    return stored(items.select("term").distinct().withColumn("term_id", F.xxhash64("term")), "terms")


def build_index(docs: DataFrame, key: str, text: str, wanted: DataFrame | None = None) -> DataFrame:
    """The postings (term_id, doc, position), stored; ``wanted`` limits them to its terms."""
    found = tokens(docs, key, text)
    if wanted is None:
        found = found.withColumn("term_id", F.xxhash64("term"))
    else:
        few = wanted.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
        found = found.join(F.broadcast(wanted) if few else wanted, "term")
    return stored(found.select("term_id", F.col(key).alias("doc"), F.col("position").cast("int").alias("position")), "postings")


def phrases(items: DataFrame, window: int) -> DataFrame:
    """Every run of ``window`` words of an item: (item, at, width, offset, term_id) per word.

    ``items``: item, position, term_id. The position counts from an item's first word.
    """
    length = F.count(F.lit(1)).over(Window.partitionBy("item"))
    first = F.min("position").over(Window.partitionBy("item"))
    words = items.withColumns({"n": length, "position": (F.col("position") - first).cast("int")})
    width = F.least(F.col("n"), F.lit(window)).cast("int")
    starts = F.sequence(
        F.greatest(F.col("position") - width + 1, F.lit(0)).cast("int"), F.least(F.col("position"), F.col("n") - width).cast("int")
    )
    return words.select("item", "position", "term_id", width.alias("width"), F.explode(starts).alias("at")).select(
        "item", "at", "width", (F.col("position") - F.col("at")).alias("offset"), "term_id"
    )


def alignments(index: DataFrame, grams: DataFrame) -> DataFrame:
    """(doc, item, shift): where a phrase's two rarest terms stand at their offsets.

    ``shift`` is the document position of the item's first word. Phrases with a term that the index
    lacks cannot occur and drop out here.
    """
    df = index.groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))
    by = Window.partitionBy("item", "at")
    ranked = grams.join(df, "term_id", "left").withColumns(
        {
            "least": F.min(F.coalesce("df", F.lit(0))).over(by),
            "place": F.row_number().over(by.orderBy("df", "offset")),
        }
    )
    two = (
        ranked.where("least > 0 AND place <= 2")
        .groupBy("item", "at")
        .agg(
            F.min_by(F.struct("term_id", (F.col("at") + F.col("offset")).alias("p")), "place").alias("a"),
            F.max_by(F.struct("term_id", (F.col("at") + F.col("offset")).alias("p")), "place").alias("b"),
        )
        .select("item", F.col("a.term_id").alias("a"), F.col("a.p").alias("pa"), F.col("b.term_id").alias("b"), F.col("b.p").alias("pb"))
        .distinct()
    )
    two = stored(two, "phrases")
    lists = index.join(F.broadcast(two.select(F.col("a").alias("term_id")).union(two.select("b")).distinct()), "term_id", "left_semi") \
        if two.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS else index
    first = lists.join(two, lists.term_id == two.a).select(
        "doc", "item", (F.col("position") - F.col("pa")).alias("shift"), "b", (F.col("position") - F.col("pa") + F.col("pb")).alias("position")
    )
    second = lists.select("doc", F.col("term_id").alias("b"), "position")
    return first.join(second, ["doc", "b", "position"], "left_semi").select("doc", "item", "shift").distinct()


def matches(index: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """Exact matches (doc, item, start, stop): runs of matched words at least a window long.

    Intersects the adjusted lists of an item's words on its alignments; a run of consecutive matched
    offsets that is as long as a window (or the whole short item) is a match, ``stop`` exclusive.
    """
    # Words that open a document or item with a separator shift all positions alike.
    base = F.min("position").over(Window.partitionBy("item"))
    words = items.withColumn("p", (F.col("position") - base).cast("int"))
    found = stored(alignments(index, phrases(items, window)), "alignments")
    near = index.join(found.select("doc").distinct(), "doc", "left_semi")
    wanted = found.join(words.select("item", "p", "term_id"), "item").select(
        "doc", "item", "shift", "p", "term_id", (F.col("shift") + F.col("p")).alias("position")
    )
    hit = wanted.join(near, ["doc", "position", "term_id"]).select("doc", "item", "shift", "p").distinct()
    run = F.col("p") - F.row_number().over(Window.partitionBy("doc", "item", "shift").orderBy("p"))
    lengths = words.groupBy("item").agg(F.least(F.count(F.lit(1)), F.lit(window)).alias("width"))
    return (
        hit.withColumn("run", run)
        .groupBy("doc", "item", "shift", "run")
        .agg(F.min("p").alias("a"), F.max("p").alias("b"))
        .join(lengths, "item")
        .where("b - a + 1 >= width")
        .select("doc", "item", (F.col("shift") + F.col("a")).alias("start"), (F.col("shift") + F.col("b") + 1).alias("stop"))
    )


def near_matches(index: DataFrame, items: DataFrame, slop: int) -> DataFrame:
    """Proximity matches (doc, item, start, stop): all distinct terms of an item within ``slop`` words.

    Starts from the postings of the item's rarest term: each must have every other term of the item
    within ``slop`` positions after the first of them. The span given is the earliest such one that
    the posting belongs to.
    """
    terms = items.select("item", "term_id").distinct()
    df = index.groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))
    by = Window.partitionBy("item")
    ranked = terms.join(df, "term_id", "left").withColumns(
        {"n": F.count(F.lit(1)).over(by), "least": F.min(F.coalesce("df", F.lit(0))).over(by), "place": F.row_number().over(by.orderBy("df", "term_id"))}
    ).where("least > 0")
    anchors = index.join(ranked.where("place = 1").select("term_id", "item", "n"), "term_id").select("doc", "item", "n", F.col("position").alias("anchor"))
    others = anchors.join(ranked.select("item", F.col("term_id").alias("t")), "item")
    beside = index.select(F.col("doc").alias("d"), F.col("term_id").alias("t"), "position")
    around = others.join(beside, (others.doc == beside.d) & (others.t == beside.t) & F.col("position").between(F.col("anchor") - slop + 1, F.col("anchor") + slop - 1))
    # A window that opens at a posting near the anchor and holds every term.
    opened = around.select("doc", "item", "n", "anchor", others.t.alias("t"), "position")
    starts = opened.where("position <= anchor").select("doc", "item", "anchor", F.col("position").alias("start")).distinct()
    inside = opened.join(starts, ["doc", "item", "anchor"]).where((F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + slop))
    return (
        inside.groupBy("doc", "item", "n", "anchor", "start", "t").agg(F.min("position").alias("position"))
        .groupBy("doc", "item", "n", "anchor", "start").agg(F.count(F.lit(1)).alias("held"), (F.max("position") + 1).alias("stop"))
        .where("held = n").groupBy("doc", "item", "anchor").agg(F.min(F.struct("start", "stop")).alias("span"))
        .select("doc", "item", "span.*").distinct()
    )


def item_key(item_id: Column, text: Column) -> Column:
    """An item's key: a digest of its text and its id, so that items sharing an id stay apart. Without
    an id it is the digest alone."""
    return F.concat_ws("\u0001", F.md5(text.cast("binary")), item_id.cast("string"))


def item_name(key: Column) -> Column:
    """The id in an item's key; null if it has none."""
    return F.when(F.length(key) > 32, F.substr(key, F.lit(34)))


def hits(found: DataFrame) -> DataFrame:
    """Per document: words inside any match, items matched (sorted as strings)."""
    order = Window.partitionBy("doc").orderBy("start", "stop")
    reached = F.coalesce(F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fresh = F.greatest(F.col("stop") - F.greatest(F.col("start"), F.col("_reached")), F.lit(0))
    return (
        found.withColumn("_reached", reached)
        .groupBy("doc")
        .agg(F.sum(fresh).alias("n_hit"), F.sort_array(F.collect_set(item_name(F.col("item")))).alias("items"))
    )


def contamination(
    docs: DataFrame, bench: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc, n_hit, items) of the documents with hits; ``doc`` is the key made by ``document_key``."""
    read = docs.select(document_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    item_text = F.col(f"`{item_text_col}`").cast("string")
    tests = bench.select(item_key(F.col(f"`{item_col}`"), F.coalesce(item_text, F.lit(""))).alias("item"), item_text.alias("text"))
    parts = tokens(tests.distinct(), "item", "text")
    parts = parts.withColumn("term_id", F.xxhash64("term"))
    index = build_index(read, "doc", "text", vocabulary(parts))
    return hits(matches(index, stored(parts.select("item", "position", "term_id"), "items"), window))


def judge(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """``docs`` with the column ``hit``: n_hit and items (null where nothing hits)."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    kept, out = unused(docs, "row"), unused(docs, "hit")
    found = contamination(docs, bench, **options)
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(kept), document_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("_doc"))
    return wide.join(found, wide._doc == found.doc, "left").select(
        f"{kept}.*", F.when(F.col("doc").isNotNull(), F.struct("n_hit", "items")).alias(out)
    )
