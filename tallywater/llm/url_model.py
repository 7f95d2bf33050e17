"""URL filter by character language models (DataFrame operations only).

Two variable-order Markov models are counted, one over accepted and one over rejected URLs. The
probability of a character blends all context lengths from 0 to ``order`` by Witten-Bell smoothing:
the longer context counts the more, the more often and the less diversely it was seen. A URL's score
is the difference of its two log-likelihoods divided by its length; the threshold is the one that
separates a held-out fifth of the labelled URLs best (largest mean of the two hit rates).

Only distinct (context, character) strings are scored; a URL's score is a sum over those it holds,
gathered by a join with partial sums on both sides. Everything grows with the distinct strings, not
with their square, and a frequent string is one row of the model.

Defined results: a null or empty URL has score 0; with no accepted or no rejected URL to learn from
all scores are 0 and the threshold is 0, so that the method allows. Repeated URLs are scored once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywater.llm.shared import stored, unused

ORDER = 4
#: Characters in front of a URL and its end, so that first characters have a context and ends count.
START, END = "\u0002", "\u0003"
#: Probability mass of a character that no model has seen is spread over this many.
ALPHABET = 256.0


def grams(urls: DataFrame, url: str, order: int) -> DataFrame:
    """A row per character: ``gram`` holds the ``order`` characters before it and itself."""
    padded = F.concat(F.lit(START * order), F.col(url), F.lit(END))
    return urls.withColumn("_text", padded).select(
        *urls.columns,
        F.explode(
            F.transform(F.sequence(F.lit(1), F.length("_text") - order), lambda i: F.substring(F.col("_text"), i, F.lit(order + 1)))
        ).alias("gram"),
    )


def model(labelled: DataFrame, texts: DataFrame, order: int) -> DataFrame:
    """The log of both probabilities for every gram of ``texts``: (gram, log_ratio).

    ``labelled``: gram, n_accept, n_reject; ``texts``: gram.
    """
    scored = texts.select("gram").distinct().withColumns({"p_accept": F.lit(1.0 / ALPHABET), "p_reject": F.lit(1.0 / ALPHABET)})
    for k in range(order + 1):
        tail = F.substring(F.col("gram"), order + 1 - k, k + 1)
        counts = labelled.groupBy(tail.alias("_tail")).agg(F.sum("n_accept").alias("a"), F.sum("n_reject").alias("r"))
        by = Window.partitionBy(F.substring(F.col("_tail"), 1, k))
        counts = counts.select(
            "_tail", "a", "r", F.sum("a").over(by).alias("na"), F.sum("r").over(by).alias("nr"),
            F.sum((F.col("a") > 0).cast("long")).over(by).alias("ta"), F.sum((F.col("r") > 0).cast("long")).over(by).alias("tr"),
        )
        contexts = counts.groupBy(F.substring(F.col("_tail"), 1, k).alias("_context")).agg(
            *[F.max(c).alias(c) for c in ("na", "nr", "ta", "tr")]
        )
        scored = (
            scored.withColumns({"_tail": tail, "_context": F.substring(F.col("gram"), order + 1 - k, k)})
            .join(counts.select("_tail", "a", "r"), "_tail", "left")
            .join(contexts, "_context", "left")
        )

        def blended(p: str, count: str, seen: str, kinds: str) -> Column:
            # Witten-Bell: (count + kinds * shorter) / (seen + kinds); an unseen context defers.
            return F.when(
                F.col(seen) > 0,
                (F.coalesce(F.col(count), F.lit(0)) + F.col(kinds) * F.col(p)) / (F.col(seen) + F.col(kinds)),
            ).otherwise(F.col(p))

        scored = scored.select(
            "gram", blended("p_accept", "a", "na", "ta").alias("p_accept"), blended("p_reject", "r", "nr", "tr").alias("p_reject")
        )
    return scored.select("gram", (F.log("p_accept") - F.log("p_reject")).alias("log_ratio"))


def score_urls(urls: DataFrame, *, url_col: str = "url", label_col: str = "label", order: int = ORDER) -> tuple[DataFrame, float]:
    """(distinct url, score), and the calibrated threshold.

    ``label_col`` is 1 for accepted, 0 for rejected and null for URLs without a label. A fifth of the
    labelled URLs, chosen by digest, is held out of the counts and calibrates the threshold.
    """
    once = (
        urls.where(F.col(url_col).isNotNull())
        .groupBy(F.col(url_col).alias("_url"))
        .agg(F.max(F.col(label_col).cast("int")).alias("_label"))
        .withColumn("_held", F.pmod(F.conv(F.substring(F.md5("_url"), 1, 8), 16, 10).cast("long"), F.lit(5)) == 0)
    )
    once = stored(once, "url-once")
    each = grams(once, "_url", order)
    learn = F.col("_label").isNotNull() & ~F.col("_held")
    counts = stored(
        each.groupBy("gram").agg(
            F.sum((learn & (F.col("_label") == 1)).cast("long")).alias("n_accept"),
            F.sum((learn & (F.col("_label") == 0)).cast("long")).alias("n_reject"),
        ).na.fill(0),
        "url-grams",
    )
    ratios = stored(model(counts.where("n_accept + n_reject > 0"), counts, order), "url-model")
    totals = each.join(ratios, "gram").groupBy("_url", "_label", "_held").agg((F.sum("log_ratio") / F.count("gram")).alias("score"))
    totals = stored(totals, "url-scores")
    return totals.select(F.col("_url").alias(url_col), "score"), calibrated(totals)


def calibrated(totals: DataFrame, steps: int = 1000) -> float:
    """The cut with the largest mean of both hit rates on the held-out labelled URLs; ties: nearest 0.

    It lies halfway between the scores that it parts. The scores are counted in cells of 1 / ``steps``, so the driver gets one row at every size.
    """
    cells = (
        totals.where(F.col("_held") & F.col("_label").isNotNull())
        .groupBy(F.floor(F.col("score") * steps).alias("_cell"))
        .agg(F.sum("_label").alias("_yes"), F.sum(1 - F.col("_label")).alias("_no"))
    )
    every = Window.partitionBy(F.lit(1))
    below = every.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    best = (
        cells.withColumns({"_ally": F.sum("_yes").over(every), "_alln": F.sum("_no").over(every)})
        .withColumn("_cut", (F.col("_cell") + F.coalesce(F.lag("_cell").over(every.orderBy("_cell")) + 1, F.col("_cell"))) / 2.0)
        .where("_ally > 0 AND _alln > 0")
        .withColumn(
            "_gain",
            (1 - F.coalesce(F.sum("_yes").over(below), F.lit(0)) / F.col("_ally")) + F.coalesce(F.sum("_no").over(below), F.lit(0)) / F.col("_alln"),
        )
        .agg(F.max_by("_cut", F.struct("_gain", -F.abs(F.col("_cut")))).alias("_best"))
        .first()
    )
    return 0.0 if best is None or best["_best"] is None else best["_best"] / steps


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, in lower case; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule (verdict, host, path) that fits, as a struct (rule, verdict); else null."""
    fits = [
        F.when(
            ((host == h) | host.endswith(f".{h}")) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]], *, url_col: str = "url", order: int = ORDER
) -> DataFrame:
    """``pages`` with the column ``judged``: host, path, rule, score, threshold, verdict.

    Rules decide where one fits and label what the models learn from; elsewhere a URL is allowed
    if its score reaches the threshold. URLs without a host are left to the models like others.
    """
    kept, out = unused(pages, "row"), unused(pages, "judged")
    wide = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias(kept), F.col(f"`{url_col}`").alias("_url"))
    wide = wide.withColumns({"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url"))})
    wide = wide.withColumn("_fit", rule_of(F.col("_host"), F.col("_path"), rules))
    label = F.when(F.col("_fit.verdict") == "allow", 1).when(F.col("_fit.verdict") == "block", 0)
    scores, threshold = score_urls(wide.select(F.col("_url").alias("url"), label.alias("label")), order=order)
    joined = wide.join(scores.select(F.col("url").alias("_url"), "score"), "_url", "left")
    score = F.coalesce(F.col("score"), F.lit(0.0))
    verdict = F.coalesce(F.col("_fit.verdict"), F.when(score >= threshold, "allow").otherwise("block"))
    return joined.select(
        f"{kept}.*",
        F.struct(
            F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_fit.rule").alias("rule"), score.alias("score"),
            F.lit(threshold).alias("threshold"), verdict.alias("verdict"),
        ).alias(out),
    )
