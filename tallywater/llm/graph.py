"""Connected components of a table of links, for the operators that group near-duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallywater.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id of ``links`` (a, b).

    Alternates large-star and small-star steps (Kiveris and others, 2014): neighbours above a node,
    then those below, are tied to the smallest one. Every round is written to the shared folder; it
    ends when a round changes nothing. Minima are pre-aggregated, so a hub is no hot group.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links"
    )
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(least.select("u", F.col("m").alias("v")).union(small).distinct(), "stars")
        # Sums of digests as decimals: two tables of equal sum and count hold the same links.
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )
