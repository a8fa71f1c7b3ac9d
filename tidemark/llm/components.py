"""Connected components of a table of links, by large stars and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _state(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """Rows (a, b) for every node that has a link: b is the smallest node it can reach.

    ``links`` has long columns a and b; direction, repetition and links to itself
    don't matter.  In turns every node ties its larger neighbours to the smallest
    neighbour it knows, then its smaller ones.  All of it are joins and
    aggregations, so a node of any degree is dealt with; each turn is written to
    the shared folder.
    """
    links = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while (state := _state(links)) != before:
        before = state
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(lowest, "a")
        small = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(met.select("a", F.col("m").alias("b")))
        links = stored(small.where("a <> b").distinct(), "links")
    roots = links.select("b").distinct().select(F.col("b").alias("a"), "b")
    return links.unionByName(roots)
