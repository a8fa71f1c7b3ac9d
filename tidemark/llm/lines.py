"""Line deduplication: lines that are spread over many sites are boilerplate.

Every line has a 128-bit hash.  One aggregation per hash merges HyperLogLog
sketches of the sites, so a line of any frequency leaves each task as one small
row.  Estimates clear of the threshold decide at once; lines whose estimate is
near it get an exact count of distinct sites.  A boilerplate line is removed
everywhere but at its first place (smallest document id, then place), so a text
that many sites mirror isn't lost with its copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import parts, stored, whole

MIN_SITES = 10     # distinct sites that make a line boilerplate, however many there are
MIN_CHARS = 1      # every line that isn't blank can be boilerplate
LOG_REGISTERS = 12  # the sketch is off by 1.04 / sqrt(2 ** LOG_REGISTERS) on average
DEVIATIONS = 4     # estimates within so many deviations of the threshold are counted


def _lines(df: DataFrame, doc_id: str, text: str, site: str, min_chars: int) -> DataFrame:
    """Row key, document, site, place and hash of every line that can be boilerplate."""
    row = df.select(
        F.xxhash64(doc_id, site, text).alias("_row1"),
        F.xxhash64(F.lit(1), doc_id, site, text).alias("_row2"),
        F.col(doc_id).alias("_doc"),
        F.coalesce(F.col(site).cast("string"), F.lit("\0")).alias("_site"),
        F.posexplode(F.split(text, "\n", -1)).alias("_place", "_line"),
    )
    line = F.trim("_line")
    return row.where((F.char_length(line) >= min_chars) & line.rlike(r"\S")).select(
        "_row1", "_row2", "_doc", "_site", "_place", F.xxhash64(line).alias("_h1"), F.xxhash64(F.lit(1), line).alias("_h2")
    )


def site_threshold(df: DataFrame, site: str = "source") -> int:
    """Sites that make a line boilerplate in ``df``: half of its sites, two at least, ``MIN_SITES`` at most.

    Of few sites a majority is asked for; ten sites are enough in a corpus of any size.
    """
    sites = df.select(F.coalesce(F.col(site).cast("string"), F.lit("\0"))).distinct().count()
    return min(MIN_SITES, max(2, (sites + 1) // 2))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Hashes of the lines on at least ``min_sites`` distinct sites, and their first place."""
    error = DEVIATIONS * 1.04 / 2 ** (LOG_REGISTERS / 2)
    low, high = min_sites * (1 - error) - 1, min_sites * (1 + error) + 1
    spread = lines.groupBy("_h1", "_h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("_site", LOG_REGISTERS)).alias("_sites"),
        F.min(F.struct(F.col("_doc").isNull().alias("_last"), "_doc", "_row1", "_place")).alias("_first"),
    )
    wide = stored(spread.where(F.col("_sites") >= low), "wide_lines")
    near = wide.where(F.col("_sites") < high)
    exact = (
        lines.join(near.select("_h1", "_h2"), ["_h1", "_h2"], "left_semi")
        .select("_h1", "_h2", "_site").distinct()
        .groupBy("_h1", "_h2").count()
        .where(F.col("count") >= min_sites)
    )
    counted = near.join(exact, ["_h1", "_h2"], "left_semi")
    return wide.where(F.col("_sites") >= high).unionByName(counted).select("_h1", "_h2", "_first")


def _without(lines: Column, places: Column) -> Column:
    """The lines but those at the sorted places: slices between them, in linear time."""

    def stretch(i: Column) -> Column:
        start = F.coalesce(F.get(places, i - 1), F.lit(-1)) + 1
        stop = F.coalesce(F.get(places, i), F.size(lines))
        return F.slice(lines, start + 1, F.greatest(stop - start, F.lit(0)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(places)), stretch))


def dedupe_lines(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int | None = None,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``df`` with boilerplate lines taken out of ``text``, plus n_lines and n_removed (long).

    Lines end at \\n and are compared without blanks at their ends.  A null text
    stays null with 0 lines; a null site counts as one site.  A text of which
    every line goes becomes empty; its row stays.  Blank lines stay.  Without
    ``min_sites`` the number of sites decides (``site_threshold``).  Rows that are equal in id,
    site and text are treated alike.  Columns named n_lines or n_removed are
    replaced, other columns are kept; an empty table gives an empty result.
    """
    lines = _lines(df, doc_id, text, site, min_chars)
    common = boilerplate(lines, site_threshold(df, site) if min_sites is None else min_sites)
    first = F.col("_first")
    again = ~(first["_doc"].eqNullSafe(F.col("_doc")) & (first["_row1"] == F.col("_row1")) & (first["_place"] == F.col("_place")))
    places = (
        lines.join(common, ["_h1", "_h2"]).where(again)
        .groupBy("_row1", "_row2").agg(F.sort_array(F.collect_set("_place")).alias("_places"))
    )
    kept = df.drop("n_lines", "n_removed")
    rows = df.select(
        whole(kept), F.xxhash64(doc_id, site, text).alias("_row1"), F.xxhash64(F.lit(1), doc_id, site, text).alias("_row2")
    )
    own = F.col("_whole").getField(text)
    split = F.split(own, "\n", -1)
    cleaned = F.when(F.col("_places").isNull(), own).otherwise(F.array_join(_without(split, F.col("_places")), "\n"))
    return rows.join(places, ["_row1", "_row2"], "left").select(
        *[cleaned.alias(c) if c == text else part for c, part in zip(kept.columns, parts(kept), strict=True)],
        F.when(own.isNull(), 0).otherwise(F.size(split)).cast("long").alias("n_lines"),
        F.when(F.col("_places").isNull(), 0).otherwise(F.size("_places")).cast("long").alias("n_removed"),
    )
