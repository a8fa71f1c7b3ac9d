"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sizes are counted in words.  Every source gets a target: its weight's share of
all words, at most ``MOST`` times its own size, with the excess shared again by
weight.  The mix is handed out in blocks of ``BLOCK`` words.  Block quotas go to
the highest quotients target / (2k + 1), first over the sources, then in each
source over its groups of shards and in each group over its shards, so that no
step ranks more than a few thousand cells even where one source holds most rows.
A shard's documents stand in a line in seeded order; blocks are laid along the
line, round again from its end, and the first quota blocks are the shard's part
of the mix.  So a block is always whole, a document is taken at most ``MOST``
times, and a rerun gives the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import parts, stored, whole
from tidemark.operators.ordered import running_totals, with_rank

WEIGHTS = (5, 2, 1)   # by code point of the source, repeating
MOST = 3              # times a source or document may be repeated
BLOCK = 16            # words
SHARD_WORDS = 200_000
SHARD_DOCS = 500
SEED = "mix-1"


def _sized(df: DataFrame, keys: list[str], text: str, source: str, seed: str) -> DataFrame:
    """Row keys, source, size in words and the seeded hash; the text ends here."""
    first = F.coalesce(F.col(keys[0]).cast("string"), F.lit(""))
    return df.select(
        *keys,
        F.col(source).alias("_source"),
        F.coalesce(F.concat(F.lit("a"), F.col(source).cast("string")), F.lit("b")).alias("_place"),
        F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("_size"),
        F.md5(F.concat(F.lit(f"{seed}:"), first).cast("binary")).alias("_hash"),
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source (``_place``, ``_words``, ``_docs``): its weight and target.

    Sources are filled in the order of limit / weight.  Where the level that the
    rest would get lies at or above a source's limit, the source stops there.
    Sources may be as many as sites: they are numbered and summed by ranges.
    """
    numbered = with_rank(sizes, ["_place"], "_number").select(
        *sizes.columns,
        F.get(F.array(*map(F.lit, weights)), ((F.col("_number") - 1) % len(weights)).cast("int")).cast("long").alias("_weight"),
    )
    fill = F.col("_words") * most / F.col("_weight")
    summed = running_totals(numbered.withColumn("_fill", F.struct(fill.alias("at"), "_place")), "_fill", ["_words", "_weight"])
    level = (F.col("_words_total") - most * F.col("_words_before")) / (F.col("_weight_total") - F.col("_weight_before"))
    leveled = summed.select("*", level.alias("_level"))
    final = leveled.agg(F.min(F.when(F.col("_fill.at") > F.col("_level"), F.struct("_fill", "_level")))["_level"].alias("level")).scalar()
    return leveled.withColumn("_final", final).select(
        "_place", "_words", "_docs",
        F.coalesce(F.least(F.col("_weight") * F.col("_final"), (F.col("_words") * most).cast("double")), F.lit(0.0)).alias("_target"),
    )


def _sure(cells: DataFrame, seats: str) -> DataFrame:
    """Add ``_low`` and ``_high``: the seats that every and some divisor in reach gives a cell, from ``_sum`` and ``_n``."""
    v, n, s = F.col("_votes"), F.col("_n"), F.col(seats)
    return cells.select(
        "*",
        F.when(v > 0, F.greatest(F.lit(0), F.ceil(v / F.col("_sum") * (s - n / 2) - 0.5 - 1e-6))).otherwise(0).cast("long").alias("_low"),
        F.when(v > 0, F.greatest(F.lit(0), F.floor(v / F.col("_sum") * (s + n / 2) + 0.5 + 1e-6))).otherwise(0).cast("long").alias("_high"),
    )


def _tries() -> Column:
    return F.when(F.col("_high") > F.col("_low"), F.sequence("_low", F.col("_high") - 1))


def apportion(cells: DataFrame, parents: list[str], cell: str, votes: str, seats: str, quota: str) -> DataFrame:
    """Add ``quota``: Sainte-Laguë seats of every cell within its parents.

    The seats go to the highest quotients votes / (2k + 1), ties to the smaller
    cell.  Every cell is sure of the seats that any divisor in reach gives it;
    only the few quotients beyond those are ranked.
    """
    within = Window.partitionBy(*parents)
    v = F.col("_votes")
    counted = cells.withColumn("_votes", F.col(votes).cast("double")).select(
        "*", F.sum("_votes").over(within).alias("_sum"), F.count(F.when(v > 0, 1)).over(within).alias("_n")
    )
    bounds = _sure(counted, seats).withColumn("_left", F.col(seats) - F.sum("_low").over(within))
    ranked = bounds.select("*", F.explode_outer(_tries()).alias("_k")).withColumn(
        "_rank",
        F.row_number().over(within.orderBy(F.desc_nulls_last(v / (2 * F.col("_k") + 1)), cell, "_k")),
    )
    won = F.count(F.when(F.col("_k").isNotNull() & (F.col("_rank") <= F.col("_left")), 1))
    kept = [c for c in cells.columns if c not in (*parents, cell)]
    return (
        ranked.groupBy(*parents, cell)
        .agg(*[F.first(c).alias(c) for c in kept], (F.first("_low") + won).alias(quota))
    )


def apportion_all(cells: DataFrame, cell: str, votes: str, seats: int, quota: str) -> DataFrame:
    """``apportion`` over one parent with any number of cells: quotients are ranked by ranges, not in one task."""
    voted = cells.withColumn("_votes", F.col(votes).cast("double"))
    held = voted.agg(F.struct(F.sum("_votes").alias("sum"), F.count(F.when(F.col("_votes") > 0, 1)).alias("n")))
    counted = voted.withColumn("_held", held.scalar()).withColumns(
        {"_sum": F.col("_held.sum"), "_n": F.col("_held.n"), "_seats": F.lit(seats)}
    )
    bounds = stored(_sure(counted, "_seats").select(*cells.columns, "_votes", "_low", "_high"), "seats")
    left = bounds.agg(F.lit(seats) - F.coalesce(F.sum("_low"), F.lit(0)))
    tries = bounds.select(cell, "_votes", F.explode(_tries()).alias("_k")).select(
        F.struct((-F.col("_votes") / (2 * F.col("_k") + 1)).alias("q"), cell, "_k").alias("_try"), F.lit(1).cast("long").alias("_one")
    )
    ranked = running_totals(tries, "_try", ["_one"]).withColumn("_left", left.scalar())
    won = ranked.where(F.col("_one_before") < F.col("_left")).groupBy(F.col(f"_try.{cell}").alias("_winner")).agg(F.count(F.lit(1)).alias("_won"))
    return bounds.join(won, F.col(cell) == F.col("_winner"), "left").select(
        *cells.columns, (F.col("_low") + F.coalesce("_won", F.lit(0))).alias(quota)
    )


def _parts(docs: Column, total: Column, shard_words: int, shard_docs: int) -> tuple[Column, Column]:
    """Groups of a source and shards in a group: about a root of the shards each."""
    shards = F.greatest(F.lit(1), F.ceil(total / shard_words), F.ceil(docs / shard_docs))
    groups = F.ceil(F.sqrt(shards))
    return groups.cast("long"), F.ceil(shards / groups).cast("long")


def mix(
    df: DataFrame,
    keys: list[str],
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    block: int = BLOCK,
    shard_words: int = SHARD_WORDS,
    shard_docs: int = SHARD_DOCS,
    seed: str = SEED,
) -> DataFrame:
    """Key columns, source, size, source_size, target, taken: one row per row.

    ``taken`` is how many words of the document the mix takes, repeats counted.
    The first key seeds the order.  A null text has size 0, a null source is a
    source of its own after all others, rows without words are taken 0 times.
    Repeated rows each count.  Further columns aren't looked at; an empty table
    gives an empty result.
    """
    sized = stored(_sized(df, keys, text, source, seed), "sized")
    sizes = sized.groupBy("_place").agg(F.sum("_size").alias("_words"), F.count(F.lit(1)).alias("_docs"))
    targets = stored(source_targets(sizes, weights, most), "targets")
    seats = targets.agg(F.round(F.sum("_target") / block).cast("long")).first()[0] or 0
    sources = apportion_all(targets, "_place", "_target", seats, "_blocks")
    groups, shards = _parts(F.col("_docs"), F.col("_words"), shard_words, shard_docs)
    sources = stored(
        sources.select("_place", "_words", "_target", "_blocks", groups.alias("_groups"), shards.alias("_shards")), "sources"
    )
    spread = sized.join(sources, "_place").select(
        *keys, "_source", "_place", "_size", "_hash", "_words", "_target", "_blocks",
        (F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long") % F.col("_groups")).alias("_group"),
        (F.conv(F.substring("_hash", 9, 8), 16, 10).cast("long") % F.col("_shards")).alias("_shard"),
    )
    cells = spread.groupBy("_place", "_group", "_shard").agg(F.sum("_size").alias("_cell"), F.first("_blocks").alias("_blocks"))
    per_group = apportion(
        cells.groupBy("_place", "_group").agg(F.sum("_cell").alias("_held"), F.first("_blocks").alias("_blocks")),
        ["_place"], "_group", "_held", "_blocks", "_share",
    )
    per_shard = apportion(
        cells.drop("_blocks").join(per_group.select("_place", "_group", "_share"), ["_place", "_group"]),
        ["_place", "_group"], "_shard", "_cell", "_share", "_quota",
    )
    quotas = per_shard.select("_place", "_group", "_shard", "_quota")
    cell = Window.partitionBy("_place", "_group", "_shard")
    line = cell.orderBy("_hash", *keys, "_size").rowsBetween(Window.unboundedPreceding, 0)
    laid = spread.select("*", F.sum("_size").over(line).alias("_end"), F.sum("_size").over(cell).alias("_cell"))
    take = F.least(F.col("_quota") * block, F.col("_cell") * most)
    rest = F.when(F.col("_cell") > 0, take % F.col("_cell")).otherwise(0)
    start = F.col("_end") - F.col("_size")
    rounds = F.when(F.col("_cell") > 0, F.floor(take / F.col("_cell"))).otherwise(0)
    taken = rounds * F.col("_size") + F.greatest(F.lit(0), F.least(F.col("_end"), rest) - F.least(start, rest))
    return laid.join(quotas, ["_place", "_group", "_shard"]).select(
        *keys,
        F.col("_source").alias("source"),
        F.col("_size").alias("size"),
        F.col("_words").alias("source_size"),
        F.col("_target").alias("target"),
        taken.cast("long").alias("taken"),
    )


def _first_words(text: Column, count: Column) -> Column:
    """The text up to the end of word number ``count``; what stands before the first word stays."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0)), F.lit(1), count.cast("int")), "")


def mixed_rows(df: DataFrame, key: str, text: str = "text", source: str = "source", **settings) -> DataFrame:
    """The rows of ``df`` that the mix takes, each as often as it takes them.

    A row is given whole ``taken / size`` times, rounded down; what is left over
    of ``taken`` is given as its first words, so the words of a source are those
    of the blocks it is due.  Only the last document of a shard's line is cut.
    Rows without words are not taken.  Rows of one key, source and text share
    their words evenly.  Other columns stay as they are.
    """
    settled = df.select(
        whole(df), F.col(key).alias("_key"), F.xxhash64(text).alias("_text1"), F.xxhash64(F.lit(1), text).alias("_text2"),
        F.col(text).alias("_text"), F.col(source).alias("_source"),
    )
    same = ["_key", "_text1", "_text2"]
    plan = mix(settled, same, "_text", "_source", **settings).groupBy(*same, "source").agg(
        F.sum("taken").alias("_taken"), F.max("size").alias("_size"), F.count(F.lit(1)).alias("_copies")
    ).where("_taken > 0").withColumnsRenamed({"_key": "_k", "_text1": "_t1", "_text2": "_t2", "source": "_s"})
    rows = settled.join(
        plan,
        settled["_key"].eqNullSafe(plan["_k"]) & (settled["_text1"] == plan["_t1"]) & (settled["_text2"] == plan["_t2"])
        & settled["_source"].eqNullSafe(plan["_s"]),
    ).drop("_k", "_t1", "_t2", "_s")
    one, several = rows.where("_copies = 1"), rows.where("_copies > 1")
    # of equal rows the first ones take a word more where the words don't divide
    turn = F.row_number().over(Window.partitionBy(*same, "_source").orderBy(F.lit(0)))
    even = F.floor(F.col("_taken") / F.col("_copies")) + F.when(F.col("_turn") <= F.col("_taken") % F.col("_copies"), 1).otherwise(0)
    own = one.withColumn("_own", F.col("_taken")).select("_whole", "_size", "_own").unionByName(
        several.withColumn("_turn", turn).select("_whole", "_size", even.cast("long").alias("_own"))
    )
    # the words of each time: all of them, or what is left over
    rest = F.col("_own") % F.col("_size")
    times = F.concat(
        F.array_repeat(F.col("_size"), F.floor(F.col("_own") / F.col("_size")).cast("int")),
        F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")),
    )
    given = own.select("_whole", "_size", F.explode(times).alias("_words"))
    own_text = F.col("_whole").getField(text)
    cut = F.when(F.col("_words") == F.col("_size"), own_text).otherwise(_first_words(own_text, F.col("_words")))
    return given.select(*[cut.alias(c) if c == text else part for c, part in zip(df.columns, parts(df), strict=True)])
