"""Exact top-k search over binary codes by multi-index hashing.

A vector's code has one bit per dimension (set where the value isn't negative),
cut into segments of about log2(classes) bits, so that a segment value is held by
one class or so however large the index is.  Equal codes are one class.  The index
lists every class under each of its segment values.  If all segment values within
``r`` bits of a query's are looked up, every code not seen differs by more than
``r`` bits in each segment, so by at least ``segments * (r + 1)`` in all.  Step
``r`` looks up the values that differ by exactly ``r`` bits and adds what they hold
to what the query has met before; a query is done when its k-th verified distance
lies below that bound.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SEGMENTS = 8, 30   # bits of a segment, at least and at most
K = 10


def codes(df: DataFrame, key: str, vector: str, bits: int) -> DataFrame:
    """Distinct (_id, _code): the code of every vector that isn't null, as words of 32 bits."""

    def word(start: int) -> Column:
        return reduce(add, [F.when(F.get(vector, F.lit(start + b)) >= 0, F.lit(1 << b)).otherwise(0).cast("long") for b in range(32)])

    return (
        df.where(F.col(vector).isNotNull())
        .select(F.col(key).alias("_id"), F.array(*[word(start) for start in range(0, bits, 32)]).alias("_code"))
        .distinct()
    )


def segment_values(code: str, bits: int, width: int) -> Column:
    """The code cut into segments of ``width`` bits, as an array of numbers."""

    def cut(start: int) -> Column:
        at, shift = divmod(start, 32)
        low = F.shiftright(F.get(code, F.lit(at)), shift)
        high = F.shiftleft(F.coalesce(F.get(code, F.lit(at + 1)), F.lit(0).cast("long")), 32 - shift)
        return low.bitwiseOR(high).bitwiseAND(F.lit((1 << width) - 1))

    return F.array(*[cut(start) for start in range(0, bits, width)])


def _masks(own: Column, width: int, radius: int) -> Column:
    """Every value that differs from ``own`` in exactly ``radius`` of ``width`` bits, as an array.

    The bits are flipped from the lowest up, each above the one before.
    """
    powers = F.array(*[F.lit(1 << i).cast("long") for i in range(width)])

    def flipped(flips: Column, left: int) -> Column:
        """All flips with one bit more, ``left`` more to come."""
        places = F.sequence(F.lit(0), F.lit(width - 1 - left))
        return F.flatten(F.transform(flips, lambda f: F.transform(
            F.filter(places, lambda b: b >= f["next"]),
            lambda b: F.struct(f["v"].bitwiseXOR(F.get(powers, b)).alias("v"), (b + 1).alias("next")),
        )))

    flips = F.array(F.struct(own.alias("v"), F.lit(0).alias("next")))
    for left in range(radius - 1, -1, -1):
        flips = flipped(flips, left)
    return F.transform(flips, lambda f: f["v"])


def search(
    df: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, bits: int | None = None
) -> DataFrame:
    """Rows (query_id, rank, <key>, distance): the ``k`` nearest rows of every query.

    Both inputs have the key and the vector; the neighbours of a query are the
    rows of ``df`` of other ids, nearest first, ties by id.  Rows equal in id and
    code count once.  Missing and null elements are 0 bits; ``bits`` defaults to
    the longest vector's length.  Null vectors aren't indexed and find nothing;
    null ids find but aren't found.  With fewer than ``k`` other rows a query gets
    them all.  Further columns aren't looked at; empty tables give an empty result.
    """
    if bits is None:
        longest = df.select(key, vector).unionByName(queries.select(key, vector)).agg(F.max(F.size(vector))).first()[0]
        bits = max(longest or 1, 1)
    everyone = stored(codes(df, key, vector, bits), "codes")
    asked = stored(codes(queries, key, vector, bits).toDF("_query", "_asked"), "asked")

    # a class needs no more ids than one query can take, its own id apart
    own = Window.partitionBy("_code").orderBy("_id")
    ids = stored(
        everyone.where(F.col("_id").isNotNull()).select("*", F.row_number().over(own).alias("_turn")).where(F.col("_turn") <= k + 1)
        .groupBy("_code").agg(F.collect_list("_id").alias("_ids")),
        "code_classes",
    )
    width = min(max(ids.count().bit_length(), SEGMENTS[0]), SEGMENTS[1], bits)
    segments = -(-bits // width)
    index = stored(
        ids.select("_code", F.size("_ids").alias("_n"), F.posexplode(segment_values("_code", bits, width)).alias("_segment", "_value")),
        "code_index",
    )
    distance = reduce(add, [F.bit_count(F.get("_asked", F.lit(w)).bitwiseXOR(F.get("_code", F.lit(w)))) for w in range(-(-bits // 32))])
    here, there = segment_values("_asked", bits, width), segment_values("_code", bits, width)
    # queries still open, with a distance that their k-th doesn't exceed
    open_ = asked.select("_asked").distinct().withColumn("_bound", F.lit(bits))
    met: DataFrame | None = None
    done: list[DataFrame] = []
    for radius in range(width + 1):
        reach = segments * (radius + 1) - 1
        last = reach >= bits or radius == width
        probes = open_.select("*", F.posexplode(here).alias("_at", "_own")).select(
            "_asked", "_bound", "_at", F.explode(_masks(F.col("_own"), width, radius)).alias("_looked")
        )
        # a code is new if no segment is nearer, and is taken at the first segment as near as this
        first = reduce(and_, [
            F.bit_count(F.get(here, F.lit(j)).bitwiseXOR(F.get(there, F.lit(j)))) >= F.when(F.col("_at") > j, radius + 1).otherwise(radius)
            for j in range(segments)
        ])
        new = probes.hint("merge").join(index, (F.col("_at") == F.col("_segment")) & (F.col("_looked") == F.col("_value")) & first).select(
            "_asked", "_code", "_n", distance.cast("int").alias("_distance"), "_bound"
        ).where(F.col("_distance") <= F.col("_bound")).drop("_bound")
        met = stored(new if met is None else met.unionByName(new), "codes_met")
        kth = (
            met.groupBy("_asked", "_distance").agg(F.sum("_n").alias("_n"))
            .select("_asked", "_distance", F.sum("_n").over(Window.partitionBy("_asked").orderBy("_distance")).alias("_upto"))
            .where(F.col("_upto") > k)
            .groupBy("_asked").agg(F.min("_distance").alias("_kth"))
        )
        bounds = stored(open_.join(kth, "_asked", "left").select("_asked", F.coalesce("_kth", F.lit(bits)).alias("_bound"), F.col("_kth").isNotNull().alias("_full")), "codes_bound")
        covered = F.lit(True) if last else F.col("_full") & (F.col("_bound") <= reach)
        held = met.join(bounds, "_asked").where(F.col("_distance") <= F.col("_bound"))
        done.append(held.where(covered).select("_asked", "_code", "_distance"))
        open_ = bounds.where(~covered).select("_asked", "_bound")
        if last or open_.isEmpty():
            break
        met = held.where(~covered).select("_asked", "_code", "_n", "_distance")
    found = reduce(DataFrame.unionByName, done)
    rows = (
        asked.join(found, "_asked")
        .join(ids, "_code")
        .select("_query", "_distance", F.explode("_ids").alias("_id"))
        .where(~F.col("_id").eqNullSafe(F.col("_query")))
    )
    order = Window.partitionBy("_query").orderBy("_distance", "_id")
    return (
        rows.groupBy("_query", "_id").agg(F.min("_distance").alias("_distance"))
        .select("*", F.row_number().over(order).alias("rank"))
        .where(F.col("rank") <= k)
        .select(F.col("_query").alias("query_id"), "rank", F.col("_id").alias(key), F.col("_distance").alias("distance"))
    )
