"""Document fingerprints of closed syncmers.

The letters of the method are words.  Every run of ``s`` words has a hash; a run
of ``k`` words is an anchor if the smallest hash among its inner runs stands at
either edge.  Whether a run is an anchor depends on its own words alone, so equal
passages have equal anchors whatever stands around them, and every window of
inner runs holds at least one.  A fingerprint lists the anchors of a text in text
order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import parts, stored, whole, words
from tidemark.operators.ordered import running_totals

K, S = 4, 1
NEIGHBOURS = 64   # ids per block when documents are put next to each other


def with_anchors(df: DataFrame, texts: dict[str, str], k: int = K, s: int = S) -> DataFrame:
    """``df`` with the anchors of text columns: arrays of (hash, place in words), in text order.

    ``texts`` gives the new column of each text column.  A text of fewer than
    ``k`` words is one anchor as a whole; a text without words, or null, has none.
    Words, inner runs and anchors are made in projections of their own, as each is
    used several times by the next.
    """
    if not 1 <= s <= k:
        raise ValueError("1 <= s <= k")
    width = k - s + 1

    def fields(row: Column, count: int) -> list[Column]:
        return [row[str(i)] for i in range(count)]

    def is_anchor(r: Column) -> Column:
        if width <= 2:
            return F.lit(True)
        between = fields(r, width)[1:-1]
        middle = F.least(*between) if len(between) > 1 else between[0]
        return F.least(r["0"], r[str(width - 1)]) <= middle

    def found(letters: str, inner: str) -> Column:
        count = F.greatest(F.size(inner) - (width - 1), F.lit(0))
        places = F.slice(F.sequence(F.lit(0), F.size(inner)), F.lit(1), count)
        runs = F.arrays_zip(*_slices(inner, width), places)
        every = F.transform(
            F.filter(runs, is_anchor), lambda r: F.struct(F.xxhash64(*fields(r, width)).alias("hash"), r[str(width)].alias("place"))
        )
        whole = F.array(F.struct(F.xxhash64(letters).alias("hash"), F.lit(0).alias("place")))
        return F.when(F.size(letters) >= k, every).when(F.size(letters) > 0, whole).otherwise(F.slice(whole, 1, 0))

    columns = [F.col(f"`{c}`") for c in df.columns if c not in texts.values()]
    letters = df.select(*columns, *[F.transform(words(F.col(t)), lambda w: F.xxhash64(w)).alias(f"_letters_{n}") for t, n in texts.items()])
    if s > 1:
        inner = letters.select(
            "*", *[F.transform(F.arrays_zip(*_slices(f"_letters_{n}", s)), lambda r: F.xxhash64(*fields(r, s))).alias(f"_inner_{n}") for n in texts.values()]
        )
        return inner.select(*columns, *[found(f"_letters_{n}", f"_inner_{n}").alias(n) for n in texts.values()])
    return letters.select(*columns, *[found(f"_letters_{n}", f"_letters_{n}").alias(n) for n in texts.values()])


def _slices(array: str, width: int) -> list[Column]:
    count = F.greatest(F.size(array) - (width - 1), F.lit(0))
    return [F.slice(array, i + 1, count) for i in range(width)]


def likeness(union: Column, shared: Column) -> Column:
    """Shared part (Dice) of two hash lists, from the sizes of their union and intersection.

    1 for equal texts, two empty ones included; 0 for nothing shared.
    """
    return F.when(union == 0, 1.0).otherwise(2 * shared / (union + shared))


def with_next(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (_doc, _text, _next): every text with the one that follows by id.

    Ids are cut into blocks of ``NEIGHBOURS``; inside a block a window finds the
    next text, and the last row of a block gets the first of the next block.  Blocks
    are numbered by ranges, as there is one per document where ids are sparse.
    Null ids come first, equal ids in the order of their texts; the last row is
    followed by the first.
    """
    lowest = F.lit(-(1 << 62))
    rows = df.select(
        F.col(doc_id).cast("long").alias("_doc"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        F.coalesce(F.floor(F.col(doc_id) / NEIGHBOURS).cast("long"), lowest).alias("_block"),
    )
    blocks = rows.select("_block").distinct().withColumn("_one", F.lit(1).cast("long"))
    numbered = stored(running_totals(blocks, "_block", ["_one"]), "text_blocks")
    lefts = numbered.select(F.col("_block").alias("_before"), (F.col("_one_before") + 1).alias("_number"))
    turn = F.when(F.col("_one_before") == 0, F.col("_one_total")).otherwise(F.col("_one_before"))
    before = numbered.select("_block", turn.alias("_number")).join(lefts, "_number").select("_block", "_before")
    order = Window.partitionBy("_block").orderBy(F.asc_nulls_first("_doc"), "_text")
    inside = rows.select(
        "*",
        F.lead("_text").over(order).alias("_next"),
        F.row_number().over(order).alias("_place"),
    )
    ends = inside.where(F.col("_next").isNull() | (F.col("_place") == 1))
    meet = ends.join(before, "_block").select(
        "_doc", "_text",
        F.explode(
            F.filter(
                F.array(
                    F.when(F.col("_next").isNull(), F.struct(F.col("_block").alias("at"), F.lit(0).alias("role"))),
                    F.when(F.col("_place") == 1, F.struct(F.col("_before").alias("at"), F.lit(1).alias("role"))),
                ),
                lambda e: e.isNotNull(),
            )
        ).alias("_end"),
    )
    pair = Window.partitionBy("_end.at").orderBy("_end.role")
    last = meet.select("_doc", "_text", "_end", F.lead("_text").over(pair).alias("_next")).where("_end.role = 0")
    return inside.where(F.col("_next").isNotNull()).select("_doc", "_text", "_next").unionByName(
        last.select("_doc", "_text", "_next")
    )


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """``df`` with ``anchors``: array of (hash, place).

    A null text counts as empty and has no anchors; rows stay as they are,
    repeated ones too; a column named anchors is replaced.
    """
    kept = df.drop("anchors")
    rows = df.select(whole(kept), F.col(text).alias("_text"))
    return with_anchors(rows, {"_text": "_found"}, k, s).select(*parts(kept), F.col("_found").alias("anchors"))


def aligned(one: Column, other: Column) -> Column:
    """Positional matches: (hash, place, other_place) of the anchors that both lists hold.

    For every anchor of the first list, the earliest place of its hash in the other.
    """
    hashes = F.transform(other, lambda a: a["hash"])
    return F.filter(
        F.transform(
            one,
            lambda a: F.struct(
                a["hash"].alias("hash"), a["place"].alias("place"),
                F.get(other, (F.array_position(hashes, a["hash"]) - 1).cast("int"))["place"].alias("other_place"),
            ),
        ),
        lambda m: m["other_place"].isNotNull(),
    )


def edited_fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last quarter (in code points, rounded down) replaced
    by as many of the first code points of the next document by id, or by all of
    it.  Columns: doc_id, n_chars, edited, fingerprint, edited_fingerprint,
    near_edited, near_next.  Null texts are empty; an empty text has an empty
    fingerprint, which is like another empty one only.  An empty table gives an
    empty result.
    """
    size = F.char_length("_text")
    cut = F.floor(size / 4).cast("int")
    edited = with_next(df, doc_id, text).select(
        "_doc", "_text", "_next", size.cast("long").alias("n_chars"),
        F.concat(F.substring("_text", F.lit(1), size - cut), F.substring("_next", F.lit(1), cut)).alias("edited"),
    )

    found = with_anchors(edited, {"_text": "_own", "edited": "_edited", "_next": "_other"}, k, s)
    lists = found.select(
        "_doc", "n_chars", "edited",
        *[F.transform(c, lambda a: a["hash"]).alias(c) for c in ("_own", "_edited", "_other")],
    )
    sizes = lists.select(
        "*",
        *[F.size(F.array_union("_own", c)).alias(f"_union{c}") for c in ("_edited", "_other")],
        *[F.size(F.array_intersect("_own", c)).alias(f"_shared{c}") for c in ("_edited", "_other")],
    )
    return sizes.select(
        F.col("_doc").alias(doc_id), "n_chars", "edited",
        F.array_join(F.col("_own").cast("array<string>"), ",").alias("fingerprint"),
        F.array_join(F.col("_edited").cast("array<string>"), ",").alias("edited_fingerprint"),
        likeness(F.col("_union_edited"), F.col("_shared_edited")).alias("near_edited"),
        likeness(F.col("_union_other"), F.col("_shared_other")).alias("near_next"),
    )
