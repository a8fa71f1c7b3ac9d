"""Merkle manifest of a dataset: a tree of SHA-256 digests that keeps its hash states.

Every row is a leaf.  The leaves of a group (a source) stand in the order of a key;
every ``FAN`` consecutive nodes of a level become one, until one is left.  The groups'
last nodes, in the order of the groups, are built up in the same way to the root.

A parent is a hash over the digests of its children.  While it is computed, the state
before each child's slot is copied and kept.  When one child is replaced, the state of
its slot is resumed with the replacement and the right siblings only; what lies left
of it is not hashed again.

On Spark the rows are put in order by ranges; every range numbers its own rows, and the
counts of the ranges before it are added.  ``FAN ** LEVELS`` consecutive nodes are one
block, which one task can hold whatever the data; blocks are folded to their top
node, which is a row of the next table of blocks, until every group has one.  On the
way back each block hands its nodes the runs on their path to the root, so that the
leaves' blocks can fold and prove every leaf for itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import batch_sizes, stored

FAN = 16     # children of a node
LEVELS = 3   # levels that are folded in one block
DIGEST = 64  # letters of a digest


def field(column: Column) -> Column:
    """A value as its count of UTF-8 bytes, a colon and itself; null is a dash."""
    value = column.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


# --- nodes ------------------------------------------------------------------------


class Parent:
    """A node over the digests of its children, with the hash state before each child's slot."""

    def __init__(self, children: list[str]):
        self.children = children
        self.before = []
        state = hashlib.sha256()
        for child in children:
            self.before.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()
        joined = "".join(children).encode()
        self.after = [joined[(i + 1) * DIGEST :] for i in range(len(children))]

    def replaced(self, slot: int, child: str) -> str:
        """The digest with another child in a slot: its state goes on with the child and what is right of it."""
        state = self.before[slot].copy()
        state.update(child.encode())
        state.update(self.after[slot])
        return state.hexdigest()

    def siblings(self, slot: int) -> str:
        return "".join(self.children[:slot]) + "".join(self.children[slot + 1 :])


def levels(nodes: list[str], count: int | None) -> list[list[Parent]]:
    """The levels of parents over ``nodes``: ``count`` of them, or as many as leave one node."""
    out: list[list[Parent]] = []
    while len(out) < count if count is not None else len(nodes) > 1:
        out.append([Parent(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)])
        nodes = [p.digest for p in out[-1]]
    return out


def path_of(place: int, built: list[list[Parent]]) -> list[tuple[int, Parent]]:
    """(slot, parent) on the way up from the node at ``place``."""
    out = []
    for level in built:
        out.append((place % FAN, level[place // FAN]))
        place //= FAN
    return out


def prove(leaf: str, replacement: str | None, path: list[tuple[int, Parent]]) -> tuple[str, str]:
    """(digest over all siblings from below, root with the replacement in the leaf's place)."""
    proof, node = hashlib.sha256(), replacement or leaf
    for slot, parent in path:
        proof.update(parent.siblings(slot).encode())
        node = parent.replaced(slot, node)
    return proof.hexdigest(), node


# --- order and blocks -------------------------------------------------------------


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``_pos`` and ``_count``: every row's place in its group, from 0, and the group's rows.

    Rows are dealt out by ranges of group and order and numbered where they lie; the
    rows of a group in the ranges before are added.  Of rows equal in all of these any
    may be first.
    """
    columns = df.columns
    ranged = df.repartitionByRange(F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order])
    sorted_ = ranged.sortWithinPartitions(F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order])
    at = columns.index(group)

    def number(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        last, held = None, None  # the group of the row before, and its rows so far
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(at)
            fresh = np.ones(batch.num_rows, bool)
            if batch.num_rows > 1:
                a, b = values.slice(1), values.slice(0, batch.num_rows - 1)
                equal = pc.or_kleene(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
                fresh[1:] = ~equal.to_numpy(zero_copy_only=False)
            first = values[0].as_py()
            carried = held if held is not None and first == last else 0
            index = np.arange(batch.num_rows)
            starts = np.maximum.accumulate(np.where(fresh, index, 0))
            local = index - starts + np.where(starts == 0, carried, 0)
            last, held = values[batch.num_rows - 1].as_py(), int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local)], names=[*batch.schema.names, "_local"])

    batch_sizes(df.sparkSession)
    with_part = sorted_.withColumn("_part", F.spark_partition_id())
    schema = T.StructType([*with_part.schema.fields, T.StructField("_local", T.LongType())])
    placed = stored(with_part.mapInArrow(number, schema), "numbered")
    shares = placed.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        shares.select(
            F.col(group).alias("_g"), F.col("_part").alias("_p"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
            F.sum("_rows").over(Window.partitionBy(group)).alias("_count"),
        ),
        "offsets",
    )
    match = placed[group].eqNullSafe(offsets["_g"]) & (placed["_part"] == offsets["_p"])
    return placed.join(offsets, match).select(*columns, (F.col("_offset") + F.col("_local")).alias("_pos"), "_count")


def _blocks(nodes: DataFrame, per: int) -> DataFrame:
    """Rows (_group, _block, _count, _nodes): the nodes (_group, _pos, _count, _row) of every block in their order."""
    grouped = nodes.groupBy("_group", F.floor(F.col("_pos") / FAN**per).cast("long").alias("_block")).agg(
        F.first("_count").alias("_count"), F.sort_array(F.collect_list(F.struct("_pos", "_row"))).alias("_nodes")
    )
    return stored(grouped.select("_group", "_block", "_count", F.col("_nodes._row").alias("_nodes")), "blocks")


def _depth(count: int, per: int) -> int | None:
    """Levels of a block: all it takes if it is its group's only one, else always the same."""
    return None if count <= FAN**per else per


def _tops(blocks: DataFrame, per: int) -> DataFrame:
    """The top node of every block, as a node (_group, _pos, _count, _row) of the next table."""
    row = T.StructType([T.StructField("digest", T.StringType())])
    schema = T.StructType(
        [blocks.schema["_group"], T.StructField("_pos", T.LongType()), T.StructField("_count", T.LongType()), T.StructField("_row", row)]
    )

    def fold(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        fields = to_arrow_schema(schema)
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                built = levels(row["_digests"], _depth(row["_count"], per))
                top = built[-1][0].digest if built else row["_digests"][0]
                found.append((row["_group"], row["_block"], row["_tops"], {"digest": top}))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), fields, strict=True)], schema=fields)

    batch_sizes(blocks.sparkSession)
    tops = F.ceil(F.col("_count") / FAN**per).cast("long").alias("_tops")
    return blocks.select("_group", "_block", "_count", tops, F.col("_nodes.digest").alias("_digests")).mapInArrow(fold, schema)


PATH = T.ArrayType(T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("run", T.StringType())]))


def _with_paths(blocks: DataFrame, paths: DataFrame | None) -> DataFrame:
    """Blocks with the runs from their top node to the root (none: the top node is the root)."""
    if paths is None:
        return blocks.withColumn("_path", F.array().cast(PATH))
    own = paths.select(F.col("_group").alias("_g"), F.col("_pos").alias("_b"), "_path")
    return blocks.join(own, blocks["_group"].eqNullSafe(own["_g"]) & (blocks["_block"] == own["_b"])).drop("_g", "_b")


def _handed_down(blocks: DataFrame, per: int) -> DataFrame:
    """Rows (_group, _pos, _path): the runs from every node of blocks with paths up to the root."""
    schema = T.StructType([blocks.schema["_group"], T.StructField("_pos", T.LongType()), T.StructField("_path", PATH)])

    def hand(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        fields = to_arrow_schema(schema)
        for batch in batches:
            for row in batch.to_pylist():
                built = levels(row["_digests"], _depth(row["_count"], per))
                joined = [["".join(p.children) for p in level] for level in built]
                found = []
                for k in range(len(row["_digests"])):
                    own = [{"slot": k // FAN**i % FAN, "run": level[k // FAN ** (i + 1)]} for i, level in enumerate(joined)]
                    found.append((row["_group"], row["_block"] * FAN**per + k, own + row["_path"]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), fields, strict=True)], schema=fields)

    batch_sizes(blocks.sparkSession)
    slim = blocks.select("_group", "_block", "_count", F.col("_nodes.digest").alias("_digests"), "_path")
    return stored(slim.mapInArrow(hand, schema), "paths")


def _run(text: str) -> list[str]:
    return [text[i : i + DIGEST] for i in range(0, len(text), DIGEST)]


def _towers(nodes: DataFrame, per: int) -> tuple[list[DataFrame], DataFrame]:
    """The tables of blocks from below until every group has one, and the groups' top nodes.

    Groups of a single block leave after the first table; a later one has larger groups only.
    """
    tables, tops = [], None
    while True:
        blocks = _blocks(nodes, per)
        tables.append(blocks)
        above = stored(_tops(blocks, per), "tops")
        done = above.where("_count <= 1")
        tops = done if tops is None else tops.unionByName(done)
        nodes = above.where("_count > 1")
        if nodes.isEmpty():
            return tables, tops


def manifest(
    leaves: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    digest: str = "leaf",
    replacement: str = "replacement",
    per: int = LEVELS,
) -> DataFrame:
    """Rows (<key>, leaf, subroot, root, proof_sha256, folded_root, verified) for rows (<key>, <group>, <digest>, <replacement>).

    ``leaf`` is the row's digest, ``subroot`` and ``root`` are the top nodes of its
    group and of all.  ``proof_sha256`` is the digest of all siblings from the leaf to
    the root; ``folded_root`` is the root that the same siblings give with the
    replacement (null: the leaf itself), and ``verified`` says if it is the root.

    Groups and keys are in ascending order, nulls first, strings by their UTF-8 bytes.
    Rows equal in group and key are in the order of their digests, then replacements;
    repeated rows are leaves of their own.  ``per`` levels are folded in one block, which
    changes nothing in the result.  A single row is its subroot and root, with
    the digest of nothing as its proof.  An empty table gives an empty result.
    """
    kind = leaves.schema[key].dataType
    # written once, as the cut points of the ranges look at the leaves too
    plain = stored(
        leaves.select(F.col(group).alias("_group"), F.col(key).alias("_key"), F.col(digest).alias("digest"), F.col(replacement).alias("replacement")),
        "leaves",
    )
    placed = numbered(plain, "_group", ["_key", "digest", "replacement"])
    nodes = placed.select("_group", "_pos", "_count", F.struct("digest", F.col("_key").alias("key"), "replacement").alias("_row"))
    lower, subroots = _towers(nodes, per)
    subroots = stored(subroots.select("_group", F.col("_row.digest").alias("digest")), "subroots")

    # the groups' top nodes are the leaves of the upper tree
    sources = numbered(subroots.withColumn("_all", F.lit(0)), "_all", ["_group"])
    upper, tops = _towers(sources.select(F.col("_all").alias("_group"), "_pos", "_count", F.struct("digest").alias("_row")), per)
    path = None
    for blocks in reversed(upper):
        path = _handed_down(_with_paths(blocks, path), per)
    at_groups = (
        sources.join(path.select(F.col("_pos").alias("_p"), "_path"), F.col("_pos") == F.col("_p"))
        .select("_group", F.lit(0).cast("long").alias("_pos"), "_path")
    )

    def reached(blocks: DataFrame, above: DataFrame | None) -> DataFrame:
        """Blocks with their paths: a group's only block goes on among the groups, another in the table above."""
        only = F.col("_count") <= FAN**per
        own = _with_paths(blocks.where(only), at_groups)
        return own if above is None else own.unionByName(_with_paths(blocks.where(~only), above))

    above = None
    for blocks in reversed(lower[1:]):
        above = _handed_down(reached(blocks, above), per)
    tops_of = subroots.select(F.col("_group").alias("_g"), F.col("digest").alias("_subroot"))
    ready = reached(lower[0], above).withColumn("_root", tops.select("_row.digest").scalar())
    ready = ready.join(tops_of, ready["_group"].eqNullSafe(tops_of["_g"])).drop("_g")

    schema = T.StructType(
        [T.StructField(key, kind)]
        + [T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
        + [T.StructField("verified", T.BooleanType())]
    )

    def fold(batches) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        fields = to_arrow_schema(schema)
        for batch in batches:
            for row in batch.to_pylist():
                nodes = row["_nodes"]
                built = levels([n["digest"] for n in nodes], _depth(row["_count"], per))
                above = [(r["slot"], Parent(_run(r["run"]))) for r in row["_path"]]
                out = []
                for k, node in enumerate(nodes):
                    proof, folded = prove(node["digest"], node["replacement"], path_of(k, built) + above)
                    out.append((node["key"], node["digest"], row["_subroot"], row["_root"], proof, folded, folded == row["_root"]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), fields, strict=True)], schema=fields)

    batch_sizes(leaves.sparkSession)
    return ready.mapInArrow(fold, schema)


def document_leaves(df: DataFrame, replaced: Column, text: Column) -> DataFrame:
    """Rows (doc_id, source, leaf, replacement) of documents.

    A leaf digests doc_id, source, lang, n_chars and text; where ``replaced`` holds, the
    replacement does with another text.  Further columns aren't looked at.
    """
    def digest(text: Column) -> Column:
        return F.sha2(F.concat(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text)), 256)

    return df.select("doc_id", "source", digest(F.col("text")).alias("leaf"), F.when(replaced, digest(text)).alias("replacement"))
