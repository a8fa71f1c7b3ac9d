"""SimHash near-duplicates, found by joining a binary trie of the fingerprints with itself.

A pair of trie nodes stands for all pairs of fingerprints below them.  It carries the
number of bits in which the paths of the two differ; a pair is followed to its
children's pairs only as long as that number is within the budget.  Fingerprints
that differ in at most ``distance`` bits differ in at most half as many in one of
their two halves, so the join runs over two tries, one from each half, and the first
half of a path has half the budget.  A pair that both tries would find is left to the
first.

The upper levels are a Spark job: nodes are prefixes with a count, and pairs of nodes
that hold more than ``LEAF`` fingerprints together are split further, so that no
group grows with the data, however alike its fingerprints are.  Pairs that are small
enough are walked bit by bit in one task, all pairs of a level at once.  A task does
not give the links it finds, but every fingerprint's number of links and the smallest
fingerprint that it reaches inside the pair, so the rows it gives are at most as many
as its fingerprints.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_rows, stored
from tidemark.llm.components import components

BITS = 64
HALF = 32
SEED = 42
LEAF = 4096      # fingerprints of a pair of nodes that one task walks
STEP = 4         # bits by which larger nodes are split
FRONTIER = 1 << 19  # node pairs of a level that are held at once
_SLICE = 1 << 20    # bytes of a text that are cut into words at a time
_SHINGLES = 1 << 15  # hashes whose bits are counted at a time
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


# --- fingerprints -----------------------------------------------------------------


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in slices of whole words; A-Z in lower case (bytes know no other letters)."""
    at = 0
    while at < len(text):
        stop = at + _SLICE
        if stop < len(text):
            blank = _BLANK.search(text, stop)
            stop = blank.start() if blank else len(text)
        yield text[at:stop].lower().split()
        at = stop


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included, as a signed number.

    A bit is set if more than half of the shingles' hashes (XXH64) have it.  Fewer
    words than ``width`` are one shingle; without words the fingerprint is zero.
    """
    import xxhash

    digest = xxhash.xxh64_intdigest
    ones, count, held = np.zeros(BITS, np.int64), 0, []

    def flush():
        nonlocal ones, count
        bits = np.unpackbits(np.array(held, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        count += len(held)
        held.clear()

    tail: list[bytes] = []
    for words in _word_lists(text or b""):
        words = tail + words
        for start in range(0, len(words) - width + 1, _SHINGLES):
            part = words[start : start + _SHINGLES + width - 1]
            shingles = map(b" ".join, zip(*[part[k:] for k in range(width)]))
            held.extend([digest(s, seed=SEED) for s in shingles])
            flush()
        tail = words[len(words) - width + 1 :] if len(words) >= width else words
    if not count and tail:
        held.append(digest(b" ".join(tail), seed=SEED))
        flush()
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """Rows (_id, _code), one per row of ``df``."""
    schema = T.StructType([T.StructField("_id", df.schema[doc_id].dataType), T.StructField("_code", T.LongType())])
    rows = df.select(F.col(doc_id).alias("_id"), F.col(text).cast("binary").alias("_text"))
    return arrow_rows(rows, ["_id", "_text"], lambda _, ids, texts: [ids, [fingerprint(t, width) for t in texts]], schema)


# --- one pair of nodes ------------------------------------------------------------


def linked_pairs(one: np.ndarray, two: np.ndarray | None, depth: int, budget: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of all pairs of two nodes whose bits differ within the budget.

    ``one`` and ``two`` are the sorted codes (unsigned) below the two nodes at
    ``depth``; without ``two`` the pairs are those inside ``one``, i < j.
    ``budget[d]`` is how many bits may differ in the first d.
    """
    codes = one if two is None else np.concatenate((one, two))
    # ones[d, i]: how many of the first i codes have bit d set, which gives the border between a node's children
    ones = np.zeros((BITS, len(codes) + 1), np.int32)
    for d in range(depth, BITS):
        np.cumsum((codes >> np.uint64(BITS - 1 - d)) & np.uint64(1), out=ones[d, 1:])
    if two is None:
        first = np.array([[0], [len(one)], [0], [len(one)]])
    else:
        first = np.array([[0], [len(one)], [len(one)], [len(codes)]])
    stack = [(depth, first)]
    while stack:
        depth, nodes = stack.pop()
        if nodes.shape[1] > FRONTIER:
            middle = nodes.shape[1] // 2
            stack += [(depth, nodes[:, :middle]), (depth, nodes[:, middle:])]
            continue
        lo1, hi1, lo2, hi2 = nodes
        # two single codes, or the end of the path: the bits themselves decide
        ends = ((hi1 - lo1 == 1) & (hi2 - lo2 == 1)) if depth < BITS else np.ones(len(lo1), bool)
        if ends.any():
            i, j = lo1[ends], lo2[ends]
            differ = codes[i] ^ codes[j]
            good = (i != j) & (np.bitwise_count(differ) <= budget[BITS])
            good &= np.bitwise_count(differ >> np.uint64(BITS - HALF)) <= budget[HALF]
            yield i[good], j[good]
            nodes = nodes[:, ~ends]
            lo1, hi1, lo2, hi2 = nodes
        if not nodes.shape[1]:
            continue
        border = ones[depth]
        mid1, mid2 = hi1 - (border[hi1] - border[lo1]), hi2 - (border[hi2] - border[lo2])
        same = lo1 == lo2
        children = [
            np.stack((lo1, mid1, lo2, mid2)),
            np.stack((mid1, hi1, mid2, hi2)),
            np.stack((lo1, mid1, mid2, hi2)),
            np.stack((mid1, hi1, lo2, mid2))[:, ~same],  # the mirror of the one before in a pair of a node with itself
        ]
        met = np.concatenate(children, axis=1)
        met = met[:, (met[0] < met[1]) & (met[2] < met[3])]
        # the paths' difference is the same for all codes below, so any code of each tells it
        differ = np.bitwise_count((codes[met[0]] ^ codes[met[2]]) >> np.uint64(BITS - 1 - depth))
        alone = (met[0] == met[2]) & (met[1] - met[0] == 1)
        stack.append((depth + 1, met[:, (differ <= budget[depth + 1]) & ~alone]))


def _roots(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place that each place reaches over the links (i, j)."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def walk(one: list[int], two: list[int] | None, sizes1: list[int], sizes2: list[int], depth: int, second: bool, distance: int):
    """(codes, roots, links) of the codes of a pair of nodes that have a link.

    Codes are turned for the second trie, whose links are only those that the first
    doesn't find.  ``links`` counts a link once per document of the other code.
    """
    budget = _budget(distance)
    a, w1 = _sorted_codes(one, sizes1)
    b, w2 = (None, None) if two is None else _sorted_codes(two, sizes2)
    codes = a if b is None else np.concatenate((a, b))
    weights = w1 if b is None else np.concatenate((w1, w2))
    links, left, right = np.zeros(len(codes), np.int64), [], []
    root = np.arange(len(codes))
    for i, j in linked_pairs(a, b, depth, budget):
        if second:
            fresh = np.bitwise_count((codes[i] ^ codes[j]) & np.uint64((1 << (BITS - HALF)) - 1)) > budget[HALF]
            i, j = i[fresh], j[fresh]
        np.add.at(links, i, weights[j])
        np.add.at(links, j, weights[i])
        left.append(root[i])
        right.append(root[j])
        if sum(map(len, left)) > FRONTIER:
            root = _roots(len(codes), np.concatenate([np.arange(len(codes)), *left]), np.concatenate([root, *right]))
            left, right = [], []
    root = _roots(len(codes), np.concatenate([np.arange(len(codes)), *left]), np.concatenate([root, *right]))
    has = np.flatnonzero(links)
    turned = codes if not second else (codes << np.uint64(HALF)) | (codes >> np.uint64(BITS - HALF))
    return turned[has].view(np.int64), turned[root[has]].view(np.int64), links[has]


def _budget(distance: int) -> np.ndarray:
    """How many bits may differ in the first d bits of a path."""
    return np.where(np.arange(BITS + 1) <= HALF, distance // 2, distance)


def _sorted_codes(codes: list[int], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    own = np.array(codes, np.int64).view(np.uint64)
    order = np.argsort(own)
    return own[order], np.array(sizes, np.int64)[order]


# --- the tries --------------------------------------------------------------------


def _masks(before: int, width: int, distance: int) -> F.Column:
    """All ways in which ``width`` further bits may differ, as arrays by the bits that differ already."""
    budget = int(_budget(distance)[before + width])
    values = [
        [sum(1 << b for b in bits) for n in range(budget - used + 1) for bits in combinations(range(width), n)]
        for used in range(budget + 1)
    ]
    return F.array(*[F.array(*[F.lit(m).cast("long") for m in row]) for row in values])


def _prefix(depth: int) -> F.Column:
    return F.shiftrightunsigned(F.col("_path"), BITS - depth) if depth else F.lit(0).cast("long")


def _split(tries: DataFrame, pairs: DataFrame | None, before: int, depth: int, distance: int) -> DataFrame:
    """Pairs of nodes (_trie, _p, _q, _used, _n1, _n2) at ``depth``, from those at ``before`` (none: from the top)."""
    nodes = tries.groupBy("_trie", _prefix(depth).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    if before or pairs is not None:
        parents = F.shiftrightunsigned("_p", depth - before)
        kids = nodes.select("_trie", F.col("_p").alias("_kid"), F.col("_n").alias("_n1"), parents.alias("_p"))
        met = pairs.select("_trie", "_p", "_q", "_used").join(kids, ["_trie", "_p"])
        stems, used = F.col("_q"), F.col("_used")
    else:
        met = nodes.select("_trie", F.col("_p").alias("_kid"), F.col("_n").alias("_n1"))
        stems, used = F.lit(0).cast("long"), F.lit(0).cast("long")
    width = depth - before
    # the other side is made from this one: its path differs by a mask, and it has to exist
    masked = met.select(
        "_trie", "_kid", "_n1", stems.alias("_stem"), used.alias("_used"),
        F.explode(F.get(_masks(before, width, distance), used.cast("int"))).alias("_mask"),
    )
    low = F.lit((1 << width) - 1).cast("long")
    other = masked.select(
        "_trie", F.col("_kid").alias("_p"), "_n1",
        F.shiftleft("_stem", width).bitwiseOR(F.col("_kid").bitwiseAND(low).bitwiseXOR(F.col("_mask"))).alias("_q"),
        (F.col("_used") + F.bit_count("_mask")).alias("_used"), (F.shiftrightunsigned("_kid", width) == F.col("_stem")).alias("_own"),
    ).where("NOT _own OR _p <= _q").drop("_own")  # a node's pair with itself gives every other pair twice
    return other.join(nodes.select("_trie", F.col("_p").alias("_q"), F.col("_n").alias("_n2")), ["_trie", "_q"])


def _walked(tries: DataFrame, pairs: DataFrame, depth: int, distance: int) -> DataFrame:
    """Rows (_code, _root, _links) of the small pairs of nodes at ``depth``."""
    wanted = pairs.select("_trie", "_p").unionByName(pairs.select("_trie", F.col("_q").alias("_p"))).distinct()
    held = (
        tries.withColumn("_p", _prefix(depth)).join(wanted, ["_trie", "_p"])
        .groupBy("_trie", "_p").agg(F.collect_list(F.struct("_path", "_size")).alias("_held"))
    )
    one = held.select("_trie", "_p", F.col("_held._path").alias("_one"), F.col("_held._size").alias("_sizes1"))
    two = one.toDF("_trie", "_q", "_two", "_sizes2")
    both = pairs.select("_trie", "_p", "_q").join(one, ["_trie", "_p"]).join(two, ["_trie", "_q"])

    def work(_, trie, p, q, one, sizes1, two, sizes2):
        found = [
            walk(a, None if x == y else b, s, t, depth, turned == 1, distance)
            for turned, x, y, a, s, b, t in zip(trie, p, q, one, sizes1, two, sizes2, strict=True)
        ]
        empty = np.empty(0, np.int64)
        return [np.concatenate([empty, *[f[k] for f in found]]) for k in range(3)]

    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("_code", "_root", "_links")])
    # walks cost far more than their bytes tell, so they are dealt out by number
    dealt = both.repartition(max(both.sparkSession.sparkContext.defaultParallelism * 4, 16), "_trie", "_p", "_q")
    return arrow_rows(dealt, ["_trie", "_p", "_q", "_one", "_sizes1", "_two", "_sizes2"], work, schema)


def trie_join(classes: DataFrame, distance: int = 3, leaf: int = LEAF) -> DataFrame:
    """Rows (_code, _root, _links) from ``classes`` (_code, _size), whose codes are distinct.

    _root is a code that links within ``distance`` bits connect _code with; a code can
    have several rows, and ``_links`` adds up to the rows of other codes it is linked with.
    """
    turned = F.shiftleft("_code", HALF).bitwiseOR(F.shiftrightunsigned("_code", BITS - HALF))
    paths = F.array(F.struct(F.lit(0).alias("_trie"), F.col("_code").alias("_path")), F.struct(F.lit(1).alias("_trie"), turned.alias("_path")))
    tries = stored(classes.select(F.explode(paths).alias("_t"), "_size").select("_t._trie", "_t._path", "_size"), "tries")
    count = tries.where("_trie = 0").count()
    depth = min((count * 4 // leaf).bit_length(), HALF)
    before, pairs, found = 0, None, []
    while True:
        pairs = stored(_split(tries, pairs, before, depth, distance), "node_pairs")
        # a node is in a task once if it is paired with itself
        together = F.when(F.col("_p") == F.col("_q"), F.col("_n1")).otherwise(F.col("_n1") + F.col("_n2"))
        small = (together <= leaf) if depth < BITS else F.lit(True)
        found.append(stored(_walked(tries, pairs.where(small), depth, distance), "walked"))
        pairs = pairs.where(~small)
        if depth == BITS or pairs.isEmpty():
            break
        before, depth = depth, min(depth + STEP, BITS)
        if before < HALF < depth:
            depth = HALF  # the budget changes there
        open_ = pairs.select("_trie", "_p").unionByName(pairs.select("_trie", F.col("_q").alias("_p"))).distinct()
        tries = stored(tries.withColumn("_p", _prefix(before)).join(open_, ["_trie", "_p"], "left_semi").drop("_p"), "tries")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_groups(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, distance: int = 3, leaf: int = LEAF
) -> DataFrame:
    """Rows (<doc_id>, fingerprint, component_id, n_links): one per row of ``df``.

    ``fingerprint`` is the SimHash of the text's ``width``-word shingles as 16
    hexadecimal digits.  Rows are linked if their fingerprints differ in at most
    ``distance`` bits; component_id is the smallest id that links reach and n_links
    the number of other rows that the row is linked with.  Null, empty and blank texts
    have the fingerprint zero, which is linked like any other.  Null ids are never the
    smallest unless there is no other.  Repeated rows each give a row; further columns
    aren't looked at; an empty table gives an empty result.
    """
    rows = stored(fingerprints(df, doc_id, text, width), "fingerprints")
    classes = stored(rows.groupBy("_code").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_size")), "classes")
    found = trie_join(classes.select("_code", "_size"), distance, leaf)
    links = found.groupBy("_code").agg(F.sum("_links").alias("_links"))
    reached = components(found.select(F.col("_code").alias("a"), F.col("_root").alias("b"))).toDF("_code", "_root")
    placed = stored(
        classes.join(reached, "_code", "left").join(links, "_code", "left").select(
            "_code", "_first", F.coalesce("_root", "_code").alias("_root"),
            (F.coalesce("_links", F.lit(0)) + F.col("_size") - 1).alias("n_links"),
        ),
        "placed",
    )
    smallest = placed.groupBy("_root").agg(F.min("_first").alias("component_id"))
    named = stored(placed.join(smallest, "_root").select("_code", "component_id", "n_links"), "named")
    return rows.join(named, "_code").select(
        F.col("_id").alias(doc_id), F.lower(F.lpad(F.hex("_code"), 16, "0")).alias("fingerprint"), "component_id", "n_links"
    )
