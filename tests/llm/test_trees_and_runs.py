"""Fingerprint tries, Merkle manifests and periodic runs next to plain versions, with odd inputs."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.test_text import DOC
from tidemark.llm import merkle, periodic, queries, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet").collect()


# --- fingerprints -----------------------------------------------------------------


def plain_fingerprint(text, width=3):
    words = WORD.findall(lower(text or ""))
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(codes, distance=3):
    """(smallest place reached, number of linked places) of every code."""
    root, links = list(range(len(codes))), [0] * len(codes)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= distance:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(find(i), links[i]) for i in range(len(codes))]


def test_fingerprints_of_odd_texts():
    rng = random.Random(3)
    for text in [None, "", " \t\n", "one", "One  TWO", "a b c", "É A b c d", "x" * 3_000_000, "w " * 400_000]:
        assert simhash.fingerprint(None if text is None else text.encode()) % (1 << 64) == plain_fingerprint(text)
    long = " ".join(rng.choice(["alpha", "Beta", "gamma\n", "été", "δ"]) + str(rng.randrange(50)) for _ in range(350_000))
    assert len(long) > 2 * simhash._SLICE
    assert simhash.fingerprint(long.encode()) % (1 << 64) == plain_fingerprint(long)


def near_codes(rng, count):
    """Random codes, and families whose members differ in few bits, in either half or both."""
    codes = [rng.getrandbits(64) for _ in range(count)]
    for _ in range(count):
        code = rng.choice(codes)
        for b in rng.sample(range(64), rng.randrange(6)):
            code ^= 1 << b
        codes.append(code)
    middle = rng.getrandbits(64)
    codes += [middle ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(count // 2)]
    return [0, 1, (1 << 64) - 1, 1 << 63, *codes]


@pytest.mark.parametrize("leaf, distance", [(4096, 3), (2, 3), (16, 1), (16, 4)])
def test_trie_join_equals_all_pairs(spark, leaf, distance):
    codes = near_codes(random.Random(leaf + distance), 60)
    rows = [(i, c - (1 << 64) if c >> 63 else c) for i, c in enumerate(codes)]
    classes = spark.createDataFrame(rows, "_i long, _code long").groupBy("_code").agg(F.min("_i").alias("_i"), F.count(F.lit(1)).alias("_size"))
    found = simhash.trie_join(classes.select("_code", "_size"), distance, leaf)
    links = {r._code: r.n for r in found.groupBy("_code").agg(F.sum("_links").alias("n")).collect()}
    want = plain_groups(codes, distance)
    same = defaultdict(int)
    for _, c in rows:
        same[c] += 1
    assert [links.get(c, 0) + same[c] - 1 for _, c in rows] == [n for _, n in want]
    pairs = found.select(F.col("_code").alias("a"), F.col("_root").alias("b"))
    first = {c: i for i, c in reversed(rows)}
    reached = {}
    for r in simhash.components(pairs).collect():
        reached.setdefault(r.b, []).append(r.a)
    got = list(range(len(codes)))
    for members in reached.values():
        low = min(first[m] for m in members)
        for i, c in rows:
            if c in members:
                got[i] = low
    got = [got[first[c]] if c not in {m for ms in reached.values() for m in ms} else got[i] for i, c in rows]
    assert got == [root for root, _ in want]


def test_near_groups_of_odd_tables(spark):
    texts = [None, "", " ", "one", "One", "b c d e", None] + [f"some words of text {i} and more of it that goes on" for i in range(5)]
    rows = [(i, t, None, None, None, "x", 1) for i, t in enumerate(texts)] + [(3, "one", "en", "s", 3, "y", 2), (None, "one", None, None, 0, "z", 3)]
    table = spark.createDataFrame(rows, DOC + ", _code string, component_id int")
    got = simhash.near_groups(table).collect()
    codes = [plain_fingerprint(r[1]) for r in rows]
    want = [(r[0], f"{c:016x}", min((rows[j][0] for j in range(len(rows)) if plain_groups(codes)[j][0] == root and rows[j][0] is not None), default=None), n) for r, c, (root, n) in zip(rows, codes, plain_groups(codes))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert simhash.near_groups(table.limit(0)).count() == 0
    assert simhash.near_groups(table.where("doc_id IS NULL")).collect()[0].component_id is None


def test_query_of_near_groups(spark, data):
    docs = documents(spark, data)
    docs.sort(key=lambda r: r.doc_id)
    codes = [plain_fingerprint(r.text) for r in docs]
    want = {(r.doc_id, f"{c:016x}", docs[root].doc_id, n) for r, c, (root, n) in zip(docs, codes, plain_groups(codes))}
    found = queries.QUERIES["op11_simhash_trie"](spark, data)
    assert {tuple(r) for r in found.collect()} == want


# --- manifest ---------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_fold(nodes):
    """(top, for each node its siblings by level) of nodes in order."""
    paths = [[] for _ in nodes]
    groups = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [(nodes[i : i + 16], groups[i : i + 16]) for i in range(0, len(nodes), 16)]
        for run, owners in runs:
            for slot, own in enumerate(owners):
                for i in own:
                    paths[i].append((run[:slot], run[slot + 1 :]))
        nodes, groups = [sha("".join(run)) for run, _ in runs], [sum(owners, []) for _, owners in runs]
    return nodes[0], paths


def plain_manifest(rows):
    """Rows of (key, group, leaf, replacement) as the operator gives them."""
    by_group = defaultdict(list)
    for r in rows:
        by_group[r[1]].append(r)
    order = sorted(by_group, key=lambda g: (g is not None, (g or "").encode()))
    tops, inner = [], {}
    for g in order:
        by_group[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3] is not None, r[3] or ""))
        top, paths = plain_fold([r[2] for r in by_group[g]])
        tops.append(top)
        inner[g] = paths
    root, outer = plain_fold(tops)
    out = []
    for g, top, above in zip(order, tops, outer):
        for r, path in zip(by_group[g], inner[g]):
            node = r[3] or r[2]
            for left, right in path + above:
                node = sha("".join(left) + node + "".join(right))
            proof = sha("".join("".join(left) + "".join(right) for left, right in path + above))
            out.append((r[0], r[2], top, root, proof, node, node == root))
    return out


def leaves_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, leaf string, replacement string")


@pytest.mark.parametrize("sizes, per", [
    ([1], 3), ([2], 3), ([16], 3), ([17], 1), ([1, 1, 1], 3), ([5, 300, 16, 1, 257, 33], 1), ([4097, 3, 4096], 3), ([1] * 40 + [600], 1), ([1] * 4100, 3),
])
def test_manifest_equals_plain_tree(spark, sizes, per):
    rng = random.Random(len(sizes))
    rows, at = [], 0
    for g, n in enumerate(sizes):
        name = None if g == 1 else "é\U0001F600" if g == 2 else "￿" if g == 3 else f"s{g}"
        for _ in range(n):
            at += 1
            rows.append((at * 7919 % 100_003, name, sha(f"leaf {at}"), sha(f"other {at}") if rng.random() < 0.2 else None))
    rng.shuffle(rows)
    got = merkle.manifest(leaves_of(spark, rows).repartition(5), per=per).collect()
    assert sorted(map(tuple, got)) == sorted(plain_manifest(rows))


def test_manifest_of_odd_rows(spark):
    a, b = sha("a"), sha("b")
    rows = [(1, "s", a, None), (1, "s", a, None), (1, "s", a, b), (1, "s", b, None), (None, "s", a, b), (None, None, b, None), (2, "", a, a)]
    got = merkle.manifest(leaves_of(spark, rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_manifest(rows), key=str)
    assert merkle.manifest(leaves_of(spark, rows).limit(0)).count() == 0
    docs = spark.createDataFrame([(1, "AÉ", None, None, None, 5), (None, None, "en", "s", 2, 6), (3, "", "", "", 0, 7)], DOC + ", leaf int")
    found = {r.doc_id: r for r in merkle.document_leaves(docs, F.col("doc_id") > 0, F.lower("text")).collect()}
    assert found[1].leaf == sha("1:1---3:AÉ") and found[1].replacement == sha("1:1---3:aé")
    assert found[None].leaf == sha("-1:s2:en1:2-") and found[None].replacement is None
    assert found[3].leaf == sha("1:30:0:1:00:") == found[3].replacement


def test_state_is_resumed_at_the_slot():
    children = [sha(str(i)) for i in range(16)]
    parent = merkle.Parent(children)
    assert parent.digest == sha("".join(children))
    for slot in range(16):
        assert parent.replaced(slot, "x" * 64) == sha("".join([*children[:slot], "x" * 64, *children[slot + 1 :]]))
    assert len(parent.after[15]) == 0 and len(parent.after[0]) == 15 * 64


def test_query_of_the_manifest(spark, data):
    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))

    rows = []
    for r in documents(spark, data):
        tampered = zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        rows.append((r.doc_id, r.source, leaf(r, r.text), leaf(r, r.text and lower(r.text)) if tampered else None))
    got = queries.QUERIES["op12_merkle_midstates"](spark, data).collect()
    assert sorted(map(tuple, got)) == sorted(plain_manifest(rows))
    assert {r.verified for r in got} == {True, False}


# --- runs -------------------------------------------------------------------------


def plain_runs(words, shortest=24):
    out = []
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i < len(words) - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            own = words[start : i + q]
            if len(own) >= max(shortest, 3 * q) and not any(own[r:] == own[:-r] for r in range(1, q)):
                out.append((start, len(own), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def thue_morse(n):
    return [b"%d" % (bin(i).count("1") & 1) for i in range(n)]


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_all_lags(seed):
    rng = random.Random(seed)
    for _ in range(25):
        texts = []
        for _ in range(rng.randint(1, 6)):
            n, letters = rng.choice([0, 1, 23, 24, 30, 100, 300, 700]), rng.choice([1, 2, 3, 50])
            words = [b"%d" % rng.randrange(letters) for _ in range(n)]
            for _ in range(rng.randint(0, 4) if n > 10 else 0):
                start, period = rng.randrange(n), rng.randint(1, max(1, n // 3))
                for i in range(start + period, min(n, start + int(period * rng.uniform(2.5, 6)))):
                    words[i] = words[i - period]
            texts.append(words)
        assert periodic.runs_of(texts) == [plain_runs(t) for t in texts]


def test_runs_of_exact_lengths_and_self_similar_words():
    texts = []
    for period in [1, 2, 8, 16, 17, 24, 25, 36, 40, 100]:
        word = [b"%d" % i for i in range(period)]
        for extra in (-1, 0, 1):
            texts.append([b"x", *(word * 4)[: 3 * period + extra], b"y"])
    word = thue_morse(256)
    texts += [word * 3, [b"a", *word * 4, b"b"], thue_morse(2048), [b"a"] * 500, [b"a", b"b"] * 250 + [b"b"] * 60]
    fib = [b"a"], [b"a", b"b"]
    while len(fib[1]) < 900:
        fib = fib[1], fib[1] + fib[0]
    texts.append(list(fib[1]))
    assert periodic.runs_of(texts) == [plain_runs(t) for t in texts]
    assert periodic.runs_of([]) == [] and periodic.runs_of([[], [b"a"]]) == [[], []]
    assert periodic.runs_of(texts, shortest=100) == [plain_runs(t, 100) for t in texts]
    assert periodic.runs_of([[b"a"] * 60], shortest=100) == [[]]


def test_runs_of_a_very_long_text():
    rng = np.random.default_rng(5)
    words = [b"%d" % w for w in rng.integers(0, 1000, 400_000)]
    want = [(10, 90_000, 25_000), (200_000, 30_000, 3), (300_000, 60_000, 20_000)]
    for start, length, period in want:
        for i in range(start + period, start + length):
            words[i] = words[i - period]
        words[start + length] = b"end"
        words[start - 1] = b"begin"
    assert periodic.runs_of([words])[0] == want


def plain_collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_find_in_odd_tables(spark):
    texts = [None, "", " \n", "a " * 30, "É x " * 24 + "tail", "no run here", " ".join(["p", "q", "r"] * 9)]
    rows = [(i, t, "en", "s", 0, 7, 1) for i, t in enumerate(texts)] + [(0, None, None, None, None, 8, 1), (None, "b " * 24, None, None, None, 9, 1)]
    table = spark.createDataFrame(rows, DOC + ", _words int, runs int")
    got = periodic.find(table, ["doc_id", "_words"]).collect()
    assert len(got) == len(rows)
    found = {(r[0], r[1]): r for r in got}
    for row in rows:
        words, r = WORD.findall(row[1] or ""), found[row[0], row[5]]
        runs = plain_runs(words)
        assert r.n_words == len(words) and [tuple(x) for x in r.runs] == runs
        assert r.collapsed == plain_collapsed(words, runs)
        assert (r.strongest and tuple(r.strongest)) == min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
    assert periodic.find(table.limit(0), ["doc_id"]).count() == 0


def test_query_of_runs(spark, data):
    want = {}
    for r in documents(spark, data):
        words = WORD.findall(r.text or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = periodic.runs_of([[w.encode() for w in words]])[0] if n > 1500 else plain_runs(words)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        start, length, period = best or (None, None, None)
        want[r.doc_id] = (
            len(runs), start, length, period, 1000 * length // period if best else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(plain_collapsed(words, runs)),
        )
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op13_periodic_runs"](spark, data).collect()}
    assert got == want and any(v[0] for v in want.values())
