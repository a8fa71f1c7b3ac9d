"""Line dedup, joins, mixing, fingerprints, quality, search and pipeline, with odd inputs."""

import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import tiktoken
import public_tokenizers
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_text import DOC
from tidemark.llm import bpe, components, hamming, jaccard, lines, mixing, quality, queries, shingles, syncmers
from tools.compare import compare, connect

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_matches_sql(spark, duck, data, name):
    _, rows, verdict = compare(spark, duck, name, queries.QUERIES[name], queries.CHECKS[name], data)
    assert verdict == "same" and rows > 0


# --- lines ------------------------------------------------------------------------


def test_boilerplate_lines(spark):
    common, rare = "this line is on every site", "this line is on few sites only"
    rows = [(i, f"own {i} start\n{common}\n{rare if i < 3 else 'other ' + str(i)}\nend", "en", f"s{i}", 0, "x") for i in range(12)]
    rows += [(20, None, "en", "s1", 0, "x"), (21, "", None, None, 0, "x"), (22, f"{common}\n{common}", "en", None, 0, "x")]
    rows += [(23, f"{common}\nkept", "en", "s1", 0, "x")] * 2
    table = spark.createDataFrame(rows, DOC + ", _row1 string")
    got = sorted(lines.dedupe_lines(table, min_sites=10, min_chars=10).collect(), key=lambda r: (r.doc_id, str(r.text)))
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and all(r._row1 == "x" for r in got)
    assert common in by_id[0].text and by_id[0].n_removed == 0           # the first place keeps it
    assert all(common not in by_id[i].text and by_id[i].n_removed == 1 for i in range(1, 12))
    assert all(rare in by_id[i].text for i in range(3))
    assert by_id[20].text is None and by_id[20].n_lines == 0 and by_id[21].text == "" and by_id[21].n_lines == 1
    assert by_id[22].text == "" and by_id[22].n_removed == 2
    assert [r.text for r in got if r.doc_id == 23] == ["kept", "kept"]
    assert lines.dedupe_lines(table.limit(0)).count() == 0


@pytest.mark.parametrize("sites", [1, 2, 5, 6, 19, 25])
def test_statement_and_operator_agree_on_any_number_of_sites(spark, tmp_path, sites):
    rng = random.Random(sites)
    texts = ["\n".join(rng.sample([f"line {n} of all" for n in range(30)], 8)) for _ in range(5 * sites)]
    rows = [(i, t, "en", None if i % sites == 3 else f"s{i % sites}", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOC).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    part = next((tmp_path / "documents.parquet").glob("*.parquet"))
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{part}')")
    want = con.sql(f"SELECT doc_id, text, n_lines, n_removed FROM ({queries.CHECKS['op2_line_dedup']})").fetchall()
    got = queries.QUERIES["op2_line_dedup"](spark, str(tmp_path)).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_threshold_is_exact_on_both_sides(spark):
    rows = [(d, f"line number {n} of all", "en", f"s{d}", 0) for n in range(8, 13) for d in range(n)]
    got = lines.dedupe_lines(spark.createDataFrame(rows, DOC), min_sites=10, min_chars=5).groupBy("text").count().collect()
    left = {r.text: r["count"] for r in got}
    assert {n: left[f"line number {n} of all"] for n in range(8, 13)} == {8: 8, 9: 9, 10: 1, 11: 1, 12: 1}


def test_short_lines_and_few_sites(spark):
    rows = [(d, f"own line {d}\nshare\n\n\t\nend {d}", "en", f"s{d}", 0) for d in range(12)]
    got = {r.doc_id: r for r in lines.dedupe_lines(spark.createDataFrame(rows, DOC)).collect()}
    assert "share" in got[0].text and all("share" not in got[d].text and "\n\n\t\n" in got[d].text for d in range(1, 12))
    few = [(d, f"own line {d}\n{'on half' if d < 3 else 'other'}\n{'on two' if d < 2 else d}", "en", f"s{d % 6}", 0) for d in range(6)]
    table = spark.createDataFrame(few, DOC)
    assert lines.site_threshold(table) == 3
    left = {r.doc_id: r.text.split("\n") for r in lines.dedupe_lines(table).collect()}
    assert [d for d in left if "on half" in left[d]] == [0] and sorted(d for d in left if "on two" in left[d]) == [0, 1]
    alone = [(d, "the same", "en", None, 0) for d in range(9)]
    assert {r.n_removed for r in lines.dedupe_lines(spark.createDataFrame(alone, DOC)).collect()} == {0}


# --- shingle join -----------------------------------------------------------------


def plain_set(text, width):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def plain_components(rows, width, num, den):
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(i, plain_set(t, width)) for i, t in rows]
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and den * len(x & y) >= num * len(x | y):
                one, two = find(i), find(j)
                root[max(one, two)] = min(one, two)
    return {i: (len(s), find(i)) for i, s in sets}


def varied(rng, count, words=120):
    """Texts around a few bases: copies, small and large edits, common passages, short texts."""
    names = [f"w{i}" for i in range(400)]
    passage = [rng.choice(names) for _ in range(60)]
    bases = [[rng.choice(names) for _ in range(rng.randint(words // 2, words))] for _ in range(4)]
    out = []
    for _ in range(count):
        text = list(rng.choice(bases))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 5))):
            text[rng.randrange(len(text))] = rng.choice(names)
        if rng.random() < 0.2:
            text += passage
        if rng.random() < 0.1:
            text = text[: rng.randint(0, 6)]
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("width, num, den, paired, small", [(3, 90, 100, 256, 48), (5, 80, 100, 40, 6), (3, 90, 100, 60, 3)])
def test_join_equals_brute_force(spark, monkeypatch, width, num, den, paired, small):
    monkeypatch.setattr(jaccard, "PAIRED", paired)
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "FREQUENT", 8)
    monkeypatch.setattr(jaccard, "WIDE", paired)
    monkeypatch.setattr(jaccard, "KEYS_SENT", paired)  # both ways of fetching texts
    rng = random.Random(width * num + paired)
    texts = varied(rng, 220) + ["", "  \n", "One", "one", "A b", "a B", "x " * 4000, "x " * 4001]
    rows = list(enumerate(texts))
    table = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, _a int").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(table, width=width, num=num, den=den).collect()}
    assert got == plain_components(rows, width, num, den)


@pytest.mark.parametrize("small, block, tokens, num", [(48, 1024, 1 << 19, 80), (3, 5, 1 << 19, 80), (1, 3, 1 << 19, 90), (2, 1024, 700, 90)])
def test_numbers_of_links_equal_brute_force(spark, monkeypatch, small, block, tokens, num):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(jaccard, "COLUMNS", 64)
    monkeypatch.setattr(jaccard, "FREQUENT", 8)
    texts = varied(random.Random(small + block), 160) + ["", "One", "one", "A b"]
    texts += [texts[0]] * 3
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    sets = [plain_set(t, 3) for t in texts]
    want = {
        i: sum(1 for j, y in enumerate(sets) if i != j and x and y and 100 * len(x & y) >= num * len(x | y))
        for i, x in enumerate(sets)
    }
    assert {r.doc_id: r.n_links for r in jaccard.join(table, width=3, num=num, den=100).collect()} == want


def test_large_families_of_texts_that_stay_apart(spark, monkeypatch):
    """Copies around the threshold: most pairs share every list, and only some of them are linked."""
    monkeypatch.setattr(jaccard, "BLOCK", 40)
    monkeypatch.setattr(jaccard, "SMALL", 6)
    rng = random.Random(23)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for _ in range(260):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"c{rng.randrange(400)}"
        texts.append(" ".join(words[: rng.choice((120, 120, 112, 100))]))
    rows = list(enumerate(texts))
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), width=3, num=90, den=100).collect()
    sets = [plain_set(t, 3) for t in texts]
    want = [sum(1 for j, y in enumerate(sets) if i != j and 100 * len(x & y) >= 90 * len(x | y)) for i, x in enumerate(sets)]
    assert {r.doc_id: r.n_links for r in got} == dict(enumerate(want)) and len(set(want)) > 9
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain_components(rows, 3, 90, 100)
    with pytest.raises(ValueError):
        jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), num=50, den=100)


def test_places_reached_over_links():
    rng = np.random.default_rng(5)
    for own in (True, False):
        for _ in range(60):
            height, width = rng.integers(1, 14, 2)
            linked = rng.random((height, height if own else width)) < rng.random() * 0.3
            linked = linked | linked.T if own else linked
            size = height if own else height + width
            root = list(range(size))
            pairs = [(i, j if own else height + j) for i, j in zip(*np.nonzero(linked), strict=True)]
            for _ in range(size):
                for i, j in pairs:
                    root[i] = root[j] = min(root[i], root[j])
            assert jaccard.reached(linked, own).tolist() == root


def test_large_sets_meet_as_often_as_their_extension_promises():
    rng = random.Random(6)
    for _ in range(200):
        n = rng.randint(60, 400)
        one = set(rng.sample(range(10_000), n))
        two = set(one)
        for _ in range(rng.randint(0, n // 12)):
            two.discard(rng.choice(sorted(two)))
            two.add(rng.randrange(10_000))
        for t in rng.sample(range(10_000), rng.randint(0, n // 30)):
            two.add(t)
        frequent = np.array(sorted(rng.sample(range(10_000), rng.choice((0, 2000, 9000)))), np.uint64)
        order = np.array(rng.sample(range(len(frequent)), len(frequent)))
        if 100 * len(one & two) >= 80 * len(one | two):
            entries = [set(jaccard.signatures(np.array(sorted(s), np.uint64), frequent, order, 80, 100, 50).tolist()) for s in (one, two)]
            assert len(entries[0] & entries[1]) >= 2 + min(len(one), len(two)) // jaccard.STRIDE


def test_signatures_share_an_entry_for_every_link():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(2, 120)
        one = set(rng.sample(range(10_000), n))
        two = set(one)
        for _ in range(rng.randint(0, max(1, n // 8))):
            two.discard(rng.choice(sorted(two))) if len(two) > 1 else None
            two.add(rng.randrange(10_000))
        frequent = np.array(sorted(rng.sample(range(10_000), rng.choice((0, 2000, 9000)))), np.uint64)
        order = np.array(rng.sample(range(len(frequent)), len(frequent)))
        if 100 * len(one & two) >= 80 * len(one | two) and one != two:
            entries = [set(jaccard.signatures(np.array(sorted(s), np.uint64), frequent, order, 80, 100).tolist()) for s in (one, two)]
            assert entries[0] & entries[1]


def test_join_odd_tables(spark):
    schema = "doc_id long, text string, component_id string"
    assert jaccard.join(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f g", "z"), (5, "a b c d e f g", "z"), (5, "a b c d e f g", "z"), (5, "other words stand in this one", "z"), (6, None, "z"), (7, "", "z")]
    table = spark.createDataFrame(rows, schema)
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard.join(table).collect())
    assert got == [("5", 2, 5), ("5", 3, 5), ("5", 3, 5), ("6", 0, 6), ("7", 0, 7), ("None", 3, 5)]
    kept = sorted((str(r.doc_id), str(r.text), r.component_id) for r in jaccard.keep_one(table).collect())
    assert kept == [("5", "a b c d e f g", "z"), ("5", "other words stand in this one", "z"), ("6", "None", "z"), ("7", "", "z")]
    no_words = spark.createDataFrame([(1, None, ""), (2, " ", "")], schema)
    assert {r.component_id for r in jaccard.join(no_words).collect()} == {1, 2}


def test_shingles_of_long_texts_in_chunks(monkeypatch):
    text = " ".join(f"word{i % 997} Äb{i}" for i in range(3000))
    whole = shingles.shingle_set(text, 3)
    monkeypatch.setattr(shingles, "CHUNK", 700)
    assert (shingles.shingle_set(text, 3) == whole).all() and len(whole) == len(plain_set(text, 3))
    assert len(shingles.shingle_set(None, 3)) == len(shingles.shingle_set(" \t", 3)) == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(8)
    pairs = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(70, 60), (5, 5), (2001, 2000), (2000, 2001)]
    pairs = [p if rng.random() < 0.5 else p[::-1] for p in pairs]
    got = {r.a: r.b for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {**{i: 0 for i in [*range(61), 70]}, **{1000 + i: 1000 for i in range(200)}, 2000: 2000, 2001: 2000}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- mix --------------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: most * sizes[s] for s in over})


def test_targets_and_takes(spark):
    rng = random.Random(9)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 60))), rng.choice(["a", "a", "a", "b", "c", "é", None, "tiny"] if i % 40 else ["tiny"])) for i in range(1500)]
    rows += [(2000, None, "b"), (2001, "x y", "b"), (2001, "x y", "b"), (None, "q r s", "c"), (2002, "", "nothing")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, _size int")
    settings = {"shard_words": 2000, "shard_docs": 200}
    got = mixing.mix(table, ["doc_id"], **settings).collect()
    again = mixing.mix(table.repartition(7), ["doc_id"], **settings).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    targets = plain_targets(dict(sizes))
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and 0 <= r.taken <= 3 * r.size
        assert abs(r.target - targets[r.source]) < 1e-6 * max(1, targets[r.source])
        taken[r.source] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 2 * mixing.BLOCK
    assert mixing.mix(table.limit(0), ["doc_id"]).count() == 0
    assert {r.taken for r in mixing.mix(table.where("doc_id in (2000, 2002)"), ["doc_id"]).collect()} == {0}
    rows = mixing.mixed_rows(table.withColumn("_round", F.lit(1)), "doc_id", **settings)
    assert rows.columns == [*table.columns, "_round"] and rows.count() > 0


def test_emitted_words_meet_the_targets(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{j}" for j in range(rng.randint(1, 90))), f"s{i % 5}") for i in range(300)]
    rows += [(1000, " \t" + "\n ".join(f"v{j}" for j in range(50_000)) + "\n", "z long"), (1001, "a b c d e f g h i j", "tiny"), (1002, None, "tiny")]
    rows += [(1003, "one two three", "s1")] * 2 + [(None, "no id", "s2"), (1001, "other text of one id", "s3")]
    table = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, _size int")
    settings = {"shard_words": 3000, "shard_docs": 60}
    plan = mixing.mix(table, ["doc_id"], **settings).collect()
    target = {r.source: r.target for r in plan}
    emitted = defaultdict(int)
    whole = {t for _, t, _ in rows}
    for r in mixing.mixed_rows(table, "doc_id", **settings).collect():
        emitted[r.source] += len(r.text.split())
        assert r.text in whole or any(t.startswith(r.text) for t in whole if t)
        assert r._size == 7
    assert 1000 < target["z long"] < 40_000                     # a part of its only document
    for source, words in target.items():
        assert abs(emitted[source] - words) <= 2 * mixing.BLOCK, source
    assert mixing.mixed_rows(table.limit(0), "doc_id").count() == 0


def test_seats_go_to_the_highest_quotients(spark):
    rng = random.Random(10)
    cells, want = [], {}
    for parent in range(20):
        votes = [rng.choice((0, rng.randint(1, 50), rng.randint(1, 5000))) for _ in range(rng.randint(1, 12))]
        seats = rng.randint(0, 60) if any(votes) else 0
        heap = sorted(((-v / (2 * k + 1), i, k) for i, v in enumerate(votes) if v for k in range(seats)))[:seats]
        for i, v in enumerate(votes):
            cells.append((parent, i, float(v), seats))
            want[parent, i] = sum(1 for _, j, _ in heap if j == i)
    df = spark.createDataFrame(cells, "parent long, cell long, votes double, seats long")
    got = {(r.parent, r.cell): r.quota for r in mixing.apportion(df, ["parent"], "cell", "votes", "seats", "quota").collect()}
    assert got == want


def test_many_sources_are_ranked_without_a_one_task_window(spark):
    rng = random.Random(12)
    votes = [rng.choice((0, 7, 7, rng.randint(1, 40), rng.randint(1, 90_000))) for _ in range(700)]
    seats = 12_345
    heap = sorted((-v / (2 * k + 1), i, k) for i, v in enumerate(votes) if v for k in range(min(seats, v)))[:seats]
    want = defaultdict(int)
    for _, i, _ in heap:
        want[i] += 1
    cells = spark.createDataFrame([(i, float(v)) for i, v in enumerate(votes)], "cell long, votes double")
    got = {r.cell: r.quota for r in mixing.apportion_all(cells, "cell", "votes", seats, "quota").collect()}
    assert got == {i: want[i] for i in range(len(votes))}
    assert mixing.apportion_all(cells.limit(0), "cell", "votes", 0, "quota").count() == 0
    sizes = {f"s{i:04}": v for i, v in enumerate(votes)}
    frame = spark.createDataFrame([("a" + s, v, 1) for s, v in sizes.items()], "_place string, _words long, _docs long")
    targets = plain_targets(sizes)
    found = mixing.source_targets(frame)
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    for r in found.collect():
        assert abs(r._target - targets[r._place[1:]]) < 1e-6 * max(1, targets[r._place[1:]])


# --- fingerprints -----------------------------------------------------------------


def plain_anchors(text, k, s):
    def chain(values):
        h = 42
        for v in values:
            h = xxhash.xxh64_intdigest((v & (2**64 - 1)).to_bytes(8, "little"), h)
        return h - 2**64 if h >= 2**63 else h

    def one(word):
        h = xxhash.xxh64_intdigest(word.encode(), 42)
        return h - 2**64 if h >= 2**63 else h

    letters = [one(w) for w in WORD.findall(text or "")]
    if len(letters) < k:
        return letters and [(None, 0)]
    inner = letters if s == 1 else [chain(letters[i : i + s]) for i in range(len(letters) - s + 1)]
    width = k - s + 1
    out = []
    for i in range(len(inner) - width + 1):
        run = inner[i : i + width]
        if min(run) in (run[0], run[-1]):
            out.append((chain(run), i))
    return out


@pytest.mark.parametrize("k, s", [(4, 1), (5, 2), (3, 3), (2, 1), (1, 1)])
def test_anchors_equal_brute_force(spark, data, k, s):
    table = spark.read.parquet(f"{data}/documents.parquet").limit(40).unionByName(
        spark.createDataFrame([(900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, "one", "en", "s", 3), (903, "b " * 3000, "en", "s", 0)], DOC)
    ).withColumn("anchors", F.lit(1)).withColumn("_text", F.lit(2))
    for r in syncmers.fingerprints(table, k=k, s=s).collect():
        want = plain_anchors(r.text, k, s)
        assert len(r.anchors) == len(want) and r._text == 2
        if want and want[0][0] is not None:
            assert [(a.hash, a.place) for a in r.anchors] == want


def test_edited_texts(spark):
    texts = {i * 37 % 5000: f"text {i} " * (i % 9) + f"tail{i} é" for i in range(300)}
    texts[7_000_000_000] = ""
    table = spark.createDataFrame([(i, t) for i, t in texts.items()] + [(None, "null id")], "doc_id long, text string")
    order = [(None, "null id"), *sorted(texts.items())]
    want = {}
    for at, (i, text) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        cut = len(text) // 4
        want[i] = (len(text), text[: len(text) - cut] + following[:cut])
    rows = syncmers.edited_fingerprints(table.repartition(6)).collect()
    assert {r.doc_id: (r.n_chars, r.edited) for r in rows} == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    again = syncmers.edited_fingerprints(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")).collect()
    assert again[0].fingerprint == again[1].fingerprint and again[0].near_next == 1.0
    alone = syncmers.edited_fingerprints(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()
    assert alone[0].fingerprint == "" and alone[0].near_edited == 1.0
    assert syncmers.edited_fingerprints(table.limit(0)).count() == 0


def test_positional_matches(spark):
    rows = spark.createDataFrame([("a b c d e f g h", "x a b c d e f g h")], "one string, two string")
    both = syncmers.with_anchors(rows, {"one": "p", "two": "q"}).select(syncmers.aligned(F.col("p"), F.col("q")).alias("m")).first().m
    assert both and all(m.other_place == m.place + 1 for m in both)


# --- quality ----------------------------------------------------------------------


def test_quality_rejects_poor_and_keeps_good(spark, data):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("_host", F.lit("x")).withColumn("quality_keep", F.lit("x"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality.score(table, labels).join(labels, "doc_id").toPandas()
    assert (scored.quality_keep == (scored.quality == 1)).mean() > 0.98
    assert scored[scored.quality == 1].quality_keep.all()
    kept = quality.keep_good(table, labels)
    assert kept.columns == table.columns and 0.75 < kept.count() / table.count() < 0.95
    odd = spark.createDataFrame([(1, None, None, None, 0), (2, "", None, "s", 0), (2, "", None, "s", 0)], DOC)
    assert quality.score(odd, labels.limit(0)).where("quality_keep").count() == 3
    assert quality.score(odd.limit(0), labels).count() == 0


def test_quality_is_fitted_on_all_labelled_rows(spark):
    """More labelled rows than the 20,000 that were once sampled: every one has its say."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["aB", "c1.", "d!", "Eee", "#%&f"]) for _ in range(1 + i % 7)), i % 3) for i in range(24_000)]
    frame = spark.createDataFrame([(i, t, "en", f"s{k}", len(t)) for i, t, k in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4, "doc_id")
    labels = spark.createDataFrame([(i, int(rng.random() < 0.2 + 0.6 * ("!" in t))) for i, t, _ in rows], "doc_id long, quality int")
    columns = quality.measures(F.col("text"))
    part = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(5)).alias("_part")
    found = quality.score(frame, labels).join(labels, "doc_id").select("quality", part, "quality_evidence", "quality_score", "quality_keep", *[c.alias(n) for n, c in columns.items()]).toPandas()
    x, y, own = found[list(columns)].to_numpy(float), found.quality.to_numpy(float), found._part.to_numpy() != 0
    mean, scale = x[own].mean(0), x[own].std(0) + 1e-9
    a, w = np.c_[np.ones(len(x)), (x - mean) / scale], np.zeros(len(columns) + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-a[own] @ w))
        w -= np.linalg.solve((a[own] * (p * (1 - p))[:, None]).T @ a[own] + quality.RIDGE * np.eye(len(w)), a[own].T @ (p - y[own]) + quality.RIDGE * w)
    assert np.abs(1 / (1 + np.exp(-a @ w)) - found.quality_evidence).max() < 1e-5
    held = found[found._part == 0]
    limit = quality.cut_off(held.quality_score.to_numpy(float), held.quality.to_numpy(float))
    assert (found.quality_keep == (found.quality_score >= limit)).all()


def test_sparse_hosts_are_shrunk(spark):
    rng = np.random.default_rng(0)
    rows = [("big", "p", float(c)) for c in rng.beta(8, 2, 400)] + [("poor", "p", float(c)) for c in rng.beta(2, 8, 400)] + [("small", "p", 0.05)]
    groups, mean, host, path = quality.posteriors(spark.createDataFrame(rows, "_host string, _path string, _chance double"))
    r = {g._host: (g._host_s + host * mean) / (g._host_n + host) for g in groups.collect()}
    assert abs(r["big"] - 0.8) < 0.05 and abs(r["poor"] - 0.2) < 0.05 and 0.05 < r["small"] < 0.5
    assert quality.cut_off(np.array([1.0, 2.0, 3.0, 4.0]), np.array([0, 0, 1, 1])) == 2.5


# --- search -----------------------------------------------------------------------


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(400, 40))
    vectors[100:180] = vectors[0]                                  # one code held by many
    vectors[180:260] = vectors[0] * np.where(rng.random((80, 40)) < 0.05, -1, 1)
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)]
    rows += [(400, None, 1), (401, [], 1), (402, [1.0, None], 1), (0, rows[0][1], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    asked = table.where("vec_id % 20 = 0")

    def code(v):
        return "".join("1" if i < len(v) and v[i] is not None and v[i] >= 0 else "0" for i in range(48))

    known = {i: code(v) for i, v, _ in rows if v is not None}
    want = set()
    for q in [i for i in known if i % 20 == 0]:
        near = sorted((sum(a != b for a, b in zip(known[q], c)), i) for i, c in known.items() if i != q)[:7]
        want |= {(q, n + 1, i, d) for n, (d, i) in enumerate(near)}
    got = {tuple(r) for r in hamming.search(table, asked, k=7).collect()}
    assert got == want
    assert hamming.search(table.limit(0), asked.limit(0)).count() == 0
    few = table.where("vec_id < 3")
    assert hamming.search(few, few, k=7).count() == 6


# --- pipeline ---------------------------------------------------------------------


def test_pipeline_equals_plain_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], data).cache())
    assert all(f.columns == docs.columns for f in frames[1:-1])
    good, lined, single, mixed, encoded = frames[1:]
    poor = {r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").where("quality = 0").collect()}
    fine = {r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").where("quality = 1").collect()}
    kept = {r.doc_id for r in good.collect()}
    assert not poor & kept and fine <= kept

    sites = defaultdict(set)
    for r in good.collect():
        for line in r.text.split("\n"):
            sites[line.strip(" ")].add(r.source)
    least = min(lines.MIN_SITES, max(2, (len({r.source for r in good.collect()}) + 1) // 2))
    common = {line for line, s in sites.items() if len(s) >= least and len(line) >= lines.MIN_CHARS}
    seen, want = set(), {}
    for r in sorted(good.collect(), key=lambda r: r.doc_id):
        out = []
        for line in r.text.split("\n"):
            if line.strip(" ") in common and line.strip(" ") in seen:
                continue
            seen.add(line.strip(" "))
            out.append(line)
        want[r.doc_id] = "\n".join(out)
    assert {r.doc_id: r.text for r in lined.collect()} == want and all(r.n_chars == len(r.text) for r in lined.collect())

    roots = plain_components([(r.doc_id, r.text) for r in sorted(lined.collect(), key=lambda r: r.doc_id)], 5, 80, 100)
    assert {r.doc_id for r in single.collect()} == {i for i, (n, root) in roots.items() if i == root or n == 0}

    plan = {r.doc_id: r for r in mixing.mix(single, ["doc_id"]).collect()}
    given = defaultdict(list)
    for r in mixed.collect():
        given[r.doc_id].append(r.text)
    whole = {r.doc_id: r.text for r in single.collect()}
    assert {i: len(texts) for i, texts in given.items()} == {
        i: r.taken // r.size + (r.taken % r.size > 0) for i, r in plan.items() if r.taken
    }
    for i, texts in given.items():  # whole texts, then the first words of one
        words, (full, rest) = WORD.findall(whole[i]), divmod(plan[i].taken, plan[i].size)
        texts.sort(key=len, reverse=True)
        assert texts[:full] == [whole[i]] * full
        assert [WORD.findall(t) for t in texts[full:]] == ([words[:rest]] if rest else [])

    entries = bpe.read_ranks(None, public_tokenizers.path(queries.RANKS))
    reference = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={e: i for i, e in enumerate(entries)}, special_tokens={}
    )
    want = sorted((r.doc_id, reference.encode_ordinary(r.text)) for r in mixed.collect())
    assert sorted((r.doc_id, r.ids) for r in encoded.collect()) == want
    assert corpus_pipeline.run(spark, data).count() == encoded.count()
