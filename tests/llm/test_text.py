"""Extraction, personal data, secrets and encoding next to plain versions, with odd inputs."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import bpe, html, pii, queries, secrets

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, schema=DOC):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], schema)


# --- pages ------------------------------------------------------------------------


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<html><body><nav><a href=x>Menu</a></nav></body></html>", ""),
        ("<body><nav>a<ul><li>b</ul></nav><article><h1>T&amp;x</h1><p>One  <b>two</b>\nthree<br>four<p>five</article><footer>f</footer>", "T&x\nOne two three\nfour\nfive"),
        ("<article><p>a<div class='ad'>buy</div><p>b<form><input>q</form><section id=comments><p>no</section></article>", "a\nb"),
        ("<body><header>Site</header><div class='side-bar'>x</div><p>Body text.</p><div class=cookie-notice>ok?</div></body>", "Body text."),
        ("<script>if (a<b) '</p>'</script><style>p{}</style><p>x &#233;&eacute; &nbsp;y</p><!-- <p>z</p> -->", "x éé y"),
        ("<article><header><h1>Own head</h1></header><p>t</p></article>", "Own head\nt"),
        ("<p>cut off <b>in the midd", "cut off in the midd"),
        ("<article>" + "<p>word</p>" * 5000 + "</article>", "\n".join(["word"] * 5000)),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ('<div class="x""><p>kept text</p></div>', "kept text"),
        ("<p title=it's>kept text</p><p>more 'of' it", "kept text\nmore 'of' it"),
        ('<p data-a="1>2">kept</p>', "kept"),
        ("<p data-a=b=\"c>kept</p>", "kept"),
        ("<p a= 'x>y' b>kept</p>", "kept"),
        ('<a href = "x">kept</a> "as it is"', 'kept "as it is"'),
        ('<p class="never closed>gone', ""),
        ("<b>bold<div>block</b> after</div>tail", "bold\nblock after\ntail"),
        ("<i><li>one</i><li>two</ul>three", "one\ntwothree"),
    ],
)
def test_tags_end_where_a_browser_ends_them(page, text):
    assert html.main_text(page) == text


def test_deep_pages_take_linear_time():
    import time

    start = time.perf_counter()
    assert html.main_text("<div>" * 200_000 + "word") == "word"
    assert html.main_text("<b>" * 200_000 + "word" + "</b>" * 200_000) == "word"
    assert html.main_text("<p>one" + "<iframe/>" * 200_000 + "two") == "onetwo"
    assert html.main_text("<div><b>" * 100_000 + "word" + "</b></div>" * 100_000) == "word"
    assert time.perf_counter() - start < 60


BODY = "".join(f"<p>{'Some words of the body, one line of it. ' * 8}</p>" for _ in range(6))
AD = "<div class=ad>buy</div>"


@pytest.mark.parametrize(
    "page, has, lacks",
    [
        (f"<article><p>Teaser of another page</p></article>{BODY}", ["Some words"], []),
        (f"<article>{BODY}</article><div>Powered by a tool</div>", ["Some words"], ["Powered"]),
        (f"<p>Short opening.</p>{AD}{BODY}{AD}<p>Short end.</p>{AD}<p>PS.</p>", ["Short opening.", "Short end.", "PS."], []),
        (f"<article><p>Short opening.</p>{AD}{AD}{AD}{BODY}</article>", ["Short opening."], []),
        (f"{BODY}<p>See <a href=x>the whole source of it</a></p>", ["whole source"], []),
        (BODY + "".join(f"<div><a href={i}>Other page {i}</a></div>" for i in range(9)), ["Some words"], ["Other page"]),
        (f"{BODY}{AD}{AD}<div>tiny far line</div>", ["Some words"], ["tiny"]),
    ],
)
def test_windows_choose_and_marks_are_evidence(page, has, lacks):
    text = html.main_text(f"<body>{page}</body>")
    assert text.count("Some words") == 48
    assert all(part in text for part in has) and not any(part in text for part in lacks)


def test_surge_and_dive_are_where_window_sums_leave_and_reach_zero():
    lengths = [0, 0, 0, 5, 0, 9, 0, 0, 0, 0, 2]
    assert html.runs_of(lengths, 3) == [(1, 6), (8, 11)]
    assert html.runs_of([], 3) == [] and html.runs_of([0, 0], 3) == []


def test_pages_keep_every_row(spark):
    rows = [(1, "u", "<p>x</p>", "t1"), (1, "u", "<p>x</p>", "t1"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(html.extract(pages).collect(), key=str)
    assert [tuple(r) for r in got] == sorted([(1, "u", "x"), (1, "u", "x"), (None, None, "")], key=str)
    assert html.extract(pages.limit(0)).count() == 0


# --- byte pairs -------------------------------------------------------------------


@pytest.fixture(scope="module")
def entries():
    return bpe.read_ranks(None, public_tokenizers.path(queries.RANKS))


@pytest.fixture(scope="module")
def reference(entries):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={e: i for i, e in enumerate(entries)}, special_tokens={}
    )


@pytest.mark.parametrize("at_spaces", [False, True])
def test_ids_equal_the_merge_loop(entries, reference, at_spaces):
    own = bpe.Codec(entries, public_tokenizers.PATTERN, at_spaces)
    rng = random.Random(1)
    alphabets = ["ab c!", "  \n\t x'", "éüñß日本 ", "\x1c\x85 　\xa0a", "aaaa", "theing ", "0123 .,", "🎉👍a<|endoftext|>"]
    texts = ["", " ", "<|endoftext|>", "a" * 3000, " " * 3000, "the" * 1000]
    texts += ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for text in texts:
        ids = own.encode(text)
        assert ids == reference.encode_ordinary(text), text
        assert own.decode(ids) == text.encode()


def test_kept_stretches_stay_few(entries, reference):
    own = bpe.Codec(entries, public_tokenizers.PATTERN, at_spaces=True, kept=1 << 17)
    texts = [" ".join(f"the{i:x}q" for i in range(first, first + 3000)) for first in range(0, 180_000, 3000)]
    kept = 0
    for text in texts:
        assert own.encode(text) == reference.encode_ordinary(text)
        kept = max(kept, len(own.known) + len(getattr(own.known, "earlier", ())))
    assert kept <= 1 << 17
    assert len(own.compatible) <= 1 << 17


def test_encoded_table(spark, entries, data):
    table = spark.read.parquet(f"{data}/documents.parquet")
    reference = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={e: i for i, e in enumerate(entries)}, special_tokens={}
    )
    got = {r.doc_id: r.ids for r in bpe.encode(table, entries, public_tokenizers.PATTERN, ["doc_id"], at_spaces=True).collect()}
    assert got == {r.doc_id: reference.encode_ordinary(r.text) for r in table.collect()}
    odd = docs(spark, [None, "", "x", "x"]).withColumn("ids", F.lit("kept out"))
    encoded = bpe.encode(odd, entries, public_tokenizers.PATTERN, ["doc_id"])
    assert [(r.ids, bytes(r.decoded)) for r in encoded.orderBy("doc_id").collect()][:3] == [([], b""), ([], b""), (reference.encode_ordinary("x"), b"x")]
    assert {bytes(r.decoded) for r in bpe.decode(encoded, entries, ["doc_id"]).collect()} == {b"", b"x"}
    assert bpe.encode(odd.limit(0), entries, public_tokenizers.PATTERN, ["doc_id"]).count() == 0


# --- personal data ----------------------------------------------------------------


def plain_pii(t):
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def plain_secrets(t):
    out = [
        (m.start(), m.end(), "assign")
        for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t)
        if len(m[2]) >= 12
    ]
    out += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[0], secrets.KINDS.index(s[2])))


PIECES = [
    "1", "2", "9", "0", ".", "..", "@", "a", "b-", "+", "(", ")", " ", "-", "c.d", "255.", "4111111111111111", "@x.y", "token", 'TOKEN="', "=", ":",
    "abcdef012345", "AKIA", "%", "é", "\n", "ABCDEFGH12345678", "ſecret=",
]


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    for _ in range(20_000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == plain_pii(text), text
        assert secrets.base_spans(text) == plain_secrets(text), text
    long = "1" * 200_000 + "a" * 200_000 + "@"
    assert pii.base_spans(long) == []


def test_messages_are_exact_on_a_tree_and_equal_tokens_agree():
    rng = np.random.default_rng(3)
    size = len(pii.LABELS)
    near, far = rng.normal(size=(size, size)), rng.normal(size=(size, size))
    field = pii.Field(rng.normal(size=(pii.WIDTH, size)), near + near.T, far + far.T)
    features = [[1, 5], [2], [7, 9, 11], [4]]
    chain, skip = [(0, 1), (1, 2)], [(1, 3)]
    weight = np.zeros((size,) * 4)
    for labels in np.ndindex(*weight.shape):
        total = sum(field.shape[f, y] for own, y in zip(features, labels) for f in own)
        total += sum(field.near[labels[i], labels[j]] for i, j in chain) + sum(field.far[labels[i], labels[j]] for i, j in skip)
        weight[labels] = np.exp(total)
    weight /= weight.sum()
    want = [weight.sum(tuple(k for k in range(4) if k != i)) for i in range(4)]
    assert np.allclose(field.marginals(features, chain, skip), want, atol=1e-3)
    # an unclear token follows its clear twin far away
    shape = np.zeros((pii.WIDTH, size))
    shape[1, 4], shape[2, 4] = 6, 0
    field = pii.Field(shape, np.zeros((size, size)), 4 * np.eye(size))
    found = field.marginals([[1], [2], [2]], [], [(0, 1)])
    assert found[1].argmax() == 4 and found[1, 4] > 0.8 and np.allclose(found[2], 1 / size)


def test_personal_data_table(spark):
    texts = [None, "", "x", "call +1 (212) 555-0123 or 555-0123", "a@b.co 10.0.0.1 4111 1111 1111 1111", "a@b.co 10.0.0.1 4111 1111 1111 1111"] + [
        f"word +1 ({200 + i}) 555-{1000 + i} mail u{i}@h.org at 10.0.{i}.7 no {i}" for i in range(60)
    ]
    table = docs(spark, texts).withColumn("base", F.lit("other"))
    rows = pii.find(table, ["doc_id"]).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        base = [(s["start"], s["end"], s["kind"]) for s in row.base]
        assert base == plain_pii(text or "")
        assert all(a["end"] <= s or e <= a["start"] for a in row.added for s, e, _ in base)
    assert pii.find(table.limit(0), ["doc_id"]).count() == 0


def test_threshold_is_the_chance_at_the_recall(monkeypatch):
    monkeypatch.setattr(secrets, "_platt", lambda margins, truth: (0.01, -3.0))   # all chances are low
    monkeypatch.setattr(secrets, "EPOCHS", 1)
    rng = random.Random(12)
    drawn = [rng.random() < 0.3 for _ in range(300)]
    net = secrets.train(["".join(rng.choices("abcdef0123456789" if d else "the of an ", k=24)) for d in drawn], [int(d) for d in drawn])
    assert 0 < net.threshold < 0.1


def test_network_learns_keys_and_keeps_recall(spark):
    rng = random.Random(5)
    texts, secret = [], []
    for i in range(900):
        key, lead = secrets.made_up(rng)
        good = i % 2
        body = key[:100] if good else f"word-{i}.example{i % 7}.org"
        texts.append(f"{lead:>24}"[-24:] + f"\x01{body}\x02 then so")
        secret.append(good)
    net = secrets.train(texts[:700], secret[:700])
    chance = net.chances(texts[700:])
    truth = np.array(secret[700:])
    assert ((chance >= net.threshold) == truth).mean() > 0.95
    assert (chance[truth == 1] >= net.threshold).mean() >= 0.93
    assert secrets.train([], []).threshold == np.inf


def test_secrets_table(spark):
    rng = random.Random(6)
    long = "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(1500))
    texts = [None, "", "x", 'password = "hunter2hunter2"', 'password = "hunter2hunter2"', f"see {long} end", "d41d8cd98f00b204e9800998ecf8427e"]
    table = docs(spark, texts).withColumn("scores", F.lit(1))
    rows = secrets.find(table, ["doc_id"]).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        assert [(s["start"], s["end"], s["kind"]) for s in row.base] == plain_secrets(text or "")
        assert len(row.scores) == len(secrets.candidates(text or ""))
    assert secrets.find(table.limit(0), ["doc_id"]).count() == 0
    assert "".join(w.split("\x01")[1].split("\x02")[0][:64] for w in secrets.windows(long, 0, 1500))[:1400] == long[:1400]
