"""Secrets in texts: base patterns and a small character convolutional network.

The base finds assigned secrets, access keys and hexadecimal runs; its spans
always stay.  Every long run of key characters with a digit is a candidate.  The
network reads a candidate with the characters around it: characters are embedded,
convolved over five places, and the largest and the mean response of every filter
over the candidate and its context decide.  It is written in numpy and trained on
labelled findings: candidates of a bounded sample of documents (labelled by the
base) and made-up keys of usual forms put into the same contexts.  A held-out part
calibrates its chances (Platt) and sets the threshold: the highest one that still
finds ``RECALL`` of the held-out secrets.
"""

from __future__ import annotations

import random
import re
import string
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_rows, smallest_hashes

KINDS = ("assign", "access", "hex", "key")   # the last is the network's
SAMPLE_DOCS = 4_000       # documents that findings are taken from at most
SAMPLE_FINDINGS = 6_000   # labelled findings that the network is trained on at most
RECALL = 0.98
BEFORE, AFTER = 24, 8     # characters of context
CHUNK = 128               # longer candidates are read in overlapping parts
EPOCHS = 6

# --- fixed values: the base patterns ---------------------------------------------
_ASSIGN = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# -------------------------------------------------------------------------------
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=.-]{12,}")
_DIGIT = re.compile("[0-9]")
Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base, by start and then by kind."""
    spans = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    spans += [(m.start(), m.end(), "hex") for m in _LONG_HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str) -> list[tuple[int, int]]:
    """Maximal runs of key characters, twelve or more, with a digit."""
    return [m.span() for m in _RUN.finditer(text) if _DIGIT.search(m[0])]


def windows(text: str, start: int, end: int) -> list[str]:
    """The candidate with its context; a long one in parts that overlap by half."""
    out = []
    for at in range(start, max(end - CHUNK // 2, start + 1), CHUNK // 2):
        stop = min(at + CHUNK, end)
        before = text[max(0, at - BEFORE) : at]
        out.append(f"{before:>{BEFORE}}\x01{text[at:stop]}\x02{text[stop : stop + AFTER]:<{AFTER}}")
    return out


LETTERS = 98   # printable ASCII, the two marks, anything else, padding
DIMENSION, FILTERS, REACH = 8, 24, 5


def _numbers(window: list[str]) -> tuple[np.ndarray, np.ndarray]:
    width = max(map(len, window))
    codes = np.full((len(window), width), LETTERS - 1, dtype=np.int64)
    for i, w in enumerate(window):
        own = np.frombuffer(w.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        codes[i, : len(w)] = np.where((own >= 32) & (own < 127), own - 32, np.where(own == 1, 95, np.where(own == 2, 95, 96)))
    return codes, codes != LETTERS - 1


@dataclass
class Network:
    """Weights, calibration (slope, shift) and threshold."""

    embedding: np.ndarray
    filters: np.ndarray    # reach x dimension x filters
    bias: np.ndarray
    out: np.ndarray        # 2 filters + 1
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    def forward(self, codes: np.ndarray, there: np.ndarray):
        half = REACH // 2
        padded = np.pad(codes, ((0, 0), (half, half)), constant_values=LETTERS - 1)
        places = np.lib.stride_tricks.sliding_window_view(padded, REACH, axis=1)      # n x width x reach
        seen = self.embedding[places].reshape(*places.shape[:2], REACH * DIMENSION)
        response = np.maximum(seen @ self.filters.reshape(REACH * DIMENSION, FILTERS) + self.bias, 0) * there[..., None]
        top = response.argmax(1)
        count = there.sum(1, keepdims=True)
        pooled = np.concatenate([response.max(1), response.sum(1) / count, np.ones((len(codes), 1))], 1)
        return pooled @ self.out, (places, seen, response, top, count, pooled)

    def margins(self, texts: list[str], size: int = 256) -> np.ndarray:
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        found = np.zeros(len(texts))
        for k in range(0, len(order), size):
            part = order[k : k + size]
            found[part] = self.forward(*_numbers([texts[i] for i in part]))[0]
        return found

    def chances(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.shift, -30, 30)))


def train(texts: list[str], secret: list[int], seed: int = 5) -> Network:
    """Adam on the logistic loss, then calibration and threshold on a held-out fifth."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.3, (LETTERS, DIMENSION)), rng.normal(0, 0.2, (REACH, DIMENSION, FILTERS)),
        np.zeros(FILTERS), rng.normal(0, 0.1, 2 * FILTERS + 1),
    )
    y = np.array(secret, dtype=float)
    if len(y) == 0 or y.min() == y.max():
        net.threshold = np.inf
        return net
    net.embedding[-1] = 0
    order = rng.permutation(len(texts))
    held, kept = order[: len(order) // 5], order[len(order) // 5 :]
    names = ("embedding", "filters", "bias", "out")
    first, second, step = {n: 0.0 for n in names}, {n: 0.0 for n in names}, 0
    for _ in range(EPOCHS):
        rng.shuffle(kept)
        for k in range(0, len(kept), 64):
            part = kept[k : k + 64]
            codes, there = _numbers([texts[i] for i in part])
            margin, (places, seen, response, top, count, pooled) = net.forward(codes, there)
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[part]) / len(part)
            up = slope[:, None] * net.out[None, : 2 * FILTERS]
            grad = np.repeat((up[:, FILTERS:] / count)[:, None, :], codes.shape[1], 1)
            rows, cols = np.arange(len(part))[:, None], np.arange(FILTERS)[None]
            grad[rows, top, cols] += up[:, :FILTERS]
            grad *= response > 0
            flat = grad.reshape(-1, FILTERS)
            to_seen = (flat @ net.filters.reshape(-1, FILTERS).T).reshape(-1, DIMENSION)
            to_embedding = np.zeros_like(net.embedding)
            np.add.at(to_embedding, places.reshape(-1), to_seen)
            to_embedding[-1] = 0
            grads = {
                "out": pooled.T @ slope, "bias": flat.sum(0), "embedding": to_embedding,
                "filters": (seen.reshape(-1, REACH * DIMENSION).T @ flat).reshape(net.filters.shape),
            }
            step += 1
            for n in names:
                first[n] = 0.9 * first[n] + 0.1 * grads[n]
                second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
                rate = 0.01 * first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                setattr(net, n, getattr(net, n) - rate)
    margins, truth = net.margins([texts[i] for i in held]), y[held]
    if len(truth) and truth.min() < truth.max():
        net.slope, net.shift = _platt(margins, truth)
        chances = np.sort(1 / (1 + np.exp(-np.clip(net.slope * margins[truth == 1] + net.shift, -30, 30))))
        net.threshold = float(chances[int((1 - RECALL) * len(chances))])
    return net


def _platt(margins: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Newton steps for slope and shift, with smoothed targets."""
    good, bad = truth.sum(), len(truth) - truth.sum()
    target = np.where(truth == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    a, w = np.c_[margins, np.ones(len(margins))], np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2), a.T @ (p - target) + 1e-3 * (w - [1.0, 0.0]))
        w = w - np.clip(step, -1, 1)
    return float(w[0]), float(w[1])


def made_up(rng: random.Random) -> tuple[str, str]:
    """A key of a usual form and what stands right before it."""
    hexes, mixed = "0123456789abcdef", string.ascii_letters + string.digits
    form = rng.randrange(5)
    if form == 0:
        key = "".join(rng.choices(hexes, k=rng.choice((32, 40, 64))))
    elif form == 1:
        key = "".join(rng.choices(mixed + "+/", k=rng.choice((24, 40, 44, 64)))) + rng.choice(("", "=", "=="))
    elif form == 2:
        key = rng.choice(("sk_live_", "pk_test_", "ghp_", "xoxb-", "glpat-")) + "".join(rng.choices(mixed, k=rng.randint(20, 40)))
    elif form == 3:
        key = ".".join("".join(rng.choices(mixed + "_-", k=n)) for n in (36, rng.randint(40, 90), 43))
    else:
        key = "".join(rng.choices(string.ascii_uppercase + string.digits, k=rng.randint(16, 32)))
    return key, rng.choice(("", "", "key: ", "auth=", 'credential = "', "bearer ", "AWS_KEY=", "private: "))


def fit(df: DataFrame, text: str = "text", docs: int = SAMPLE_DOCS, limit: int = SAMPLE_FINDINGS) -> Network:
    """Train on at most ``limit`` findings of at most ``docs`` documents with candidates.

    The documents with the smallest hashes are taken; only windows around
    candidates get to the driver.  Numbers of digits alone are left out: the
    base calls them hexadecimal, but nothing says that they are keys.
    """
    likely = F.col(text).rlike(r"[A-Za-z0-9+/_.=-]{12}") & F.col(text).rlike("[0-9]")
    chosen = smallest_hashes(df.where(likely), text, docs)
    schema = T.StructType([T.StructField("window", T.StringType()), T.StructField("secret", T.IntegerType())])

    def work(_, texts, hashes):
        out, secret = [], []
        for text in texts:
            base = base_spans(text)
            for start, end in candidates(text):
                if not text[start:end].isdigit():
                    out.append(windows(text, start, end)[0])
                    secret.append(int(any(s < end and start < e for s, e, _ in base)))
        return [out, secret]

    rows = arrow_rows(chosen, ["text", "hash"], work, schema).distinct().orderBy(F.xxhash64("window"), "secret").limit(limit).collect()
    texts, secret = [r["window"] for r in rows], [r["secret"] for r in rows]
    rng = random.Random(11)
    contexts = [w[:BEFORE] for w in texts] or [" " * BEFORE]
    for _ in range(max(600, len(texts) // 2) if rows else 0):
        key, lead = made_up(rng)
        before = (rng.choice(contexts) + lead)[-BEFORE:]
        texts.append(f"{before:>{BEFORE}}\x01{key[:CHUNK]}\x02{rng.choice(contexts)[:AFTER]:<{AFTER}}")
        secret.append(1)
    # digits of everyday text that are no keys: dates, versions, hosts, numbers
    for _ in range(max(600, len(texts) // 3) if rows else 0):
        before = rng.choice(contexts)
        n = lambda a, b: str(rng.randint(a, b))
        word = lambda: "".join(rng.choices(string.ascii_lowercase, k=rng.randint(3, 8)))
        plain = rng.choice((
            f"{n(1990, 2030)}-{n(10, 12)}-{n(10, 28)}T{n(10, 23)}", f"{word()}-{n(1, 9)}.{n(0, 20)}.{n(0, 20)}.{word()}",
            f"mail{n(1, 9)}.{word()}.example.com", f"{n(100, 255)}.{n(10, 255)}.{n(100, 255)}.{n(0, 255)}",
            f"{word()}_{word()}_{n(1, 2030)}", f"{word()}/{word()}/{word()}{n(1, 99)}", f"{n(100, 999)}-{n(100, 999)}-{n(1000, 9999)}",
            f"{word()}.{word()}{n(0, 99)}.{word()}", f"{word().upper()}-{n(1000, 99999)}-{word()}",
        ))
        texts.append(f"{before}\x01{plain}\x02{rng.choice(contexts)[:AFTER]:<{AFTER}}")
        secret.append(0)
    return train(texts, secret)


SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
)


def find(df: DataFrame, keys: list[str], text: str = "text", network: Network | None = None) -> DataFrame:
    """The key columns, ``base``, ``added`` (arrays of kind, start, end in code points) and ``scores``.

    ``scores`` holds the calibrated chance of every candidate in text order;
    ``added`` those candidates that reach the threshold and touch no base span,
    with the kind "key".  A null or empty text has none.  Without a network one is
    trained on ``df``.  Keys are carried as they are, null or repeated; an empty
    table gives an empty result.
    """
    network = network or fit(df, text)
    schema = T.StructType(
        [df.schema[k] for k in keys]
        + [T.StructField(n, T.ArrayType(SPAN)) for n in ("base", "added")] + [T.StructField("scores", T.ArrayType(T.DoubleType()))]
    )

    def work(_, texts, *columns):
        texts = [t or "" for t in texts]
        bases = [base_spans(t) for t in texts]
        places = [candidates(t) for t in texts]
        read, owner = [], []
        for text, own in zip(texts, places, strict=True):
            for start, end in own:
                parts = windows(text, start, end)
                owner.append((len(read), len(read) + len(parts)))
                read += parts
        chances = network.chances(read) if read else []
        best = iter([float(max(chances[a:b])) for a, b in owner])
        added, scores = [], []
        for base, own in zip(bases, places, strict=True):
            mine = [next(best) for _ in own]
            scores.append(mine)
            added.append(_clear(own, mine, base, network.threshold))
        return [*columns, [[(k, s, e) for s, e, k in spans] for spans in bases], added, scores]

    return arrow_rows(df, [text, *keys], work, schema)


def _clear(own: list[tuple[int, int]], chances: list[float], base: list[Span], threshold: float) -> list[tuple[str, int, int]]:
    """Candidates over the threshold that touch no base span; both lists are in text order."""
    out, at, reach = [], 0, 0
    for (start, end), chance in zip(own, chances, strict=True):
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][1])
            at += 1
        if chance >= threshold and reach <= start:
            out.append(("key", start, end))
    return out
