"""Personal data in texts: base patterns and a skip-chain conditional random field.

The base finds emails, IP addresses, card and phone numbers by pattern and check
digits; its spans always stay.  The field adds what the base misses.  Its nodes
are the tokens that hold a digit or an at sign (any other token is no entity).
Three kinds of potential share them: shape features of the token, the labels of
tokens right next to each other, and, over any distance in the document, the
labels of tokens that are equal once signs and case are put aside.  Equal tokens
are linked from one occurrence to the next, so a token that occurs a thousand
times has a thousand links.  Sum-product messages run over the loopy graph until
they settle; a token is marked where an entity label is surer than ``SURE``.

Weights are fitted here, piece by piece: the shape features by maximum
likelihood, both kinds of link by how much more often two labels meet than they
would by chance, on a bounded sample of documents labelled by the base.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_rows, smallest_hashes

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
SAMPLE_DOCS = 4_000      # documents that the weights are fitted on at most
SAMPLE_TOKENS = 40_000   # tokens of them
SURE = 0.9
ROUNDS = 30              # of messages at most
DAMPING = 0.5
PRIOR = 100.0            # pairs counted before those of the sample
NEXT_TO = 3              # characters between tokens that stand next to each other

# --- fixed values: the base patterns ---------------------------------------------
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# -------------------------------------------------------------------------------
_MARK = re.compile(r"[0-9@]\S*")
_SIGNS = re.compile(r"[^0-9a-z@]+")
Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[Span]:
    """Leftmost matches, found from the at signs outward, so in linear time."""
    spans, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            spans.append((start, domain.end(), "email"))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return spans


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base, by start and then by kind."""
    spans = _emails(text) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), m.end(), "card"))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            spans.append((m.start(), m.end(), "phone"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


@dataclass
class Tokens:
    """The nodes of one document."""

    start: list[int]
    end: list[int]
    features: list[list[int]]
    keys: list[str]


def tokens(text: str) -> Tokens:
    """Tokens with a digit or an at sign, without the signs at their ends."""
    out = Tokens([], [], [], [])
    position = 0
    while m := _MARK.search(text, position):
        start, end = m.start(), m.end()
        while start > position and not text[start - 1].isspace():
            start -= 1
        position = end
        left, right = start, end
        while left < right and not (text[left].isalnum() or text[left] in "+@"):
            left += 1
        while right > left and not (text[right - 1].isalnum() or text[right - 1] == "@"):
            right -= 1
        if left == right:
            continue
        out.start.append(left)
        out.end.append(right)
        out.features.append(_features(text, start, left, right))
        out.keys.append(_SIGNS.sub("", text[left:right].lower()))
    return out


WIDTH = 96  # features are numbers below it


def _features(text: str, outer: int, left: int, right: int) -> list[int]:
    """Numbers of the features that hold: what the token is made of and what stands before it."""
    token = text[left:right]
    digits = _digits(token)
    rest = len(token) - len(digits)
    dots, dashes = token.count("."), token.count("-")
    parts = token.split(".")
    before = text[max(0, outer - 2) : outer]
    found = [0, 1 + min(len(digits), 20), 22 + min(rest, 7), 30 + min(dots, 4), 35 + min(dashes, 3)]
    at = token.find("@")
    if at >= 0:
        found.append(39 if 0 < at < len(token) - 1 and "." in token[at:].strip(".") else 40)
    if len(parts) == 4 and all(p.isdigit() for p in parts):
        found.append(41 if all(len(p) <= 3 and int(p) <= 255 for p in parts) else 42)
    if 14 <= len(digits) <= 19:
        found.append(43 if luhn(digits) else 44)
    if rest == 0:
        found.append(45)
    if rest and rest == dashes:
        found.append(46)
    if token[0] == "+":
        found.append(47)
    if outer < left and text[left - 1] == "(":
        found.append(48)
    if any(c.isalpha() for c in token):
        found.append(49 if at < 0 else 50)
    if any(c in "abcdef" for c in token) and all(c in "0123456789abcdef" for c in token):
        found.append(51)
    if before[-1:].isspace() and before[:1] == ")":
        found.append(52)
    if before[-1:].isspace() and before[:1].isdigit():
        found.append(53)
    if outer > 0 and text[outer - 1] == "\n":
        found.append(54)
    if dots and rest == dots:
        found.append(55 + min(dots, 4))
    if len(digits) == 7 and rest == 1 and dashes == 1:
        found.append(60)
    return found


def links(found: Tokens) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Pairs of neighbours, and pairs of each token and its next equal one.

    Keys of fewer than four characters say nothing and are not linked.
    """
    near = [(i, i + 1) for i in range(len(found.start) - 1) if found.start[i + 1] - found.end[i] <= NEXT_TO]
    last: dict[str, int] = {}
    far = []
    for i, key in enumerate(found.keys):
        if len(key) >= 4:
            if key in last:
                far.append((last[key], i))
            last[key] = i
    return near, far


@dataclass(frozen=True)
class Field:
    """Log potentials: features by label, neighbouring labels, labels of equal tokens."""

    shape: np.ndarray
    near: np.ndarray
    far: np.ndarray

    def marginals(self, features: list[list[int]], near: list[tuple[int, int]], far: list[tuple[int, int]]) -> np.ndarray:
        """Label chances of every node by loopy sum-product messages.

        Nodes of any number of documents can be given at once; documents don't
        share links, so they don't share messages.
        """
        node = np.array([self.shape[f].sum(0) for f in features]).reshape(len(features), len(LABELS))
        node -= node.max(1, keepdims=True) if len(node) else 0
        pairs = np.array([*near, *far], dtype=np.int64).reshape(-1, 2)
        if not len(pairs):
            belief = np.exp(node)
            return belief / belief.sum(1, keepdims=True)
        tables = np.exp(np.concatenate([np.broadcast_to(self.near, (len(near), *self.near.shape)), np.broadcast_to(self.far, (len(far), *self.far.shape))]))
        source = np.concatenate([pairs[:, 0], pairs[:, 1]])
        target = np.concatenate([pairs[:, 1], pairs[:, 0]])
        table = np.concatenate([tables, tables.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
        message = np.zeros((len(source), len(LABELS)))
        for _ in range(ROUNDS):
            gathered = node.copy()
            np.add.at(gathered, target, message)
            out = gathered[source] - message[back]
            out = np.exp(out - out.max(1, keepdims=True))
            new = np.log(np.einsum("ei,eij->ej", out, table) + 1e-300)
            new -= new.max(1, keepdims=True)
            change = np.abs(new - message).max()
            message = DAMPING * message + (1 - DAMPING) * new
            if change < 1e-4:
                break
        belief = node.copy()
        np.add.at(belief, target, message)
        belief = np.exp(belief - belief.max(1, keepdims=True))
        return belief / belief.sum(1, keepdims=True)


def token_labels(found: Tokens, base: list[Span]) -> list[int]:
    """The base label of every token that lies in a span of the base."""
    labels, at = [], 0
    for start, end in zip(found.start, found.end, strict=True):
        while at < len(base) and base[at][1] <= start:
            at += 1
        here = [s for s in base[at : at + len(KINDS)] if s[0] < end and start < s[1]]
        labels.append(LABELS.index(here[0][2]) if here else 0)
    return labels


def train(samples: list[tuple[list[list[int]], list[int], list[tuple[int, int]], list[tuple[int, int]]]]) -> Field:
    """Fit the potentials on documents given as (features, labels, near, far)."""
    size = len(LABELS)
    rows = [(f, y) for features, labels, _, _ in samples for f, y in zip(features, labels, strict=True)]
    shape = np.zeros((WIDTH, size))
    if rows:
        x = np.zeros((len(rows), WIDTH))
        for i, (f, _) in enumerate(rows):
            x[i, f] = 1
        y = np.eye(size)[[label for _, label in rows]]
        velocity = np.zeros_like(shape)
        for _ in range(300):
            margin = x @ shape
            p = np.exp(margin - margin.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            gradient = x.T @ (p - y) / len(rows) + 1e-4 * shape
            velocity = 0.9 * velocity - 1.0 * gradient
            shape = shape + velocity
    counts = np.bincount([label for _, label in rows], minlength=size) + 1.0
    chance = counts / counts.sum()

    def meeting(pick: int, alike: float) -> np.ndarray:
        """Log of how much more often two labels meet than by chance.

        ``PRIOR`` pairs are counted beforehand: a share ``alike`` of them with
        equal labels, the others as chance has them.
        """
        met = PRIOR * (alike * np.diag(chance) + (1 - alike) * np.outer(chance, chance))
        for sample in samples:
            for i, j in sample[pick]:
                met[sample[1][i], sample[1][j]] += 1
                met[sample[1][j], sample[1][i]] += 1
        met /= met.sum()
        return np.clip(np.log(met / np.outer(met.sum(1), met.sum(0))), -4, 4)

    return Field(shape, meeting(2, 0.0), meeting(3, 0.9))


def fit(df: DataFrame, text: str = "text", docs: int = SAMPLE_DOCS, limit: int = SAMPLE_TOKENS) -> Field:
    """The field's weights from at most ``docs`` documents with digits or at signs.

    The documents with the smallest hashes are taken, whole; the driver gets the
    numbers of their features and their base labels, no text.
    """
    chosen = smallest_hashes(df.where(F.col(text).rlike("[0-9@]")), text, docs)
    schema = T.StructType(
        [
            T.StructField("hash", T.LongType()),
            T.StructField("features", T.ArrayType(T.ArrayType(T.IntegerType()))),
            T.StructField("labels", T.ArrayType(T.IntegerType())),
            T.StructField("near", T.ArrayType(T.ArrayType(T.IntegerType()))),
            T.StructField("far", T.ArrayType(T.ArrayType(T.IntegerType()))),
        ]
    )

    def work(_, texts, hashes):
        out: list[list] = [[], [], [], []]
        for text in texts:
            found = tokens(text)
            near, far = links(found)
            for column, value in zip(out, (found.features, token_labels(found, base_spans(text)), near, far), strict=True):
                column.append(value)
        return [hashes, *out]

    # one long text can hold millions of tokens: documents count up to the limit
    marked = arrow_rows(chosen, ["text", "hash"], work, schema).where(F.size("labels") <= limit // 10).dropDuplicates(["hash"])
    samples, held = [], 0
    for row in sorted(marked.collect(), key=lambda r: r["hash"]):
        if held + len(row["labels"]) > limit:
            break
        held += len(row["labels"])
        samples.append((row["features"], row["labels"], row["near"], row["far"]))
    return train(samples)


def added_spans(texts: list[str], bases: list[list[Span]], field: Field) -> list[list[Span]]:
    """What the field marks beyond the base, per document; runs of one label are one span."""
    found = [tokens(t) for t in texts]
    features: list[list[int]] = []
    near: list[tuple[int, int]] = []
    far: list[tuple[int, int]] = []
    first = []
    for own in found:
        offset = len(features)
        first.append(offset)
        features += own.features
        a, b = links(own)
        near += [(i + offset, j + offset) for i, j in a]
        far += [(i + offset, j + offset) for i, j in b]
    chance = field.marginals(features, near, far)
    best, sure = chance.argmax(1), chance.max(1) >= SURE
    out = []
    for own, base, offset in zip(found, bases, first, strict=True):
        inside = token_labels(own, base)
        spans: list[Span] = []
        previous = -2
        for i in range(len(own.start)):
            label = int(best[offset + i])
            if not label or not sure[offset + i] or inside[i]:
                continue
            kind = LABELS[label]
            if previous == i - 1 and spans[-1][2] == kind and own.start[i] - own.end[i - 1] <= NEXT_TO:
                spans[-1] = (spans[-1][0], own.end[i], kind)
            else:
                spans.append((own.start[i], own.end[i], kind))
            previous = i
        out.append(spans)
    return out


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])


def find(df: DataFrame, keys: list[str], text: str = "text", field: Field | None = None) -> DataFrame:
    """The key columns, ``base`` and ``added``: arrays of (kind, start, end) in code points.

    Both are ordered by start, then kind; added spans never touch base ones.  A
    null or empty text has none.  Without a field one is fitted on ``df``.  Keys
    are carried as they are, null or repeated; an empty table gives an empty
    result.
    """
    field = field or fit(df, text)
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField(n, T.ArrayType(SPAN)) for n in ("base", "added")])

    def work(_, texts, *columns):
        texts = [t or "" for t in texts]
        bases = [base_spans(t) for t in texts]
        added = added_spans(texts, bases, field)
        return [*columns, *[[[(k, s, e) for s, e, k in spans] for spans in lists] for lists in (bases, added)]]

    return arrow_rows(df, [text, *keys], work, schema)
