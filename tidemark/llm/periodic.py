"""Periodic runs of words, found through minimizers at many scales.

A run is a stretch of words with smallest period q, at least ``max(shortest, 3 * q)``
words long, that neither neighbour extends.  Periods up to ``LAGS`` are found by direct
scans: words are compared with those q places on.  Longer ones are found at scales
P, P * 3 / 2, ...: the scale P stands for the periods above two thirds of P.

At a scale every place has the hash of the P words from it, and the places that hold
the smallest hash of some window of P / 3 places are minimizers.  Inside a run of
period q <= P the windows repeat q places on, three periods have room for a
window and its repetition, and so the minimizers repeat.  P words determine their place
in a run up to its period, so the next minimizer with an equal hash is exactly q places on.  Each
pair of neighbouring equal minimizers whose distance belongs to the scale is a seed;
it is extended over the words themselves to both sides, so an accident of hashes
gives no wrong run.  Seeds inside a stretch that is known for their distance are not extended again.
Stretches with a smaller period, a divisor of the distance, are left to that one.

Texts are cut into words of their own; all texts of an Arrow batch are laid on one
line with a mark between them that equals nothing, so short texts cost little.  The
texts are in order of their length, and a scale looks at those that are long enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_rows, mix64, words

LAGS = 16      # periods that are scanned directly
SHORTEST = 24  # words of a run at least
PERIODS = 3    # periods of a run at least

Run = tuple[int, int, int]  # start, length, period


def scales(longest: int) -> Iterator[tuple[int, int]]:
    """(P, last): scales whose periods are above the last one's P, for runs of up to ``longest`` words."""
    last = LAGS
    while PERIODS * (last + 1) <= longest:
        yield last * 3 // 2, last
        last = last * 3 // 2


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of at least ``least`` true values."""
    edge = np.diff(np.concatenate(([0], same.view(np.int8), [0])))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = stop - start >= least
    return start[long], stop[long]


def _primitive(line: np.ndarray, start: int, period: int) -> bool:
    """Is a period of a stretch its smallest?  Three periods of it are; a smaller one would divide it."""
    word = line[start : start + period]
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            part = period // factor
            if np.array_equal(word[part:], word[:-part]):
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def _spread(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every window of ``width`` values, by windows of doubling length."""
    length = 1
    while 2 * length <= width:
        values = pick(values[:-length], values[length:])
        length *= 2
    return pick(values[: len(values) - (width - length)], values[width - length :]) if width > length else values


def _minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the smallest value of some window of ``width`` places, ties included."""
    if len(hashes) < width:
        return np.empty(0, np.int64)
    least = _spread(hashes, width, np.minimum)
    # the largest of the minima of all windows over a place; at the ends there are fewer windows
    padded = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    return np.flatnonzero(_spread(padded, width, np.maximum) == hashes)


class _Hashes:
    """Hashes of the words from every place of a line, for any number of words, from doubled lengths."""

    def __init__(self, line: np.ndarray):
        self.length, self.doubled = 1, mix64(line.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))

    def of(self, width: int) -> np.ndarray:
        """Hashes of ``width`` words; widths have to come in ascending order."""
        while 2 * self.length <= width:
            h, n = self.doubled, self.length
            self.doubled = mix64(h[:-n] * np.uint64(0xA0761D6478BD642F) + mix64(h[n:] + np.uint64(n)))
            self.length *= 2
        h, rest = self.doubled, width - self.length
        return mix64(h[: len(h) - rest] * np.uint64(0xE7037ED1A0B428DB) + h[rest:]) if rest else h

    def cut(self, first: int) -> None:
        """Forget what lies before a place."""
        self.doubled = self.doubled[first:]


def _extended(line: np.ndarray, place: int, period: int) -> tuple[int, int]:
    """Ends of the widest stretch over ``place`` in which words ``period`` apart are equal."""
    step, stop = 64, place
    while stop + period < len(line):  # to the right, in steps that double
        end = min(stop + step, len(line) - period)
        differ = np.flatnonzero(line[stop:end] != line[stop + period : end + period])
        if len(differ):
            stop += int(differ[0])
            break
        stop, step = end, 2 * step
    step, start = 64, place
    while start:
        begin = max(0, start - step)
        differ = np.flatnonzero(line[begin:start] != line[begin + period : start + period])
        if len(differ):
            start = begin + int(differ[-1]) + 1
            break
        start, step = begin, 2 * step
    return start, stop + period


def _line_runs(line: np.ndarray, first_of: list[int], lengths: list[int], shortest: int) -> Iterator[Run]:
    """Runs of a line of texts, whose lengths ascend; places are those on the line."""
    for period in range(1, min(LAGS, len(line) - 1) + 1):
        least = max(shortest, PERIODS * period) - period
        for start, stop in zip(*_stretches(line[:-period] == line[period:], least), strict=True):
            if _primitive(line, int(start), period):
                yield int(start), int(stop - start) + period, period
    hashes, offset = _Hashes(line), 0
    for scale, last in scales(lengths[-1] if lengths else 0):
        k = int(np.searchsorted(lengths, max(shortest, PERIODS * (last + 1))))
        if k == len(lengths):
            continue
        hashes.cut(first_of[k] - offset)  # shorter texts have no such run
        offset = first_of[k]
        own = hashes.of(scale)
        places = _minimizers(own, max(scale // 3, 1))
        places = places[np.lexsort((places, own[places]))]
        apart = places[1:] - places[:-1]
        seeds = (own[places[1:]] == own[places[:-1]]) & (apart > last) & (apart <= scale)
        found = sorted(zip(apart[seeds].tolist(), (places[:-1][seeds] + offset).tolist(), strict=True))
        period, known = 0, -1
        for distance, place in found:
            if distance == period and place < known:
                continue
            period = distance
            start, stop = _extended(line, place, period)
            known = stop - period
            if stop - start >= max(shortest, PERIODS * period) and _primitive(line, start, period):
                yield start, stop - start, period


def runs_of(texts: list[list[bytes]], shortest: int = SHORTEST) -> list[list[Run]]:
    """The runs of every list of words, by start, then period."""
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    names: dict[bytes, int] = {}
    parts, first_of, at = [], [], 0
    for k, i in enumerate(order):
        own = texts[i]
        parts.append(np.fromiter((names.setdefault(w, len(names)) for w in own), np.int64, len(own)))
        parts.append(np.array([-1 - k], np.int64))  # a mark that equals nothing
        first_of.append(at)
        at += len(own) + 1
    if not parts:
        return []
    out: list[list[Run]] = [[] for _ in texts]
    lengths = [len(texts[i]) for i in order]
    for start, length, period in _line_runs(np.concatenate(parts), first_of, lengths, shortest):
        k = int(np.searchsorted(first_of, start, "right")) - 1
        out[order[k]].append((start - first_of[k], length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapsed(text: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by one space, without those that a run holds behind its first period."""
    if not runs:
        return b" ".join(text)
    gone = np.zeros(len(text) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
    return b" ".join([text[i] for i in kept])


def strongest(runs: list[Run]) -> Run | None:
    """The run with most periods, exactly; of equals the one that starts first, then the shorter period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def find(df: DataFrame, keep: list[str], text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """Rows (<keep...>, n_words, runs, strongest, collapsed), one per row of ``df``.

    ``runs`` are (start, length, period) by start, then period, counted in words from
    0; ``strongest`` is the one with most periods (null without runs).  ``collapsed``
    is the text as words with one space between them, every run cut down to its first
    period.  Null, empty and blank texts have no words, no runs and an empty collapsed
    text.  Repeated rows each give a row, further columns aren't looked at, and an
    empty table gives an empty result.
    """
    own = [T.StructField(c, df.schema[c].dataType) for c in keep]
    schema = T.StructType(
        [*own, T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("strongest", RUN)]
        + [T.StructField("collapsed", T.StringType())]
    )

    def work(_, *columns):
        texts = [(t or b"").split() for t in columns[-1]]  # bytes are split at blanks of ASCII only
        found = runs_of(texts, shortest)

        def named(run: Run | None):
            return run and dict(zip(("start", "length", "period"), run, strict=True))

        return [
            *columns[:-1], [len(t) for t in texts], [[named(r) for r in runs] for runs in found],
            [named(strongest(runs)) for runs in found], [collapsed(t, runs).decode() for t, runs in zip(texts, found, strict=True)],
        ]

    # kept columns are known by their place, so that a text column among them can't clash
    rows = df.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)], F.col(text).cast("binary").alias("_words"))
    return arrow_rows(rows, [f"_{i}" for i in range(len(keep))] + ["_words"], work, schema)


def planted(text: Column, doc_id: Column) -> Column:
    """The text, in which one of ten ids has its words from some place on repeated with some period.

    Place and period are drawn from the checksum of the id; other texts stay as they are.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")
    own = words(text)
    n = F.size(own).cast("long")
    a = g % F.greatest(n, F.lit(1))
    p = F.floor((n - a) / (F.lit(3) + g % 8)).cast("long") + 1

    def part(array: Column, before: Column | int, count: Column) -> Column:
        return F.slice(array, (F.lit(before) + 1).cast("int"), count.cast("int"))

    again = F.flatten(F.array_repeat(part(own, a, p), F.ceil((n - a) / p).cast("int")))
    repeated = F.array_join(F.concat(part(own, 0, a), part(again, 0, n - a)), " ")
    return F.when(h % 10 == 0, F.when(n > 0, repeated).otherwise(text)).otherwise(text)
