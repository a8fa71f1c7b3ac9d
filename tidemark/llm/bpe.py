"""Byte-level BPE encoding by longest matches and backtracking, and decoding.

Every byte of a piece is read as the Latin-1 character of the same number, so a
string automaton finds, for each position, the longest vocabulary entry that
starts there.  The encoder goes from left to right with longest matches.  Two
neighbouring tokens are compatible if merging their joined bytes by rank would
give these two again; where the next token isn't compatible, shorter entries are
tried, and where none is left the encoder steps back.  Positions that failed are
marked, so each is tried once per length and the work is linear in the piece.
Compatibility of a pair is worked out from how the entries were merged and kept
in a bounded memo.  A piece that is itself an entry is that entry.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
from itertools import chain

import ahocorasick
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_rows

KEPT = 1 << 20     # encoded stretches of text, and pairs of tokens, kept per worker process
LONG = 48          # longer stretches are encoded each time they are met

#: White space before a space: there a match may span the space.
_BLANK_SPACE = re.compile(r"\s ")


def read_ranks(spark: SparkSession, path: str) -> list[bytes]:
    """Entries by rank from a rank file (base64 entry and rank per line)."""
    if "://" in path:
        lines = spark.read.format("binaryFile").load(path).first()["content"].splitlines()
    else:
        with io.open(path, "rb") as file:
            lines = file.read().splitlines()
    ranks = {int(rank): base64.b64decode(entry) for entry, rank in (line.split() for line in lines if line.strip())}
    if sorted(ranks) != list(range(len(ranks))) or {e for e in ranks.values() if len(e) == 1} != {bytes([i]) for i in range(256)}:
        raise ValueError("ranks must count up from 0 and contain every byte")
    return [ranks[i] for i in range(len(ranks))]


class _Memo(dict):
    """Ids of stretches of text; when half of the codec's ``kept`` is full it starts anew.

    The half before is kept beside it until then, and what is met again comes over,
    so frequent stretches stay.
    """

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec
        self.earlier: dict[str, tuple[int, ...]] = {}

    def __missing__(self, unit: str) -> tuple[int, ...]:
        ids = self.earlier.get(unit)
        if ids is None:
            own = self.codec
            pieces = own.split_pieces(unit)
            if len(pieces) == 1:
                ids = own.encode_piece(unit.encode())
            else:
                ids = tuple(chain.from_iterable(map(self.__getitem__, pieces)))
        if len(unit) <= LONG:
            if len(self) >= self.codec.kept // 2:
                self.earlier = dict(self)
                self.clear()
            self[unit] = ids
        return ids


class Codec:
    """Encoder and decoder for one vocabulary and one splitting pattern.

    ``at_spaces`` says that every match of the pattern that holds a space after
    something else than white space begins at that space.  Text is then cut
    there first, and the stretches are looked up whole.
    """

    def __init__(self, entries: list[bytes], pattern: str, at_spaces: bool = False, kept: int = KEPT):
        self.entries = entries
        self.kept = kept
        self.ranks = {entry: i for i, entry in enumerate(entries)}
        self.split_pieces = regex.compile(pattern).findall
        self.shorter = [self._shorter(entry) for entry in entries]
        self.compatible: dict[tuple[int, int], bool] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: list[tuple[int, int]] = []
        for token, entry in enumerate(entries):
            self.halves.append(self._halves(token, entry))
        self.compatible.clear()
        self.matcher = ahocorasick.Automaton()
        for token, entry in enumerate(entries):
            self.matcher.add_word(entry.decode("latin-1"), (len(entry) - 1, token))
        self.matcher.make_automaton()
        self.at_spaces = at_spaces
        self.known = _Memo(self)

    def _shorter(self, entry: bytes) -> int:
        """The longest entry that is a proper prefix, -1 for single bytes."""
        for size in range(len(entry) - 1, 0, -1):
            if (token := self.ranks.get(entry[:size])) is not None:
                return token
        return -1

    def _halves(self, token: int, entry: bytes) -> tuple[int, int]:
        """The two tokens whose merge makes this entry; itself twice if none do."""
        left = self.shorter[token]
        while left >= 0:
            right = self.ranks.get(entry[len(self.entries[left]) :])
            if right is not None and left < token and right < token and self._fits(left, right):
                self.merged[left, right] = token
                return left, right
            left = self.shorter[left]
        return token, token

    def _fits(self, left: int, right: int) -> bool:
        """Whether the joined bytes of two tokens are merged into these two again.

        The merges along the seam are undone from the latest to the earliest.  A
        merge across the seam that comes before the limit would have happened
        first, so the pair can't stand.
        """
        merged, halves, limit = self.merged, self.halves, len(self.entries)
        while True:
            across = merged.get((left, right))
            if across is not None and across < limit:
                return False
            if left > right:
                limit = left
                left = halves[left][1]
                if left == limit:
                    limit = right + 1
                    right = halves[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit = right + 1
                right = halves[right][0]
                if right + 1 == limit:
                    limit = left
                    left = halves[left][1]
                    if left == limit:
                        return True

    def fits(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.compatible.get(key)
        if known is None:
            if len(self.compatible) >= self.kept:
                self.compatible.clear()
            known = self.compatible[key] = self._fits(left, right)
        return known

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        size, letters = len(piece), piece.decode("latin-1")
        entries, shorter, fits = self.entries, self.shorter, self.fits
        # longest matches all along are the answer if every pair fits
        greedy = [token for _, (_, token) in self.matcher.iter_long(letters)]
        if all(map(fits, greedy, greedy[1:])):
            return tuple(greedy)
        longest = [-1] * (size + 1)
        for last, (extra, token) in self.matcher.iter(letters):
            longest[last - extra] = token  # later ends are longer
        open_at = bytearray(b"\x01") * (size + 1)
        tokens: list[int] = []
        position, token = 0, longest[0]
        while position < size:
            end = position + len(entries[token])
            if open_at[end] and (not tokens or fits(tokens[-1], token)):
                tokens.append(token)
                position, token = end, longest[end]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                open_at[position] = 0
                token = tokens.pop()
                position -= len(entries[token])
        return tuple(tokens)

    def encode(self, text: str) -> list[int]:
        if self.at_spaces and not _BLANK_SPACE.search(text):
            parts = text.split(" ")
            units = [parts[0], *[f" {part}" for part in parts[1:]]]
        else:
            units = self.split_pieces(text)
        return list(chain.from_iterable(map(self.known.__getitem__, units)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids))


_codecs: dict[tuple, Codec] = {}


def codec(entries: list[bytes], pattern: str, at_spaces: bool, kept: int) -> Codec:
    """The codec of this worker process; it is made once and serves all its tasks."""
    key = (hashlib.sha256(b"\n".join(map(base64.b64encode, entries))).hexdigest(), pattern, at_spaces, kept)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(entries, pattern, at_spaces, kept)
    return _codecs[key]


def encode(
    df: DataFrame, entries: list[bytes], pattern: str, keys: list[str], text: str = "text", at_spaces: bool = False,
    kept: int = KEPT,
) -> DataFrame:
    """The key columns, ``ids`` (array of int) and ``decoded`` (the bytes of the ids again).

    Null and empty texts have no ids and no bytes.  Ids of special tokens are
    never made.  Keys are carried as they are, null or repeated; an empty table
    gives an empty result.  The vocabulary is sent to the workers (its size does
    not depend on the data).  Fewer ``kept`` stretches need less memory and more time.
    """
    sent = df.sparkSession.sparkContext.broadcast(entries)

    def setup():
        return codec(sent.value, pattern, at_spaces, kept)

    def work(own, texts, *columns):
        ids = [own.encode(t) if t else [] for t in texts]
        return [*columns, ids, [own.decode(i) for i in ids]]

    schema = T.StructType(
        [df.schema[k] for k in keys]
        + [T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.BinaryType())]
    )
    return arrow_rows(df, [text, *keys], work, schema, setup)


def decode(df: DataFrame, entries: list[bytes], keys: list[str], ids: str = "ids") -> DataFrame:
    """The key columns and ``decoded``: the bytes of the ids; null ids give no bytes."""
    sent = df.sparkSession.sparkContext.broadcast(entries)

    def work(_, rows, *columns):
        return [*columns, [b"".join(map(sent.value.__getitem__, r or [])) for r in rows]]

    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField("decoded", T.BinaryType())])
    return arrow_rows(df, [ids, *keys], work, schema)


def digests(encoded: DataFrame, keys: list[str]) -> DataFrame:
    """Counts and digests of encoded rows: n_tokens, ids_sha256, decoded_sha256."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        *keys,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
