"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece of text there is exactly one token that can end the encoding of that
prefix: the one that fits the prefix before it, where two neighbours fit if merging their joint
bytes gives back just these two. Keeping that last token per prefix gives the encoding of every
prefix at once, so bytes can be appended, cut off or replaced without starting over.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm.arrow import map_texts

#: Words kept with their ids by a task, and the longest word or piece kept.
KEPT_WORDS = 500_000
KEPT_LENGTH = 64
#: Prefixes of such pieces, and pairs of neighbours, kept by a task.
KEPT_PREFIXES = 1_000_000
KEPT_PAIRS = 1_000_000
#: How many pieces at the end of a text may change when text is appended ("'l" + "l").
LOOSE_PIECES = 2
_SPACE_BEFORE_BLANK = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


class Vocabulary:
    """Ranks of byte strings, with what the dynamic programme asks of them (memoised)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for data, rank in ranks.items():
            self.bytes_of[rank] = data
        self.own = _OwnTokens(self)
        self.fits = _Fits(self)

    @classmethod
    def parse(cls, text: bytes) -> Vocabulary:
        """From lines of a base64 token and its rank."""
        lines = (line.split() for line in text.splitlines() if line)
        return cls({base64.b64decode(a): int(b) for a, b in lines})

    def merged(self, data: bytes) -> list[int]:
        """Ids by merging the lowest ranked neighbours, leftmost first. For short bytes."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]


class _OwnTokens(dict):
    """Whether merging a token's bytes ends with the token alone."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, token: int) -> bool:
        own = self[token] = self.vocabulary.merged(self.vocabulary.bytes_of[token]) == [token]
        return own


class _Fits(dict):
    """Whether two tokens can stand next to each other in an encoding."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, pair: tuple[int, int]) -> bool:
        if len(self) >= KEPT_PAIRS:
            self.clear()
        left, right = pair
        both = self.vocabulary.bytes_of[left] + self.vocabulary.bytes_of[right]
        fits = self[pair] = self.vocabulary.merged(both) == [left, right]
        return fits


class PrefixEncoder:
    """The unique last token of every prefix of some bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = bytearray()
        self.last: list[int] = []
        self.append(data)

    def append(self, data: bytes) -> None:
        """Extend by some bytes; earlier prefixes keep their tokens."""
        self.data += data
        whole, last = bytes(self.data), self.last
        vocabulary = self.vocabulary
        find, own, fits = vocabulary.ranks.get, vocabulary.own, vocabulary.fits
        longest = vocabulary.longest
        for end in range(len(last) + 1, len(whole) + 1):
            # just one token fits, so the order of the trials is free: short ones are likelier
            for start in range(end - 1, max(-1, end - 1 - longest), -1):
                token = find(whole[start:end])
                if (
                    token is not None
                    and (start == 0 or fits[last[start - 1], token])
                    and own[token]
                ):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a single byte")

    def truncate(self, length: int) -> None:
        """Back to a prefix; its tokens are already known."""
        del self.data[length:], self.last[length:]

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Put other bytes in place of ``[start, end)``, keeping all prefixes before it.

        Behind the edit, work ends where a new token boundary meets an old one with the same
        token before it: from there on the old tokens hold again.
        """
        tail, old = bytes(self.data[end:]), self.last[end:]
        self.truncate(start)
        self.append(data)
        run, needed = 0, self.vocabulary.longest
        for at in range(len(tail)):
            self.append(tail[at : at + 1])
            # a new last token depends on the last tokens of the longest-token bytes before it
            run = run + 1 if self.last[-1] == old[at] else 0
            if run >= needed:
                self.data += tail[at + 1 :]
                self.last += old[at + 1 :]
                return

    def ids(self, length: int | None = None) -> list[int]:
        """The encoding of the whole or of a prefix."""
        out, end = [], len(self.last) if length is None else length
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(self.vocabulary.bytes_of[token])
        return out[::-1]


class PrefixStore(dict):
    """Last tokens by prefix, shared by many short pieces that begin alike."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def ids(self, data: bytes) -> list[int]:
        """The encoding of some bytes; only prefixes not met before cost more than a look-up."""
        if len(self) >= KEPT_PREFIXES:
            self.clear()
        vocabulary = self.vocabulary
        find, own, fits = vocabulary.ranks.get, vocabulary.own, vocabulary.fits
        known = size = len(data)
        while known and data[:known] not in self:
            known -= 1
        for end in range(known + 1, size + 1):
            for start in range(end - 1, -1, -1):
                token = find(data[start:end])
                if (
                    token is not None
                    and (start == 0 or fits[self[data[:start]], token])
                    and own[token]
                ):
                    self[data[:end]] = token
                    break
            else:
                raise ValueError("the vocabulary lacks a single byte")
        out, end, bytes_of = [], size, vocabulary.bytes_of
        while end:
            token = self[data[:end]]
            out.append(token)
            end -= len(bytes_of[token])
        return out[::-1]


class TextEncoder(dict):
    """Whole texts: pieces by a pattern, each encoded by itself.

    No piece holds a blank behind a character that isn't white space, so a text may be cut before
    such blanks. Maps what stands behind a blank to the packed ids of both. A piece that is itself
    a token is that token, as in the tiktoken library.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        super().__init__()
        self.vocabulary = vocabulary
        self.prefixes = PrefixStore(vocabulary)
        self.split: Callable[[str], list[str]] = regex.compile(pattern).findall

    def __missing__(self, word: str) -> bytes:
        packed = self._pieces(f" {word}")
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = packed
        return packed

    def _pieces(self, text: str) -> bytes:
        ids: list[int] = []
        for piece in self.split(text):
            data = piece.encode("utf-8", "surrogatepass")
            whole = self.vocabulary.ranks.get(data)
            if whole is not None:
                ids.append(whole)
            elif len(data) <= KEPT_LENGTH:
                ids += self.prefixes.ids(data)
            else:
                ids += PrefixEncoder(self.vocabulary, data).ids()
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if _SPACE_BEFORE_BLANK.search(text):
            first, *rest = _CUT.split(text)
            rest = [part[1:] for part in rest]
        else:
            first, *rest = text.split(" ")
        return self._pieces(first) + b"".join(map(self.__getitem__, rest))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(
            map(self.vocabulary.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist())
        )

    def append(self, text: str, packed: bytes, more: str) -> bytes:
        """The encoding of ``text + more`` from that of ``text``: only its end is redone."""
        pieces = self.split(text)[-LOOSE_PIECES:]
        redone = sum(len(self._pieces(p)) for p in pieces)
        return packed[: len(packed) - redone] + self.encode("".join(pieces) + more)


def encode_texts(
    frame: DataFrame,
    ranks: bytes,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows of ``(id, ids, decoded)``: packed ids of the whole text, and the bytes they decode to.

    ``ids`` holds little-endian unsigned 32-bit integers. A null or empty text has no ids; every
    row gives one row, repeated ids and texts too; other columns are left behind. ``ranks`` is
    the content of a rank file (a few hundred kB, fixed by the tokenizer), sent to each executor
    once. A task keeps a bounded number of pieces; a very long piece costs time in proportion to
    its length.
    """
    shared = frame.sparkSession.sparkContext.broadcast(ranks)

    def make():
        encoder = TextEncoder(Vocabulary.parse(shared.value), pattern)

        def work(batch: pa.RecordBatch) -> dict:
            packed = [encoder.encode(t) if t else b"" for t in batch.column(1).to_pylist()]
            return {
                id_column: batch.column(0),
                "ids": packed,
                "decoded": list(map(encoder.decode, packed)),
            }

        return work

    kind = frame.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, ids binary, decoded binary"
    return map_texts(frame.select(id_column, text_column), text_column, make, schema)


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """A rank file's content, read by the driver."""
    with open(path, "rb") as file:
        return file.read()
