"""Token ids of whole documents in binary files of Simple-8b blocks, written and read by tasks.

A file is a sequence of blocks, each followed by the marker ``S8B1``; all numbers are
little-endian. A block holds whole documents:

===============  =====================================================================
``4s I Q Q Q``   ``S8BK``, documents, 64-bit words, ids, position of the first id
``n x q``        document ids
``n x B``        1 where a document has an id, 0 where it is null
``n x Q``        ids of each document
``n x Q``        words of each document, its escapes included
``n x Q``        escapes of each document
``words x Q``    Simple-8b words, document by document (see ``simple8b``)
===============  =====================================================================

Positions count within a part, the files that one task wrote; documents ascend through parts,
files and blocks. The index has a row per block, and the sums of its parts, one number per writing
task, turn positions within parts into positions in the whole. Files are written by Spark's own
writer, so a task that is lost or runs twice leaves one copy, on any storage Spark can write to.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegauge.llm.arrow import slices
from tidegauge.llm.simple8b import pack, unpack

#: Words a block is closed at, and blocks a file has at most (64 MB).
BLOCK_WORDS = 65_536
FILE_BLOCKS = 128
#: Units of text kept with their ids by a Python worker, and the bytes of the longest one kept.
KEPT_WORDS = 300_000
KEPT_LENGTH = 64
#: Units that are encoded as one text, and bytes of texts that are cut into units at a time.
JOINED_WORDS = 10_000
SLICE_CHARS = 1_000_000

_HEAD, _HEAD_SIZE = "<4sIQQQ", 32
_BLOCK, _MARK = b"S8BK", b"S8B1"
#: How the vocabulary writes a blank and a line feed, by their bytes.
_WRITTEN = {b" ": "\u0120", b"\n": "\u010a"}
_PART = r"part-(\d+)-"

#: Kinds of bytes: white space, ASCII that is neither white space nor letter, ASCII letters.
_SPACE, _SIGN, _LETTER = 1, 2, 4
_KINDS = np.zeros(256, "u1")
_KINDS[:128] = _SIGN
_KINDS[list(b"\t\n\v\f\r ")] = _SPACE
_KINDS[[*range(65, 91), *range(97, 123)]] = _LETTER
#: Last three bytes of characters that are, or once were, white space outside ASCII.
_WIDE_SPACES = np.array([
    int.from_bytes(chr(c).encode().rjust(3, b"\0")[-3:], "big")
    for c in (0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)
])


def _cuts(text: np.ndarray, byte_level: bool) -> np.ndarray:
    """Marks on the bytes of UTF-8 text where a piece begins in any case.

    These are blanks behind a character that isn't white space. With the library's own byte-level
    pattern they are also other ASCII white space behind such a character, and other ASCII signs
    behind a letter of Latin-1: that pattern looks at what follows only, so the pieces behind such
    a place don't depend on what stands before it; no piece reaches over it, and none before it
    changes with what follows, as only white space does.
    """
    kinds = _KINDS[text]
    behind = np.zeros(len(text), "u1")
    behind[1:] = kinds[:-1]
    # control characters 28 to 31 are white space to some
    behind[1:][(text[:-1] >= 0x1C) & (text[:-1] < 0x20)] = _SPACE
    behind[:1] = _SPACE
    wide = np.flatnonzero((text[1:] < 0x80) & (text[:-1] >= 0x80)) + 1
    if len(wide):
        last, lead = text[wide - 1], text[wide - 2]
        latin = (lead == 0xC3) & (last != 0x97) & (last != 0xB7)
        three = (text[wide - 3].astype(np.int64) << 16) | (lead.astype(np.int64) << 8) | last
        space = np.isin(three, _WIDE_SPACES) | ((lead == 0xC2) & ((last == 0x85) | (last == 0xA0)))
        behind[wide] = np.where(latin, _LETTER, np.where(space, _SPACE, _SIGN))
    if not byte_level:
        return (text == ord(" ")) & (behind != _SPACE)
    return ((kinds == _SPACE) & (behind != _SPACE)) | ((kinds == _SIGN) & (behind == _LETTER))


class WordCache:
    """A library tokenizer that is asked only for units of text not met before, many at a time.

    For byte-level tokenizers that split text by the usual patterns: texts are cut into units, such
    as a word with the blank before it or the signs behind a word, where a piece begins in any case
    (see ``_cuts``), and each different unit of a slice is looked up once. Of the ids of joined
    units just those that begin a unit begin with its white space. A text that holds an added token
    is a unit of its own.
    """

    def __init__(self, tokenizer: str):
        self.tokenizer = Tokenizer.from_str(tokenizer)
        names = self.tokenizer.get_vocab()
        pattern = {"use_regex": True} | (json.loads(tokenizer)["pre_tokenizer"] or {})
        kind = [pattern.get(k) for k in ("type", "use_regex", "add_prefix_space")]
        self.byte_level = kind == ["ByteLevel", True, False]
        self.begins = {}
        for first, written in list(_WRITTEN.items())[: 2 if self.byte_level else 1]:
            self.begins[first] = marks = np.zeros(max(names.values()) + 1, bool)
            marks[[k for name, k in names.items() if name.startswith(written)]] = True
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ids: dict[bytes, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        ids, lengths = self.code(pa.array(texts, pa.string()))
        raw, ends = ids.tobytes(), (4 * np.cumsum(lengths)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def code(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has; null is empty."""
        texts = pa.compute.fill_null(texts, "").cast(pa.large_string())
        if not pa.compute.any(pa.compute.not_equal(texts, "")).as_py():
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        places = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
        size = int(places[-1] - places[0])
        text = np.frombuffer(texts.buffers()[2], "u1")[places[0] :][:size]
        places = places - places[0]
        cuts = _cuts(text, self.byte_level)
        for token in self.added:
            for at in np.flatnonzero(pa.compute.match_substring(texts, token)).tolist():
                cuts[places[at] : places[at + 1]] = False
        cuts[places[:-1][places[:-1] < places[1:]]] = True
        starts = np.flatnonzero(cuts)
        units = pa.Array.from_buffers(
            pa.large_binary(),
            len(starts),
            [None, pa.py_buffer(np.append(starts, size)), pa.py_buffer(text)],
        ).dictionary_encode()
        _, ends, raw = units.dictionary.buffers()
        ends = np.frombuffer(ends, np.int64)[: len(units.dictionary) + 1].tolist()
        raw = raw.to_pybytes()
        coded = self._look_up([raw[a:b] for a, b in zip(ends, ends[1:])])
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        unit = units.indices.to_numpy()
        n = sizes[unit]
        ends = np.cumsum(n)
        shift = (np.cumsum(sizes) - sizes)[unit] - (ends - n)
        at = np.repeat(shift, n)
        at += np.arange(ends[-1])
        ids = np.frombuffer(b"".join(coded), "<u4")[at]
        before = np.append(0, ends)[np.searchsorted(starts, places)]
        return ids, np.diff(before)

    def _look_up(self, units: list[bytes]) -> list[bytes]:
        """The ids of different units."""
        if len(self.ids) > KEPT_WORDS:
            self.ids.clear()
        known = self.ids
        out = list(map(known.get, units))
        missed = [at for at, ids in enumerate(out) if ids is None]
        # a unit with more white space, or a long one that isn't kept, is encoded by itself
        plain: dict[bytes, list[bytes]] = {first: [] for first in self.begins}
        odd = []
        for at in missed:
            unit = units[at]
            words = unit.split()
            simple = len(words) == 1 and len(words[0]) == len(unit) - 1 < KEPT_LENGTH
            (plain.get(unit[:1], odd) if simple else odd).append(unit)
        known.update(zip(odd, self._each(odd), strict=True))
        for first, some in plain.items():
            for at in range(0, len(some), JOINED_WORDS):
                part = some[at : at + JOINED_WORDS]
                known.update(zip(part, self._joined(part, self.begins[first]), strict=True))
        for at in missed:
            out[at] = known[units[at]]
        for unit in odd:
            if len(unit) > KEPT_LENGTH:
                del known[unit]
        return out

    def _joined(self, units: list[bytes], begins: np.ndarray) -> list[bytes]:
        """The ids of units that begin with one and the same white space and hold no other."""
        text = b"".join(units).decode()
        if any(token in text for token in self.added):
            return self._each(units)
        (coded,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(coded.ids, "<u4")
        first = np.flatnonzero(begins[ids])
        if len(first) != len(units):
            raise ValueError("the tokenizer joins or splits words at other places than blanks")
        raw, places = ids.tobytes(), (4 * first).tolist()
        return [raw[a:b] for a, b in zip(places, [*places[1:], len(raw)], strict=True)]

    def _each(self, units: list[bytes]) -> list[bytes]:
        texts = [unit.decode() for unit in units]
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in (c.ids for c in coded)]


@lru_cache(maxsize=1)
def _word_cache(tokenizer: str) -> WordCache:
    return WordCache(tokenizer)  # outlives a task where Spark uses a worker again


class _Blocks:
    """Puts the documents of a task into blocks, in the order they come."""

    def __init__(self, block_words: int):
        self.block_words, self.start = block_words, 0
        self.held: list[tuple] = []
        self.held_words = 0

    def add(self, ids: list[int | None], lengths, n_words, n_escapes, words) -> Iterator[bytes]:
        ends, at = np.cumsum(n_words), 0
        while at < len(ids):
            before = int(ends[at - 1]) if at else 0
            # the document that fills the block is its last
            full = int(np.searchsorted(ends, before + self.block_words - self.held_words))
            to = min(full + 1, len(ids))
            part = slice(at, to)
            self.held.append((
                ids[part], lengths[part], n_words[part], n_escapes[part],
                words[before : int(ends[to - 1])],
            ))
            self.held_words += int(ends[to - 1]) - before
            at = to
            if self.held_words >= self.block_words:
                yield self.close()

    def close(self) -> bytes:
        lists, *arrays = zip(*self.held, strict=True)
        ids = [i for some in lists for i in some]
        lengths, n_words, n_escapes, words = (np.concatenate(a).astype("<u8") for a in arrays)
        n_ids = int(lengths.sum())
        block = b"".join([
            struct.pack(_HEAD, _BLOCK, len(ids), len(words), n_ids, self.start),
            np.array([i or 0 for i in ids], "<i8").tobytes(),
            np.array([i is not None for i in ids], "u1").tobytes(),
            lengths.tobytes(), n_words.tobytes(), n_escapes.tobytes(), words.tobytes(),
        ])
        self.start += n_ids
        self.held, self.held_words = [], 0
        return block


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    path: str,
    end_id: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_words: int = BLOCK_WORDS,
    file_blocks: int = FILE_BLOCKS,
) -> None:
    """Write the token ids of whole texts in ascending order of ids, nulls first, and an index.

    ``tokenizer`` is the JSON of a byte-level tokenizer (a few MB, fixed by it), sent to each
    executor once; ``end_id`` stands behind each document. Null and empty texts have just the end
    id, or none; repeated rows and ids stay, other columns are left behind, no rows give an index
    without rows. Texts are dealt to tasks by ranges of ids before they are encoded; rows that
    share an id spread over several ranges, ordered by a hash of their text, so a hot id is no hot
    task. A task holds a bounded slice of texts, a bounded word cache and one open block; a very
    long text is a slice and fills a block of its own.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer)
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text")
    )
    rows = rows.withColumn("digest", F.xxhash64("text"))
    rows = rows.withColumn("deal", F.monotonically_increasing_id())  # tells equal rows apart
    order = [F.col("id").asc_nulls_first(), F.col("digest"), F.col("deal")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        cache, made = _word_cache(shared.value), _Blocks(block_words)

        def record(block: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block])], ["block"])

        for batch in batches:
            for part in slices(batch, "text", SLICE_CHARS):
                ids, lengths = cache.code(part.column(1))
                if end_id is not None:
                    ids, lengths = np.insert(ids, np.cumsum(lengths), end_id), lengths + 1
                words, n_words, n_escapes = pack(ids, lengths)
                yield from map(
                    record, made.add(part.column(0).to_pylist(), lengths, n_words, n_escapes, words)
                )
        if made.held:
            yield record(made.close())

    (
        dealt.select("id", "text")
        .mapInArrow(blocks, "block binary")
        .select(F.col("block").cast("string").alias("value"))
        .write.option("lineSep", _MARK.decode())
        .option("maxRecordsPerFile", file_blocks)
        .text(f"{path}/ids")
    )
    _block_heads(spark, path).write.parquet(f"{path}/index")


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ids")
    file = F.substring_index("path", "/", -1)
    return files.select(
        F.regexp_extract(file, _PART, 1).cast("int").alias("part"), file.alias("file"), "content"
    )


def _each_block(content: bytes) -> Iterator[tuple[int, tuple[int, int, int, int]]]:
    """Places of the blocks of a file, with documents, words, ids and first position."""
    at = 0
    while at < len(content):
        magic, *sizes = struct.unpack_from(_HEAD, content, at)
        end = at + _HEAD_SIZE + 33 * sizes[0] + 8 * sizes[1]
        if magic != _BLOCK or content[end : end + len(_MARK)] != _MARK:
            raise ValueError(f"no block at byte {at}")
        yield at, tuple(sizes)
        at = end + len(_MARK)


def _ids_of(content: bytes, at: int, n: int) -> list[int | None]:
    ids = np.frombuffer(content, "<i8", n, at + _HEAD_SIZE).tolist()
    valid = np.frombuffer(content, "u1", n, at + _HEAD_SIZE + 8 * n).tolist()
    return [i if v else None for i, v in zip(ids, valid, strict=True)]


def _block_heads(spark: SparkSession, path: str) -> DataFrame:
    """A row per block: part, file, byte, documents, ids, first position, least and largest id."""
    schema = (
        "part int, file string, at bigint, n_docs bigint, n_ids bigint, start bigint, "
        "least_id bigint, largest_id bigint"
    )
    names = [c.split()[0] for c in schema.split(", ")]

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for part, file, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for at, (n, _, n_ids, start) in _each_block(content):
                    known = [i for i in _ids_of(content, at, n) if i is not None]
                    rows.append((
                        part, file, at, n, n_ids, start,
                        min(known, default=None), max(known, default=None),
                    ))
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            kinds = [pa.int32(), pa.string(), *[pa.int64()] * 6]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    return _files(spark, path).mapInArrow(heads, schema)


def read_token_files(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """Rows of ``(id, start, n_tokens, ids)``: every document as the files hold it.

    ``start`` is the number of ids before the document in all files; ``ids`` holds little-endian
    unsigned 32-bit integers. A task reads one file after another and decodes a block at a time.
    The driver holds one number per part.
    """
    sums = spark.read.parquet(f"{path}/index").groupBy("part").agg(F.sum("n_ids").alias("n"))
    before, starts = 0, {}
    for part, n in sorted(tuple(r) for r in sums.collect()):
        starts[part], before = before, before + n
    shared = spark.sparkContext.broadcast(starts)
    schema = f"`{id_column}` bigint, start bigint, n_tokens bigint, ids binary"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for at, (n, n_words, _, start) in _each_block(content):
                    table = at + _HEAD_SIZE + 9 * n
                    sizes = np.frombuffer(content, "<u8", 3 * n, table).astype(np.int64)
                    lengths, words_of, escapes = sizes.reshape(3, n)
                    words = np.frombuffer(content, "<u8", n_words, table + 24 * n)
                    raw = unpack(words, words_of, escapes, lengths).astype("<u4").tobytes()
                    ends = np.cumsum(lengths)
                    first = ends - lengths
                    ids = [
                        raw[4 * a : 4 * b]
                        for a, b in zip(first.tolist(), ends.tolist(), strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(_ids_of(content, at, n), pa.int64()),
                            pa.array(shared.value[part] + start + first, pa.int64()),
                            pa.array(lengths, pa.int64()),
                            pa.array(ids, pa.binary()),
                        ],
                        [id_column, "start", "n_tokens", "ids"],
                    )

    return _files(spark, path).mapInArrow(decode, schema)
