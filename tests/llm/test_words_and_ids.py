"""Spelling variants, token files and ranked search against brute force and the library."""

import os
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

from tidegauge.llm import bag_search, spelling, token_files
from tidegauge.llm.queries import QUERIES, TOKENIZER, WORD
from tidegauge.llm.simple8b import pack, unpack

SF_DIR = "/root/testdata/sf0.001"
with open(TOKENIZER, encoding="utf-8") as _file:
    JSON = _file.read()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, columns named like the operators' own."""
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (None, "no identifier anywhere here"), (4, "!!! ??? ..."),
        (5, "repeated wordings in one row"), (5, "repeated wordings in one row"),
        (5, "other wordings of one id"), (6, "repeatet wordings, in ROW"), (7, "ab" * 100_000),
        (8, "wording  wordings\n  wordinx " * 10_000), (9, "é漢字🧭 \x1c word <|endoftext|> don't"),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name in ("word", "n", "words", "ids", "bag", "m", "digest", "id", "item", "score", "side"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


# --- spelling ---------------------------------------------------------------------------


def near_words(counts):
    """Words one edit apart, by trying every deletion and replaced place."""
    places, near = {}, {w: set() for w in counts}
    for word in counts:
        for i in range(len(word)):
            places.setdefault((len(word), i, word[:i] + word[i + 1 :]), []).append(word)
            shorter = word[:i] + word[i + 1 :]
            if shorter in near:
                near[word].add(shorter)
                near[shorter].add(word)
    for group in places.values():
        for word in group:
            near[word] |= set(group) - {word}
    return near


def variants(counts, times=10):
    near = near_words(counts)
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        if best is not None and counts[best] >= times * n:
            form[word] = best

    def root(word):
        while word in form:
            word = form[word]
        return word

    return sorted(
        (
            (w, n, form.get(w), root(w), len(near[w]), counts.get(form.get(w)))
            for w, n in counts.items()
        ),
        key=repr,
    )


COLUMNS = ("word", "n", "form", "root", "n_near", "form_n")


def test_variants_equal_brute_force_over_dense_words(spark):
    draw = random.Random(5)
    counts = {"".join(draw.choices("abé", k=draw.randint(7, 9))): 0 for _ in range(600)}
    for word in counts:
        counts[word] = draw.choice([2, 2, 3, 25, 300, 4000])
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert rows_of(spelling.spelling_variants(frame), *COLUMNS) == variants(counts)


@pytest.mark.parametrize("chunks, grams", [(1, 1), (4, 10), (10**6, 10**6)])
def test_hot_keys_lose_no_pair_and_add_none(spark, chunks, grams):
    draw = random.Random(6)
    # one first half and one second half stand in most of the words
    words = {"samepref" + "".join(draw.choices("xyz", k=draw.randint(6, 8))) for _ in range(250)}
    words |= {"".join(draw.choices("xyz", k=draw.randint(5, 7))) + "samesuf" for _ in range(250)}
    counts = dict.fromkeys(words, 2)
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = rows_of(spelling.near_pairs(frame, chunks, grams), "a", "b")
    near = near_words(counts)
    assert sorted(tuple(sorted(p)) for p in found) == sorted(
        (a, b) for a in near for b in near[a] if a < b
    )


def test_words_of_odd_rows(spark, odd, empty):
    change = spelling.crc_typo(3)
    expected = Counter()
    for r in odd.select("doc_id", "text").collect():
        name = "" if r.doc_id is None else str(r.doc_id)
        for run in re.findall(WORD, r.text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{name}:{word}".encode())
            if h % 3 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            expected[word] += len(word) >= 7
    found = spelling.count_words(odd, WORD, 7, change)
    assert dict(rows_of(found, "word", "n")) == {w: n for w, n in expected.items() if n}
    got = rows_of(spelling.spelling_variants(found.where("n >= 2")), *COLUMNS)
    assert got == variants({w: n for w, n in expected.items() if n >= 2})
    assert spelling.spelling_variants(spelling.count_words(empty, WORD, 7)).count() == 0


# --- Simple-8b and token files ----------------------------------------------------------


def test_packing_round_trips_any_width_and_fills_words():
    draw = np.random.default_rng(1)
    for _ in range(100):
        lengths = draw.integers(0, 150, draw.integers(1, 12))
        lengths[draw.random(len(lengths)) < 0.3] = 0
        size = int(lengths.sum())
        values = draw.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        values >>= draw.integers(0, 64, size).astype(np.uint64)
        words, n_words, n_escapes = pack(values, lengths)
        assert n_words.sum() == len(words)
        assert n_escapes.sum() == (values >= 2**60).sum()
        assert (unpack(words, n_words, n_escapes, lengths) == values).all()
    words, n_words, _ = pack(np.ones(600, np.uint64), np.array([600]))
    assert len(words) == 10 and n_words.tolist() == [10]


def test_joined_words_are_encoded_as_in_their_texts():
    cache, tokenizer = token_files.WordCache(JSON), Tokenizer.from_str(JSON)
    draw = random.Random(2)
    parts = [
        " ", "  ", "\n", " \n ", "\t", "a", "Word", "don't", "12", "\u00e9", "\u6f22\u5b57", "\u2003", "\x1c",
        "\u00a0", "!?", "<|endoftext|>", "\U0001f9ed", "\u0120", "_",
    ]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 30))) for _ in range(3000)]
    for at in range(0, len(texts), 500):
        some = texts[at : at + 500]
        mine = [np.frombuffer(c, "<u4").tolist() for c in cache.encode(some)]
        assert mine == [tokenizer.encode(t, add_special_tokens=False).ids for t in some]


def with_pattern(name):
    """The tokenizer with its own pattern, with a blank put before texts, or with a newer pattern."""
    tokenizer = Tokenizer.from_str(JSON)
    if name == "prefix":
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    if name == "newer":
        pattern = r"[^\r\n\p{L}\p{N}]?\p{L}+('s|'t|'ll)?|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]+|\s+(?!\S)|\s+"
        tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
    return tokenizer.to_str()


@pytest.mark.parametrize("pattern", ["own", "prefix", "newer"])
def test_units_are_encoded_as_in_their_texts(pattern):
    changed = with_pattern(pattern)
    cache, tokenizer = token_files.WordCache(changed), Tokenizer.from_str(changed)
    draw = random.Random(3)
    wide = [chr(c) for c in (
        0x85, 0xA0, 0xAA, 0xB5, 0xD7, 0xDF, 0xE9, 0xF7, 0x130, 0x301, 0x627, 0x4E00, 0x1680, 0x180E,
        0x2000, 0x200A, 0x200B, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF, 0x1F9ED,
    )]
    parts = [*map(chr, range(128)), *wide, *" \n'" * 12, "'s", "'ll", "ab", "Z", "<|endoftext|>", "<|end"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 40))) for _ in range(6000)]
    texts += ["", "\n", "one. \n\n two", "a\nb\n\nc", "x" * 300 + ", y"]
    for at in range(0, len(texts), 1500):
        some = [None, *texts[at : at + 1500]]
        ids, lengths = cache.code(pa.array([None, "left out", *some, ""], pa.string())[2:])
        mine = [a.tolist() for a in np.split(ids, np.cumsum(lengths))[:-1]]
        theirs = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in [*some, ""]]
        assert mine == theirs
    assert cache.encode([]) == [] and cache.encode(["", ""]) == [b"", b""]


def test_a_word_is_encoded_once_whatever_stands_behind_it():
    cache, asked = token_files.WordCache(JSON), []
    library = cache.tokenizer

    class Asked:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **options)

    cache.tokenizer = Asked()
    words = [f"wor{chr(97 + i)}{chr(97 + k)}é" for i in range(20) for k in range(20)]
    texts = [" ".join(["a", *(w + sign for w in words)]) for sign in ("", ",", ".", "!?", "...", ";")]
    mine = [np.frombuffer(c, "<u4").tolist() for c in cache.encode(texts)]
    assert mine == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(map(len, asked)) < 2 * len(" ".join(words))


def expected_files(frame, end=2):
    tokenizer, start, out = Tokenizer.from_str(JSON), 0, []
    rows = []
    for r in frame.select("doc_id", "text").collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, end]
        rows.append((r.doc_id, ids))
    for number, ids in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        out.append((number, start, ids))
        start += len(ids)
    return out


def test_files_give_back_odd_documents_in_order(spark, odd, empty, tmp_path):
    path = str(tmp_path / "odd")
    token_files.write_token_files(odd.repartition(3), JSON, path, 2, block_words=2, file_blocks=1)
    read = token_files.read_token_files(spark, path).collect()
    mine = sorted((r.start, r.doc_id, r.n_tokens, r.ids) for r in read)
    theirs = expected_files(odd)
    assert [r[1] for r in mine] == [r[0] for r in theirs]
    assert sorted((r[1] or -1, r[3]) for r in mine) == sorted(
        (number or -1, struct.pack(f"<{len(ids)}I", *ids)) for number, _, ids in theirs
    )
    assert [r[0] for r in mine] == [0, *np.cumsum([r[2] for r in mine])[:-1].tolist()]
    index = spark.read.parquet(f"{path}/index")
    assert index.count() > 3 and index.agg(F.sum("n_docs")).first()[0] == odd.count()
    assert index.select("file").distinct().count() > 1
    none = str(tmp_path / "none")
    token_files.write_token_files(empty, JSON, none)
    assert token_files.read_token_files(spark, none).count() == 0


def test_a_damaged_file_is_refused(spark, odd, tmp_path):
    path = str(tmp_path / "damaged")
    token_files.write_token_files(odd, JSON, path)
    file = next(p for p in (tmp_path / "damaged" / "ids").iterdir() if p.name.startswith("part-"))
    file.write_bytes(file.read_bytes()[:-1] + b"?")
    for crc in (tmp_path / "damaged" / "ids").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="no block at byte"):
        token_files.read_token_files(spark, path).collect()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")
def test_token_files_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    theirs = [
        (number, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        for number, start, ids in expected_files(docs)
    ]
    found = QUERIES["op12_token_files"](spark, SF_DIR)
    assert rows_of(found, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(theirs, key=repr)


# --- ranked search ----------------------------------------------------------------------


def ranked(docs, items, k):
    """Every document against every item, one word at a time."""
    import math

    def split(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower)

    counted = [(number, Counter(split(text))) for number, text in docs]
    n_docs = sum(bool(c) for _, c in counted)
    total = sum(sum(c.values()) for _, c in counted)
    words = {}
    for item, text in items:
        words.setdefault(item, set()).update(split(text))
    out = []
    for item, some in words.items():
        weight = {
            t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in c for _, c in counted) + 1)))
            for t in some
        }
        scored = []
        for number, c in counted:
            m = 10 + 90 * sum(c.values()) * n_docs // max(total, 1)
            score = sum(w * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, w in weight.items() if c[t])
            if score > 0:
                scored.append((-score, number is None, number or 0, number))
        for rank, row in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, row[3], -row[0]))
    return sorted(out, key=repr)


RANKED = ("item_id", "rank", "doc_id", "score")


@pytest.mark.parametrize("k, block, held", [(1, 10**6, 10**6), (4, 3, 7), (50, 10**6, 20)])
def test_ranks_equal_brute_force_with_ties_and_copies(spark, monkeypatch, k, block, held):
    monkeypatch.setattr(bag_search, "BLOCK_TERMS", block)
    monkeypatch.setattr(bag_search, "HELD_SCORES", held)
    draw = random.Random(k)
    words = [f"w{i}" for i in range(12)]
    docs = [
        (i % 90, " ".join(draw.choices(words, k=draw.choice([3, 3, 8])))) for i in range(200)
    ] + [(100 + i, "w1 w2 w3 filler") for i in range(60)]
    items = [(i, " ".join(draw.choices(words, k=4))) for i in range(9)] + [(None, "W1 w1!"), (3, "w5")]
    docs_frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    items_frame = spark.createDataFrame(items, "item_id bigint, text string")
    found = rows_of(bag_search.search(docs_frame, items_frame, k), *RANKED)
    assert found == ranked(docs, items, k)


def test_search_over_odd_rows_and_empty_tables(spark, odd, empty):
    items = [(1, "wordings ROW"), (2, None), (3, "?!"), (4, "漢字"), (5, "é漢字🧭"), (6, "absent")]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert rows_of(bag_search.search(odd, frame, 3), *RANKED) == ranked(docs, items, 3)
    assert bag_search.search(empty, frame).count() == 0
    assert bag_search.search(odd, frame.where("false")).count() == 0


def test_a_class_holds_only_its_smallest_ids(spark):
    docs = spark.createDataFrame([(i, "same bag") for i in range(50)], "doc_id bigint, text string")
    items = next(bag_search.item_blocks(docs.limit(1), "doc_id", "text"))
    bagged = bag_search.bags(docs.repartition(4), items, "doc_id", "text")
    (row,) = bag_search.bag_classes(bagged, 50, 100, 3, "doc_id").collect()
    assert row.members == [0, 1, 2]
