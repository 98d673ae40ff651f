"""Spelling variants of words by asymmetric q-chunks.

One edit can touch only one of two disjoint chunks that make up a word, so of two words that are
one edit apart, the other holds one of the longer's chunks where it stood, or moved by the
difference of their lengths. The longer word of a pair contributes its two halves, the other all
grams that such a half can meet there; the join finds pairs, the edit distance verifies them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.arrow import cut, map_texts

#: Chunks and grams of one key that are compared pair by pair; above, keys hold the rest as well.
HOT_CHUNKS = 256
HOT_GRAMS = 4096

_LOWER = str.maketrans({c: chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def count_words(
    docs: DataFrame,
    pattern: str,
    least_length: int,
    change: Callable[[str], Callable[[str], str]] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows of ``(word, n)``: words of at least that many characters in whole texts.

    A word is a match of ``pattern`` with A-Z in lower case. ``change`` makes, for the text of a
    document's id (empty for null), a function from a word to what it counts as; a word that
    occurs several times in a document changes alike. Null texts have no words, repeated rows
    count again. Tasks add up slices of texts before anything is shuffled.
    """
    split = re.compile(pattern).findall

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            counts: Counter[str] = Counter()
            for number, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = split(text.translate(_LOWER)) if text else ()
                if change is None:
                    counts.update(words)
                    continue
                changed = change(number or "")
                for word, n in Counter(words).items():
                    counts[changed(word)] += n
            kept = {w: n for w, n in counts.items() if len(w) >= least_length}
            return {"word": list(kept), "n": list(kept.values())}

        return work

    rows = docs.select(F.col(id_column).cast("string").alias("_id"), text_column)
    parts = map_texts(rows, text_column, make, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def crc_typo(every: int) -> Callable[[str], Callable[[str], str]]:
    """A ``change`` for ``count_words``: where ``every`` divides the CRC-32 of ``id:word``, the
    word loses one character, at the place that the CRC-32 leaves over its length."""

    def of(number: str) -> Callable[[str], str]:
        start = zlib.crc32(f"{number}:".encode())

        def changed(word: str) -> str:
            crc = zlib.crc32(word.encode(), start)
            if crc % every:
                return word
            at = crc % len(word)
            return word[:at] + word[at + 1 :]

        return changed

    return of


def _half(length: Column) -> Column:
    return F.floor(length / 2).cast("int")


def _chunks(words: DataFrame) -> DataFrame:
    """Both halves of every word as the longer, or one of two equally long, of a pair."""
    size, half = F.length("word"), _half(F.length("word"))
    chunks = F.array(
        F.struct(
            F.lit(1).alias("side"), size.alias("size"),
            F.substring("word", F.lit(1), half).alias("chunk"),
            F.substring("word", half + 1, size - half).alias("rest"),
        ),
        F.struct(
            F.lit(2).alias("side"), size.alias("size"),
            F.substring("word", half + 1, size - half).alias("chunk"),
            F.substring("word", F.lit(1), half).alias("rest"),
        ),
    )
    return words.select("word", "n", F.inline(chunks))


def _grams(words: DataFrame) -> DataFrame:
    """The grams of every word that a half of another, as long or one longer, can meet.

    A half before the edit stands where it stood; one behind it moves by the difference of the
    lengths, which puts it at the end of both words.
    """
    size = F.length("word")

    def gram(side: int, longer: int) -> Column:
        half = _half(size + longer)
        taken = half if side == 1 else size + longer - half
        begin = F.lit(1) if side == 1 else size - taken + 1
        rest_at, rest = (half + 1, size - half) if side == 1 else (F.lit(1), size - taken)
        return F.struct(
            F.lit(side).alias("side"), (size + longer).alias("size"),
            F.substring("word", begin, taken).alias("chunk"),
            F.substring("word", rest_at, rest).alias("rest"),
        )

    grams = F.array(*[gram(side, longer) for side in (1, 2) for longer in (0, 1)])
    return words.select("word", "n", F.inline(grams))


KEY = ["side", "size", "chunk"]


def _verified(chunks: DataFrame, grams: DataFrame, key: list[str]) -> DataFrame:
    """Pairs of a common key that are one edit apart, each once."""
    a = chunks.select(*key, F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = grams.select(*key, F.col("word").alias("b"), F.col("n").alias("b_n"))
    half = _half(F.length("a"))
    first = F.substring("a", F.lit(1), half) == F.substring("b", F.lit(1), half)
    return a.join(b, key).where(
        # words of one length meet both ways; a pair that both sides bring counts by the first
        ((F.length("a") > F.length("b")) | (F.col("a") < F.col("b")))
        & ((F.col("side") == 1) | ~first)
        & (F.levenshtein("a", "b", 1) == 1)
    ).select("a", "a_n", "b", "b_n")


def _without_one(text: Column) -> Column:
    """Every way to leave out one character, with its place."""
    return F.transform(
        F.sequence(F.lit(1), F.length(text)),
        lambda i: F.struct(
            i.alias("at"),
            F.concat(
                F.substring(text, F.lit(1), i - 1),
                F.substring(text, i + 1, F.length(text) - i),
            ).alias("left"),
        ),
    )


def _refined(rows: DataFrame, longer: bool) -> DataFrame:
    """Rows of hot keys with what is left of the rest of the word, for all pairs of one key.

    Among words of one length a place is left out of both rests (``at``), otherwise any character
    of the longer one's (``at`` is 0), so rows meet only if no more than that one edit parts them.
    """
    out = _without_one(F.col("rest"))
    whole = F.array(F.struct(F.lit(0).alias("at"), F.col("rest").alias("left")))
    if longer:
        dropped = F.array_distinct(
            F.transform(out, lambda x: F.struct(F.lit(0).alias("at"), x["left"].alias("left")))
        )
        keys = F.concat(out, dropped)
    else:
        keys = F.when(F.length("word") == F.col("size"), out).otherwise(whole)
    return rows.select("word", "n", *KEY, F.inline(keys))


def near_pairs(
    words: DataFrame, hot_chunks: int = HOT_CHUNKS, hot_grams: int = HOT_GRAMS
) -> DataFrame:
    """Rows of ``(a, a_n, b, b_n)``: all pairs of distinct words exactly one edit apart, once each.

    ``words`` has distinct ``word`` of two or more characters and ``n``. A key that very many
    chunks or grams share is refined by what is left of the rest of the word once a character is
    left out, which bounds the words that meet by the alphabet and loses no pair; all other keys
    bring at most ``hot_chunks`` pairs per gram.
    """
    chunks, grams = _chunks(words), _grams(words)
    sizes = (
        chunks.select(*KEY, F.lit(1).alias("c"), F.lit(0).alias("g"))
        .unionAll(grams.select(*KEY, F.lit(0).alias("c"), F.lit(1).alias("g")))
        .groupBy(*KEY)
        .agg(F.sum("c").alias("c"), F.sum("g").alias("g"))
    )
    hot = cut(
        sizes.where((F.col("c") > 0) & (F.col("g") > 0))
        .where((F.col("c") > hot_chunks) | (F.col("g") > hot_grams))
        .select(*KEY)
    )
    cold = _verified(chunks.join(hot, KEY, "left_anti"), grams.join(hot, KEY, "left_anti"), KEY)
    refined = _verified(
        _refined(chunks.join(hot, KEY, "left_semi"), longer=True),
        _refined(grams.join(hot, KEY, "left_semi"), longer=False),
        [*KEY, "at", "left"],
    )
    return cold.unionAll(refined)


def spelling_variants(words: DataFrame, times: int = 10) -> DataFrame:
    """Rows of ``(word, n, form, root, n_near, form_n)`` for every distinct word.

    ``n_near`` counts the words one edit away. ``form`` is the most frequent of them, the first in
    code-point order among equals, if it occurs at least ``times`` as often; ``root`` follows forms
    to the last one. An empty table gives no rows.
    """
    words = cut(words)
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("form"), F.col("b_n").alias("form_n"))
    both = both.unionAll(pairs.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"),
    )
    found = words.join(best, "word", "left").withColumn("form_n", -F.col("best.less"))
    chosen = F.col("form_n") >= times * F.col("n")
    rows = cut(
        found.select(
            "word", "n",
            F.when(chosen, F.col("best.form")).alias("form"),
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(chosen, F.col("form_n")).alias("form_n"),
        )
    )
    roots = _roots(rows.where(F.col("form").isNotNull()).select("word", "form"))
    return rows.join(roots, "word", "left").select(
        "word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n"
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: the last form of each word, by pointers that double their reach. A form is
    ``times`` as frequent as its word, so chains are short and have no loops."""
    reach = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        # whether any word moved is known from the rows that were just landed
        moved = cut(
            reach.join(further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            )
        )
        reach = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return reach
