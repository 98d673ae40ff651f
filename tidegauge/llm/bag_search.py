"""Ranked lexical search that scores each distinct bag of words once.

Documents are cut down to the words of the searched items. Those that hold the same of these words
equally often, and have the same length norm, score alike against every item, so they form one
class: found by a hash, verified by the whole bag, scored once, and expanded to its members by
ascending id where it ranks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.arrow import map_texts
from tidegauge.session import shared_dir

#: Words of items that are searched in one scan of the documents; an item is never split.
BLOCK_TERMS = 1_000_000
#: Scores of classes times items that a task holds at a time.
HELD_SCORES = 4_000_000
#: Share of the norm that follows the length, in hundredths, and its weight.
NORM_LENGTH, NORM_WEIGHT = 90, 8

# ASCII letters in lower case and digits stay, other ASCII parts words, all else is kept
_TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower()
)


def terms(text: str) -> list[bytes]:
    """The words of a text: runs of ASCII letters, ASCII digits and all characters above them."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class Items:
    """Searched items with their words by number."""

    ids: list
    numbers: dict[bytes, int]  # word -> number
    starts: np.ndarray  # of the items of each word within ``holders``
    holders: np.ndarray  # places of the items that hold a word, word by word

    @classmethod
    def of(cls, words: dict[object, set[bytes]]) -> Items:
        numbers = {t: k for k, t in enumerate(sorted(set().union(*words.values())))}
        pairs = sorted((numbers[t], i) for i, some in enumerate(words.values()) for t in some)
        held, holders = np.array(pairs, np.int64).reshape(-1, 2).T
        return cls(list(words), numbers, np.searchsorted(held, np.arange(len(numbers) + 1)), holders)


def item_blocks(items: DataFrame, id_column: str, text_column: str) -> Iterator[Items]:
    """Items in blocks of bounded words; rows of one id are one item, items without words go."""
    rows = items.select(id_column, text_column).orderBy(id_column)
    words: dict[object, set[bytes]] = {}
    for number, text in rows.toLocalIterator():
        if number not in words and sum(map(len, words.values())) >= BLOCK_TERMS:
            yield Items.of(words)
            words = {}
        if found := set(terms(text or "")):
            words.setdefault(number, set()).update(found)
    if words:
        yield Items.of(words)


def bags(docs: DataFrame, items: Items, id_column: str, text_column: str) -> DataFrame:
    """Rows of ``(id, n, bag)``: a document's words with repeats, and of the items' words the
    number and count of each as unsigned 32-bit integers, ascending; the bag may be empty."""
    shared = docs.sparkSession.sparkContext.broadcast(items.numbers)
    kind = docs.schema[id_column].dataType

    def make():
        number = shared.value.get

        def bag(words: list[bytes]) -> bytes:
            held = [k for k in map(number, words) if k is not None]
            return np.column_stack(np.unique(held, return_counts=True)).astype("<u4").tobytes()

        def work(batch: pa.RecordBatch) -> dict:
            split = [terms(text) if text else [] for text in batch.column(1).to_pylist()]
            return {
                id_column: batch.column(0),
                "n": list(map(len, split)),
                "bag": [bag(words) if words else b"" for words in split],
            }

        return work

    schema = T.StructType([T.StructField(id_column, kind)])
    schema = schema.add("n", "long").add("bag", "binary")
    return map_texts(docs.select(id_column, text_column), text_column, make, schema)


def document_counts(bagged: DataFrame, items: Items) -> np.ndarray:
    """Documents that hold each word, by its number; tasks count before anything is sent."""
    size = len(items.numbers)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            pairs = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4")
            held += np.bincount(pairs[::2], minlength=size)
        seen = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(held[seen])], ["term", "df"])

    parts = bagged.select("bag").mapInArrow(count, "term bigint, df bigint")
    found = np.zeros(size, np.int64)
    for term, df in parts.groupBy("term").agg(F.sum("df").alias("df")).collect():
        found[term] = df
    return found


def bag_classes(bagged: DataFrame, n_docs: int, n_words: int, members: int, id_column: str) -> DataFrame:
    """Rows of ``(digest, m, bag, members)``: each class of equal bag and norm with its smallest ids.

    Each task drops all but that many ids of a class before anything is shuffled, so a class that
    holds most documents is no hot spot. Null ids come last. Empty bags are left out.
    """
    m = F.expr(
        f"{100 - NORM_LENGTH} + (({NORM_LENGTH} * n * {n_docs}L) div {max(n_words, 1)}L)"
    )
    keyed = bagged.where(F.length("bag") > 0).select(id_column, "bag", m.cast("bigint").alias("m"))
    keyed = keyed.withColumn("digest", F.xxhash64("bag", "m"))
    # the digest deals and sorts, bag and norm verify
    same = Window.partitionBy("digest", "bag", "m").orderBy(F.col(id_column).asc_nulls_last())
    ranked = keyed.withColumn("place", F.row_number().over(same)).where(F.col("place") <= members)
    # places keep a null id, which a list of ids alone would drop
    listed = F.sort_array(F.collect_list(F.struct("place", F.col(id_column).alias("id"))))
    return ranked.groupBy("digest", "bag", "m").agg(listed["id"].alias("members"))


def _best(scores, order, items, k):
    """Places of the k best of every item, by falling score and then rising order."""
    by = np.lexsort((order, -scores, items))
    grouped = items[by]
    first = np.searchsorted(grouped, grouped)
    return by[np.arange(len(by)) - first < k]


def score_classes(
    classes: DataFrame, items: Items, weights: np.ndarray, k: int, id_type: T.DataType
) -> DataFrame:
    """Rows of ``(item, score, id)``: each task's k best members of its classes for every item.

    A task holds the scores of a slice of classes and the best classes so far; the k best
    documents of an item are always among the members of its k best classes, in order of score
    and smallest id.
    """
    shared = classes.sparkSession.sparkContext.broadcast((items.starts, items.holders, weights))
    n_items = len(items.ids)
    schema = T.StructType().add("item", "long").add("score", "long").add("id", id_type)
    step = max(1, HELD_SCORES // n_items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, holders, weight = shared.value
        best: list[tuple] = []  # (item, score, members)
        floor = np.zeros(n_items, np.int64)  # of scores that can still rank
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                raw = part.column(0).to_pylist()
                sizes = np.array([len(b) // 8 for b in raw])
                term, tf = np.frombuffer(b"".join(raw), "<u4").astype(np.int64).reshape(-1, 2).T
                owner = np.repeat(np.arange(len(raw)), sizes)
                m = part.column(1).to_numpy(zero_copy_only=False)[owner]
                adds = weight[term] * ((1_000_000_000 * tf) // (1_000 * tf + NORM_WEIGHT * m))
                # every word of a class once per item that holds it
                times = starts[term + 1] - starts[term]
                ends = np.cumsum(times)
                each = np.repeat(np.arange(len(term)), times)
                item = holders[starts[term[each]] + np.arange(len(each)) - (ends - times)[each]]
                scores = np.zeros((len(raw), n_items), np.int64)
                np.add.at(scores, (owner[each], item), adds[each])
                row, item = np.nonzero((scores > 0) & (scores >= floor))
                members = part.column(2)
                lists = {r: members[r].as_py() for r in np.unique(row).tolist()}
                best += [
                    (i, s, lists[r])
                    for r, i, s in zip(row.tolist(), item.tolist(), scores[row, item].tolist(), strict=True)
                ]
                if best:
                    best = _prune(best, floor, k)
        rows = sorted(
            ((i, -s, d is None, d) for i, s, ids in best for d in ids),
            key=lambda r: (r[:3], r[3] or 0),
        )
        out, seen = [], {}
        for i, s, _, d in rows:
            seen[i] = seen.get(i, 0) + 1
            if seen[i] <= k:
                out.append({"item": i, "score": -s, "id": d})
        yield pa.RecordBatch.from_pylist(out, schema=arrow_schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_schema = to_arrow_schema(schema)
    return classes.select("bag", "m", "members").mapInArrow(run, schema)


def _prune(best: list[tuple], floor: np.ndarray, k: int) -> list[tuple]:
    items = np.array([b[0] for b in best])
    scores = np.array([b[1] for b in best])
    # classes of one score in order of their smallest id, those of null ids last
    order = sorted(range(len(best)), key=lambda j: (best[j][2][0] is None, best[j][2][0] or 0))
    place = np.empty(len(best), np.int64)
    place[order] = np.arange(len(best))
    kept = _best(scores, place, items, k)
    counts = np.bincount(items[kept], minlength=len(floor))
    full = np.flatnonzero(counts == k)
    least = np.full(len(floor), np.iinfo(np.int64).max)
    np.minimum.at(least, items[kept], scores[kept])
    floor[full] = least[full]
    return [best[j] for j in kept]


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows of ``(item_id, rank, doc_id, score)``: the k documents that score highest per item.

    Scores are integers, as the README states; only those above 0 rank, equal ones by ascending
    id. Every row of ``docs`` is a document: repeated rows rank one after the other, null ids last
    among equals; null, empty or wordless texts rank nowhere and, but for words, count nowhere.
    Rows of ``items`` that share an id are one item with the words of all. Texts are read whole,
    other columns of either table are left behind, and an empty table gives no rows.

    Items are searched in blocks of ``BLOCK_TERMS`` words, each of which scans the documents once
    and lands 16 bytes and the bag per document; the driver and tasks hold one block of items.
    """
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType
    result = T.StructType([T.StructField(item_id, items.schema[item_id].dataType)])
    result = result.add("rank", "integer").add(doc_id, id_type).add("score", "long")
    found = [
        _search_block(docs, block, k, doc_id, text_column, result)
        for block in item_blocks(items, item_id, text_column)
    ]
    out = spark.createDataFrame([], result) if not found else found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def _search_block(docs, block: Items, k: int, doc_id: str, text_column: str, result) -> DataFrame:
    spark = docs.sparkSession
    path = shared_dir(spark, "bags")
    bags(docs, block, doc_id, text_column).write.parquet(path)
    bagged = spark.read.parquet(path)
    n_docs, n_words = bagged.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    df = document_counts(bagged, block).tolist()
    # floors of the same doubles as a loop over plain floats gives
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df])
    classes = bag_classes(bagged, n_docs, n_words or 0, k, doc_id)
    id_type = result[doc_id].dataType
    scored = score_classes(classes, block, weights, k, id_type)
    ids = spark.createDataFrame(
        list(enumerate(block.ids)), T.StructType().add("item", "long").add(result[0].name, result[0].dataType)
    )
    ranks = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    best = scored.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
    return best.join(ids, "item").select(
        result[0].name, "rank", F.col("id").alias(doc_id), "score"
    )
