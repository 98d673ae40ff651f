"""Near-duplicate join on word shingles: MinHash LSH forest, then exact verification."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.llm.arrow import cut, map_texts
from tidegauge.llm.components import components
from tidegauge.llm.words import WordHashes, shingles

#: Groups of documents up to this size are verified in one piece.
WHOLE_GROUP = 64
#: Characters of text, about, that a verifying task holds at a time.
GROUP_CHARS = 16_000_000
_PLACE_BYTES = 2


@dataclass(frozen=True)
class Forest:
    """Parameters of the join: ``trees`` tries, each over ``depth`` minimum hashes."""

    threshold: float = 0.8
    words: int = 5
    trees: int = 20
    depth: int = 7
    recall: float = 0.995
    seed: int = 11

    def prefix(self) -> int:
        """How deep two documents must agree in some trie.

        Starts at full depth and shortens the matched prefix until a pair at the threshold is
        found with the target recall.
        """
        depth = self.depth
        while depth > 1 and self.found(self.threshold, depth) < self.recall:
            depth -= 1
        return depth

    def found(self, similarity: float, depth: int) -> float:
        """The share of pairs of some similarity that agree in a prefix of some trie."""
        return 1 - (1 - similarity**depth) ** self.trees

    def factors(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        size = self.trees * self.depth
        odd = rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        return odd, rng.integers(0, 2**63, size, dtype=np.uint64)


def signature(runs: np.ndarray, factors: tuple[np.ndarray, np.ndarray]) -> bytes:
    """The minimum hashes of a set, two bytes each, trie by trie."""
    odd, shift = factors
    low = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(runs), 1024):
        part = runs[at : at + 1024, None] * odd + shift
        np.minimum(low, part.min(0), out=low)
    mixed = (low * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
    return mixed.astype(">u2").tobytes()


def sign(frame: DataFrame, forest: Forest) -> DataFrame:
    """Rows of ``(doc_id, text_hash, digest, signature)``: copies of a shingle set share the last two."""

    def make():
        words, factors = WordHashes(), forest.factors()

        def work(batch: pa.RecordBatch) -> dict:
            digests, signatures = [], []
            for text in batch.column(2).to_pylist():
                runs = shingles(words.of(text or ""), forest.words)
                digests.append(xxhash.xxh3_128_digest(runs.tobytes()) if len(runs) else None)
                signatures.append(signature(runs, factors) if len(runs) else None)
            return {
                "doc_id": batch.column(0), "text_hash": batch.column(1),
                "digest": digests, "signature": signatures,
            }

        return work

    schema = "doc_id bigint, text_hash bigint, digest binary, signature binary"
    ids, text_hash = F.col("doc_id").cast("bigint"), F.xxhash64("text")
    rows = frame.select(ids.alias("doc_id"), text_hash.alias("text_hash"), "text")
    return map_texts(rows, "text", make, schema)


def _groups(sets: DataFrame, forest: Forest) -> DataFrame:
    """Sets that agree with another one in a prefix, by connected group: ``(rep, grp)``."""
    width, deep = forest.depth * _PLACE_BYTES, forest.prefix() * _PLACE_BYTES
    nodes = sets.select(
        "rep", F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1))).alias("tree"), "signature"
    ).select(
        "rep", "tree", F.expr(f"substring(signature, 1 + tree * {width}, {deep})").alias("prefix")
    )
    # partial minima and counts shrink a trie node that holds many sets before the shuffle
    hubs = (
        nodes.groupBy("tree", "prefix")
        .agg(F.min("rep").alias("hub"), F.max("rep").alias("top"))
        .where("hub < top")
        .drop("top")
    )
    links = nodes.join(hubs, ["tree", "prefix"]).where("rep <> hub")
    found = components(links.select(F.col("hub").alias("a"), F.col("rep").alias("b")))
    return found.select(F.col("node").alias("rep"), F.col("root").alias("grp"))


def verify(docs: pd.DataFrame, forest: Forest, one: int, other: int) -> pd.DataFrame:
    """Links between the documents of two blocks of a group, or within one block.

    For each document: the weight of those it is linked to, and the smallest document its links
    lead to within these blocks.
    """
    hashes = WordHashes()
    docs = docs.sort_values(["rep", "digest"]).drop_duplicates(["rep", "digest"])
    sets = [shingles(hashes.of(t), forest.words) for t in docs["text"]]
    mine = [
        xxhash.xxh3_128_digest(s.tobytes()) == bytes(d)
        for s, d in zip(sets, docs["digest"], strict=True)
    ]
    docs = docs[mine]  # a row that shares its id with another text may have come along
    sets = [s for s, own in zip(sets, mine, strict=True) if own]
    n = len(sets)
    if n < 2:
        return pd.DataFrame({"rep": [], "least": [], "links": []})
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, number, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1  # other runs are in no intersection
    place = np.cumsum(shared) - 1
    keep = shared[number]
    owner, number = owner[keep], place[number[keep]]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    common = np.zeros((n, n), np.float32)
    step = 4096
    for at in range(0, int(shared.sum()), step):
        lo, hi = np.searchsorted(number, [at, at + step])
        part = np.zeros((n, step), np.float32)
        part[owner[lo:hi], number[lo:hi] - at] = 1
        common += part @ part.T
    linked = common >= forest.threshold * (sizes[:, None] + sizes - common) - 1e-6
    np.fill_diagonal(linked, False)
    if one != other:
        block = docs["block"].to_numpy()
        linked &= block[:, None] != block
    reps, weights = docs["rep"].to_numpy(), docs["weight"].to_numpy()
    least = np.arange(n)
    while True:
        seen = np.minimum(least, np.where(linked, least, n).min(1))
        if (seen == least).all():
            break
        least = seen
    return pd.DataFrame({"rep": reps, "least": reps[least], "links": linked @ weights})


def _links(frame: DataFrame, sets: DataFrame, groups: DataFrame, forest: Forest) -> DataFrame:
    """Verified links, block by block: ``(rep, least, links)``."""
    texts = frame.select(F.col("doc_id").cast("bigint").alias("rep"), "text")
    length = F.length("text")
    members = cut(
        sets.select("rep", "digest", "weight").join(groups, "rep").join(texts, "rep")
    )
    sizes = members.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum(length).alias("chars"))
    blocks = F.when((F.col("n") <= WHOLE_GROUP) & (F.col("chars") <= GROUP_CHARS), 1).otherwise(
        F.greatest(F.ceil(F.sqrt("n")), F.ceil(F.col("chars") / (GROUP_CHARS // 2)))
    )
    block = F.pmod(F.xxhash64("rep", "digest"), F.col("blocks")).cast("int")
    dealt = (
        members.join(sizes.select("grp", blocks.cast("int").alias("blocks")), "grp")
        .withColumn("block", block)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "grp",
            F.least("block", "with").alias("one"),
            F.greatest("block", "with").alias("other"),
            "rep", "digest", "weight", "block", "text",
        )
    )

    def check(key: tuple, docs: pd.DataFrame) -> pd.DataFrame:
        return verify(docs, forest, key[1], key[2])

    return dealt.groupBy("grp", "one", "other").applyInPandas(
        check, "rep bigint, least bigint, links bigint"
    )


def near_duplicates(frame: DataFrame, forest: Forest | None = None) -> DataFrame:
    """Rows of ``(doc_id, class_id, n_links)``, one for each row of ``(doc_id, text)``.

    Two documents are linked if the Jaccard similarity of their sets of word shingles reaches the
    threshold; ``n_links`` counts the documents linked to one, copies too. A class is what links
    connect; its id is its smallest doc_id. Words are white-space separated, in lower case and
    without anything but letters and digits; a text with fewer words than a shingle is one
    shingle. Texts without words are linked to nothing and form a class each. Rows that share a
    doc_id belong to one document, whatever their texts; rows without a doc_id take the class of
    their copies, or none. Other columns are left behind.

    Copies collapse to one set with a weight first. Sets that agree in a prefix of some trie
    form groups; groups are cut into blocks by their size, and each pair of blocks is verified
    exactly in a task of its own, so links between blocks are counted without listing pairs.
    """
    return _classes(frame, forest or Forest()).select("doc_id", "class_id", "n_links")


def _classes(frame: DataFrame, forest: Forest) -> DataFrame:
    """What ``near_duplicates`` gives, with ``text_hash`` and ``digest`` of each row's text."""
    signed = cut(sign(frame, forest))
    sets = cut(
        signed.where("digest is not null and doc_id is not null")
        .groupBy("digest", "signature")
        .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    )
    links = cut(_links(frame, sets, _groups(sets, forest), forest))
    roots = components(
        links.where("rep <> least").select(F.col("least").alias("a"), F.col("rep").alias("b"))
    )
    counted = links.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = (
        sets.select("digest", "rep", "weight")
        .join(counted, "rep", "left")
        .join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
        .select(
            "digest",
            F.coalesce("root", "rep").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        )
    )
    return (
        signed.select("doc_id", "text_hash", "digest")
        .join(classes, "digest", "left")
        .select(
            "doc_id", "text_hash", "digest",
            F.coalesce("class_id", "doc_id").alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        )
    )


def keep_one(frame: DataFrame, forest: Forest | None = None) -> DataFrame:
    """The rows, with all their columns, that stand for the class of their text.

    A row stays if its doc_id names that class. Of rows that share a doc_id and the words of their
    text one stays, so an id's other, different texts are judged by themselves; rows without a
    doc_id all stay, those of repeated texts without words once per id. An empty table gives no
    rows. The columns may have any names.
    """
    ids, text_hash, number = (_free(frame, name) for name in ("ids", "text_hash", "number"))
    judged = _classes(frame, forest or Forest()).where("doc_id = class_id")
    same = F.coalesce("digest", F.col("text_hash").cast("string").cast("binary"))
    kept = judged.groupBy("doc_id", same).agg(F.min("text_hash").alias(text_hash)).select(
        F.col("doc_id").alias(ids), text_hash
    )
    rows = frame.withColumns({ids: F.col("doc_id").cast("bigint"), text_hash: F.xxhash64("text")})
    # a task drops all but one of equal rows before they are shuffled
    equal = Window.partitionBy(ids, text_hash).orderBy("text")
    left = rows.where(F.col("doc_id").isNotNull()).join(kept.distinct(), [ids, text_hash], "left_semi")
    left = left.withColumn(number, F.row_number().over(equal)).where(F.col(number) == 1)
    return left.select(*frame.columns).unionAll(frame.where(F.col("doc_id").isNull()))


def _free(frame: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have."""
    while name in frame.columns:
        name += "_"
    return name
