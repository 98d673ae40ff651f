"""Benchmark decontamination: latent semantic retrieval, then subsequence and answer checks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.arrow import map_texts
from tidegauge.llm.words import KEPT_TOKENS, WordHashes, normal

#: Items, and characters of items, about, that are sent to the tasks at once; more are taken in turn.
BLOCK_ITEMS = 1000
BLOCK_CHARS = 4_000_000
#: Latent spaces of a block, about, and pairs of places and items that a task holds at a time.
BLOCK_SPACES = 8
SLICE_PAIRS = 2_000_000


@dataclass(frozen=True)
class Retrieval:
    """Parameters: passages of two strides of words, latent dimensions, thresholds."""

    stride: int = 16
    dims: int = 384
    oversample: int = 16
    frequent: float = 0.01  # words of a larger share of the documents weigh nothing
    prior: int = 1000  # documents without the word that each word's share is smoothed by
    rare_words: int = 4  # words of an item that weigh something in any case, its rarest
    together: int = 3  # weighty words without which a passage is not looked at
    cosine: float = 0.45
    verbatim: float = 0.8  # share of an item's words in common order that makes a leak
    paraphrase: float = 0.6  # share that makes one if the answer is there too
    answer: float = 0.6  # share of the answer's words in common order
    contiguous: int = 8  # items of fewer words must occur in one piece
    seed: int = 5


class Places(dict):
    """Raw token to the place of its word among the given ones.

    Their number stands for any other word, -1 for a token without letters or digits.
    """

    def __init__(self, words: dict[str, int]):
        self.words, self.other = words, len(words)

    def __missing__(self, token: str) -> int:
        if len(self) >= KEPT_TOKENS:
            self.clear()
        word = normal(token)
        value = self[token] = self.words.get(word, self.other) if word else -1
        return value

    def of(self, text: str) -> np.ndarray:
        """Places of the words of a whole text, in order."""
        tokens = text.split()
        places = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        return places[places >= 0]


class Passages:
    """Runs of two strides of words over several texts, of which weighty words count.

    ``text`` and ``number`` name each passage's text and its first stride.
    """

    def __init__(self, texts: list[np.ndarray], stride: int, weighty: np.ndarray):
        sizes = np.array([len(t) for t in texts], np.int64)
        counts = -(-sizes // stride)
        self.text = np.repeat(np.arange(len(texts)), counts)
        first = np.cumsum(counts) - counts
        self.number = np.arange(len(self.text)) - first[self.text]
        words = np.concatenate(texts) if texts else np.empty(0, np.int64)
        used = np.flatnonzero(weighty[words])
        owner = np.searchsorted(np.cumsum(sizes), used, "right")
        place = used - (np.cumsum(sizes) - sizes)[owner]
        self.words, self.at = words[used], first[owner] + place // stride
        self.follows = np.append(self.text[1:] == self.text[:-1], False)[: len(self.text)]

    def total(self, values: np.ndarray | None = None, of: np.ndarray | None = None) -> np.ndarray:
        """For each passage the sum of a value of its weighty words, or their number."""
        at = self.at if of is None else self.at[of]
        sums = np.bincount(at, values, minlength=len(self.text) + 1)
        return sums[:-1] + np.where(self.follows, sums[1:], 0)

    def rows(self, words: np.ndarray, at: np.ndarray, matrix: np.ndarray, chosen: np.ndarray):
        """Sums of the rows of a matrix over some of the words, for the chosen passages."""
        begins = np.flatnonzero(np.diff(at, prepend=-1))
        # a row of zeros behind the sums stands for a stride without such words
        sums = np.zeros((len(begins) + 1, matrix.shape[1]), matrix.dtype)
        if len(begins):
            np.add.reduceat(matrix[words], begins, 0, out=sums[:-1])
        row = np.full(len(self.text) + 1, len(begins))
        row[at[begins]] = np.arange(len(begins))
        return sums[row[chosen]] + sums[
            np.where(self.follows[chosen], row[chosen + 1], len(begins))
        ]


@dataclass
class Space:
    """A latent space of some passages of items, no more than its dimensions: nothing is cut."""

    place: np.ndarray  # row of each word of the vocabulary, -1 for words of no passage
    rows: np.ndarray  # words by dimensions
    passages: np.ndarray  # dimensions by passages, of length 1
    passage_item: np.ndarray
    least: int  # weighty words of a passage without which none of the items is there


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows**2).sum(1, keepdims=True)), 1e-9)


def common_subsequence(masks: dict[int, int], length: int, words: list[int]) -> int:
    """Length of the longest common subsequence, by one addition of bit rows per word."""
    row = whole = (1 << length) - 1
    for word in words:
        mask = masks.get(word)
        if mask:
            row = (row + (row & mask)) | (row & ~mask)
    return length - (row & whole).bit_count()


def bit_masks(words: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << i
    return masks


class Benchmark:
    """A block of items as word numbers of their own vocabulary, with its latent spaces.

    Passages are dealt to spaces by their order, ``dims`` to each, those of equal items once.
    """

    def __init__(self, ids: list, texts: list[str], answers: list[str | None], how: Retrieval):
        hashes, self.how = WordHashes(), how
        words = [hashes.of(t or "") for t in texts]
        kept = [i for i, w in enumerate(words) if len(w)]
        self.ids = [ids[i] for i in kept]
        words = [words[i] for i in kept]
        self.vocabulary = np.unique(np.concatenate(words)) if words else np.empty(0, np.uint64)
        self.items = [self.numbers(w) for w in words]
        names = {normal(t) for i in kept for t in texts[i].split()} - {""}
        own = {w: hashes[w] for w in names}
        self.words = {w: int(k) for w, k in zip(own, self.numbers(np.array(list(own.values()), np.uint64)), strict=True)}
        self.answers = []
        for i, item in zip(kept, self.items, strict=True):
            answer = answers[i]
            if answer is None:  # the last fourth of an item stands for its answer
                self.answers.append(item[-max(1, len(item) // 4) :].tolist())
            else:
                known = self.numbers(hashes.of(answer))
                self.answers.append(known[known < len(self.vocabulary)].tolist())
        self.masks = [bit_masks(i.tolist()) for i in self.items]
        self.answer_masks = [bit_masks(a) for a in self.answers]
        self.first: dict[bytes, int] = {}  # first passage of each sequence of words
        number = 0
        for item in self.items:
            if item.tobytes() not in self.first:
                self.first[item.tobytes()] = number
                number += -(-len(item) // how.stride)
        self.count = -(-number // how.dims)
        self.pairs()

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Places in the vocabulary; its length stands for any other word."""
        size = len(self.vocabulary)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == size] = 0
        return np.where(self.vocabulary[at] == hashes, at, size) if size else at

    def weights(self, counts: np.ndarray, documents: int) -> np.ndarray:
        """Inverse document frequencies above that of a frequent word; frequent words get 0."""
        how = self.how
        share = (counts + 1) / (documents + how.prior)
        idf = np.maximum(0, np.log(how.frequent) - np.log(share))
        for item in self.items:  # an item of frequent words only must be found too
            words = np.unique(item)
            if (idf[words] > 0).sum() < how.rare_words:
                rarest = words[np.argsort(counts[words], kind="stable")[: how.rare_words]]
                idf[rarest] = np.maximum(idf[rarest], 1.0)
        return idf

    def pairs(self) -> None:
        """Pairs of neighbouring words of each item (of one word: that), and how many stay.

        A copy with ``edits`` words changed or left out, as many as ``compare`` lets pass, keeps
        all pairs but two for each of them.
        """
        size, how = len(self.vocabulary) + 1, self.how
        held: dict[int, list[int]] = {}
        self.need, self.distinct = [], []
        for i, item in enumerate(self.items):
            n, share = len(item), min(how.verbatim, how.paraphrase)
            short = n < how.contiguous
            edits = 0 if short else n - min(c for c in range(n + 1) if c / n >= share)
            pairs = item[:-1] * size + item[1:] if n > 1 else item + size * size
            pairs = set(pairs.tolist())
            for pair in pairs:
                held.setdefault(pair, []).append(i)
            self.need.append(max(1, n - 1 - 2 * edits))
            self.distinct.append(max(1, len(pairs) - 2 * edits))
        self.need = np.array(self.need, np.int64)
        self.distinct = np.array(self.distinct, np.int64)
        self.sizes = np.array([len(i) for i in self.items], np.int64)
        self.pair = np.array(sorted(held), np.int64)
        owners = [held[p] for p in self.pair.tolist()]
        self.owners = np.array([len(o) for o in owners], np.int64)
        self.owner_begin = np.cumsum(self.owners) - self.owners
        self.owner = np.array([i for o in owners for i in o], np.int64)
        self.single = bool(len(self.pair)) and int(self.pair[-1]) >= size * size

    def members(self, space: int) -> list[tuple[int, int]]:
        """The passages of a space as items and numbers."""
        dims, stride = self.how.dims, self.how.stride
        return [
            (i, k)
            for i, item in enumerate(self.items)
            for k in range(-(-len(item) // stride))
            if (self.first[item.tobytes()] + k) // dims == space
        ]

    def run(self, item: int, number: int) -> np.ndarray:
        stride = self.how.stride
        return self.items[item][number * stride : (number + 2) * stride]

    def own_words(self, space: int, idf: np.ndarray) -> np.ndarray:
        """The weighty words of the passages of a space."""
        runs = [self.run(*m) for m in self.members(space)]
        words = np.unique(np.concatenate(runs))
        return words[idf[words] > 0]

    def certain(self, item: int) -> int:
        """Weighty words that the best passage of a text holds, wherever a copy begins."""
        stride, weighty = self.how.stride, self.weighty[self.items[item]]
        sums = np.append(0, np.cumsum(weighty))
        best = []
        for shift in range(stride):
            begins = np.arange(-shift, len(weighty), stride)
            ends = np.minimum(begins + 2 * stride, len(weighty))
            best.append((sums[ends] - sums[np.maximum(begins, 0)]).max())
        return int(min(best))

    def place(self, idf: np.ndarray, spaces: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Fix the latent spaces, each given by its words and their rows of its basis."""
        self.idf = np.append(idf, 0.0)
        self.weighty = self.idf > 0
        self.spaces = []
        for number, (words, basis) in enumerate(spaces):
            place = np.full(len(self.idf), -1)
            place[words] = np.arange(len(words))
            rows = (idf[words, None] * basis).astype(np.float32)
            members = [m for m in self.members(number) if self.weighty[self.run(*m)].any()]
            if not members:
                continue
            sums = []
            for member in members:
                run = place[self.run(*member)]
                sums.append(rows[run[run >= 0]].sum(0))
            owner = np.array([i for i, _ in members])
            least = min([self.how.together, *map(self.certain, np.unique(owner).tolist())])
            passages = np.ascontiguousarray(unit(np.array(sums)).T)
            self.spaces.append(Space(place, rows, passages, owner, max(1, least)))

    def find(self, texts: list[np.ndarray]) -> list[list[tuple[int, float, float, str]]]:
        """For each text the items it holds: ``(item, cosine, overlap, kind)``."""
        found: list[dict[int, tuple]] = [{} for _ in texts]
        self.find_near(texts, found)
        self.find_copies(texts, found)
        return [list(f.values()) for f in found]

    def region(self, text: np.ndarray, begin: int, item: int) -> list[int]:
        size = len(self.items[item])
        return text[max(0, begin - size) : begin + 2 * self.how.stride + size].tolist()

    def find_near(self, texts: list[np.ndarray], found: list[dict[int, tuple]]) -> None:
        """Add the items of which a passage comes close to one of a text in a latent space."""
        passages = Passages(texts, self.how.stride, self.weighty)
        norms = np.sqrt(np.maximum(passages.total(self.idf[passages.words] ** 2), 1e-9))
        held = passages.total()
        tried: set[tuple[int, int, int]] = set()
        for space in self.spaces:
            row = space.place[passages.words]
            own = np.flatnonzero(row >= 0)
            # what lies in the words of a space bounds the cosine with any of its passages
            inside = passages.total(self.idf[passages.words[own]] ** 2, own)
            reach = np.sqrt(inside) >= (self.how.cosine - 1e-3) * norms
            chosen = np.flatnonzero((held >= space.least) & reach)
            for begin in range(0, len(chosen), 4096):
                part = chosen[begin : begin + 4096]
                lo, hi = np.searchsorted(passages.at[own], [part[0], part[-1] + 2])
                rows = passages.rows(row[own[lo:hi]], passages.at[own[lo:hi]], space.rows, part)
                cosines = (rows / norms[part, None].astype(np.float32)) @ space.passages
                for at, column in zip(*np.nonzero(cosines >= self.how.cosine), strict=True):
                    text, number = int(passages.text[part[at]]), int(passages.number[part[at]])
                    item = int(space.passage_item[column])
                    if item in found[text] or (text, item, number) in tried:
                        continue
                    tried.add((text, item, number))
                    hit = self.compare(item, self.region(texts[text], number * self.how.stride, item))
                    if hit:
                        cosine = float(min(1.0, cosines[at, column]))
                        found[text][item] = (self.ids[item], cosine, *hit)

    def find_copies(self, texts: list[np.ndarray], found: list[dict[int, tuple]]) -> None:
        """Add the items of which a text holds as many pairs of words as any copy keeps.

        This depends on no weights, neighbours or alignment: of a copy with words changed or left
        out ``compare`` sees each one that it would accept.
        """
        size = len(self.vocabulary) + 1
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        words = np.full(int(begins[-1]) + 1, size - 1)  # another word behind each text
        for text, begin in zip(texts, begins.tolist(), strict=False):
            words[begin : begin + len(text)] = text
        inside = words < size - 1
        places = np.flatnonzero(inside[:-1] & inside[1:])
        keys = words[places] * size + words[places + 1]
        if self.single:
            alone = np.flatnonzero(inside)
            places = np.append(places, alone)
            keys = np.append(keys, words[alone] + size * size)
        at = np.searchsorted(self.pair, keys)
        at[at == len(self.pair)] = 0
        hit = self.pair[at] == keys
        places, at = places[hit], at[hit]
        if self.single:
            order = np.argsort(places, kind="stable")
            places, at = places[order], at[order]
        # texts in turn, so that a bounded number of pairs is held
        text = np.searchsorted(begins, places, "right") - 1
        total = np.cumsum(self.owners[at])
        start = 0
        while start < len(places):
            room = (total[start - 1] if start else 0) + SLICE_PAIRS
            last = text[min(np.searchsorted(total, room, "right"), len(places) - 1)]
            end = np.searchsorted(text, last, "left") if total[-1] > room else len(places)
            end = end if end > start else np.searchsorted(text, last, "right")
            self.find_pairs(texts, begins, places[start:end], at[start:end], found)
            start = end

    def find_pairs(self, texts, begins, places, at, found) -> None:
        counts = self.owners[at]
        each = np.repeat(np.arange(len(at)), counts)
        within = np.arange(len(each)) - np.repeat(np.cumsum(counts) - counts, counts)
        item = self.owner[self.owner_begin[at][each] + within]
        order = np.argsort(item, kind="stable")
        item, each = item[order], each[order]
        place = places[each]
        enough = np.arange(len(item)) + self.need[item] - 1
        ok = enough < len(item)
        enough[~ok] = 0
        text = np.searchsorted(begins, place, "right") - 1
        ok &= (item[enough] == item) & (text[enough] == text)
        ok &= place[enough] - place <= self.sizes[item]
        # a text with fewer distinct pairs of an item than a copy keeps holds none, wherever
        owner = item * len(texts) + text
        held = np.unique(owner * len(self.pair) + at[each]) // len(self.pair)
        owners, kinds_held = np.unique(held, return_counts=True)
        ok &= kinds_held[np.searchsorted(owners, owner)] >= self.distinct[item]
        kind = at[each]
        ends = np.searchsorted(item, np.arange(len(self.items)), "right")
        seen: dict[tuple[int, int], int] = {}
        for k in np.flatnonzero(ok).tolist():
            i, t, p = int(item[k]), int(text[k]), int(place[k])
            # the region of a place holds all copies that begin up to two strides behind it
            if i in found[t] or seen.get((t, i), -1) >= p:
                continue
            end = np.searchsorted(place[k : ends[i]], p + self.sizes[i], "right") + k
            if len(np.unique(kind[k:end])) < self.distinct[i]:
                continue
            seen[t, i] = p + 2 * self.how.stride
            begin = p - int(begins[t])
            hit = self.compare(i, self.region(texts[t], begin, i))
            if hit:
                found[t][i] = (self.ids[i], self.likeness(i, texts[t], begin), *hit)

    def likeness(self, item: int, text: np.ndarray, begin: int) -> float:
        """The best cosine of the passages of an item with those of a text near a place."""
        stride, size = self.how.stride, len(self.items[item])

        def vectors(runs: list[np.ndarray]) -> np.ndarray:
            return unit(np.array([np.bincount(r, minlength=len(self.idf)) * self.idf for r in runs]))

        numbers = range(max(0, (begin - size) // stride), (begin + size) // stride + 1)
        mine = [self.run(item, k) for k in range(-(-size // stride))]
        theirs = [text[k * stride : (k + 2) * stride] for k in numbers]
        return float(min(1.0, (vectors(mine) @ vectors(theirs).T).max()))

    def compare(self, item: int, region: list[int]) -> tuple[float, str] | None:
        """Overlap and kind if the region holds the item word for word, nearly, or in other words."""
        words = self.items[item]
        size = len(words)
        if size < self.how.contiguous:
            run = words.tolist()
            whole = any(region[i : i + size] == run for i in range(len(region) - size + 1))
            return (1.0, "verbatim") if whole else None
        common = common_subsequence(self.masks[item], size, region)
        overlap = common / size
        if overlap >= self.how.verbatim:
            return overlap, "verbatim"
        if overlap < self.how.paraphrase or not self.answers[item]:
            return None
        length = len(self.answers[item])
        there = common_subsequence(self.answer_masks[item], length, region) / length
        return (overlap, "paraphrase") if there >= self.how.answer else None


def _document_frequencies(frame: DataFrame, block: Benchmark) -> tuple[np.ndarray, int]:
    """How many documents hold each word of the vocabulary, and how many there are, over all rows."""
    shared = frame.sparkSession.sparkContext.broadcast(block.words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(shared.value)
        counts = np.zeros(places.other + 1, np.int64)
        rows = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                rows += 1
                held = set(map(places.__getitem__, set((text or "").split())))
                held.difference_update((-1, places.other))
                counts[np.fromiter(held, np.int64, len(held))] += 1
        counts[-1] = rows
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"word": at, "n": counts[at]})

    found = (
        frame.select("text").mapInArrow(count, "word bigint, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n")).collect()
    )
    counts = np.zeros(len(block.vocabulary) + 1, np.int64)
    for row in found:
        counts[row["word"]] = row["n"]
    return counts[:-1], int(counts[-1])


def latent_bases(
    items: DataFrame, block: Benchmark, idf: np.ndarray
) -> list[tuple[np.ndarray, np.ndarray]]:
    """The words of each space of a block and right singular vectors of its TF-IDF passages.

    A distributed randomised SVD: the tasks multiply their passages with a test matrix and with
    the transpose; what comes back has a row for each word of a space, whatever the number of
    passages. Two such rounds (one power iteration) are followed by a small eigenproblem. A space
    has no more passages than dimensions, so the vectors span every passage.
    """
    own = [block.own_words(s, idf) for s in range(block.count)]
    context = items.sparkSession.sparkContext

    def gram(tests: list[np.ndarray]) -> list[np.ndarray]:
        shared = context.broadcast((block.vocabulary, idf, own, tests, block.first, block.how))

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary, weights, own, tests, first, how = shared.value
            hashes, totals = WordHashes(), [np.zeros(t.shape) for t in tests]
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    words = np.searchsorted(vocabulary, hashes.of(text or ""))
                    begin = first.get(words.tobytes(), 0)
                    for number in range(-(-len(words) // how.stride)):
                        run = words[number * how.stride : (number + 2) * how.stride]
                        run = run[weights[run] > 0]
                        space = (begin + number) // how.dims
                        at = np.searchsorted(own[space], run)
                        weight = weights[run, None]
                        row = (weight * tests[space][at]).sum(0)
                        np.add.at(totals[space], at, weight * row)
            found = [
                (space, word, row.tobytes())
                for space, total in enumerate(totals)
                for word, row in enumerate(total)
                if row.any()
            ]
            names = ("space", "word", "row")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f[k] for f in found], kind)
                    for k, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))
                ],
                names,
            )

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                rows = batch.to_pydict()
                for *key, row in zip(rows["space"], rows["word"], rows["row"], strict=True):
                    sums[tuple(key)] = sums.get(tuple(key), 0.0) + np.frombuffer(row)
            yield pa.RecordBatch.from_pydict(
                {
                    "space": pa.array([s for s, _ in sums], pa.int64()),
                    "word": pa.array([w for _, w in sums], pa.int64()),
                    "row": pa.array([r.tobytes() for r in sums.values()], pa.binary()),
                }
            )

        schema = "space bigint, word bigint, row binary"
        parts = items.select("text").mapInArrow(multiply, schema)
        # a row for each word of a space: bounded by the block's characters
        sums = parts.repartition("space", "word").mapInArrow(add, schema).toArrow().to_pydict()
        out = [np.zeros(t.shape) for t in tests]
        for space, word, row in zip(sums["space"], sums["word"], sums["row"], strict=True):
            out[space][word] = np.frombuffer(row)
        return out

    rng = np.random.default_rng(block.how.seed)
    width = block.how.dims + block.how.oversample
    tests = [rng.normal(size=(len(w), min(width, len(w)))) for w in own]
    bases = [np.linalg.qr(g)[0] for g in gram(tests)]
    bases = [np.linalg.qr(g)[0] for g in gram(bases)]
    out = []
    for words, basis, image in zip(own, bases, gram(bases), strict=True):
        values, vectors = np.linalg.eigh(basis.T @ image)
        best = np.argsort(-values)[: block.how.dims]
        out.append((words, basis @ vectors[:, best]))
    return out


def _blocks(frame: DataFrame, benchmark: DataFrame, how: Retrieval) -> Iterator[Benchmark]:
    """The benchmark in blocks of a bounded size, each with its latent spaces."""
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.where("item_id is not null and text is not null").select(
        "item_id", "text", answer.alias("answer")
    )
    passages = F.ceil(F.size(F.split("text", r"\s+")) / how.stride)
    size = items.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("text")).alias("chars"),
        F.sum(passages).alias("passages"),
    ).first()
    parts = max(
        -(-size["n"] // BLOCK_ITEMS),
        -(-(size["chars"] or 0) // BLOCK_CHARS),
        -(-(size["passages"] or 0) // (BLOCK_SPACES * how.dims)),
    )
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, parts)))
    for part in range(parts):
        mine = items.where(number == part)
        rows = mine.distinct().orderBy("item_id", "text").collect()
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        block = Benchmark(*map(list, columns), how)
        if not block.ids:
            continue
        counts, documents = _document_frequencies(frame, block)
        idf = block.weights(counts, documents)
        block.place(idf, latent_bases(mine, block, idf))
        yield block


def _search(batch: pa.RecordBatch, column: int, places: Places, block: Benchmark) -> list:
    texts = batch.column(column).to_pylist()
    return block.find([places.of(t or "") for t in texts])


def leaks(
    frame: DataFrame, benchmark: DataFrame, how: Retrieval | None = None
) -> DataFrame:
    """Rows of ``(doc_id, item_id, cosine, overlap, kind)``: items that documents hold.

    Passages of every whole text are compared with those of the items in latent spaces; a
    candidate is an item whose passage comes close, or of which as many pairs of neighbouring
    words occur together as a copy with words changed or left out must keep. It counts as ``verbatim`` if enough of its
    words occur in order near the passage, as ``paraphrase`` if fewer do but its answer's as
    well. Without an ``answer`` column the last fourth of an item stands for its answer. Items of
    very few words must occur in one piece. Word frequencies cover all documents.

    Null and empty texts and items hold and are nothing; an empty table gives no rows. A repeated
    document gives its rows each time; an item counts once for a row. Other columns are left
    behind.
    """
    how = how or Retrieval()
    schema = "doc_id bigint, item_id bigint, cosine double, overlap double, kind string"
    out = frame.sparkSession.createDataFrame([], schema)
    docs = frame.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    for block in _blocks(docs, benchmark, how):
        shared = frame.sparkSession.sparkContext.broadcast(block)

        def make(shared=shared):
            places = Places(shared.value.words)

            def work(batch: pa.RecordBatch) -> dict:
                rows = [
                    (doc, *hit)
                    for doc, hits in zip(
                        batch.column(0).to_pylist(),
                        _search(batch, 1, places, shared.value),
                        strict=True,
                    )
                    for hit in hits
                ]
                names = ("doc_id", "item_id", "cosine", "overlap", "kind")
                return dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)) if rows else {
                    n: [] for n in names
                }

            return work

        out = out.union(map_texts(docs, "text", make, schema))
    return out


def keep_clean(frame: DataFrame, benchmark: DataFrame, how: Retrieval | None = None) -> DataFrame:
    """The rows, with all their columns, that hold no item of the benchmark."""
    how = how or Retrieval()
    at = frame.columns.index("text")
    left = frame
    for block in _blocks(frame, benchmark, how):
        shared = frame.sparkSession.sparkContext.broadcast(block)

        def make(shared=shared):
            places = Places(shared.value.words)

            def work(batch: pa.RecordBatch) -> pa.RecordBatch:
                clean = [not hits for hits in _search(batch, at, places, shared.value)]
                return batch.filter(pa.array(clean, pa.bool_()))

            return work

        left = map_texts(left, "text", make, frame.schema)
    return left
