"""Language identification by a byte convolutional network over fixed-length windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.llm.arrow import map_texts
from tidegauge.llm.byte_cnn import WindowClassifier

UNKNOWN = "und"
#: Distinct texts of a language that training takes at most, and the characters of each.
SAMPLE_PER_LANGUAGE = 600
SAMPLE_CHARS = 1024
#: Texts that training takes of all languages together, unless that left one with too few.
SAMPLE_ROWS, LEAST_PER_LANGUAGE = 60_000, 20
#: How often a text of a language with few texts counts at most.
MOST_TIMES = 32
EPOCHS = 3
_LETTER = regex.compile(r"\p{L}")


class LanguageModel:
    """A trained network and the names of its classes; none if there was nothing to learn."""

    def __init__(self, languages: list[str], network: WindowClassifier | None):
        self.languages, self.network = languages, network

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language of each text and its probability."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        rows = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        if rows and self.network is not None:
            p = self.network.predict([texts[i].encode("utf-8", "replace") for i in rows])
            for i, best, score in zip(rows, p.argmax(1).tolist(), p.max(1).tolist(), strict=True):
                names[i], scores[i] = self.languages[best], min(1.0, score)
        return names, scores


def train(frame: DataFrame, rows: Column | None = None) -> LanguageModel:
    """Learn every language of the labelled rows of ``(doc_id, text, lang)`` from a bounded sample.

    ``rows`` says which rows may be learned from. Of each language the ``SAMPLE_PER_LANGUAGE``
    distinct texts of smallest hash are taken, fewer each beyond ``SAMPLE_ROWS`` in all but never
    under ``LEAST_PER_LANGUAGE``, and of each text a stretch of ``SAMPLE_CHARS`` characters. The
    hashes cover all rows; copies count once, however many. No labelled rows give a model without
    languages; other columns are not looked at.
    """
    usable = frame.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if rows is not None:
        usable = usable.where(rows)
    n_languages = usable.select("lang").distinct().count()
    if not n_languages:
        return LanguageModel([], None)
    most = max(LEAST_PER_LANGUAGE, min(SAMPLE_PER_LANGUAGE, SAMPLE_ROWS // n_languages))
    key = F.xxhash64("text")
    by_key = Window.partitionBy("lang").orderBy("key")  # cut in each task before it is shuffled
    bars = (
        usable.select("lang", key.alias("key")).distinct()
        .withColumn("place", F.row_number().over(by_key)).where(F.col("place") <= most)
        .groupBy("lang").agg(F.max("key").alias("bar"))
        .collect()
    )
    largest = frame.sparkSession.createDataFrame(
        [(r["lang"], r["bar"]) for r in bars], "lang string, bar bigint"
    )
    room = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0))
    begin = (1 + F.pmod(F.xxhash64("text", F.lit(1)), room + 1)).cast("int")
    sample = (
        usable.select("lang", "text")
        .join(F.broadcast(largest), "lang")  # a row per language, from the driver
        .where(key <= F.col("bar"))
        .select("lang", key.alias("key"), F.substring("text", begin, SAMPLE_CHARS).alias("part"))
        .groupBy("lang", "key").agg(F.min("part").alias("part"))
        .collect()
    )
    sample.sort(key=lambda r: (r["key"], r["lang"]))
    languages = sorted({r["lang"] for r in sample})
    number_of = {name: i for i, name in enumerate(languages)}
    numbers = np.array([number_of[r["lang"]] for r in sample])
    # languages of few texts weigh as much as others: their texts count several times
    counts = np.bincount(numbers)
    times = np.clip(counts.max() // counts, 1, MOST_TIMES)[numbers]
    sample = [r for r, n in zip(sample, times.tolist(), strict=True) for _ in range(n)]
    numbers = np.repeat(numbers, times)
    network = WindowClassifier(len(languages))
    return LanguageModel(
        languages, network.fit([r["part"].encode("utf-8", "replace") for r in sample], numbers, EPOCHS)
    )


def identify(frame: DataFrame, model: LanguageModel, id_column: str = "doc_id") -> DataFrame:
    """Rows of ``(id, lang_pred, score)``, one for each row, from windows over the whole text.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if the
    model learned nothing. Repeated rows and ids each give their row; other columns are left
    behind, whatever their names. Text shorter than a window is padded.
    """
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            names, scores = shared.value.predict(batch.column(1).to_pylist())
            return {id_column: batch.column(0), "lang_pred": names, "score": scores}

        return work

    kind = frame.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, lang_pred string, score double"
    return map_texts(frame.select(id_column, "text"), "text", make, schema)


def keep_identified(frame: DataFrame, model: LanguageModel, least: float) -> DataFrame:
    """The rows, with all their columns, whose language is known with the least score."""
    shared = frame.sparkSession.sparkContext.broadcast(model)
    at = frame.columns.index("text")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            names, scores = shared.value.predict(batch.column(at).to_pylist())
            known = [n != UNKNOWN and s >= least for n, s in zip(names, scores, strict=True)]
            return batch.filter(pa.array(known, pa.bool_()))

        return work

    return map_texts(frame, "text", make, frame.schema)
