"""Document quality by a byte-level convolutional network over overlapping chunks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.arrow import map_texts
from tidegauge.llm.byte_cnn import DocumentScorer

#: Documents of a label that training takes, about.
SAMPLE_PER_LABEL = 1500
#: Longer texts are trained on as so many stretches of so many characters, from begin to end.
STRETCHES, STRETCH_CHARS = 8, 512
EPOCHS = 5
THRESHOLD = 0.3


class QualityModel:
    """A trained network, or the share of good documents if only one label was seen."""

    def __init__(self, network: DocumentScorer | None, share: float):
        self.network, self.share = network, share

    def score(self, texts: list[str | None]) -> list[float]:
        if self.network is None:
            return [self.share] * len(texts)
        return self.network.predict([(t or "").encode("utf-8", "replace") for t in texts]).tolist()


def train(documents: DataFrame, labels: DataFrame, rows: Column | None = None) -> QualityModel:
    """Learn ``quality`` from a bounded sample of the labels and the texts of these documents.

    ``rows`` says which labels may be learned from. A label counts once for a document; labels
    that contradict each other count for none, and null labels neither. About
    ``SAMPLE_PER_LABEL`` documents of each label are taken by a hash of the id; the counts behind
    the shares cover all labels. Without both labels the score is the share of good ones.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    if rows is not None:
        usable = usable.where(rows)
    known = (
        usable.groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .where("low = high")
        .select("labelled", F.col("low").alias("good"))
    )
    counts = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return QualityModel(None, counts.get(1, 0) / total if total else 0.5)
    draw = F.pmod(F.xxhash64("labelled"), F.lit(1_000_000)) / 1_000_000
    share = F.when(F.col("good") == 1, SAMPLE_PER_LABEL / counts[1]).otherwise(
        SAMPLE_PER_LABEL / counts[0]
    )
    most = 4 * SAMPLE_PER_LABEL
    # at most `most` pairs of two numbers, whatever the size of the labels
    picked = F.broadcast(known.where(draw < share).orderBy("labelled").limit(most))
    text = F.coalesce("text", F.lit(""))
    gap = (F.length(text) - STRETCH_CHARS) / (STRETCHES - 1)
    stretches = F.concat(
        *[
            F.substring(text, (1 + F.floor(gap * i)).cast("int"), F.lit(STRETCH_CHARS))
            for i in range(STRETCHES)
        ]
    )
    part = F.when(F.length(text) <= STRETCHES * STRETCH_CHARS, text).otherwise(stretches)
    sample = (
        documents.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("labelled"))
        .groupBy("labelled", "good").agg(F.min(part).alias("part"))
        .orderBy("labelled").limit(most).collect()
    )
    good = np.array([r["good"] for r in sample])
    if len(set(good.tolist())) < 2:
        return QualityModel(None, counts[1] / total)
    texts = [r["part"] for r in sample]
    # short texts are rare, so every third document also counts by its last few words
    ends = [t[-(16 + 29 * i % 145) :] for i, t in enumerate(texts[::3])]
    data = [t.encode("utf-8", "replace") for t in texts + ends]
    good = np.concatenate([good, good[::3]])
    return QualityModel(DocumentScorer().fit(data, good, EPOCHS), counts[1] / total)


def score(frame: DataFrame, model: QualityModel, id_column: str = "doc_id") -> DataFrame:
    """Rows of ``(id, score, predicted)``, one for each row, from chunks over the whole text.

    Null and empty texts count as one empty chunk and get a score too. Repeated rows and ids each
    give their row; other columns are left behind, whatever their names.
    """
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            scores = shared.value.score(batch.column(1).to_pylist())
            return {
                id_column: batch.column(0),
                "score": scores,
                "predicted": [int(s >= THRESHOLD) for s in scores],
            }

        return work

    kind = frame.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, score double, predicted int"
    return map_texts(frame.select(id_column, "text"), "text", make, schema)


def keep_good(frame: DataFrame, model: QualityModel) -> DataFrame:
    """The rows, with all their columns, that are predicted to be good."""
    shared = frame.sparkSession.sparkContext.broadcast(model)
    at = frame.columns.index("text")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = shared.value.score(batch.column(at).to_pylist())
            return batch.filter(pa.array([s >= THRESHOLD for s in scores], pa.bool_()))

        return work

    return map_texts(frame, "text", make, frame.schema)
