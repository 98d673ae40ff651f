"""From raw documents to token ids: the stages of a training-data pipeline.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read
again as the next stage's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import bpe, decontaminate, jaccard_join, language, quality
from tidegauge.llm.arrow import table
from tidegauge.llm.queries import PATTERN, RANKS, fold
from tidegauge.session import shared_dir

#: How many times likelier than by chance the language of an identified document is at least.
TIMES_CHANCE = 1.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those of no identifiable language.

    Null and empty texts go; repeated rows stay; no rows, or none that is labelled, give no rows.
    """
    model = language.train(docs, fold("doc_id", 3) != 1)
    least = TIMES_CHANCE / max(2, len(model.languages))
    return language.keep_identified(docs, model, least)


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of low quality; learns from the labels of the documents that are left.

    Repeated rows share their fate; no labels leave the model's score without any to decide.
    """
    labels = table(spark, sf_dir, "labels")
    return quality.keep_good(docs, quality.train(docs, labels, fold("doc_id", 5) != 0))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each near-duplicate class."""
    return jaccard_join.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers), their number, and a check of decoding."""
    coded = bpe.encode_texts(docs, bpe.read_ranks(spark, RANKS), PATTERN)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", identify_language),
    ("quality", judge_quality),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("token_ids", encode),
]

#: The stages learn models and run a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
