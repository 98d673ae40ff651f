"""Exact histogram of encoded lengths, and what it answers for every context limit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.llm.arrow import cut
from tidegauge.llm.bpe import encode_texts

#: Lengths that share a bucket of the two-step sums.
BUCKET = 1024


def encoded_lengths(
    frame: DataFrame, ranks: bytes, pattern: str, id_column: str = "doc_id"
) -> DataFrame:
    """Rows of ``(id, n_tokens)``: the whole text's number of tokens; 0 for null or empty."""
    packed = encode_texts(frame, ranks, pattern, id_column)
    return packed.select(id_column, (F.length("ids") / 4).cast("bigint").alias("n_tokens"))


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row for each length that occurs, taken as a context limit.

    ``(n_tokens, n_docs, tokens, docs_at_least, docs_longer, tokens_total, truncated_total,
    lost_tokens, quantile)``: documents and tokens of this length, documents at least and more
    than as long, tokens of all documents in full and cut to the limit, tokens lost by the cut, and the
    share of documents that fit. Null lengths take no part; no lengths give no rows.

    Sums run within buckets of lengths and over one row per bucket, so no task holds all lengths.
    """
    histogram = cut(
        lengths.where("n_tokens is not null")
        .groupBy("n_tokens")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .withColumn("bucket", F.floor(F.col("n_tokens") / BUCKET))
        .withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    )
    above = Window.partitionBy(F.lit(0)).orderBy(F.desc("bucket")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy(F.lit(0))
    buckets = (
        histogram.groupBy("bucket")
        .agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
        .select(
            "bucket",
            F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
            F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
            F.sum("d").over(whole).alias("docs_all"),
            F.sum("t").over(whole).alias("tokens_total"),
        )
    )
    suffix = Window.partitionBy("bucket").orderBy(F.desc("n_tokens")).rowsBetween(
        Window.unboundedPreceding, 0
    )
    return (
        histogram.join(buckets, "bucket")
        .withColumn("docs_at_least", F.col("docs_above") + F.sum("n_docs").over(suffix))
        .withColumn("tokens_at_least", F.col("tokens_above") + F.sum("tokens").over(suffix))
        .withColumn(
            "lost_tokens", F.col("tokens_at_least") - F.col("n_tokens") * F.col("docs_at_least")
        )
        .select(
            "n_tokens",
            "n_docs",
            "tokens",
            "docs_at_least",
            (F.col("docs_at_least") - F.col("n_docs")).alias("docs_longer"),
            "tokens_total",
            (F.col("tokens_total") - F.col("lost_tokens")).alias("truncated_total"),
            "lost_tokens",
            (
                (F.col("docs_all") - F.col("docs_at_least") + F.col("n_docs")) / F.col("docs_all")
            ).alias("quantile"),
        )
    )
