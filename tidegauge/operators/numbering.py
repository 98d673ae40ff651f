"""Exact running numbers within a key that no single task has to sort.

A plain ``row_number`` puts all rows of a key into one task. Here each key is cut into
slices of its order column: rows are numbered per (key, slice), and the slice offsets
come from a count per slice, which is one small row each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_rows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    slice_by: Column,
    number: str = "row_no",
    total: str | None = None,
) -> DataFrame:
    """Add ``number``, the 1-based position of a row within ``by`` under ``order``.

    ``slice_by`` must not decrease along ``order``; its slices should fit a task each.
    ``total`` names an optional column with the row count of the key. The input is
    evaluated twice, once for the counts, so it must be deterministic.
    """
    # one struct column: equal as a whole even where a key is null, and both the window and
    # the join partition by it, so the rows are shuffled once
    sliced = df.withColumn("_key", F.struct(*by, slice_by.alias("_slice")))
    counts = sliced.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    whole_key = Window.partitionBy(*[F.col("_key").getField(c) for c in by])
    earlier = whole_key.orderBy(F.col("_key._slice")).rowsBetween(Window.unboundedPreceding, -1)
    slices = counts.select(
        "_key",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole_key).alias("_total"),
    )
    within = F.row_number().over(Window.partitionBy("_key").orderBy(*order)).cast("bigint")
    extra = [F.col("_total").alias(total)] if total else []
    return (
        sliced.withColumn("_within", within)
        .join(slices, "_key")
        .select(*df.columns, (F.col("_before") + F.col("_within")).alias(number), *extra)
    )
