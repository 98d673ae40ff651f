"""Operators on whole event streams: union, de-duplication, rejects, counters."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.schema import CONTENT, REJECT

#: What makes two events the same event.
EVENT_KEY = ("stream_key", "idempotency_key")


def merge_streams(*streams: DataFrame) -> DataFrame:
    """Bag union of event streams."""
    if not streams:
        raise ValueError("nothing to merge")
    return reduce(lambda a, b: a.unionByName(b), streams)


def _drop_local_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep the first event of each key within an Arrow batch."""
    for batch in batches:
        keys = pd.DataFrame({c: batch.column(c).to_pandas() for c in EVENT_KEY})
        yield batch.filter(pa.array(~keys.duplicated().to_numpy()))


def dedupe_events(
    events: DataFrame | Sequence[DataFrame], watermark: str | None = None, combine: bool = False
) -> DataFrame:
    """One event per stream and idempotency key.

    In batch the smallest row of the copies is kept, so a rerun keeps the same one; copies
    collapse within each task before the shuffle, so a much repeated event is no hot spot.
    A stream needs a ``watermark`` delay, which bounds the keys held in state. Give several
    streams one by one: each then has its own watermark, and the slowest one counts, so an input
    that catches up beside a live one loses nothing. Streaming de-duplication has no step before
    its shuffle; ``combine`` adds one, in Python, that drops copies batch by batch.
    """
    if not isinstance(events, DataFrame):
        parts = list(events)
        if watermark is not None:
            parts = [p.withWatermark("event_ts", watermark) if p.isStreaming else p for p in parts]
        merged = merge_streams(*parts)
        if not merged.isStreaming:
            return dedupe_events(merged)
        if watermark is None:
            raise ValueError("de-duplicating a stream needs a watermark delay")
        return merged.dropDuplicatesWithinWatermark(list(EVENT_KEY))
    if events.isStreaming:
        if watermark is None:
            raise ValueError("de-duplicating a stream needs a watermark delay")
        if combine:
            events = events.mapInArrow(_drop_local_copies, events.schema)
        return events.withWatermark("event_ts", watermark).dropDuplicatesWithinWatermark(
            list(EVENT_KEY)
        )
    rest = [c for c in events.columns if c not in EVENT_KEY]
    ordered = ["event_ts"] + [c for c in rest if c != "event_ts"]
    return (
        events.groupBy(*EVENT_KEY)
        .agg(F.min(F.struct(*ordered)).alias("_row"))
        .select(*[F.col(c) if c in EVENT_KEY else F.col(f"_row.{c}") for c in events.columns])
    )


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and quarantined rows, as two lazy filters of one plan."""
    good = rows.where(F.col(REJECT).isNull()).drop(REJECT, CONTENT)
    return good, quarantine(rows)


def quarantine(rows: DataFrame) -> DataFrame:
    """The rejected rows with their reason."""
    return rows.where(F.col(REJECT).isNotNull())


def run_stats(rows: DataFrame) -> DataFrame:
    """``(stream_key, reject_reason, n)``; accepted rows have a null reason."""
    return rows.groupBy("stream_key", REJECT).agg(F.count(F.lit(1)).alias("n"))


def observed(rows: DataFrame, name: str) -> DataFrame:
    """Attach counters that Spark reports with each batch of a running query."""
    return rows.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        F.count(F.col(REJECT)).alias("rejected"),
        F.max("event_ts").alias("latest_event"),
    )


def reserved_fields(events: DataFrame, reserved: Sequence[str]) -> DataFrame:
    """``(stream_key, k, n)``: extracted fields that delivery leaves out because their name
    is reserved."""
    named = events.select("stream_key", F.explode_outer("entries.k").alias("k"))
    clashing = named.where(F.col("k").isin(*reserved))
    return clashing.groupBy("stream_key", "k").agg(F.count(F.lit(1)).alias("n"))
