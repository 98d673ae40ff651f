"""Offsets and the time ranges to fetch next."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions import resolve_org_filter
from tidegauge.operators.numbering import number_rows
from tidegauge.plans.spec import CATCH_UP_MS, CATCH_UP_WAIT_MS, LAG_BUFFER_MS

#: What offsets and steps stay below, so that no sum of them overflows.
_FAR_MS = 1 << 61


def plan_ranges(
    offsets: DataFrame,
    now_ms: int | Column,
    step_ms: int | Column,
    max_ms: int = CATCH_UP_MS,
    overlap_ms: int = 0,
) -> DataFrame:
    """Half-open ranges that tile ``[offset_ms, now)`` per stream: windows of ``max_ms``
    while the lag exceeds it, then steps of ``step_ms``, the last cut at now.

    ``overlap_ms`` moves every start back to re-read late records; the event key absorbs
    the repeats.
    """
    now = now_ms if isinstance(now_ms, Column) else F.lit(int(now_ms)).cast("bigint")
    step = step_ms if isinstance(step_ms, Column) else F.lit(int(step_ms)).cast("bigint")
    rows = offsets.select(
        "stream_key",
        F.col("offset_ms").alias("_from"),
        now.alias("_now"),
        step.cast("bigint").alias("_step"),
    )
    # a lag of exactly max_ms is stepped, so one window fewer than the rounded-up count
    windows = F.greatest(
        F.lit(0), F.ceil((F.col("_now") - F.col("_from")) / F.lit(float(max_ms))) - 1
    ).cast("bigint")
    rows = rows.withColumn("_windows", windows).withColumn(
        "_mid", F.col("_from") + F.col("_windows") * F.lit(max_ms).cast("bigint")
    )
    none = F.array().cast("array<struct<start:bigint,width:bigint>>")
    coarse = F.when(
        F.col("_windows") > 0,
        F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.col("_windows") - 1),
            lambda i: F.struct(
                (F.col("_from") + i * F.lit(max_ms).cast("bigint")).alias("start"),
                F.lit(max_ms).cast("bigint").alias("width"),
            ),
        ),
    ).otherwise(none)
    fine = F.when(
        F.col("_now") > F.col("_mid"),
        F.transform(
            F.sequence(F.col("_mid"), F.col("_now") - 1, F.col("_step")),
            lambda at: F.struct(at.alias("start"), F.col("_step").alias("width")),
        ),
    ).otherwise(none)
    return rows.select(
        "stream_key", "_now", F.explode(F.concat(coarse, fine)).alias("_range")
    ).select(
        "stream_key",
        (F.col("_range.start") - F.lit(overlap_ms).cast("bigint")).alias("start_ms"),
        F.least(F.col("_range.start") + F.col("_range.width"), F.col("_now")).alias("end_ms"),
    )


def poll_times(inputs: DataFrame, now_ms: int, until_ms: int) -> DataFrame:
    """When each input will be polled, and for which range: ``(stream_key, wake_ms, start_ms,
    end_ms)`` from ``(stream_key, offset_ms, step_ms)``, if fetching took no time.

    All wake at ``now_ms``; a window of an hour is fetched while an input lags by more than that,
    else a step. It waits shortly while it lags by more than a step and a buffer afterwards, else
    a step; with nothing to fetch it waits a step. Polls before ``until_ms`` are listed, so the
    length of that span bounds the rows of an input.

    A small table of inputs gives many polls, so it is dealt to all tasks first. A task makes the
    polls of a batch of inputs round by round and lets go of them.
    """
    key = inputs.schema["stream_key"].dataType
    schema = T.StructType([T.StructField("stream_key", key)])
    for name in ("wake_ms", "start_ms", "end_ms"):
        schema.add(name, T.LongType())
    rounds = max(0, -(-(until_ms - now_ms) // CATCH_UP_WAIT_MS))
    names = schema.names

    def polls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, offsets, steps = batch.columns
            at = offsets.to_numpy(zero_copy_only=False)
            step = pc.fill_null(steps, 0).to_numpy(zero_copy_only=False)
            if max(abs(at.min()), abs(at.max()), abs(step.min()), abs(step.max())) > _FAR_MS:
                raise OverflowError("an offset or step is too far off for a time in milliseconds")
            stepless = steps.is_null().to_numpy(zero_copy_only=False)
            wake = np.full(len(at), now_ms, np.int64)
            for turn in range(rounds):
                head = np.minimum(at + np.where(wake - at > CATCH_UP_MS, CATCH_UP_MS, step), wake)
                if not turn:
                    # without a step an input is polled once, for a window or for all there is
                    head = np.where(stepless & (wake - at <= CATCH_UP_MS), wake, head)
                fetched = (head > at) & (wake < until_ms) & ~(stepless & (turn > 0))
                if fetched.any():
                    columns = [keys, *map(pa.array, (wake, at, head))]
                    yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(fetched))
                short = fetched & (wake - head > step + LAG_BUFFER_MS)
                at = np.where(fetched, head, at)
                wake = wake + np.where(short, CATCH_UP_WAIT_MS, step)

    rows = inputs.where("offset_ms IS NOT NULL").select(
        "stream_key", F.col("offset_ms").cast("bigint"), F.col("step_ms").cast("bigint")
    )
    tasks = int(inputs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks).mapInArrow(polls, schema)


def current_offsets(log: DataFrame) -> DataFrame:
    """Last committed offset per stream from the append-only offset log."""
    latest = F.max_by("offset_ms", F.struct("updated_at", "offset_ms"))
    return log.groupBy("stream_key").agg(
        latest.alias("offset_ms"), F.max("updated_at").alias("updated_at")
    )


def resolve_offsets(inputs: DataFrame, offsets: DataFrame) -> DataFrame:
    """Where each input resumes: the later of its stored offset and ``start_from``, or
    ``start_from`` when ``override`` is set. ``inputs`` is
    ``(stream_key, start_from, override)``; ``offsets`` has one row per stream."""
    stored = offsets.select("stream_key", F.col("offset_ms").alias("_stored"))
    start = F.col("start_from")
    resumed = F.when(F.coalesce(F.col("override"), F.lit(False)), start).otherwise(
        F.greatest(F.coalesce(F.col("_stored"), start), start)
    )
    return inputs.join(stored, "stream_key", "left").select(
        "stream_key", resumed.cast("bigint").alias("offset_ms")
    )


def offset_keys(inputs: DataFrame, slice_rows: int = 100_000) -> DataFrame:
    """Add ``offset_key``: the stream key, with ``_0``, ``_1``, ... in order of ``pos``
    when several inputs share it."""
    numbered = number_rows(
        inputs,
        by=["stream_key"],
        order=["pos"],
        slice_by=F.floor(F.col("pos") / slice_rows),
        number="_no",
        total="_shared",
    )
    suffixed = F.concat(F.col("stream_key"), F.lit("_"), (F.col("_no") - 1).cast("string"))
    return numbered.select(
        *inputs.columns,
        F.when(F.col("_shared") > 1, suffixed).otherwise(F.col("stream_key")).alias("offset_key"),
    )


def duplicate_streams(inputs: DataFrame) -> DataFrame:
    """Stream keys that more than one input uses, with their count."""
    counted = inputs.groupBy("stream_key").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)


def latest_ingested(
    delivered: DataFrame, stream_key: str | None = None, org: str | None = None
) -> DataFrame:
    """Latest event time per stream among delivered events, optionally of one stream and
    one organisation (``hash:v`` looks up the digest of ``v``)."""
    rows = delivered
    if stream_key is not None:
        rows = rows.where(F.col("stream_key") == stream_key)
    if org is not None and org.strip():
        rows = rows.where(F.col("organization_id") == resolve_org_filter(F.lit(org)))
    return rows.groupBy("stream_key").agg(F.max("event_ts").alias("event_ts"))


def offsets_from_delivered(inputs: DataFrame, delivered: DataFrame) -> DataFrame:
    """Offsets derived from delivered events: latest event time in whole milliseconds, or
    ``start_from`` for an input with none; ``override`` skips the lookup.

    An input that names an ``organization_id`` looks at that organisation's events only
    (``hash:v`` at the digest of ``v``), any other at the whole stream's. Inputs with an
    ``offset_key`` are resolved one by one and returned under it as ``stream_key``; otherwise
    ``stream_key`` names one input.
    """
    key = "offset_key" if "offset_key" in inputs.columns else "stream_key"
    if "organization_id" in inputs.columns:
        org = resolve_org_filter(F.col("organization_id"))
    else:
        org = F.lit(None).cast("string")
    asked = inputs.withColumn("_org", org)
    # one small row per stream and organisation; the maxima combine before the shuffle
    latest = delivered.groupBy("stream_key", F.col("organization_id").alias("_org")).agg(
        F.unix_millis(F.max("event_ts")).alias("_at")
    )
    whole = latest.groupBy("stream_key").agg(F.max("_at").alias("offset_ms"))
    of_org = latest.where(F.col("_org").isNotNull()).withColumnRenamed("_at", "offset_ms")
    seen = (
        asked.where(F.col("_org").isNull())
        .join(whole, "stream_key")
        .select(F.col(key).alias("stream_key"), "offset_ms")
        .unionAll(
            asked.join(of_org, ["stream_key", "_org"]).select(
                F.col(key).alias("stream_key"), "offset_ms"
            )
        )
    )
    return resolve_offsets(inputs.withColumn("stream_key", F.col(key)), seen)


def commit_offsets(ranges: DataFrame, delivered_streams: DataFrame | None = None) -> DataFrame:
    """Rows to append to the offset log once ``ranges`` have been delivered: the highest
    range end per stream. ``delivered_streams`` limits them to streams that finished."""
    if delivered_streams is not None:
        ranges = ranges.join(delivered_streams.select("stream_key"), "stream_key", "left_semi")
    return ranges.groupBy("stream_key").agg(
        F.max("end_ms").alias("offset_ms"), F.current_timestamp().alias("updated_at")
    )


class OffsetTable:
    """The offset log at a path. ``suffix`` keys it like a key-value store would,
    ``stream:suffix``."""

    def __init__(self, spark, path: str, suffix: str | None = None):
        self.spark, self.path, self.suffix = spark, path, suffix

    def _stored_key(self) -> Column:
        key = F.col("stream_key")
        return key if self.suffix is None else F.concat(key, F.lit(f":{self.suffix}"))

    def log(self) -> DataFrame:
        from pyspark.errors import AnalysisException

        from tidegauge.schema import OFFSETS, ddl

        try:
            rows = self.spark.read.schema(ddl(OFFSETS)).parquet(self.path)
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return self.spark.createDataFrame([], ddl(OFFSETS))
        if self.suffix is None:
            return rows
        tail = f":{self.suffix}"
        return rows.where(F.col("stream_key").endswith(tail)).withColumn(
            "stream_key", F.expr(f"left(stream_key, length(stream_key) - {len(tail)})")
        )

    def current(self) -> DataFrame:
        return current_offsets(self.log())

    def commit(self, rows: DataFrame) -> None:
        """Append offset rows; an append of one small file either shows up or does not."""
        rows.select(
            self._stored_key().alias("stream_key"),
            F.col("offset_ms").cast("bigint").alias("offset_ms"),
            "updated_at",
        ).repartition(1).write.mode("append").parquet(self.path)

    def seed(self, inputs: DataFrame) -> None:
        """Store the resolved start of inputs that have no offset yet, lie behind their
        ``start_from``, or override it."""
        known = self.current().select("stream_key", F.col("offset_ms").alias("_known"))
        fresh = (
            resolve_offsets(inputs, known.withColumnRenamed("_known", "offset_ms"))
            .join(known, "stream_key", "left")
            .where(F.col("_known").isNull() | (F.col("_known") != F.col("offset_ms")))
            .select("stream_key", "offset_ms", F.current_timestamp().alias("updated_at"))
        )
        self.commit(fresh)
