"""Structured Streaming around the same operators."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidegauge.files import Files
from tidegauge.operators.deliver import ATTEMPTS, print_events, send_requests, write_table
from tidegauge.operators.payload import BATCH_SECONDS, BATCH_SIZE, to_payload
from tidegauge.plans.spec import CATCH_UP_WAIT_MS, STEP_MS
from tidegauge.streaming.grids import live_grid as live_grid
from tidegauge.streaming.grids import live_rates as live_rates


def poll_trigger(kind: str | None = None) -> dict[str, str]:
    """Trigger of a stream that polls a provider: often enough for an input that catches up, the
    source itself letting each input wait for its time; or the length of one range of a kind."""
    seconds = CATCH_UP_WAIT_MS // 1000 if kind is None else STEP_MS[kind] // 1000
    return {"processingTime": f"{seconds} seconds"}


def stream_run(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """The run id of a stream's batch: by the id that the query has from its checkpoint, so a new
    checkpoint, at the same path too, never writes over the runs of an old one."""
    metadata = Files(spark).read(f"{checkpoint.rstrip('/')}/metadata")
    return f"stream-{json.loads(metadata)['id']}-{batch_id:010d}"


def stream_to(
    events: DataFrame,
    mode: str,
    checkpoint: str,
    path: str | None = None,
    post: Callable[[str], None] | None = None,
    available_now: bool = False,
    size: int = BATCH_SIZE,
    attempts: int = ATTEMPTS,
    backoff_s: float = 0.1,
    trigger_seconds: int = BATCH_SECONDS,
    write: Callable[[str], None] = print,
) -> DataStreamWriter:
    """A writer that delivers an event stream: ``table``, ``http``, ``console`` or ``noop``.

    Offsets advance in the checkpoint only after a batch is delivered. The table sink
    writes each batch as a run of its own, in the layout of a batch delivery, and a replayed
    batch over its earlier attempt; a replayed http batch carries the same idempotency keys.
    """
    if mode == "table":

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            write_table(batch, path, stream_run(batch.sparkSession, checkpoint, batch_id))

        writer = events.writeStream.foreachBatch(write_batch)
    elif mode == "http":

        def post_batch(batch: DataFrame, batch_id: int) -> None:
            sent = send_requests(batch, post, size, attempts, backoff_s)
            sent.write.format("noop").mode("overwrite").save()

        writer = events.writeStream.foreachBatch(post_batch)
    elif mode == "console":

        def print_batch(batch: DataFrame, batch_id: int) -> None:
            print_events(batch, write).write.format("noop").mode("overwrite").save()

        writer = events.writeStream.foreachBatch(print_batch)
    elif mode == "noop":
        writer = to_payload(events).writeStream.format("noop")
    else:
        raise ValueError(f"unknown delivery mode {mode!r}")
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{trigger_seconds} seconds")


def run_available(writer: DataStreamWriter, timeout_s: int | None = None) -> StreamingQuery:
    """Process everything that is available and return when done.

    A pull source that plans a limited number of ranges per trigger ends such a run early, so
    runs follow until it has reached the moment it planned from.
    """
    while True:
        query = writer.start()
        if timeout_s is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout_s):
            query.stop()
            raise TimeoutError(f"stream still running after {timeout_s} s")
        if not _lags(query):
            return query


def _lags(query: StreamingQuery) -> bool:
    progress = query.lastProgress
    # by the progress as JSON: its Python form shows an offset as Python's text of it
    for source in json.loads(progress.json)["sources"] if progress else []:
        offset = source["endOffset"]
        if isinstance(offset, dict) and "heads" in offset:
            if any(head < offset["now"] for head in offset["heads"].values()):
                return True
    return False
