"""Delivery of events: tables, requests, console, nowhere."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.delivered import Delivered
from tidegauge.operators.payload import BATCH_SIZE, to_payload
from tidegauge.schema import CONTENT, EVENT, REJECT, ddl

# Fixed value: attempts per request before the task fails.
ATTEMPTS = 5
SENT_SCHEMA = "n bigint, attempts int"


def request_sender(
    post: Callable[[str], None], size: int, attempts: int, backoff_s: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A partition function that posts payloads in requests of ``size`` as they arrive.

    Only one open request is held in memory. A request that keeps failing fails the task;
    Spark then retries the task, and the receiver drops repeats by idempotency key.
    """

    def send(payloads: list[str]) -> int:
        body = "[" + ", ".join(payloads) + "]"
        for attempt in range(1, attempts + 1):
            try:
                post(body)
                return attempt
            except Exception:
                if attempt == attempts:
                    raise
                time.sleep(backoff_s * 2 ** (attempt - 1))
        raise AssertionError("unreachable")

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_request: list[str] = []

        def sent(payloads: list[str]) -> pa.RecordBatch:
            tries = send(payloads)
            return pa.RecordBatch.from_arrays(
                [pa.array([len(payloads)], pa.int64()), pa.array([tries], pa.int32())],
                ["n", "attempts"],
            )

        for batch in batches:
            for payload in batch.column(0).to_pylist():
                open_request.append(payload)
                if len(open_request) == size:
                    yield sent(open_request)
                    open_request = []
        if open_request:
            yield sent(open_request)

    return partition


def send_requests(
    events: DataFrame,
    post: Callable[[str], None],
    size: int = BATCH_SIZE,
    attempts: int = ATTEMPTS,
    backoff_s: float = 0.1,
) -> DataFrame:
    """``(n, attempts)`` per request. Each task batches what it holds; nothing is shuffled."""
    payloads = to_payload(events).select("payload")
    return payloads.mapInArrow(request_sender(post, size, attempts, backoff_s), SENT_SCHEMA)


def delivered_table(events: DataFrame) -> DataFrame:
    """Events as stored: with their date, the table's second partition column."""
    return events.withColumn("event_date", F.to_date("event_ts"))


#: Columns of the delivered table; those it is partitioned by come last.
DELIVERED = EVENT | {"ingested_at": "timestamp", "run_id": "string", "event_date": "date"}
#: Columns of the quarantine table.
QUARANTINED = EVENT | {
    CONTENT: "string", "ingested_at": "timestamp", "run_id": "string", REJECT: "string"
}
_RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def write_table(events: DataFrame, path: str, run_id: str) -> None:
    """Write one run's events under ``run_id``, replacing all that an earlier attempt of the
    same run left, and note what it holds in the table's index. The rebalance hint keeps files
    even and splits a hot stream and date."""
    if not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"run_id {run_id!r} can't name a folder")
    index = Delivered(events.sparkSession, path)
    index.open_run(run_id)
    (
        delivered_table(events)
        .hint("rebalance", "stream_key", "event_date")
        .withColumn("ingested_at", F.current_timestamp())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("stream_key", "event_date")
        .parquet(f"{path.rstrip('/')}/run_id={run_id}")
    )
    index.close_run(run_id)


def write_rejects(rejects: DataFrame, path: str, run_id: str) -> None:
    """Write one run's rejected rows with reason and content, replacing an earlier attempt's."""
    if not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"run_id {run_id!r} can't name a folder")
    (
        rejects.hint("rebalance", "stream_key", REJECT)
        .withColumn("ingested_at", F.current_timestamp())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("stream_key", REJECT)
        .parquet(f"{path.rstrip('/')}/run_id={run_id}")
    )


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The quarantined rows of all runs, with their declared types; none if there are none yet."""
    try:
        return spark.read.schema(ddl(QUARANTINED)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl(QUARANTINED))


def read_delivered(spark: SparkSession, path: str) -> DataFrame:
    """The delivered table with its declared types, so that a stream named ``007`` keeps its
    name; no rows if nothing was delivered yet."""
    try:
        return spark.read.schema(ddl(DELIVERED)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl(DELIVERED))


def not_delivered(events: DataFrame, delivered: DataFrame, run_id: str | None = None) -> DataFrame:
    """Events whose key is not in a frame of delivered events; rows of ``run_id`` itself, left by
    an earlier attempt, don't count. Next to a delivered table use ``Delivered.not_delivered``,
    which reads only the dates at hand."""
    known = delivered if run_id is None else delivered.where(F.col("run_id") != run_id)
    key = ["stream_key", "event_date", "idempotency_key"]
    return delivered_table(events).join(known.select(*key), key, "left_anti").select(*events.columns)


def print_events(events: DataFrame, write: Callable[[str], None]) -> DataFrame:
    """``(n, attempts)`` per payload, each written whole by the task that holds it."""
    return send_requests(events, lambda body: write(body[1:-1]), size=1, attempts=1)


def deliver(
    events: DataFrame,
    mode: str,
    path: str | None = None,
    post: Callable[[str], None] | None = None,
    run_id: str = "batch",
    size: int = BATCH_SIZE,
    attempts: int = ATTEMPTS,
    backoff_s: float = 0.1,
    write: Callable[[str], None] = print,
) -> None:
    """Deliver a batch of events: ``table``, ``http``, ``console`` or ``noop``.

    ``console`` writes every payload, uncut, from the task that holds it. For a stream use
    ``streaming.stream_to``.
    """
    if events.isStreaming:
        raise ValueError("use tidegauge.streaming.stream_to for a stream")
    if mode == "table":
        write_table(events, path, run_id)
    elif mode == "http":
        send_requests(events, post, size, attempts, backoff_s).write.format("noop").mode(
            "overwrite"
        ).save()
    elif mode == "console":
        print_events(events, write).write.format("noop").mode("overwrite").save()
    elif mode == "noop":
        to_payload(events).write.format("noop").mode("overwrite").save()
    else:
        raise ValueError(f"unknown delivery mode {mode!r}")
