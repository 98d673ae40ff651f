"""Queries of flows that pull, stream, resume and reject, over the given tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge import operators as op
from tidegauge.functions import to_millis
from tidegauge.plans import tables as t
from tidegauge.plans.flow import Flow, build_flow
from tidegauge.plans.registry import (
    _DELTA, _GRID, _GRID_END, _GRID_START, EVENT_FILTER, START, registered,
)
from tidegauge.plans.spec import FlowSpec, InputSpec, OutputSpec
from tidegauge.session import shared_dir
from tidegauge.sources import PulledPages, land_pages, read_pages, register_paged_pull
from tidegauge.streaming import live_grid, live_rates, run_available


def _log_input(stream_key: str) -> InputSpec:
    return InputSpec(stream_key, "cloudwatch", "logs", START, filters=EVENT_FILTER)


def _flow_over(spark: SparkSession, folder: str, base: str, streaming: bool, **output: str) -> Flow:
    spec = FlowSpec([_log_input("app_logs")], OutputSpec("table", path=f"{base}/events", **output))
    return build_flow(spark, spec, read_pages(spark, folder, streaming=streaming))


def _keyed(events: DataFrame) -> DataFrame:
    return events.select(
        "stream_key", "idempotency_key", "organization_id",
        to_millis(F.col("event_ts")).alias("event_ms"),
    )


_EACH_EVENT = """
SELECT {stream} AS stream_key, CAST(event_id AS VARCHAR) AS idempotency_key,
       CAST(user_id AS VARCHAR) AS organization_id, epoch_us(ts) // 1000 AS event_ms
FROM events
"""


def _pulled_flow(
    spark: SparkSession, sf_dir: str, purpose: str, streaming: bool = False, **options: str
) -> tuple[Flow, str]:
    """A flow of two inputs that pull the events table by time ranges, and its base folder."""
    path = f"{sf_dir}/events.parquet"

    def record(r: dict) -> dict:
        return {
            "eventId": str(r["event_id"]),
            "timestamp": int(r["ts"].replace(tzinfo=UTC).timestamp() * 1000),
            "message": json.dumps({
                "event_type": r["event_type"], "value": r["value"],
                "user": {"id": r["user_id"]}, "props": json.loads(r["props"]),
            }),
        }

    def fetch(input_key: str, start_ms: int, end_ms: int):
        import pyarrow.dataset as ds

        since, until = (datetime.fromtimestamp(m / 1000, UTC).replace(tzinfo=None) for m in (start_ms, end_ms))
        within = (ds.field("ts") >= since) & (ds.field("ts") < until)
        page = []
        for fragment in ds.dataset(path).get_fragments(within):
            # one row group after another: a scan of the whole table reads many ahead
            for group in fragment.split_by_row_group(within):
                for rows in group.to_batches(filter=within, batch_size=16_384, batch_readahead=1, use_threads=False):
                    for r in rows.to_pylist():
                        if (r["event_id"] % 2 == 0) == (input_key == "even"):
                            page.append(record(r))
                        if len(page) == t.PAGE_ROWS:
                            yield None, json.dumps({"events": page})
                            page = []
        if page:
            yield None, json.dumps({"events": page})

    first, last = (
        t.table(spark, sf_dir, "events")
        .select(*[F.unix_millis(f("ts").cast("timestamp")) for f in (F.min, F.max)])
        .first()
    )
    register_paged_pull(spark, fetch, "events_by_time")
    inputs = [
        {"stream_key": k, "provider": "cloudwatch", "kind": "logs", "start_from": first}
        for k in ("even", "odd")
    ]
    options = {"inputs": json.dumps(inputs), "now_ms": str(last + 1), "ranges_per_task": "64"} | options
    base = shared_dir(spark, purpose)
    flow = build_flow(
        spark,
        FlowSpec([_log_input("even"), _log_input("odd")], OutputSpec("table", path=f"{base}/events")),
        PulledPages(spark, options, "events_by_time", streaming),
    )
    return flow, base


_EVEN_AND_ODD = _EACH_EVENT.format(stream="CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END")


@registered(_EVEN_AND_ODD)
def pulled_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inputs that pull the events table by time ranges, each fetching its own, delivered to
    a table."""
    flow, base = _pulled_flow(spark, sf_dir, "pulled")
    flow.deliver("run-1")
    return _keyed(op.read_delivered(spark, f"{base}/events"))


@registered(_EVEN_AND_ODD)
def limited_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream that plans at most 600 ranges a batch, run until it has caught up."""
    flow, base = _pulled_flow(spark, sf_dir, "limited", streaming=True, max_ranges_per_trigger="600")
    run_available(flow.stream(f"{base}/checkpoint", available_now=True))
    return _keyed(op.read_delivered(spark, f"{base}/events"))


@registered(_EACH_EVENT.format(stream="'app_logs'"))
def delivered_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch over half of the pages, then streams from two checkpoints over all of them, into
    one table that stores each event once."""
    base = shared_dir(spark, "mixed")
    pages = t.cloudwatch_log_pages(t.table(spark, sf_dir, "events"), "app_logs")
    land_pages(pages.where("page_no % 2 = 0"), f"{base}/pages")
    _flow_over(spark, f"{base}/pages", base, streaming=False).deliver("run-1")
    land_pages(pages.where("page_no % 2 = 1"), f"{base}/pages")
    for checkpoint in ("first", "second"):
        flow = _flow_over(spark, f"{base}/pages", base, streaming=True)
        run_available(flow.stream(f"{base}/{checkpoint}", available_now=True))
    return _keyed(op.read_delivered(spark, f"{base}/events"))


_SIGNUP_TEXT = """'{"event_type":"signup","value":' || CAST(value AS VARCHAR)
       || ',"user":{},"props":' || replace(props, ' ', '') || '}'"""


@registered(f"""
SELECT 'app_logs' AS stream_key, CAST(event_id AS VARCHAR) AS idempotency_key,
       'missing_org' AS reject_reason, sha256({_SIGNUP_TEXT}) AS content_sha256
FROM events WHERE event_type = 'signup'
""")
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records of a stream, kept with reason and whole content; signups lack an
    organisation."""
    base = shared_dir(spark, "rejects")
    org = F.when(F.col("event_type") != "signup", F.col("user_id").cast("string"))
    land_pages(
        t.cloudwatch_log_pages(t.table(spark, sf_dir, "events"), "app_logs", org), f"{base}/pages"
    )
    flow = _flow_over(spark, f"{base}/pages", base, streaming=True, quarantine=f"{base}/bad")
    run_available(flow.stream(f"{base}/checkpoint", available_now=True))
    return op.read_rejects(spark, f"{base}/bad").select(
        "stream_key", "idempotency_key", "reject_reason", F.sha2("content", 256).alias("content_sha256")
    )


def _late_stream(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a stream whose first batch has the even events and whose second the odd."""
    base = shared_dir(spark, "late")
    events = t.table(spark, sf_dir, "events")
    org = F.when(F.col("event_type") != "signup", F.col("user_id").cast("string"))
    for rest in (0, 1):
        half = events.where(F.col("event_id") % 2 == rest)
        land_pages(t.cloudwatch_log_pages(half, "app_logs", org), f"{base}/pages")
        flow = _flow_over(spark, f"{base}/pages", base, streaming=True, quarantine=f"{base}/bad")
        run_available(flow.stream(f"{base}/checkpoint", available_now=True, lateness="10 days"))
    return base


_LATE_ROWS = """
WITH e AS (SELECT *, epoch_us(ts) // 1000 AS ms FROM events),
     bar AS (SELECT max(ms) - 864000000 AS bar FROM e WHERE event_id % 2 = 0 AND event_type <> 'signup'),
     judged AS (
       SELECT event_id, CASE WHEN event_type = 'signup' THEN 'missing_org'
                             WHEN event_id % 2 = 1 AND ms < bar THEN 'late' ELSE 'delivered' END AS outcome
       FROM e, bar)
"""


@registered(_LATE_ROWS + """
SELECT 'app_logs' AS stream_key, CAST(event_id AS VARCHAR) AS idempotency_key, outcome FROM judged
""")
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event of a stream under what became of it: stored, rejected, or kept as late."""
    base = _late_stream(spark, sf_dir)
    key = ["stream_key", "idempotency_key"]
    stored = op.read_delivered(spark, f"{base}/events").select(*key, F.lit("delivered").alias("outcome"))
    kept = op.read_rejects(spark, f"{base}/bad").select(*key, F.col("reject_reason").alias("outcome"))
    return stored.unionAll(kept)


@registered(_LATE_ROWS + """
SELECT 'app_logs' AS stream_key, outcome, CAST(count(*) AS BIGINT) AS n FROM judged GROUP BY outcome
""")
def live_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that a live flow kept of every outcome."""
    counts = op.Delivered(spark, f"{_late_stream(spark, sf_dir)}/events").counts()
    return counts.groupBy("stream_key", "outcome").agg(F.sum("n").alias("n"))


@registered("""
SELECT CAST(user_id AS VARCHAR) AS organization_id, max(epoch_us(ts) // 1000) AS event_ms
FROM events GROUP BY user_id
""")
def delivered_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per organisation from the summaries that two overlapping runs kept."""
    base = shared_dir(spark, "maxima")
    pages = t.cloudwatch_log_pages(t.table(spark, sf_dir, "events"), "app_logs")
    for run, where in (("run-1", "page_no % 3 < 2"), ("run-2", "page_no % 3 > 0")):
        land_pages(pages.where(where), f"{base}/{run}")
        _flow_over(spark, f"{base}/{run}", base, streaming=False).deliver(run)
    maxima = op.Delivered(spark, f"{base}/events").maxima()
    return maxima.groupBy("organization_id").agg(to_millis(F.max("event_ts")).alias("event_ms"))


@registered("""
SELECT CAST(o_custkey AS VARCHAR) AS stream_key, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS offset_ms
FROM orders GROUP BY o_custkey
""")
def offset_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last offset per input after a commit per order priority; customers stand for inputs and
    order keys for offsets."""
    store = op.OffsetStore(spark, shared_dir(spark, "offsets"))
    orders = t.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("stream_key"),
        F.col("o_orderkey").alias("offset_ms"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        "o_orderpriority",
    )
    for (priority,) in sorted(orders.select("o_orderpriority").distinct().collect()):
        store.commit(op.current_offsets(orders.where(F.col("o_orderpriority") == priority)))
    return store.current().select("stream_key", "offset_ms")


_POLL_NOW = 1_704_067_200_000


@registered(f"""
WITH RECURSIVE polls(stream_key, step, pos, wake, head) AS (
  SELECT CAST(c_custkey AS VARCHAR), step, pos, wake,
         least(pos + CASE WHEN wake - pos > 3600000 THEN 3600000 ELSE step END, wake)
  FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 60000 ELSE 24000 END AS step,
               {_POLL_NOW} - c_custkey * 977000 AS pos, {_POLL_NOW} AS wake FROM customer)
  UNION ALL
  SELECT stream_key, step, pos, wake,
         least(pos + CASE WHEN wake - pos > 3600000 THEN 3600000 ELSE step END, wake)
  FROM (SELECT stream_key, step, greatest(head, pos) AS pos,
               wake + CASE WHEN head > pos AND wake - head > step + 60000 THEN 2000 ELSE step END AS wake
        FROM polls)
  WHERE wake < {_POLL_NOW + 90_000})
SELECT stream_key, wake AS wake_ms, pos AS start_ms, head AS end_ms FROM polls WHERE head > pos
""")
def poll_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When inputs that lag by up to months poll for which ranges; customers stand for inputs,
    those in debt for metrics."""
    inputs = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("stream_key"),
        (F.lit(_POLL_NOW) - F.col("c_custkey") * 977_000).alias("offset_ms"),
        F.when(F.col("c_acctbal") < 0, 60_000).otherwise(24_000).alias("step_ms"),
    )
    return op.poll_times(inputs, _POLL_NOW, _POLL_NOW + 90_000)


_LATENESS_MS = 3_600_000
# the watermark of the last batch, in whole milliseconds
_PASSED = f"""
  passed AS (SELECT (max(epoch_us(ts)) - 1) // 1000 - {_LATENESS_MS} AS bar FROM events)
"""


def _over_two_runs(
    spark: SparkSession, sf_dir: str, build: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """What a stream of the events as counters gives on the grid, stopped after half of the month
    and started again from its checkpoint."""
    base = shared_dir(spark, "live_series")
    events = t.table(spark, sf_dir, "events")
    half = F.timestamp_millis(F.lit((_GRID_START + _GRID_END) // 2))
    for part in (F.col("ts") < half, F.col("ts") >= half):
        samples = t.user_series(events.where(part))
        samples.write.mode("append").parquet(f"{base}/samples")
        stream = spark.readStream.schema(samples.schema).parquet(f"{base}/samples")
        writer = build(stream).writeStream.format("parquet").option("path", f"{base}/grid")
        writer = writer.option("checkpointLocation", f"{base}/checkpoint").outputMode("append")
        run_available(writer.trigger(availableNow=True))
    grid = spark.read.parquet(f"{base}/grid").select(
        "organization_id", to_millis(F.col("event_ts")).alias("event_ms"), "value"
    )
    return grid.where(F.col("event_ms").between(_GRID_START, _GRID_END))


@registered(f"""
WITH {_DELTA}, {_GRID}, {_PASSED}
SELECT CAST(g.user_id AS VARCHAR) AS organization_id, epoch_us(g.moment) // 1000 AS event_ms,
       round((sum(delta) - arg_min(delta, d.ts)) / 259200.0, 9) AS value
FROM g JOIN d ON g.user_id = d.user_id AND d.ts <= g.moment AND d.ts > g.moment - INTERVAL 3 DAY
WHERE epoch_us(g.moment) // 1000 <= (SELECT bar FROM passed)
GROUP BY g.user_id, g.moment HAVING count(*) > 1
""")
def stream_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of live counters over three days on a six hour grid, over a restart."""
    rates = _over_two_runs(
        spark, sf_dir,
        lambda s: live_rates(s, 21_600_000, 3 * 86_400_000, f"{_LATENESS_MS} milliseconds", _GRID_START),
    )
    return rates.withColumn("value", F.round("value", 9))


@registered(f"""
WITH {_GRID}, {_PASSED}
SELECT CAST(g.user_id AS VARCHAR) AS organization_id, epoch_us(g.moment) // 1000 AS event_ms, e.value AS value
FROM g ASOF JOIN events e ON g.user_id = e.user_id AND g.moment >= e.ts
WHERE e.ts > g.moment - INTERVAL 24 HOUR AND epoch_us(g.moment) // 1000 <= (SELECT bar FROM passed)
""")
def stream_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live series on a six hour grid with a day of lookback, over a restart."""
    return _over_two_runs(
        spark, sf_dir,
        lambda s: live_grid(s, 21_600_000, f"{_LATENESS_MS} milliseconds", 86_400_000, _GRID_START),
    )
