"""Queries of routing, adapters, transforms, offset stores and small sinks, over the given tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidegauge import operators as op
from tidegauge.functions import to_millis
from tidegauge.plans import tables as t
from tidegauge.plans.flow import build_flow, commit_ranges, next_ranges
from tidegauge.plans.registry import EVENT_FILTER, START, _typed_events, registered
from tidegauge.plans.spec import FlowSpec, InputSpec, OffsetSpec
from tidegauge.schema import LOG_METADATA
from tidegauge.session import shared_dir
from tidegauge.sources import land_pages, read_pages, register_normalizer


def _journal_pages(events: DataFrame, stream_key: str) -> DataFrame:
    """Pages of a provider that the library does not know: a line of JSON per record."""
    line = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        "event_type", "value", F.struct(F.col("user_id").alias("id")).alias("user"),
        F.from_json("props", "k bigint").alias("props"),
    ))
    body = F.array_join(F.collect_list(line), "\n")
    page = F.floor(F.col("event_id") / t.PAGE_ROWS).cast("int").alias("page_no")
    return events.groupBy(page).agg(body.alias("body")).withColumns({
        "stream_key": F.lit(stream_key), "provider": F.lit("journal"), "kind": F.lit("logs"),
    })


def _journal_entries(pages: DataFrame, spec: InputSpec, plan: DataFrame | None) -> DataFrame:
    """An adapter: journal pages to log entries. A line that is no record is rejected."""
    lines = pages.select("stream_key", F.explode(F.split("body", "\n")).alias("content"))
    record = F.from_json("content", "id string, ms bigint")
    return lines.withColumn("r", record).select(
        "stream_key", F.col("r.id").alias("log_id"), "content", F.lit(True).alias("is_json"),
        F.lit(None).cast(LOG_METADATA).alias("metadata"),
        F.timestamp_millis("r.ms").alias("event_ts"),
        F.when(F.col("r.id").isNull() | F.col("r.ms").isNull(), "bad_line").alias("reject_reason"),
    )


def _of_even_users(events: DataFrame) -> DataFrame:
    """A step of the user's own: rejected rows and events of other users go."""
    return events.where(F.col("organization_id").cast("bigint") % 2 == 0)


@registered("""
SELECT CASE event_id % 3 WHEN 0 THEN 'app_logs' WHEN 1 THEN 'dd_logs' ELSE 'journal' END AS stream_key,
       CAST(event_id AS VARCHAR) AS idempotency_key, CAST(user_id AS VARCHAR) AS organization_id,
       epoch_us(ts) // 1000 AS event_ms
FROM events
WHERE user_id % 2 = 0 AND NOT (event_id % 3 = 1 AND event_type = 'error')
""")
def routed_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed table of three providers' pages, each routed to its normaliser, one of them an
    adapter of the user's, with a transform of the user's behind all. Errors of the second
    provider come without attributes and are rejected."""
    folder = shared_dir(spark, "routed")
    events = t.table(spark, sf_dir, "events")

    def third(rest: int) -> DataFrame:
        return events.where(F.col("event_id") % 3 == rest)

    land_pages(t.cloudwatch_log_pages(third(0), "app_logs"), folder)
    land_pages(t.datadog_log_pages(third(1), "dd_logs"), folder)
    land_pages(_journal_pages(third(2), "journal"), folder)
    register_normalizer("journal", "logs", _journal_entries)
    inputs = [
        InputSpec(key, provider, "logs", START, filters=EVENT_FILTER)
        for key, provider in (("app_logs", "cloudwatch"), ("dd_logs", "datadog"), ("journal", "journal"))
    ]
    flow = build_flow(spark, FlowSpec(inputs), read_pages(spark, folder), [_of_even_users])
    return flow.events.select(
        "stream_key", "idempotency_key", "organization_id",
        to_millis(F.col("event_ts")).alias("event_ms"),
    )


_STORES = ("table", "keyed_table", "delivered")
_START_FROM, _NOW = 991_353_600_000, 1_009_843_200_000  # June 2001 and the end of the year


@registered(f"""
WITH o AS (SELECT n_nationkey, n_name, epoch_us(o_orderdate) // 1000 AS ms, o_orderpriority
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
     seen AS (SELECT n_nationkey, max(ms) AS ms FROM o
              WHERE n_nationkey % 3 = 2 OR o_orderpriority = '1-URGENT' GROUP BY n_nationkey)
SELECT n_name AS stream_key,
       CAST(CASE WHEN n_nationkey < 5 THEN {_START_FROM} ELSE greatest(coalesce(ms, 0), {_START_FROM}) END AS BIGINT)
         AS start_ms,
       CAST({_NOW} AS BIGINT) AS end_ms,
       CASE WHEN n_nationkey % 3 = 0 THEN n_name WHEN n_nationkey % 3 = 1 THEN n_name || ':at' END AS stored_key,
       CAST(CASE WHEN n_nationkey % 3 < 2 THEN {_NOW} END AS BIGINT) AS stored_ms
FROM nation LEFT JOIN seen USING (n_nationkey)
""")
def offset_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A round of inputs that keep their offsets in a table, in the table under a suffix, or in
    what they delivered, five of them starting anew: what each fetches, and what is stored then.
    Nations stand for inputs and their customers' orders for events."""
    nations = t.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    spec = FlowSpec([
        InputSpec(
            n.n_name, "cloudwatch", "logs",
            OffsetSpec(_START_FROM, _STORES[n.n_nationkey % 3], n.n_nationkey < 5, "at"),
            filters=EVENT_FILTER,
        )
        for n in nations.orderBy("n_nationkey").collect()  # the inputs, which are configuration
    ])
    customers = t.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = t.table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    events = orders.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("stream_key"), F.col("o_custkey").cast("string").alias("organization_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_ts"), "n_nationkey", "o_orderpriority",
    )
    store = op.OffsetTable(spark, shared_dir(spark, "stores"))
    urgent = events.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("n_nationkey") % 3 < 2))
    keyed = F.when(F.col("n_nationkey") % 3 == 1, F.concat("stream_key", F.lit(":at")))
    store.commit(
        urgent.withColumn("stream_key", F.coalesce(keyed, "stream_key"))
        .groupBy("stream_key")
        .agg(to_millis(F.max("event_ts")).alias("offset_ms"), F.max("event_ts").alias("updated_at"))
    )
    ranges = next_ranges(spark, spec, _NOW, store, events)
    planned = ranges.groupBy("stream_key").agg(
        F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms")
    )
    commit_ranges(spark, spec, ranges, store)
    stored = store.current().select(
        F.split("stream_key", ":")[0].alias("of"), F.col("stream_key").alias("stored_key"),
        F.col("offset_ms").alias("stored_ms"),
    )
    return planned.join(stored, F.col("of") == F.col("stream_key"), "left").drop("of")


def _check_line(line: str) -> None:
    if "idempotency_key" not in json.loads(line):
        raise ValueError("not a payload")


@registered("""
SELECT sink, CAST(count(*) AS BIGINT) AS n, max(epoch_us(ts) // 1000) AS latest_ms
FROM events, (VALUES ('console'), ('noop')) AS s(sink) GROUP BY sink
""")
def small_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that the console sink hands to its writer, a payload a line, and those that reach
    the sink which drops them, by their counters."""
    events = _typed_events(spark, sf_dir).withColumn("reject_reason", F.lit(None).cast("string"))

    def counted(name: str, deliver) -> Column:
        seen = Observation(name)
        latest = to_millis(F.max("event_ts")).alias("latest_ms")
        deliver(events.observe(seen, F.count(F.lit(1)).alias("n"), latest))
        return F.struct(
            F.lit(name).alias("sink"), F.lit(seen.get["n"]).cast("bigint").alias("n"),
            F.lit(seen.get["latest_ms"]).cast("bigint").alias("latest_ms"),
        )

    rows = [
        counted("console", lambda rows: op.deliver(rows, "console", write=_check_line)),
        counted("noop", lambda rows: op.deliver(rows, "noop")),
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))
