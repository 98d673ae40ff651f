"""The given tables in the roles of the engine's inputs.

Events become log lines and metric samples, in landed page form where a decoder is
exercised. A page holds a bounded run of event ids, as a provider's page holds a bounded
number of records, so building pages spreads evenly whatever the event mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import ntz_as_utc
from tidegauge.schema import RAW_PAGES

PAGE_ROWS = 500
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, **options: str) -> DataFrame:
    """The same table as a file stream. The bracket makes the path a pattern, which the
    stream reader accepts for a single file as well as for a folder."""
    schema = table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).options(**options)
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")


def event_message(org: Column | None = None) -> Column:
    """An event as the JSON text of a log line."""
    user = F.struct((F.col("user_id") if org is None else org).alias("id"))
    return F.to_json(
        F.struct(
            "event_type",
            "value",
            user.alias("user"),
            F.from_json("props", "k bigint").alias("props"),
        )
    )


def event_logs(events: DataFrame, stream_key: str | Column, org: Column | None = None) -> DataFrame:
    """Events as log entries."""
    key = F.lit(stream_key) if isinstance(stream_key, str) else stream_key
    empty = F.lit(None).cast("string")
    metadata = F.struct(
        F.lit("").alias("log_stream_name"), empty.alias("service"), empty.alias("status"),
        F.lit(None).cast("array<string>").alias("tags"),
    )
    return events.select(
        key.alias("stream_key"),
        F.col("event_id").cast("string").alias("log_id"),
        event_message(org).alias("content"),
        F.lit(True).alias("is_json"),
        metadata.alias("metadata"),
        ntz_as_utc(F.col("ts")).alias("event_ts"),
    )


def event_metrics(events: DataFrame, stream_key: str = "app_metrics") -> DataFrame:
    """Events as metric samples named by type, labelled with ``k``, owned by the user."""
    k = F.from_json("props", "k bigint")["k"].cast("string")
    return _metrics(
        events, stream_key, F.col("event_type"), F.col("value"), F.col("user_id").cast("string"),
        F.create_map(F.lit("k"), k), F.col("ts"),
    )


def user_series(events: DataFrame, stream_key: str = "app_counters") -> DataFrame:
    """Events as one counter per user; readings that drop are counter resets."""
    return _metrics(
        events, stream_key, F.lit("activity"), F.col("value"), F.col("user_id").cast("string"),
        F.create_map().cast("map<string,string>"), F.col("ts"),
    )


def order_metrics(orders: DataFrame, stream_key: str = "orders") -> DataFrame:
    """Orders as metric samples labelled with status, priority and customer."""
    labels = F.create_map(
        F.lit("status"), F.col("o_orderstatus"), F.lit("order-priority"), F.col("o_orderpriority"),
        F.lit("customer"), F.col("o_custkey").cast("string"),
    )
    return _metrics(
        orders, stream_key, F.lit("order.total"), F.col("o_totalprice"),
        F.col("o_custkey").cast("string"), labels, F.col("o_orderdate"), F.lit("customer"),
    )


def lineitem_metrics(lineitem: DataFrame, stream_key: str = "shipments") -> DataFrame:
    """Line items as metric samples labelled with supplier and return flag."""
    labels = F.create_map(
        F.lit("supplier"), F.col("l_suppkey").cast("string"), F.lit("flag"), F.col("l_returnflag")
    )
    return _metrics(
        lineitem, stream_key, F.lit("quantity"), F.col("l_quantity"),
        F.col("l_suppkey").cast("string"), labels, F.col("l_shipdate"),
    )


def _metrics(
    rows: DataFrame, stream_key: str, name: Column, value: Column, org: Column, labels: Column,
    at: Column, identifier: Column | None = None,
) -> DataFrame:
    return rows.select(
        F.lit(stream_key).alias("stream_key"),
        name.alias("metric_name"),
        value.alias("value"),
        org.alias("organization_id"),
        (F.lit(None) if identifier is None else identifier).cast("string").alias(
            "organization_identifier"
        ),
        labels.alias("labels"),
        ntz_as_utc(at).alias("event_ts"),
    )


# --- landed pages ---------------------------------------------------------------------


def _paged(
    events: DataFrame, stream_key: str, provider: str, kind: str, item: Column, body,
    query_index: Column | None = None,
) -> DataFrame:
    """Pages of ``PAGE_ROWS`` event ids. ``body`` maps the time-ordered items to the page."""
    grouped = events.groupBy(F.floor(F.col("event_id") / PAGE_ROWS).alias("page")).agg(
        F.sort_array(F.collect_list(item)).alias("items"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
    values = {
        "stream_key": F.lit(stream_key),
        "provider": F.lit(provider),
        "kind": F.lit(kind),
        "query_index": F.lit(None) if query_index is None else query_index,
        "start_ms": F.unix_millis(ntz_as_utc(F.col("first_ts"))),
        "end_ms": F.unix_millis(ntz_as_utc(F.col("last_ts"))) + 1,
        "page_no": F.col("page"),
        "body": F.to_json(body(F.col("items"))),
    }
    return grouped.select(*[values[c].cast(t).alias(c) for c, t in RAW_PAGES.items()])


def _ms() -> Column:
    return F.unix_millis(ntz_as_utc(F.col("ts")))


def cloudwatch_log_pages(
    events: DataFrame, stream_key: str, org: Column | None = None
) -> DataFrame:
    item = F.struct(
        F.col("event_id").cast("string").alias("eventId"),
        _ms().alias("timestamp"),
        event_message(org).alias("message"),
        F.concat(F.lit("stream-"), "event_type").alias("logStreamName"),
    )
    return _paged(
        events, stream_key, "cloudwatch", "logs", item, lambda items: F.struct(items.alias("events"))
    )


def datadog_log_pages(events: DataFrame, stream_key: str) -> DataFrame:
    """Errors come without attributes, as some provider records do."""
    inner = F.struct(
        F.struct("event_type", "value", F.struct(F.col("user_id").alias("id")).alias("user")).alias(
            "attributes"
        ),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.col("event_type").alias("service"),
        F.lit("info").alias("status"),
        F.array("event_type").alias("tags"),
    )
    item = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.when(F.col("event_type") != "error", inner).alias("attributes"),
    )
    return _paged(
        events, stream_key, "datadog", "logs", item, lambda items: F.struct(items.alias("data"))
    )


def _sample() -> Column:
    """A sample of a series; small views read zero."""
    idle = (F.col("event_type") == "view") & (F.col("value") < 1)
    return F.struct(
        _ms().alias("ms"),
        F.col("event_id").alias("id"),
        F.col("event_type").alias("type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at"),
        F.when(idle, F.lit(0.0)).otherwise(F.col("value")).alias("value"),
    )


def datadog_metric_pages(
    events: DataFrame, stream_key: str, types: Sequence[str] = EVENT_TYPES
) -> DataFrame:
    """Timeseries pages: shared times, one series per type, null where a time is not its own."""

    def body(items: Column) -> Column:
        def own(kind: str) -> Column:
            return F.transform(items, lambda x: F.when(x["type"] == kind, x["value"]))

        values = F.array(*[own(kind) for kind in types])
        series = F.array(*[F.struct(F.lit(i).alias("query_index")) for i in range(len(types))])
        attributes = F.struct(
            series.alias("series"),
            F.transform(items, lambda x: x["ms"]).alias("times"),
            values.alias("values"),
        )
        return F.struct(F.struct(attributes.alias("attributes")).alias("data"))

    return _paged(events, stream_key, "datadog", "metrics", _sample(), body)


def cloudwatch_metric_pages(
    events: DataFrame, stream_key: str, metric_name: str, types: Sequence[str] = EVENT_TYPES
) -> DataFrame:
    """Metric data results: parallel arrays of times and values per query id."""

    def body(items: Column) -> Column:
        def result(i: int, kind: str) -> Column:
            own = F.filter(items, lambda x: x["type"] == kind)
            return F.struct(
                F.lit(f"{metric_name.lower()}_query_{i}").alias("Id"),
                F.transform(own, lambda x: x["at"]).alias("Timestamps"),
                F.transform(own, lambda x: x["value"]).alias("Values"),
            )

        results = [result(i, kind) for i, kind in enumerate(types)]
        return F.struct(F.array(*results).alias("MetricDataResults"))

    return _paged(events, stream_key, "cloudwatch", "metrics", _sample(), body)


def prometheus_pages(events: DataFrame, stream_key: str) -> DataFrame:
    """Matrix pages with one series per event. Signups lack the customer label, and views
    carry it empty."""
    customer = F.when(F.col("event_type") == "view", F.lit("")).otherwise(
        F.col("user_id").cast("string")
    )
    labels = F.create_map(F.lit("__name__"), F.lit("activity"), F.lit("type"), F.col("event_type"))
    metric = F.when(F.col("event_type") == "signup", labels).otherwise(
        F.map_concat(labels, F.create_map(F.lit("customer"), customer))
    )
    sample = F.array(
        (_ms() / F.lit(1000)).cast("decimal(20,3)").cast("string"), F.col("value").cast("string")
    )
    item = F.struct(
        F.col("event_id").alias("_id"),
        F.to_json(F.struct(metric.alias("metric"), F.array(sample).alias("values"))).alias("text"),
    )

    def body(items: Column) -> Column:
        joined = F.array_join(F.transform(items, lambda x: x["text"]), ",")
        return F.struct(joined.alias("result"))

    pages = _paged(events, stream_key, "prometheus", "metrics", item, body)
    # the series texts are objects already; put them into the page unquoted
    result = F.from_json("body", "result string")["result"]
    text = F.concat(
        F.lit('{"status":"success","data":{"resultType":"matrix","result":['), result, F.lit("]}}")
    )
    return pages.withColumn("body", text)
