"""Registered queries over the given tables, each with the SQL that must agree with it."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge import operators as op
from tidegauge import sources
from tidegauge.functions import iso_utc, object_text, sanitize_key, to_millis
from tidegauge.plans import tables as t
from tidegauge.plans.flow import build_flow, query_plan
from tidegauge.plans.spec import (
    CloudwatchMetrics,
    DatadogMetrics,
    DatadogTagSet,
    FlowSpec,
    InputSpec,
    LogField,
    LogFilter,
    MetricField,
    MetricFilter,
    OffsetSpec,
    PrometheusQuery,
)
from tidegauge.session import configure, shared_dir
from tidegauge.streaming import run_available, stream_to

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL counterpart."""

    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return wrap


# --- specifications used below --------------------------------------------------------

START = OffsetSpec(start_from=0)

EVENT_FILTER = LogFilter(
    fields=(
        LogField("event_type", path="event_type"),
        LogField("value", path="value", field_type="float"),
        LogField("k", path="props.k", field_type="integer"),
        LogField("organization_id", path="user.id"),
        LogField("user hash", path="user.id", field_type="integer", hash=True),
    )
)

APP_LOGS = InputSpec("app_logs", "cloudwatch", "logs", START, filters=EVENT_FILTER)

DD_METRICS = InputSpec(
    "dd_metrics", "datadog", "metrics", START,
    datadog=DatadogMetrics(
        "app.value", 60, "AVERAGE", "customer",
        tuple(DatadogTagSet(f"org-{n}", f"customer:org-{n},env:prod") for n in t.EVENT_TYPES),
    ),
)

CW_METRICS = InputSpec(
    "cw_metrics", "cloudwatch", "metrics", START,
    cloudwatch=CloudwatchMetrics(
        "App", "Value", 60, "SUM", "customer",
        tuple({"env": "prod", "customer": f"org-{n}"} for n in t.EVENT_TYPES),
    ),
)

PROM_QUERY = PrometheusQuery(
    "activity", "activity_total", organization_identifier="customer", fallback_org_id="nobody",
    step=(30, "s"),
)
PROM_METRICS = InputSpec("prom", "prometheus", "metrics", START, prometheus=(PROM_QUERY,))

PAYLOAD = ["stream_key", "organization_id", "timestamp", "key", "idempotency_key", "values_json"]

# shared SQL pieces
_EVENTS = """
  e AS (SELECT event_id, ts, user_id, event_type, value,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS sec,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS iso,
               epoch_us(ts) // 1000 AS ms
        FROM events)
"""
_LOG_VALUES = """'{"event_type": "' || event_type || '", "k": ' || k || ', "user_hash": "'
       || sha256(CAST(user_id AS VARCHAR)) || '", "value": ' || CAST(value AS VARCHAR) || '}'"""
_METRIC_VALUES = """CASE WHEN event_type < 'k'
       THEN '{"' || event_type || '": ' || CAST(value AS VARCHAR) || ', "k": "' || k || '"}'
       ELSE '{"k": "' || k || '", "' || event_type || '": ' || CAST(value AS VARCHAR) || '}' END"""


def _shown(events: DataFrame) -> DataFrame:
    return op.payload_struct(events).select(*PAYLOAD)


# --- logs -----------------------------------------------------------------------------


@registered(f"""
WITH {_EVENTS}
SELECT 'app_logs' AS stream_key, CAST(user_id AS VARCHAR) AS organization_id, sec AS "timestamp",
       'app_logs' AS "key", CAST(event_id AS VARCHAR) AS idempotency_key,
       {_LOG_VALUES} AS values_json
FROM e
""")
def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed log pages to delivered payloads: decode, extract, hash, check, compose."""
    pages = t.cloudwatch_log_pages(t.table(spark, sf_dir, "events"), "app_logs")
    return _shown(build_flow(spark, FlowSpec([APP_LOGS]), pages).events)


@registered(f"""
WITH {_EVENTS}
SELECT CAST(event_id AS VARCHAR) AS log_id, ms AS event_ms,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS service,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
       CASE WHEN event_type = 'error' THEN 'missing_attributes' END AS reject_reason
FROM (SELECT * REPLACE (CASE WHEN event_type = 'error' THEN NULL ELSE ms END AS ms) FROM e)
""")
def datadog_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log search pages to log entries; records without attributes are quarantined."""
    pages = t.datadog_log_pages(t.table(spark, sf_dir, "events"), "dd_logs")
    logs = sources.normalize_datadog_logs(pages)
    fields = (LogField("event_type", path="event_type"),
              LogField("value", path="value", field_type="float"))
    found = op.extract_json_fields(logs, fields)
    return found.select(
        "log_id", to_millis(F.col("event_ts")).alias("event_ms"),
        F.nullif(F.col("metadata.service"), F.lit("")).alias("service"),
        "fields.event_type", "fields.value", "reject_reason",
    )


@registered("""
SELECT CAST(event_id AS VARCHAR) AS log_id, sha256(CAST(user_id AS VARCHAR)) AS user_hash,
       sha256(CAST(value AS VARCHAR)) AS value_hash, sha256(event_type) AS type_hash
FROM events
""")
def log_hashed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed fields of each type."""
    logs = t.event_logs(t.table(spark, sf_dir, "events"), "app_logs")
    fields = (
        LogField("user_hash", path="user.id", field_type="integer", hash=True),
        LogField("value_hash", path="value", field_type="float", hash=True),
        LogField("type_hash", path="event_type", hash=True),
    )
    return op.extract_json_fields(logs, fields).select("log_id", "fields.*")


@registered("""
SELECT CAST(o_orderkey AS VARCHAR) AS log_id,
       CASE WHEN o_orderstatus <> 'P' THEN epoch_us(CAST(o_orderdate AS TIMESTAMP)) END AS placed_us,
       CASE WHEN o_orderstatus = 'P' THEN 'parse_error' END AS reject_reason
FROM orders
""")
def log_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamp fields by a format; dates in another form are rejected."""
    form = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy HH:mm")
    )
    logs = t.table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("stream_key"), F.col("o_orderkey").cast("string").alias("log_id"),
        F.to_json(F.struct(form.alias("placed"))).alias("content"),
    )
    field = LogField("placed", path="placed", field_type="timestamp", format="%d/%m/%Y %H:%M")
    return op.extract_json_fields(logs, (field,)).select(
        "log_id", F.unix_micros("fields.placed").alias("placed_us"), "reject_reason"
    )


@registered("""
SELECT CAST(event_id AS VARCHAR) AS log_id, epoch_us(ts) // 1000 AS event_ms
FROM events WHERE event_type IN ('purchase', 'error') AND value >= 10
""")
def log_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicate on JSON fields of the content."""
    logs = t.event_logs(t.table(spark, sf_dir, "events"), "app_logs")
    wanted = op.json_equals("event_type", "purchase", "error") & (
        F.get_json_object("content", "$.value").try_cast("double") >= 10
    )
    return op.filter_logs(logs, wanted).select(
        "log_id", to_millis(F.col("event_ts")).alias("event_ms")
    )


@registered("""
SELECT 'app_logs' AS stream_key, CAST(event_id AS VARCHAR) AS idempotency_key,
       CASE event_type WHEN 'signup' THEN NULL WHEN 'view' THEN '' ELSE CAST(user_id AS VARCHAR) END
         AS organization_id,
       CASE WHEN event_type IN ('signup', 'view') THEN 'missing_org' END AS reject_reason
FROM events
""")
def log_missing_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs whose organisation is absent (signups) or empty (views) are rejected."""
    org = F.when(F.col("event_type") == "view", F.lit("")).when(
        F.col("event_type") != "signup", F.col("user_id").cast("string")
    )
    fields = (LogField("organization_id", path="user.id"), LogField("event_type", path="event_type"))
    logs = t.event_logs(t.table(spark, sf_dir, "events"), "app_logs", org)
    return op.extract_log_events(logs, LogFilter(fields)).select(
        "stream_key", "idempotency_key", "organization_id", "reject_reason"
    )


@registered("""
SELECT 'app_logs' AS stream_key,
       CASE WHEN event_type = 'signup' THEN 'missing_org' END AS reject_reason,
       CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY 1, 2
UNION ALL
SELECT 'documents', 'parse_error', CAST(count(*) AS BIGINT) FROM documents
""")
def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per stream and reason, over log lines and over texts that are not JSON."""
    return op.run_stats(_rows_with_rejects(spark, sf_dir))


def _rows_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    org = F.when(F.col("event_type") != "signup", F.col("user_id").cast("string"))
    logs = t.event_logs(t.table(spark, sf_dir, "events"), "app_logs", org)
    texts = t.table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("stream_key"),
        F.col("doc_id").cast("string").alias("log_id"),
        F.col("text").alias("content"),
        F.lit(None).cast("timestamp").alias("event_ts"),
    )
    return op.merge_streams(
        op.extract_log_events(logs, EVENT_FILTER), op.extract_log_events(texts, EVENT_FILTER)
    )


@registered(r"""
SELECT CAST(page_id AS VARCHAR) AS log_id,
       regexp_extract(url, '^https?://([^/:?#]+)', 1) AS organization_id,
       nullif(regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1), '') AS lang,
       TRY_CAST(nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS BIGINT) AS number,
       nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS page
FROM pages
""")
def text_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of raw text lines by pattern."""
    logs = t.table(spark, sf_dir, "pages").select(
        F.lit("web").alias("stream_key"),
        F.col("page_id").cast("string").alias("log_id"),
        F.col("url").alias("content"),
    )
    fields = (
        LogField("organization_id", value=r"^https?://([^/:?#]+)"),
        LogField("lang", value=r"^https?://[^/]+/([a-z]{2})/"),
        LogField("number", value=r"/([0-9]+)", field_type="integer"),
        LogField("page", value=r"[?&]page=([0-9]+)"),
    )
    return op.extract_text_fields(logs, fields).select("log_id", "fields.*")


@registered(r"""
SELECT CAST(page_id AS VARCHAR) AS log_id,
       nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title,
       nullif(regexp_extract(html, '<h1[^>]*>([^<]*)<', 1), '') AS heading,
       nullif(regexp_extract(html, 'href="([^"]*)"', 1), '') AS first_link
FROM pages
""")
def markup_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of whole raw pages by pattern."""
    logs = t.table(spark, sf_dir, "pages").select(
        F.lit("web").alias("stream_key"),
        F.col("page_id").cast("string").alias("log_id"),
        F.col("html").alias("content"),
    )
    fields = (
        LogField("title", value=r"<title>([^<]*)</title>"),
        LogField("heading", value=r"<h1[^>]*>([^<]*)<"),
        LogField("first_link", value=r'href="([^"]*)"'),
    )
    return op.extract_text_fields(logs, fields).select("log_id", "fields.*")


@registered(r"""
SELECT 'url' AS kind, page_id AS id, regexp_replace(url, '[^\p{L}\p{N}_/]', '_', 'g') AS name
FROM pages
UNION ALL
SELECT 'source', doc_id, regexp_replace(source, '[^\p{L}\p{N}_/]', '_', 'g') FROM documents
UNION ALL
SELECT 'turn', conv_id * 1000 + turn, sha256(regexp_replace(text, '[^\p{L}\p{N}_/]', '_', 'g'))
FROM conversations
""")
def sanitized_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key sanitising of addresses, source names and whole multilingual texts."""
    urls = t.table(spark, sf_dir, "pages").select(
        F.lit("url").alias("kind"), F.col("page_id").alias("id"), sanitize_key(F.col("url")).alias("name")
    )
    names = t.table(spark, sf_dir, "documents").select(
        F.lit("source").alias("kind"), F.col("doc_id").alias("id"),
        sanitize_key(F.col("source")).alias("name"),
    )
    texts = t.table(spark, sf_dir, "conversations").select(
        F.lit("turn").alias("kind"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.sha2(sanitize_key(F.col("text")), 256).alias("name"),
    )
    return urls.unionAll(names).unionAll(texts)


# --- metrics --------------------------------------------------------------------------

_SAMPLE_VALUE = "CASE WHEN event_type = 'view' AND value < 1 THEN 0.0 ELSE value END"


def _metric_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "stream_key", "metric_name", "organization_id",
        F.unix_micros("event_ts").alias("event_us"), "value", "reject_reason",
    )


@registered(f"""
SELECT 'dd_metrics' AS stream_key, 'app.value' AS metric_name, 'org-' || event_type AS organization_id,
       epoch_us(ts) // 1000 * 1000 AS event_us, value, CAST(NULL AS VARCHAR) AS reject_reason
FROM (SELECT ts, event_type, {_SAMPLE_VALUE} AS value FROM events) WHERE value <> 0
""")
def datadog_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timeseries pages to samples; null and zero points are dropped."""
    pages = t.datadog_metric_pages(t.table(spark, sf_dir, "events"), "dd_metrics")
    return _metric_rows(sources.normalize_datadog_metrics(pages, query_plan(spark, DD_METRICS)))


@registered(f"""
SELECT 'cw_metrics' AS stream_key, 'Value' AS metric_name, 'org-' || event_type AS organization_id,
       epoch_us(ts) AS event_us, {_SAMPLE_VALUE} AS value, CAST(NULL AS VARCHAR) AS reject_reason
FROM events
""")
def cloudwatch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric data results to samples, with the organisation looked up by query id."""
    pages = t.cloudwatch_metric_pages(t.table(spark, sf_dir, "events"), "cw_metrics", "Value")
    return _metric_rows(sources.normalize_cloudwatch_metrics(pages, query_plan(spark, CW_METRICS)))


@registered("""
SELECT 'prom' AS stream_key, 'activity_total' AS metric_name,
       CASE event_type WHEN 'signup' THEN 'nobody' WHEN 'view' THEN '' ELSE CAST(user_id AS VARCHAR) END
         AS organization_id,
       CASE WHEN event_type = 'view' THEN NULL ELSE epoch_us(ts) // 1000 * 1000 END AS event_us,
       CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value,
       CASE WHEN event_type = 'view' THEN 'missing_org' END AS reject_reason,
       '__name__,type' AS label_names
FROM events
""")
def prometheus_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrix pages to samples. An absent organisation label falls back, an empty one does
    not, and the label itself leaves the label set."""
    pages = t.prometheus_pages(t.table(spark, sf_dir, "events"), "prom")
    rows = sources.normalize_prometheus_metrics(pages, PROM_QUERY)
    names = F.array_join(F.array_sort(F.map_keys("labels")), ",")
    return rows.select(
        "stream_key", "metric_name", "organization_id", F.unix_micros("event_ts").alias("event_us"),
        "value", "reject_reason", names.alias("label_names"),
    )


@registered("""
SELECT 'customers' AS stream_key, 'Balance' AS metric_name, q.i AS query_index,
       'balance_query_' || q.i AS query_id, c_name AS organization_id,
       CASE q.i WHEN 0 THEN 'Sum:CRM/Balance{name=' || c_name || ',segment=' || c_mktsegment || '} by 60s'
                ELSE 'Sum:CRM/Balance{nation=' || c_nationkey || ',name=' || c_name || '} by 60s' END
         AS query_text,
       0 AS chunk_no
FROM customer, (VALUES (0), (1)) q(i)
""")
def metric_query_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query expansion: one query per dimension set, named after the metric and its place."""

    def dim(name: str, value) -> F.Column:
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))

    c = t.table(spark, sf_dir, "customer")
    name, segment, nation = F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey")
    specs = c.select(
        F.lit("customers").alias("stream_key"), F.lit("CRM").alias("namespace"),
        F.lit("Balance").alias("metric_name"), F.lit(60).alias("period"),
        F.lit("Sum").alias("statistic"), F.lit("name").alias("organization_identifier"),
        F.array(
            F.array(dim("name", name), dim("segment", segment)),
            F.array(dim("nation", nation), dim("name", name)),
        ).alias("metric_queries"),
    )
    return op.metric_query_plan(specs)


@registered("""
SELECT s_name AS stream_key, 'stock' AS metric_name, CAST(n AS INT) AS query_index, s_name AS query_id,
       s_name AS organization_id,
       'avg:stock{supplier:' || s_name || CASE n WHEN 0 THEN '' ELSE ',nation:' || s_nationkey END || '}'
         AS query_text,
       0 AS chunk_no
FROM supplier, (VALUES (0), (1)) q(n)
""")
def tag_query_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query texts of tag sets: one query per set, found again by its place."""
    name, nation = F.col("s_name"), F.col("s_nationkey").cast("string")

    def tagged(text) -> F.Column:
        return F.struct(name.alias("customer_value"), text.alias("tag_string"))

    supplier = F.concat(F.lit("supplier:"), name)
    specs = t.table(spark, sf_dir, "supplier").select(
        name.alias("stream_key"), F.lit("stock").alias("metric_name"), F.lit("avg").alias("statistic"),
        F.array(tagged(supplier), tagged(F.concat(supplier, F.lit(",nation:"), nation))).alias(
            "metric_tag_data"
        ),
    )
    return op.metric_query_plan(specs)


@registered(f"""
WITH {_EVENTS}
SELECT 'app_metrics' AS stream_key, CAST(user_id AS VARCHAR) AS organization_id,
       sha256(iso || '|' || user_id || '|' || {_METRIC_VALUES}) AS idempotency_key,
       {_METRIC_VALUES} AS values_json
FROM e
""")
def metric_event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric values with labels, and the key over time, organisation and values."""
    events = op.metric_events(t.event_metrics(t.table(spark, sf_dir, "events")))
    return events.select(
        "stream_key", "organization_id", "idempotency_key",
        object_text(F.col("entries")).alias("values_json"),
    )


_ORDER_VALUES = """'{"order_priority": "' || sha256(o_orderpriority) || '", "order_total": '
       || CAST(o_totalprice AS VARCHAR) || ', "status": "' || o_orderstatus || '"}'"""


@registered(f"""
SELECT sha256(CAST(o_custkey AS VARCHAR)) AS organization_id,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') AS event_iso,
       sha256(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') || '|' || o_custkey || '|'
              || {_ORDER_VALUES}) AS idempotency_key,
       {_ORDER_VALUES} AS values_json
FROM (SELECT * EXCLUDE (o_custkey), CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders)
""")
def metric_labels_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen labels, one hashed, and the organisation hashed through its own label. The
    organisation's label is stripped first, as the decoder does."""
    spec = MetricFilter(
        (MetricField("status"), MetricField("order-priority", hash=True),
         MetricField("customer", hash=True))
    )
    metrics = t.order_metrics(t.table(spark, sf_dir, "orders"))
    stripped = metrics.withColumn(
        "labels", F.map_filter("labels", lambda k, _: k != F.col("organization_identifier"))
    )
    return op.metric_events(stripped, spec).select(
        "organization_id", iso_utc(F.col("event_ts")).alias("event_iso"), "idempotency_key",
        object_text(F.col("entries")).alias("values_json"),
    )


@registered("""
SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE 'no_labels_matched' END AS reject_reason,
       CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY 1
""")
def metric_labels_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with labels of which none is listed are rejected; only urgent orders carry
    the listed label."""
    metrics = t.order_metrics(t.table(spark, sf_dir, "orders"))
    urgent = F.try_element_at(F.col("labels"), F.lit("order-priority")) == "1-URGENT"
    listed = F.map_concat("labels", F.create_map(F.lit("urgent"), F.lit("yes")))
    some = metrics.withColumn("labels", F.when(urgent, listed).otherwise(F.col("labels")))
    rows = op.metric_events(some, MetricFilter((MetricField("urgent"),)))
    return op.run_stats(rows).select("reject_reason", "n")


@registered(f"""
WITH {_EVENTS}, c AS (SELECT *, CASE WHEN event_type = 'view' AND value < 1 THEN 0.0::DOUBLE ELSE value END AS v FROM e)
SELECT CAST(event_id AS VARCHAR) AS idempotency_key,
       CASE WHEN event_type IN ('click', 'error') THEN CAST(user_id AS VARCHAR) ELSE event_type END
         AS organization_id
FROM e
UNION ALL
SELECT sha256(iso || '|org-' || event_type || '|{{"Value": ' || CAST(v AS VARCHAR) || '}}'),
       'org-' || event_type
FROM c
""")
def shared_key_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two log inputs and a metric input of one stream key, each with pages of its own: one log
    input takes the user as organisation, the other the type."""
    events = t.table(spark, sf_dir, "events")
    by_user = LogFilter((LogField("organization_id", path="user.id"),))
    by_type = LogFilter((LogField("organization_id", path="event_type"),))
    spec = FlowSpec([
        InputSpec("shop", "cloudwatch", "logs", START, filters=by_user),
        InputSpec("shop", "cloudwatch", "logs", START, filters=by_type),
        InputSpec("shop", "cloudwatch", "metrics", START, cloudwatch=CW_METRICS.cloudwatch),
    ])
    first = F.col("event_type").isin("click", "error")
    parts = [
        t.cloudwatch_log_pages(events.where(first), "shop"),
        t.cloudwatch_log_pages(events.where(~first), "shop"),
        t.cloudwatch_metric_pages(events, "shop", "Value"),
    ]
    pages = op.merge_streams(
        *[p.withColumn("input_key", F.lit(f"shop_{n}")) for n, p in enumerate(parts)]
    )
    return build_flow(spark, spec, pages).events.select("idempotency_key", "organization_id")


# --- event streams --------------------------------------------------------------------


def _both_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = t.table(spark, sf_dir, "events")
    logs, _ = op.split_rejects(op.extract_log_events(t.event_logs(events, "app_logs"), EVENT_FILTER))
    metrics, _ = op.split_rejects(op.metric_events(t.event_metrics(events)))
    return op.merge_streams(logs, metrics)


_BOTH = f"""
SELECT 'app_logs' AS stream_key, CAST(user_id AS VARCHAR) AS organization_id, sec AS "timestamp",
       'app_logs' AS "key", CAST(event_id AS VARCHAR) AS idempotency_key, {_LOG_VALUES} AS values_json
FROM e
UNION ALL
SELECT 'app_metrics', CAST(user_id AS VARCHAR), sec, 'app_metrics',
       sha256(iso || '|' || user_id || '|' || {_METRIC_VALUES}), {_METRIC_VALUES}
FROM e
"""


@registered(f"WITH {_EVENTS} {_BOTH}")
def merged_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of a log stream and a metric stream with different fields."""
    return _shown(_both_streams(spark, sf_dir))


@registered(f"WITH {_EVENTS} SELECT DISTINCT * FROM ({_BOTH})")
def dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries of the same events become one."""
    both = _both_streams(spark, sf_dir)
    return _shown(op.dedupe_events(op.merge_streams(both, both, both)))


@registered("""
SELECT 'app' AS stream_key, CAST(user_id AS VARCHAR) AS organization_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp", 'app' AS "key",
       CAST(event_id AS VARCHAR) AS idempotency_key,
       '{"app_value": ' || CAST(value AS VARCHAR) || '}' AS values_json
FROM events
""")
def payload_reserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reserved names, bare and prefixed, are extracted but not delivered."""
    fields = (
        LogField("organization_id", path="user.id"),
        LogField("key", path="event_type"),
        LogField("timestamp", path="props.k", field_type="integer"),
        LogField("app_timestamp", path="props.k", field_type="integer"),
        LogField("app_value", path="value", field_type="float"),
    )
    logs = t.event_logs(t.table(spark, sf_dir, "events"), "app")
    events, _ = op.split_rejects(op.extract_log_events(logs, LogFilter(fields)))
    return _shown(events)


@registered("""
SELECT 'app' AS stream_key, v.k AS k, CAST(count(*) AS BIGINT) AS n
FROM events, (VALUES ('key'), ('organization_id')) v(k) GROUP BY ALL
""")
def reserved_field_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many extracted fields delivery leaves out, by name."""
    fields = (
        LogField("organization_id", path="user.id"), LogField("key", path="event_type"),
        LogField("value", path="value", field_type="float"),
    )
    logs = t.event_logs(t.table(spark, sf_dir, "events"), "app")
    events = op.extract_log_events(logs, LogFilter(fields))
    return op.reserved_fields(events, ("key", "organization_id", "timestamp", "idempotency_key"))


@registered("""
SELECT CAST(event_id AS VARCHAR) AS idempotency_key,
       '{"shop_event_type": "' || event_type || '", "shop_organization_id": "' || user_id || '"}'
         AS values_json
FROM events
""")
def prefixed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value keys prefixed with the trimmed stream key."""
    fields = (LogField("organization_id", path="user.id"), LogField("event_type", path="event_type"))
    logs = t.event_logs(t.table(spark, sf_dir, "events"), " shop ")
    events = op.prefix_values(op.extract_log_events(logs, LogFilter(fields)))
    return events.select("idempotency_key", object_text(F.col("entries")).alias("values_json"))


@registered("""
SELECT 'event' AS kind, event_id AS id, '{"k": ' || json_extract_string(props, '$.k') || '}' AS values_json
FROM events
UNION ALL SELECT 'document', doc_id, '{}' FROM documents
""")
def foreign_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that arrive as text: JSON objects are taken over, any other text gives none."""

    def coerced(rows: DataFrame, kind: str, key: str, text: str) -> DataFrame:
        values = object_text(op.entries_of(F.col(text)))
        return rows.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), values.alias("values_json"))

    events = coerced(t.table(spark, sf_dir, "events"), "event", "event_id", "props")
    return events.unionAll(coerced(t.table(spark, sf_dir, "documents"), "document", "doc_id", "text"))


_PAYLOADS = """
  p AS (SELECT event_type AS stream_key, ts, event_id,
               '{"organization_id": "' || user_id || '", "timestamp": "'
               || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '", "key": "' || event_type
               || '", "idempotency_key": "' || event_id || '", "values": {"value": '
               || CAST(value AS VARCHAR) || '}}' AS payload
        FROM events)
"""


def _typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log events in one stream per event type."""
    fields = (
        LogField("organization_id", path="user.id"),
        LogField("value", path="value", field_type="float"),
    )
    logs = t.event_logs(t.table(spark, sf_dir, "events"), F.col("event_type"))
    events, _ = op.split_rejects(op.extract_log_events(logs, LogFilter(fields)))
    return events


@registered(f"""
WITH {_PAYLOADS},
  numbered AS (SELECT *, (row_number() OVER (PARTITION BY stream_key ORDER BY ts, CAST(event_id AS VARCHAR)) - 1) // 50
                 AS batch_no FROM p)
SELECT stream_key, CAST(batch_no AS BIGINT) AS batch_no, CAST(count(*) AS BIGINT) AS n,
       '[' || string_agg(payload, ', ' ORDER BY ts, CAST(event_id AS VARCHAR)) || ']' AS body
FROM numbered GROUP BY stream_key, batch_no
""")
def request_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of fifty events per stream in event order."""
    return op.request_batches(op.to_payload(_typed_events(spark, sf_dir)))


@registered("SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS oversized FROM events")
def sent_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as tasks send them without a shuffle: all events, none above fifty. The
    poster only checks the body."""
    sent = op.send_requests(_typed_events(spark, sf_dir), _check_body)
    return sent.agg(
        F.sum("n").alias("n"), F.sum((F.col("n") > 50).cast("bigint")).alias("oversized")
    )


def _check_body(body: str) -> None:
    if not (body.startswith("[{") and body.endswith("}]")):
        raise ValueError("not a JSON array of objects")


@registered("""
SELECT event_type AS stream_key, CAST(event_id AS VARCHAR) AS idempotency_key,
       CAST(user_id AS VARCHAR) AS organization_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date
FROM events
""")
def delivered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written twice under one run id to the table sink, read back once. The first
    attempt put them a day later, into partitions that the second must clear."""
    path = shared_dir(spark, "delivered")
    events = _typed_events(spark, sf_dir)
    later = events.withColumn("event_ts", F.col("event_ts") + F.expr("interval 1 day"))
    op.write_table(later, path, "run-1")
    op.write_table(events, path, "run-1")
    return op.read_delivered(spark, path).select(
        "stream_key", "idempotency_key", "organization_id", F.col("event_date").cast("string")
    )

@registered(ORACLES["delivered_table"])
def delivered_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs that overlap by half of the events, and a third from a stream's batch: each
    event is stored once."""
    path = shared_dir(spark, "overlap")
    events = _typed_events(spark, sf_dir)
    half = F.pmod(F.xxhash64("idempotency_key"), F.lit(2)) == 0
    op.write_table(events.where(half), path, "run-1")
    for run_id in ("run-2", "stream-0-0000000000"):
        rest = op.not_delivered(events, op.read_delivered(spark, path), run_id)
        op.write_table(rest, path, run_id)
    return op.read_delivered(spark, path).select(
        "stream_key", "idempotency_key", "organization_id", F.col("event_date").cast("string")
    )


_SIGNUP_TEXT = """'{"event_type":"signup","value":' || CAST(value AS VARCHAR)
       || ',"user":{},"props":{"k":' || k || '}}'"""


@registered(f"""
WITH {_EVENTS}
SELECT 'app_logs' AS stream_key, CAST(event_id AS VARCHAR) AS idempotency_key,
       'missing_org' AS reject_reason, sha256({_SIGNUP_TEXT}) AS content_sha256
FROM e WHERE event_type = 'signup'
UNION ALL
SELECT 'documents', CAST(doc_id AS VARCHAR), 'parse_error', sha256(text) FROM documents
""")
def quarantined_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records as the quarantine table keeps them, with reason and whole content."""
    path = shared_dir(spark, "quarantine")
    rows = _rows_with_rejects(spark, sf_dir)
    op.write_rejects(op.split_rejects(rows)[1], path, "run-1")
    return op.read_rejects(spark, path).select(
        "stream_key", "idempotency_key", "reject_reason", F.sha2("content", 256).alias("content_sha256")
    )


# --- offsets and ranges ---------------------------------------------------------------


@registered("""
SELECT s_suppkey AS pos, CAST(s_nationkey AS VARCHAR) AS stream_key,
       CASE WHEN count(*) OVER w > 1
            THEN s_nationkey || '_' || (row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1)
            ELSE CAST(s_nationkey AS VARCHAR) END AS offset_key
FROM supplier WINDOW w AS (PARTITION BY s_nationkey)
""")
def offset_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of inputs that share a stream, numbered in order; suppliers stand for inputs."""
    inputs = t.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("pos"), F.col("s_nationkey").cast("string").alias("stream_key")
    )
    return op.offset_keys(inputs)


@registered("""
SELECT CAST(s_nationkey AS VARCHAR) AS stream_key, CAST(count(*) AS BIGINT) AS n
FROM supplier GROUP BY s_nationkey HAVING count(*) > 1
""")
def duplicate_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream keys used by several inputs."""
    inputs = t.table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("string").alias("stream_key")
    )
    return op.duplicate_streams(inputs)


def _customer_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as inputs; those in debt override their stored offset."""
    return t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("stream_key"),
        F.lit(852_076_800_000).alias("start_from"),
        (F.col("c_acctbal") < 0).alias("override"),
    )


@registered("""
WITH last AS (SELECT o_custkey, max(o_orderdate) AS moment FROM orders GROUP BY o_custkey),
     log AS (SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS offset_ms
             FROM orders GROUP BY o_custkey)
SELECT CAST(c_custkey AS VARCHAR) AS stream_key,
       CAST(CASE WHEN c_acctbal < 0 THEN 852076800000
            ELSE greatest(coalesce(epoch_us(moment) // 1000, 852076800000), 852076800000) END AS BIGINT)
         AS offset_ms,
       log.offset_ms AS logged
FROM customer LEFT JOIN last ON c_custkey = last.o_custkey LEFT JOIN log ON c_custkey = log.o_custkey
""")
def latest_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every input resumes after what was delivered, and the last row of its offset
    log; customers stand for inputs and orders for what they delivered."""
    orders = t.table(spark, sf_dir, "orders")
    delivered = t.order_metrics(orders).withColumn("stream_key", F.col("organization_id"))
    log = orders.select(
        F.col("o_custkey").cast("string").alias("stream_key"),
        F.col("o_orderkey").alias("offset_ms"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
    )
    logged = op.current_offsets(log).select("stream_key", F.col("offset_ms").alias("logged"))
    resumed = op.offsets_from_delivered(_customer_inputs(spark, sf_dir), delivered)
    return resumed.join(logged, "stream_key", "left").select("stream_key", "offset_ms", "logged")


@registered("""
WITH last AS (SELECT o_custkey, max(epoch_us(o_orderdate) // 1000) AS moment FROM orders GROUP BY o_custkey),
     whole AS (SELECT max(epoch_us(o_orderdate) // 1000) AS moment FROM orders)
SELECT CAST(c_custkey AS VARCHAR) AS stream_key,
       CAST(CASE WHEN c_acctbal < 0 THEN 852076800000
            WHEN c_mktsegment = 'BUILDING' THEN greatest(whole.moment, 852076800000)
            ELSE greatest(coalesce(last.moment, 852076800000), 852076800000) END AS BIGINT) AS offset_ms
FROM customer LEFT JOIN last ON c_custkey = o_custkey, whole
""")
def offsets_by_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs of one stream that resume after the last delivered event of their own
    organisation; those of one segment name none and resume after the stream's last."""
    customers = t.table(spark, sf_dir, "customer").withColumn("stream_key", F.col("c_custkey").cast("string"))
    own = F.when(F.col("c_mktsegment") != "BUILDING", F.col("stream_key"))
    inputs = _customer_inputs(spark, sf_dir).join(
        customers.select("stream_key", own.alias("organization_id")), "stream_key"
    )
    inputs = inputs.withColumnRenamed("stream_key", "offset_key").withColumn("stream_key", F.lit("orders"))
    return op.offsets_from_delivered(inputs, t.order_metrics(t.table(spark, sf_dir, "orders")))


@registered("""
SELECT 'orders' AS stream_key, organization_id, max(epoch_us(o_orderdate) // 1000) AS latest_ms
FROM (SELECT sha256(CAST(o_custkey AS VARCHAR)) AS organization_id, o_orderdate FROM orders)
WHERE organization_id = sha256('1') OR organization_id = sha256('2')
GROUP BY organization_id
""")
def latest_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest delivered event of two organisations, looked up by the text that was hashed."""
    metrics = t.order_metrics(t.table(spark, sf_dir, "orders"))
    spec = MetricFilter((MetricField("customer", hash=True),))
    events, _ = op.split_rejects(op.metric_events(metrics, spec))

    def of(org: str) -> DataFrame:
        found = op.latest_ingested(events, "orders", f"hash:{org}")
        return found.select(
            "stream_key", F.sha2(F.lit(org), 256).alias("organization_id"),
            to_millis(F.col("event_ts")).alias("latest_ms"),
        )

    return of("1").unionAll(of("2"))


_NOW_MS = 1_706_745_600_000  # 2024-02-01T00:00:00Z

_RANGES = f"""
  o AS (SELECT CAST(user_id AS VARCHAR) AS stream_key, max(epoch_us(ts) // 1000) AS c
        FROM events GROUP BY user_id),
  n AS (SELECT *, greatest(0, CAST(ceil(({_NOW_MS} - c) / 3600000.0) AS BIGINT) - 1) AS hours FROM o),
  m AS (SELECT *, c + hours * 3600000 AS mid FROM n),
  r AS (SELECT stream_key, c + i * 3600000 AS start_ms, c + (i + 1) * 3600000 AS end_ms
        FROM m, LATERAL (SELECT unnest(range(hours)) AS i)
        UNION ALL
        SELECT stream_key, s, least(s + 60000, {_NOW_MS})
        FROM m, LATERAL (SELECT unnest(range(mid, {_NOW_MS}, 60000)) AS s))
"""


def _user_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivered = t.user_series(t.table(spark, sf_dir, "events")).withColumn(
        "stream_key", F.col("organization_id")
    )
    offsets = op.latest_ingested(delivered).select(
        "stream_key", to_millis(F.col("event_ts")).alias("offset_ms")
    )
    return op.plan_ranges(offsets, _NOW_MS, 60_000)


@registered(f"WITH {_RANGES} SELECT stream_key, CAST(start_ms AS BIGINT) AS start_ms, CAST(end_ms AS BIGINT) AS end_ms FROM r")
def planned_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges from every user's last event up to a fixed now: hours, then minutes."""
    return _user_ranges(spark, sf_dir)


@registered(f"WITH {_RANGES} SELECT stream_key, CAST(max(end_ms) AS BIGINT) AS offset_ms FROM r GROUP BY stream_key")
def committed_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets to store once the planned ranges are delivered."""
    return op.commit_offsets(_user_ranges(spark, sf_dir)).select("stream_key", "offset_ms")


@registered(f"""
WITH {_RANGES}
SELECT stream_key, stream_key || '@' || CAST(start_ms AS BIGINT) AS idempotency_key,
       CAST(start_ms AS BIGINT) AS event_ms, CAST(end_ms - start_ms AS BIGINT) AS width
FROM r
""")
def pulled_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned ranges of every user fetched by tasks, one record each, and decoded."""
    ranges = _user_ranges(spark, sf_dir).withColumns(
        {"input_key": F.col("stream_key"), "provider": F.lit("cloudwatch"), "kind": F.lit("logs")}
    )
    logs = sources.normalize_cloudwatch_logs(sources.pull_ranges(ranges, _range_record))
    found = op.extract_json_fields(logs, (LogField("width", path="width", field_type="integer"),))
    return found.select(
        "stream_key", F.col("log_id").alias("idempotency_key"),
        to_millis(F.col("event_ts")).alias("event_ms"), "fields.width",
    )


def _range_record(input_key: str, start_ms: int, end_ms: int):
    """A fetcher that answers a range with a page of one record at its start."""
    message = json.dumps({"width": end_ms - start_ms})
    event = {"eventId": f"{input_key}@{start_ms}", "timestamp": start_ms, "message": message}
    yield None, json.dumps({"events": [event]})


# --- series ---------------------------------------------------------------------------


def _exact(rows: DataFrame) -> DataFrame:
    """Values as decimals, whose sums do not depend on the order of addition."""
    return rows.withColumn("value", F.col("value").cast("decimal(18,2)"))


def _five_statistics(rows: DataFrame, period_s: int, by: list[str]) -> DataFrame:
    names = ("Average", "Minimum", "Maximum", "Sum", "SampleCount")
    return op.rollup(rows, period_s, names, by).select(
        *by, "statistic", to_millis(F.col("period_start")).alias("start_ms"),
        F.round("value", 6).alias("value"),
    )


_STATS = """
       unnest(['Average', 'Minimum', 'Maximum', 'Sum', 'SampleCount']) AS statistic,
       start_ms,
       round(unnest([CAST(s AS DOUBLE) / n, CAST(lo AS DOUBLE), CAST(hi AS DOUBLE), CAST(s AS DOUBLE),
                     CAST(n AS DOUBLE)]), 6) AS value
"""


@registered(f"""
SELECT metric_name, {_STATS}
FROM (SELECT event_type AS metric_name, epoch_us(ts) // 3600000000 * 3600000 AS start_ms,
             sum(CAST(value AS DECIMAL(18,2))) AS s, min(value) AS lo, max(value) AS hi, count(*) AS n
      FROM events GROUP BY ALL)
""")
def rollup_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five period statistics per hour and metric."""
    metrics = t.event_metrics(t.table(spark, sf_dir, "events"))
    return _five_statistics(_exact(metrics), 3600, ["metric_name"])


@registered(f"""
SELECT flag, {_STATS}
FROM (SELECT l_returnflag AS flag, epoch_us(l_shipdate) // 604800000000 * 604800000 AS start_ms,
             sum(CAST(l_quantity AS DECIMAL(18,2))) AS s, min(l_quantity) AS lo, max(l_quantity) AS hi,
             count(*) AS n
      FROM lineitem GROUP BY ALL)
""")
def rollup_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five period statistics per week of shipping and return flag."""
    metrics = t.lineitem_metrics(t.table(spark, sf_dir, "lineitem"))
    flagged = metrics.withColumn("flag", F.col("labels")["flag"])
    return _five_statistics(_exact(flagged), 7 * 86_400, ["flag"])


@registered("""
SELECT s_name AS spec_id, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey AND (s_acctbal >= 0 OR l_returnflag = 'R')
GROUP BY s_name
""")
def select_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples by dimension set: suppliers in credit by supplier, others also by flag."""
    supplier = t.table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    dims = F.when(F.col("s_acctbal") >= 0, F.create_map(F.lit("supplier"), key)).otherwise(
        F.create_map(F.lit("supplier"), key, F.lit("flag"), F.lit("R"))
    )
    specs = supplier.select(F.col("s_name").alias("spec_id"), dims.alias("dims"))
    metrics = t.lineitem_metrics(t.table(spark, sf_dir, "lineitem"))
    chosen = op.select_series(metrics, specs, [["supplier"], ["flag", "supplier"]])
    return _exact(chosen).groupBy("spec_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("quantity")
    )


_DELTA = """
  d AS (SELECT user_id, ts, value, lag(value) OVER s AS prev,
               CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END AS delta
        FROM events WINDOW s AS (PARTITION BY user_id ORDER BY ts))
"""


@registered(f"""
WITH {_DELTA}
SELECT CAST(user_id AS VARCHAR) AS organization_id, epoch_us(ts) AS event_us,
       round((sum(delta) OVER w - first_value(delta) OVER w) / 432000.0, 9) AS value
FROM d
WINDOW w AS (PARTITION BY user_id ORDER BY ts
             RANGE BETWEEN INTERVAL '431999.999999 seconds' PRECEDING AND CURRENT ROW)
""")
def counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of a counter with resets over five days, at every sample."""
    series = t.user_series(t.table(spark, sf_dir, "events"))
    return op.counter_rate(series, 5 * 86_400_000, block_ms=60_000).select(
        "organization_id", F.unix_micros("event_ts").alias("event_us"),
        F.round("value", 9).alias("value"),
    )


_GRID_START = 1_704_067_200_000  # 2024-01-01T00:00:00Z
_GRID_END = _GRID_START + 30 * 86_400_000
_GRID = f"""
  g AS (SELECT u.user_id, make_timestamp(x * 1000) AS moment
        FROM (SELECT DISTINCT user_id FROM events) u,
             (SELECT unnest(range({_GRID_START}, {_GRID_END} + 1, 21600000)) AS x))
"""


@registered(f"""
WITH {_GRID}
SELECT CAST(g.user_id AS VARCHAR) AS organization_id, epoch_us(g.moment) // 1000 AS event_ms, e.value AS value
FROM g ASOF JOIN events e ON g.user_id = e.user_id AND g.moment >= e.ts
WHERE e.ts > g.moment - INTERVAL 24 HOUR
""")
def step_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series on a six hour grid with a day of lookback."""
    series = t.user_series(t.table(spark, sf_dir, "events"))
    grid = op.step_grid(series, _GRID_START, _GRID_END, 21_600_000, 86_400_000)
    return grid.select("organization_id", to_millis(F.col("event_ts")).alias("event_ms"), "value")


@registered(f"""
WITH {_DELTA}, {_GRID}
SELECT CAST(g.user_id AS VARCHAR) AS organization_id, epoch_us(g.moment) // 1000 AS event_ms,
       round((sum(delta) - arg_min(delta, d.ts)) / 259200.0, 9) AS value
FROM g JOIN d ON g.user_id = d.user_id AND d.ts <= g.moment AND d.ts > g.moment - INTERVAL 3 DAY
GROUP BY g.user_id, g.moment HAVING count(*) > 1
""")
def rate_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of a counter over three days on a six hour grid."""
    series = t.user_series(t.table(spark, sf_dir, "events"))
    rates = op.rate_grid(
        series, _GRID_START, _GRID_END, 21_600_000, 3 * 86_400_000, fold_ms=60_000
    )
    return rates.select(
        "organization_id", to_millis(F.col("event_ts")).alias("event_ms"),
        F.round("value", 9).alias("value"),
    )


@registered(f"""
WITH {_DELTA}, {_GRID},
w AS (SELECT g.user_id, g.moment, count(*) AS n, sum(delta) - arg_min(delta, d.ts) AS inc,
             arg_min(value, d.ts) AS first_value,
             CAST(epoch_us(max(d.ts)) - epoch_us(min(d.ts)) AS DOUBLE) AS sampled,
             CAST(epoch_us(min(d.ts)) - epoch_us(g.moment) + 259200000000 AS DOUBLE) AS to_start,
             CAST(epoch_us(g.moment) - epoch_us(max(d.ts)) AS DOUBLE) AS to_end
      FROM g JOIN d ON g.user_id = d.user_id AND d.ts <= g.moment AND d.ts > g.moment - INTERVAL 3 DAY
      GROUP BY g.user_id, g.moment HAVING count(*) > 1),
x AS (SELECT *, sampled / (n - 1) AS apart FROM w),
y AS (SELECT *, CASE WHEN to_start >= apart * 1.1 THEN apart / 2 ELSE to_start END AS head,
             CASE WHEN to_end >= apart * 1.1 THEN apart / 2 ELSE to_end END AS tail FROM x)
SELECT CAST(user_id AS VARCHAR) AS organization_id, epoch_us(moment) // 1000 AS event_ms,
       round(inc * (sampled + least(head, CASE WHEN inc > 0 AND first_value >= 0
                                               THEN sampled * first_value / inc ELSE head END) + tail)
             / sampled / 259200.0, 12) AS value
FROM y
""")
def rate_grid_extrapolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rate stretched to the window borders."""
    series = t.user_series(t.table(spark, sf_dir, "events"))
    rates = op.rate_grid(
        series, _GRID_START, _GRID_END, 21_600_000, 3 * 86_400_000, extrapolate=True, fold_ms=60_000
    )
    return rates.select(
        "organization_id", to_millis(F.col("event_ts")).alias("event_ms"),
        F.round("value", 12).alias("value"),
    )


@registered(f"""
WITH {_DELTA}, {_GRID}
SELECT CAST(g.user_id AS VARCHAR) AS organization_id, epoch_us(g.moment) // 1000 AS event_ms,
       round((sum(delta) - arg_min(delta, d.ts)) / 144000.0, 9) AS value
FROM g JOIN d ON g.user_id = d.user_id AND d.ts <= g.moment AND d.ts > g.moment - INTERVAL 40 HOUR
GROUP BY g.user_id, g.moment HAVING count(*) > 1
""")
def rate_grid_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate over forty hours on a six hour grid, a window that is no multiple of the step."""
    series = t.user_series(t.table(spark, sf_dir, "events"))
    rates = op.rate_grid(series, _GRID_START, _GRID_END, 21_600_000, 40 * 3_600_000)
    return rates.select(
        "organization_id", to_millis(F.col("event_ts")).alias("event_ms"),
        F.round("value", 9).alias("value"),
    )


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples at the start of their day, with the type as a label of one metric."""
    events = t.table(spark, sf_dir, "events").withColumn("ts", F.date_trunc("day", "ts"))
    named = t.event_metrics(events)
    return named.withColumn("labels", F.create_map(F.lit("type"), "metric_name")).withColumn(
        "metric_name", F.lit("daily")
    )


@registered("""
SELECT event_type AS type, epoch_us(date_trunc('day', ts)) // 1000 AS event_ms,
       round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 4) AS total,
       round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS mean
FROM events GROUP BY ALL
""")
def aggregate_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum and average by a label at each instant."""
    daily = _daily(spark, sf_dir)
    at = to_millis(F.col("event_ts")).alias("event_ms")
    kind = F.col("labels")["type"].alias("type")
    total = op.aggregate_by(daily, ["type"], "sum").select(kind, at, F.round("value", 4).alias("total"))
    mean = op.aggregate_by(daily, ["type"], "avg").select(kind, at, F.round("value", 6).alias("mean"))
    return total.join(mean, ["type", "event_ms"])


@registered("""
SELECT CAST(user_id AS VARCHAR) AS organization_id, epoch_us(date_trunc('day', ts)) // 1000 AS event_ms,
       round(count(*) FILTER (event_type = 'error') / count(*), 9) AS value
FROM events GROUP BY user_id, date_trunc('day', ts) HAVING count(*) FILTER (event_type = 'error') > 0
""")
def series_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of errors per organisation and day."""
    daily = _daily(spark, sf_dir)
    errors = op.aggregate_by(op.match_labels(daily, {"type": "error"}), ["organization_id"], "count")
    every = op.aggregate_by(daily, ["organization_id"], "count")
    ratio = op.series_ratio(errors, every, ["organization_id"], "error_rate")
    return ratio.select(
        "organization_id", to_millis(F.col("event_ts")).alias("event_ms"),
        F.round("value", 9).alias("value"),
    )


_BOUNDS = (10, 20, 30, 40)


@registered("""
WITH c AS (
  SELECT l_returnflag AS flag, date_trunc('month', l_shipdate) AS moment, count(*) AS total,
         [0, 10, 20, 30, 40] AS lows,
         [count(*) FILTER (l_quantity <= 0), count(*) FILTER (l_quantity <= 10),
          count(*) FILTER (l_quantity <= 20), count(*) FILTER (l_quantity <= 30),
          count(*) FILTER (l_quantity <= 40)] AS cums
  FROM lineitem GROUP BY ALL),
q AS (SELECT *, unnest([0.5, 0.9]) AS q FROM c),
r AS (SELECT *, q * total AS rank, len(list_filter(cums[2:], lambda x: x < q * total)) AS i FROM q)
SELECT flag, epoch_us(moment) // 1000 AS event_ms, CAST(q AS DOUBLE) AS q,
       round(CASE WHEN i = 4 THEN 40.0
                  ELSE lows[i + 1] + 10.0 * (rank - CASE WHEN i = 0 THEN 0 ELSE cums[i + 1] END)
                       / (cums[i + 2] - CASE WHEN i = 0 THEN 0 ELSE cums[i + 1] END) END, 6) AS value
FROM r
""")
def histogram_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and ninth decile of shipped quantity per month and flag, from buckets."""
    quantity = F.col("l_quantity")
    counts = (
        t.table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", F.date_trunc("month", "l_shipdate").alias("at"))
        .agg(
            *[F.count_if(quantity <= b).alias(f"b{b}") for b in _BOUNDS],
            F.count(F.lit(1)).alias("binf"),
        )
    )
    pairs = [(str(b), f"b{b}") for b in _BOUNDS] + [("+Inf", "binf")]
    bucket = F.explode(
        F.array(
            *[F.struct(F.lit(le).alias("le"), F.col(c).cast("double").alias("n")) for le, c in pairs]
        )
    )
    buckets = counts.select("l_returnflag", "at", bucket.alias("b")).select(
        F.lit("shipments").alias("stream_key"), F.lit("quantity_bucket").alias("metric_name"),
        F.col("b.n").alias("value"), F.lit(None).cast("string").alias("organization_id"),
        F.create_map(F.lit("le"), F.col("b.le"), F.lit("flag"), F.col("l_returnflag")).alias("labels"),
        F.col("at").cast("timestamp").alias("event_ts"),
    )

    def at(q: float) -> DataFrame:
        found = op.histogram_quantile(buckets, q, ["flag"])
        return found.select(
            F.col("labels")["flag"].alias("flag"), to_millis(F.col("event_ts")).alias("event_ms"),
            F.lit(q).alias("q"), F.round("value", 6).alias("value"),
        )

    return at(0.5).unionAll(at(0.9))


@registered("""
SELECT o_orderstatus AS status, o_orderpriority AS priority,
       epoch_us(o_orderdate + INTERVAL 60 SECOND) // 1000 AS event_ms, o_totalprice AS value
FROM orders
WHERE o_orderstatus = 'F' AND regexp_full_match(o_orderpriority, '[12]-.*|5-LOW')
""")
def label_match_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label match by value and by full regex, and a shift by a minute."""
    metrics = t.order_metrics(t.table(spark, sf_dir, "orders"))
    matched = op.match_labels(metrics, {"status": "F"}, {"order-priority": "[12]-.*|5-LOW"})
    return op.shift_series(matched, 60).select(
        F.col("labels")["status"].alias("status"),
        F.col("labels")["order-priority"].alias("priority"),
        to_millis(F.col("event_ts")).alias("event_ms"), "value",
    )


# --- streaming ------------------------------------------------------------------------


@registered(ORACLES["log_events"])
def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log extraction as a stream over the table's files, de-duplicated under a
    watermark and written by the table sink, equals the batch result."""
    base = shared_dir(spark, "stream")
    logs = t.event_logs(t.table_stream(spark, sf_dir, "events"), "app_logs")
    events, _ = op.split_rejects(op.extract_log_events(logs, EVENT_FILTER))
    unique = op.dedupe_events(events, watermark="60 days")
    writer = stream_to(
        unique, "table", f"{base}/checkpoint", path=f"{base}/events", available_now=True
    )
    run_available(writer)
    return _shown(op.read_delivered(spark, f"{base}/events"))


# further queries register themselves
from tidegauge.plans import live, routes  # noqa: E402, F401
