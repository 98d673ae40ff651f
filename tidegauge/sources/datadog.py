"""Datadog responses: log search results and timeseries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import from_millis, ntz_as_utc
from tidegauge.schema import LOG_METADATA
from tidegauge.sources.pages import explode_points, fail_on, first_reason, page_items

LOG_PAGE = (
    "data array<struct<id:string,attributes:struct<attributes:string,timestamp:string,"
    "service:string,status:string,tags:array<string>>>>, "
    "meta struct<page:struct<after:string>>"
)
METRIC_PAGE = (
    "data struct<attributes:struct<series:array<struct<query_index:int>>,"
    "times:array<bigint>,values:array<array<double>>>>"
)


def normalize_datadog_logs(pages: DataFrame, strict: bool = False) -> DataFrame:
    """Log pages to log entries plus ``reject_reason``. The content is the inner
    attribute object; the record's clock reading is taken as UTC."""
    items = page_items(pages, LOG_PAGE, "page.data")
    outer = F.col("item")["attributes"]
    content = outer["attributes"]
    is_object = content.rlike(r"^\s*\{") & ~content.rlike(r"^\s*\{\s*\}\s*$")
    event_ts = ntz_as_utc(outer["timestamp"].try_cast("timestamp_ntz"))
    metadata = F.struct(
        F.lit(None).cast("string").alias("log_stream_name"),
        F.coalesce(outer["service"], F.lit("")).alias("service"),
        F.coalesce(outer["status"], F.lit("")).alias("status"),
        F.coalesce(outer["tags"], F.array().cast("array<string>")).alias("tags"),
    ).cast(LOG_METADATA)
    out = items.select(
        "stream_key",
        F.col("item")["id"].alias("log_id"),
        content.alias("content"),
        F.coalesce(is_object, F.lit(False)).alias("is_json"),
        metadata.alias("metadata"),
        event_ts.alias("event_ts"),
        first_reason(
            (F.col("reject_reason").isNotNull(), "bad_page"),
            (outer.isNull(), "missing_attributes"),
            (event_ts.isNull(), "bad_timestamp"),
            (F.col("item")["id"].isNull(), "missing_id"),
        ).alias("reject_reason"),
    )
    return fail_on(out) if strict else out


def normalize_datadog_metrics(
    pages: DataFrame, plan: DataFrame, keep_zero: bool = False, strict: bool = False
) -> DataFrame:
    """Timeseries pages to metric entries plus ``reject_reason``.

    Series *k* takes ``values[k]`` against the shared times, cut to the shorter of the
    two. Null points are dropped and, unless ``keep_zero``, so are zero points.
    """
    listed = page_items(
        pages,
        METRIC_PAGE,
        "transform(page.data.attributes.series, (s, k) -> struct(s.query_index as query_index, "
        "try_element_at(page.data.attributes.values, k + 1) as samples))",
        shared={"times": "page.data.attributes.times"},
    )
    lookup = plan.select("stream_key", "query_index", "metric_name", "organization_id")
    series = listed.select(
        "stream_key",
        F.col("item")["query_index"].alias("query_index"),
        "times",
        F.col("item")["samples"].alias("samples"),
        F.col("reject_reason").alias("page_reason"),
    ).join(lookup, ["stream_key", "query_index"], "left")
    reason = first_reason(
        (F.col("page_reason").isNotNull(), "bad_page"),
        (F.col("organization_id").isNull(), "unknown_query"),
        (F.col("samples").isNull() | F.col("times").isNull(), "missing_values"),
    )
    shorter = F.least(F.size("times"), F.size("samples"))
    zipped = F.arrays_zip(
        F.slice("times", F.lit(1), shorter).alias("ms"),
        F.slice("samples", F.lit(1), shorter).alias("value"),
    )
    kept = F.filter(
        zipped,
        lambda p: p["value"].isNotNull() & (F.lit(True) if keep_zero else p["value"] != 0),
    )
    points = explode_points(
        series.withColumn("series_reason", reason), kept, "struct<ms:bigint,value:double>"
    )
    out = points.select(
        "stream_key",
        "metric_name",
        F.col("point.value").alias("value"),
        "organization_id",
        F.lit(None).cast("string").alias("organization_identifier"),
        F.lit(None).cast("map<string,string>").alias("labels"),
        from_millis(F.col("point.ms")).alias("event_ts"),
        F.coalesce(
            F.col("series_reason"), first_reason((F.col("point.ms").isNull(), "bad_timestamp"))
        ).alias("reject_reason"),
    )
    return fail_on(out) if strict else out
