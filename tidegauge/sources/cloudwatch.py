"""CloudWatch responses: filtered log events and metric data results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import from_millis
from tidegauge.schema import LOG_METADATA
from tidegauge.sources.pages import (
    explode_points,
    fail_on,
    first_reason,
    is_json_text,
    page_items,
)

LOG_PAGE = (
    "events array<struct<eventId:string,timestamp:bigint,message:string,logStreamName:string>>, "
    "nextToken string"
)
METRIC_PAGE = (
    "MetricDataResults array<struct<Id:string,Timestamps:array<string>,Values:array<double>>>, "
    "NextToken string"
)


def normalize_cloudwatch_logs(pages: DataFrame, strict: bool = False) -> DataFrame:
    """Log pages to log entries plus ``reject_reason``."""
    items = page_items(pages, LOG_PAGE, "page.events")
    item = F.col("item")
    metadata = F.struct(
        F.coalesce(item["logStreamName"], F.lit("")).alias("log_stream_name"),
        F.lit(None).cast("string").alias("service"),
        F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("array<string>").alias("tags"),
    ).cast(LOG_METADATA)
    out = items.select(
        "stream_key",
        item["eventId"].alias("log_id"),
        item["message"].alias("content"),
        is_json_text(item["message"]).alias("is_json"),
        metadata.alias("metadata"),
        from_millis(item["timestamp"]).alias("event_ts"),
        first_reason(
            (F.col("reject_reason").isNotNull(), "bad_page"),
            (item["eventId"].isNull(), "missing_id"),
            (item["timestamp"].isNull(), "bad_timestamp"),
            (item["message"].isNull(), "missing_message"),
        ).alias("reject_reason"),
    )
    return fail_on(out) if strict else out


def _instant(text: Column) -> Column:
    """A point's time: ISO text, or an epoch number in seconds or, from 1e11 on, milliseconds."""
    number = F.when(text.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE]\+?[0-9]+)?$"), text.try_cast("double"))
    micros = F.when(F.abs(number) < 1e11, number * 1e6).otherwise(number * 1e3)
    epoch = F.timestamp_micros(F.round(micros).try_cast("bigint"))
    return F.when(number.isNotNull(), epoch).otherwise(text.try_cast("timestamp"))


def normalize_cloudwatch_metrics(
    pages: DataFrame, plan: DataFrame, strict: bool = False
) -> DataFrame:
    """Metric pages to metric entries plus ``reject_reason``.

    The query id is looked up once per series, before its points are exploded. The plan
    carries no broadcast hint: Spark broadcasts it while its known size is below the
    threshold and otherwise shuffles both sides, where AQE splits a hot query id.
    """
    # an empty result list is an error of the page, so it becomes one item without an id
    listed = page_items(
        pages,
        METRIC_PAGE,
        "if(size(page.MetricDataResults) > 0, page.MetricDataResults, "
        "from_json('[{}]', 'array<struct<Id:string,Timestamps:array<string>,Values:array<double>>>'))",
    )
    lookup = plan.select(
        "stream_key", F.col("query_id").alias("Id"), "metric_name", "organization_id"
    )
    series = listed.select(
        "stream_key",
        F.col("item")["Id"].alias("Id"),
        F.col("item")["Timestamps"].alias("times"),
        F.col("item")["Values"].alias("samples"),
        first_reason(
            (F.col("reject_reason").isNotNull(), "bad_page"),
            (F.col("item")["Id"].isNull(), "no_results"),
        ).alias("page_reason"),
    ).join(lookup, ["stream_key", "Id"], "left")
    reason = first_reason(
        (F.col("page_reason") == "bad_page", "bad_page"),
        (F.col("page_reason") == "no_results", "no_results"),
        (F.col("organization_id").isNull(), "unknown_query"),
        (~F.size("times").eqNullSafe(F.size("samples")), "length_mismatch"),
        (F.col("times").isNull(), "length_mismatch"),
    )
    points = explode_points(
        series.withColumn("series_reason", reason),
        F.arrays_zip("times", "samples"),
        "struct<times:string,samples:double>",
    )
    when = _instant(F.col("point.times"))
    out = points.select(
        "stream_key",
        "metric_name",
        F.col("point.samples").alias("value"),
        "organization_id",
        F.lit(None).cast("string").alias("organization_identifier"),
        F.lit(None).cast("map<string,string>").alias("labels"),
        when.alias("event_ts"),
        F.coalesce(
            F.col("series_reason"),
            first_reason((when.isNull(), "bad_timestamp"), (F.col("point.samples").isNull(), "bad_value")),
        ).alias("reject_reason"),
    )
    return fail_on(out) if strict else out
