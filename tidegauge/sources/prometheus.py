"""Prometheus range query responses (matrices)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.plans.spec import PrometheusQuery
from tidegauge.sources.pages import explode_points, fail_on, first_reason, page_items

MATRIX_PAGE = (
    "status string, data struct<resultType:string,"
    "result:array<struct<metric:map<string,string>,values:array<array<string>>>>>"
)


def resolve_org(labels: Column, org_label: Column, fallback: Column) -> Column:
    """Organisation of a series: the label when present, even if empty, else the fallback."""
    present = F.coalesce(F.map_contains_key(labels, F.coalesce(org_label, F.lit(""))), F.lit(False))
    return F.when(
        present & org_label.isNotNull(), F.try_element_at(labels, org_label)
    ).otherwise(fallback)


def normalize_prometheus_metrics(
    pages: DataFrame, queries: PrometheusQuery | Sequence[PrometheusQuery], strict: bool = False
) -> DataFrame:
    """Matrix pages to metric entries plus ``reject_reason``.

    ``query_index`` of a page picks its query; a null index means the first. The label
    that names the organisation moves out of the label set.
    """
    if isinstance(queries, PrometheusQuery):
        queries = [queries]

    def per_query(attribute: str) -> Column:
        values = F.array(*[F.lit(getattr(q, attribute)).cast("string") for q in queries])
        return F.try_element_at(values, F.coalesce(F.col("query_index"), F.lit(0)) + 1)

    listed = page_items(pages, MATRIX_PAGE, "page.data.result", keep=("query_index",))
    labels = F.coalesce(F.col("item")["metric"], F.create_map().cast("map<string,string>"))
    series = listed.select(
        "stream_key",
        per_query("metric_name").alias("metric_name"),
        per_query("organization_identifier").alias("org_label"),
        per_query("fallback_org_id").alias("fallback"),
        labels.alias("all_labels"),
        F.col("item")["values"].alias("samples"),
        F.col("reject_reason").alias("page_reason"),
    ).withColumn(
        "organization_id", resolve_org(F.col("all_labels"), F.col("org_label"), F.col("fallback"))
    )
    reason = first_reason(
        (F.col("page_reason").isNotNull(), "bad_page"),
        (F.col("metric_name").isNull(), "unknown_query"),
        (F.coalesce(F.col("organization_id"), F.lit("")) == "", "missing_org"),
    )
    labelled = series.select(
        "stream_key",
        "metric_name",
        "organization_id",
        "org_label",
        F.map_filter(
            "all_labels", lambda name, _: ~name.eqNullSafe(F.col("org_label"))
        ).alias("labels"),
        "samples",
        reason.alias("series_reason"),
    )
    points = explode_points(labelled, F.col("samples"), "array<string>")
    seconds = F.col("point")[0].try_cast("decimal(20,6)")
    event_ts = F.timestamp_micros((seconds * 1_000_000).cast("bigint"))
    value = F.col("point")[1].try_cast("double")
    out = points.select(
        "stream_key",
        "metric_name",
        value.alias("value"),
        "organization_id",
        F.col("org_label").alias("organization_identifier"),
        "labels",
        event_ts.alias("event_ts"),
        F.coalesce(
            F.col("series_reason"),
            first_reason((seconds.isNull(), "bad_timestamp"), (value.isNull(), "bad_value")),
        ).alias("reject_reason"),
    )
    return fail_on(out) if strict else out
