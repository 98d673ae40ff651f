"""Metric queries an input runs, one row per dimension or tag set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.schema import QUERY_PLAN

# Fixed value: queries one CloudWatch request may hold.
QUERIES_PER_REQUEST = 500


def cloudwatch_query_plan(specs: DataFrame, chunk: int = QUERIES_PER_REQUEST) -> DataFrame:
    """Expand ``(stream_key, namespace, metric_name, period, statistic,
    organization_identifier, metric_queries)`` to one row per dimension set.

    The organisation is the value of the identifying dimension; a set without it has a null
    organisation, which spec checks refuse and decoding reports as ``unknown_query``.
    """
    sets = specs.select("*", F.posexplode("metric_queries").alias("query_index", "_dims"))
    org = F.filter("_dims", lambda d: d["name"] == F.col("organization_identifier"))
    dims = F.array_join(
        F.transform("_dims", lambda d: F.concat(d["name"], F.lit("="), d["value"])), ","
    )
    return _plan(
        sets.withColumn("_org", F.try_element_at(org, F.lit(1)).getField("value")),
        query_id=F.format_string(
            "%s_query_%d", F.lower("metric_name"), F.col("query_index")
        ),
        text=F.format_string(
            "%s:%s/%s{%s} by %ds", "statistic", "namespace", "metric_name", dims, "period"
        ),
        chunk_no=F.floor(F.col("query_index") / chunk),
    )


def datadog_query_plan(specs: DataFrame) -> DataFrame:
    """Expand ``(stream_key, metric_name, statistic, metric_tag_data)`` to one row per tag
    set, with the query text the provider takes."""
    sets = specs.select("*", F.posexplode("metric_tag_data").alias("query_index", "_tag"))
    return _plan(
        sets.withColumn("_org", F.col("_tag")["customer_value"]),
        query_id=F.col("_org"),
        text=F.format_string("%s:%s{%s}", "statistic", "metric_name", F.col("_tag")["tag_string"]),
        chunk_no=F.lit(0),
    )


def _plan(rows: DataFrame, query_id, text, chunk_no) -> DataFrame:
    plan = rows.select(
        "stream_key",
        "metric_name",
        "query_index",
        query_id.alias("query_id"),
        F.col("_org").alias("organization_id"),
        text.alias("query_text"),
        chunk_no.alias("chunk_no"),
    )
    return plan.select(*[F.col(c).cast(t).alias(c) for c, t in QUERY_PLAN.items()])


def metric_query_plan(specs: DataFrame) -> DataFrame:
    """The plan of either provider's specs, told apart by their columns."""
    if "metric_queries" in specs.columns:
        return cloudwatch_query_plan(specs)
    return datadog_query_plan(specs)
