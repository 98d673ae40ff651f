"""Sources: landed provider pages and the range-pulling data source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.schema import INPUT_PAGES, ddl
from tidegauge.sources.cloudwatch import normalize_cloudwatch_logs, normalize_cloudwatch_metrics
from tidegauge.sources.datadog import normalize_datadog_logs, normalize_datadog_metrics
from tidegauge.sources.pages import PAGE_FILES
from tidegauge.sources.prometheus import normalize_prometheus_metrics, resolve_org
from tidegauge.sources.pull import (
    PulledPages,
    paged_pull_source,
    pull_ranges,
    register_paged_pull,
)

#: (provider, kind) -> function of (pages, input spec, query plan or None)
_NORMALIZERS: dict[tuple[str, str], Callable] = {
    ("cloudwatch", "logs"): lambda pages, spec, plan: normalize_cloudwatch_logs(pages),
    ("cloudwatch", "metrics"): lambda pages, spec, plan: normalize_cloudwatch_metrics(pages, plan),
    ("datadog", "logs"): lambda pages, spec, plan: normalize_datadog_logs(pages),
    ("datadog", "metrics"): lambda pages, spec, plan: normalize_datadog_metrics(
        pages, plan, keep_zero=spec.keep_zero
    ),
    ("prometheus", "metrics"): lambda pages, spec, plan: normalize_prometheus_metrics(
        pages, spec.prometheus
    ),
}


def normalizer_for(provider: str, kind: str) -> Callable:
    """The normaliser of a provider and record kind; unknown pairs are refused."""
    try:
        return _NORMALIZERS[(provider.lower(), kind.lower())]
    except KeyError:
        raise ValueError(f"No normalizer for {kind} from {provider}") from None


def register_normalizer(provider: str, kind: str, fn: Callable) -> None:
    """Add an adapter: ``fn(pages, input_spec, plan)`` to entries plus ``reject_reason``."""
    _NORMALIZERS[(provider.lower(), kind.lower())] = fn


def read_pages(
    spark: SparkSession, path: str, streaming: bool = False, fmt: str = "parquet", **options: str
) -> DataFrame:
    """The landed page table, as a batch or as a stream of newly landed files."""
    reader = (spark.readStream if streaming else spark.read).schema(ddl(INPUT_PAGES)).format(fmt)
    return reader.options(**options).load(path)


def land_pages(pages: DataFrame, path: str) -> None:
    """Append pages to the landed table, partitioned so that one input reads only its own.
    The rebalance hint evens out file sizes and splits a hot input over several tasks. Row groups
    are small, as a task that reads them holds a group's bodies."""
    columns = [
        (F.col(c) if c in pages.columns else F.lit(None)).cast(t).alias(c)
        for c, t in INPUT_PAGES.items()
    ]
    writer = pages.select(*columns).hint("rebalance", "stream_key").write.mode("append")
    writer.partitionBy("stream_key").options(**PAGE_FILES).parquet(path)


def read_ranges(
    spark: SparkSession, source: str = "paged_pull", streaming: bool = False, **options: str
) -> DataFrame:
    """Pages pulled per time range through a registered pull source."""
    reader = spark.readStream if streaming else spark.read
    return reader.format(source).options(**options).load()


__all__ = [
    "PAGE_FILES", "PulledPages", "land_pages", "normalize_cloudwatch_logs", "normalize_cloudwatch_metrics",
    "normalize_datadog_logs", "normalize_datadog_metrics", "normalize_prometheus_metrics",
    "normalizer_for", "paged_pull_source", "read_pages", "read_ranges", "register_normalizer",
    "pull_ranges", "register_paged_pull", "resolve_org",
]
