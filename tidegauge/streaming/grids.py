"""Rates and grids of live series.

Windows over rows are refused by streams; here both stages are windows of time, so state lives
in Spark's aggregations, is dropped behind the watermark and comes back after a restart. The
first stage folds the samples of a series to one row per ``fold_ms``, the second gathers the
folded rows of each grid instant's window. Both are keyed by series *and* time, so a series with
most of all samples is spread over its slots, and no state holds more than one slot's samples or
one window's folded rows. On a batch the same plans give the same rows, for all instants.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.series import (
    _extrapolated, _increase, _series_columns, _series_key,
)


def _ms(length: int) -> str:
    return f"{length} milliseconds"


def _slots(
    metrics: DataFrame, fold_ms: int, start_ms: int, lateness: str, step_ms: int, reach_ms: int
) -> DataFrame:
    """Samples with ``slot``, the time ``(end - fold, end]`` they fall in; ``reach_ms`` is how far
    an instant of the grid looks back. Samples without a value or a time take no part."""
    # windows of Spark hold their start and not their end; a microsecond earlier it is as wanted
    moved = F.timestamp_micros(F.unix_micros("event_ts") - 1)
    rows = metrics.where(F.col("value").isNotNull() & F.col("event_ts").isNotNull()).select(
        _series_key().alias("series"), F.unix_micros("event_ts").alias("at"),
        F.col("value").cast("double").alias("value"), moved.alias("moved"),
    )
    rows = rows.withWatermark("moved", lateness)
    if step_ms > reach_ms:
        # instants further apart than they look back: samples that none of them looks at; by the
        # watermark's own column, so that Spark keeps the filter behind the watermark
        ahead = F.pmod(F.lit(start_ms * 1000 - 1) - F.unix_micros("moved"), F.lit(step_ms * 1000))
        rows = rows.where(ahead < reach_ms * 1000)
    return rows.withColumn(
        "slot", F.window("moved", _ms(fold_ms), startTime=_ms(start_ms % fold_ms))
    )


def _instants(step_ms: int, start_ms: int, reach_ms: int) -> Column:
    """Windows that end at the instants of the grid, over folded rows."""
    length = max(reach_ms, step_ms)
    offset = (start_ms - length) % step_ms
    return F.window(F.window_time("slot"), _ms(length), _ms(step_ms), _ms(offset))


def _total(parts: Column, inside: Callable[[Column], Column], first: str, last: str) -> Column:
    """Increase over ordered parts: what each holds, and the step from one to the next."""
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("double").alias("last"))

    def add(so_far: Column, part: Column) -> Column:
        step = inside(part) + _increase(part[first], so_far["last"])
        return F.struct((so_far["sum"] + step).alias("sum"), part[last].alias("last"))

    return F.aggregate(parts, start, add, lambda state: state["sum"])


def live_rates(
    metrics: DataFrame, step_ms: int, window_ms: int, lateness: str, start_ms: int = 0,
    extrapolate: bool = False, fold_ms: int | None = None,
) -> DataFrame:
    """``rate_grid`` for a stream: the rate of each counter at every instant ``start + n * step``,
    over the samples in ``(t - window, t]``, once the watermark has passed the instant.

    Instants whose window holds fewer than two samples have no row, so a series that ends gives
    no more rows and leaves no state. Samples more than ``lateness`` behind the latest are not
    counted in; Spark shows their number in a query's progress. ``fold_ms`` divides step and
    window, by default it is the longest time that does; a shorter one bounds the state of a
    dense series. Needs the append mode.
    """
    fold_ms = fold_ms or math.gcd(step_ms, window_ms)
    if window_ms % fold_ms or step_ms % fold_ms:
        raise ValueError("fold_ms must divide window_ms and step_ms")
    readings = (
        _slots(metrics, fold_ms, start_ms, lateness, step_ms, window_ms)
        .groupBy("series", "slot")
        .agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("r"))
    )
    first, last = F.col("r")[0], F.element_at("r", -1)
    folded = readings.select(
        "series", "slot",
        F.struct(
            first["at"].alias("first_at"), last["at"].alias("last_at"),
            first["value"].alias("first_value"), last["value"].alias("last_value"),
            F.size("r").cast("bigint").alias("n"),
            _total(F.col("r"), lambda _: F.lit(0.0), "value", "value").alias("inside"),
        ).alias("part"),
    )
    windows = (
        folded.groupBy("series", _instants(step_ms, start_ms, window_ms).alias("w"))
        .agg(F.sort_array(F.collect_list("part")).alias("parts"), F.sum("part.n").alias("n"))
        .where(F.col("n") > 1)
    )
    total = _total(F.col("parts"), lambda p: p["inside"], "first_value", "last_value")
    if extrapolate:
        end = F.unix_micros("w.end")
        earliest, latest = F.col("parts")[0], F.element_at("parts", -1)
        total = _extrapolated(
            total, F.col("n"), earliest["first_at"], latest["last_at"], earliest["first_value"],
            end - window_ms * 1000, end,
        )
    rate = (total / F.lit(window_ms / 1000.0)).alias("value")
    return windows.select("series", rate, F.col("w.end").alias("event_ts")).select(
        *_series_columns()
    )


def live_grid(
    metrics: DataFrame, step_ms: int, lateness: str, lookback_ms: int = 300_000, start_ms: int = 0
) -> DataFrame:
    """``step_grid`` for a stream: the last sample of each series in ``(t - lookback, t]`` at every
    instant ``start + n * step``, once the watermark has passed the instant; of samples at one
    time the largest. Instants without a sample have no row. Late samples are as in ``live_rates``.
    """
    newest = F.max(F.struct("at", "value")).alias("s")
    reach = -(-lookback_ms // step_ms) * step_ms
    slots = _slots(metrics, step_ms, start_ms, lateness, step_ms, reach)
    per_slot = slots.groupBy("series", "slot").agg(newest)
    at_instants = per_slot.groupBy(
        "series", _instants(step_ms, start_ms, reach).alias("w")
    ).agg(F.max("s").alias("s"))
    fresh = F.col("s.at") > F.unix_micros("w.end") - lookback_ms * 1000
    return (
        at_instants.where(fresh)
        .select("series", F.col("s.value").alias("value"), F.col("w.end").alias("event_ts"))
        .select(*_series_columns())
    )
