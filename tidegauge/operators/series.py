"""Time-series operators: the queries a provider usually runs for its users.

All take and return metric entries unless said otherwise. Operators that look along a
series work on blocks of time, so that a series with very many samples is spread over
many tasks; the few samples a block needs from its neighbour are sent there as well.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rollup statistics by the spellings users write.
STATISTICS = {
    "average": "avg", "avg": "avg", "minimum": "min", "min": "min", "maximum": "max",
    "max": "max", "sum": "sum", "samplecount": "count", "sample_count": "count", "count": "count",
}

#: Columns that a label name may also refer to.
IDENTITY = ("stream_key", "metric_name", "organization_id")


def statistic(name: str, value: Column) -> Column:
    """The aggregate of a statistic name."""
    kind = STATISTICS.get(name.lower())
    if kind is None:
        raise ValueError(f"invalid statistic {name!r}")
    if kind == "avg":
        return F.sum(value).cast("double") / F.count(value)
    return {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}[kind](value)


def rollup(
    df: DataFrame, period_s: int, stat: str | Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """``(by..., period_start, value)``: one statistic per aligned period, or with several
    statistics ``(by..., period_start, statistic, value)`` from one pass over the data.
    Works on streams with a watermark on ``event_ts``; partial aggregates are formed before
    the shuffle."""
    period = F.window("event_ts", f"{period_s} seconds").alias("_period")
    grouped = df.groupBy(*by, period)
    start = F.col("_period.start").alias("period_start")
    if isinstance(stat, str):
        rolled = grouped.agg(statistic(stat, F.col("value")).alias("value"))
        return rolled.select(*by, start, "value")
    wide = grouped.agg(*[statistic(s, F.col("value")).alias(f"_s{i}") for i, s in enumerate(stat)])
    cells = F.array(
        *[
            F.struct(F.lit(s).alias("statistic"), F.col(f"_s{i}").cast("double").alias("value"))
            for i, s in enumerate(stat)
        ]
    )
    return wide.select(*by, start, F.inline(cells))


# --- labels -------------------------------------------------------------------------


def label(name: str) -> Column:
    """A label by name; identity columns can be named like labels."""
    if name in IDENTITY:
        return F.col(name)
    # a plain map access: Spark resolves it at plan time when the map is built in the plan
    return F.col("labels")[name]


def match_labels(
    metrics: DataFrame,
    eq: Mapping[str, str] | None = None,
    regex: Mapping[str, str] | None = None,
) -> DataFrame:
    """Keep series whose labels equal a value or match a regex in full. An absent label
    counts as empty text."""
    for name, value in (eq or {}).items():
        metrics = metrics.where(F.coalesce(label(name), F.lit("")) == value)
    for name, pattern in (regex or {}).items():
        metrics = metrics.where(
            F.coalesce(label(name), F.lit("")).rlike(rf"(?s)\A(?:{pattern})\z")
        )
    return metrics


def shift_series(metrics: DataFrame, seconds: int) -> DataFrame:
    """Present samples ``seconds`` later, so that a query at t sees the value of t - offset."""
    shift = F.expr(f"interval {int(seconds)} seconds")
    return metrics.withColumn("event_ts", F.col("event_ts") + shift)


def select_series(
    metrics: DataFrame, specs: DataFrame, dimension_sets: Sequence[Sequence[str]]
) -> DataFrame:
    """Join each sample to the specs whose dimensions it carries with equal values.

    ``specs`` is ``(spec_id, dims map)``; ``dimension_sets`` lists the distinct sets of
    dimension names they use, usually one. A spec matches on the values of its set, which
    makes this an equality join instead of a test of every pair. A sample is repeated at
    most once per set.
    """
    sets = [tuple(sorted(names)) for names in dimension_sets]

    def option(no: int, names: Sequence[str]) -> Column:
        values = F.array(*[label(name) for name in names]).cast("array<string>")
        complete = reduce(lambda a, b: a & b, [label(name).isNotNull() for name in names])
        return F.when(complete, F.struct(F.lit(no).alias("set_no"), values.alias("vals")))

    names_of = {no: F.array(*[F.lit(n) for n in names]) for no, names in enumerate(sets)}
    own_names = F.sort_array(F.map_keys("dims"))
    unlisted = F.raise_error(
        F.concat(F.lit("dimension names not in dimension_sets: "), F.to_json("dims"))
    )
    own_set = F.coalesce(
        *[F.when(own_names == v, F.lit(no)) for no, v in names_of.items()], unlisted.cast("int")
    )
    lookup = specs.select(
        "spec_id",
        own_set.alias("_set"),
        F.transform(own_names, lambda n: F.try_element_at(F.col("dims"), n)).alias("_vals"),
    )
    options = F.array(*[option(no, names) for no, names in enumerate(sets)])
    candidates = metrics.withColumn("_key", F.explode(options)).where(F.col("_key").isNotNull())
    joined = candidates.join(
        lookup,
        (F.col("_key.set_no") == F.col("_set")) & (F.col("_key.vals") == F.col("_vals")),
    )
    return joined.select("spec_id", *metrics.columns)


def aggregate_by(
    metrics: DataFrame, labels: Sequence[str], fn: str, metric_name: str | None = None
) -> DataFrame:
    """``fn by (labels)`` at each instant. Other labels are dropped; the organisation is
    kept when it is among ``labels``."""
    keys = {f"_l{i}": name for i, name in enumerate(labels)}
    grouped = metrics.groupBy(
        "stream_key", "metric_name", "event_ts", *[label(n).alias(k) for k, n in keys.items()]
    ).agg(statistic(fn, F.col("value")).cast("double").alias("value"))
    return _rebuilt(grouped, keys, metric_name)


def _rebuilt(grouped: DataFrame, keys: Mapping[str, str], metric_name: str | None) -> DataFrame:
    """Metric entries from grouped rows whose label columns are named by ``keys``."""
    by_name = {name: key for key, name in keys.items()}
    pairs = F.array(
        *[F.struct(F.lit(n).alias("key"), F.col(k).alias("value")) for k, n in keys.items()
          if n not in IDENTITY]
    ).cast("array<struct<key:string,value:string>>")
    org = F.col(by_name["organization_id"]) if "organization_id" in by_name else F.lit(None)
    return grouped.select(
        "stream_key",
        (F.lit(metric_name) if metric_name else F.col("metric_name")).alias("metric_name"),
        "value",
        org.cast("string").alias("organization_id"),
        F.lit(None).cast("string").alias("organization_identifier"),
        F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull())).alias("labels"),
        "event_ts",
    )


def series_ratio(
    left: DataFrame, right: DataFrame, labels: Sequence[str], metric_name: str = "ratio"
) -> DataFrame:
    """``left / right`` where stream, label values and instant agree, in floating point:
    division by zero gives an infinity or NaN. Several rows of a side for one stream, label set
    and instant fail the job."""
    keys = {f"_l{i}": name for i, name in enumerate(labels)}

    by = ["stream_key", "event_ts", *keys]

    def side(df: DataFrame, value: str) -> DataFrame:
        named = df.select(
            "stream_key", "event_ts", "value",
            *[F.coalesce(label(n), F.lit("")).alias(k) for k, n in keys.items()],
        )
        several = F.raise_error(F.lit("a label set has several values at one instant"))
        once = F.when(F.count(F.lit(1)) == 1, F.max("value")).otherwise(several.cast("double"))
        return named.groupBy(*by).agg(once.alias(value))

    # the sums' shuffle serves the join
    joined = side(left, "_a").join(side(right, "_b"), by)
    a, b = F.col("_a"), F.col("_b")
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    by_zero = F.when(F.isnan(a) | (a == 0), nan).when(a > 0, inf).otherwise(-inf)
    value = F.when(b == 0, by_zero).otherwise(F.try_divide(a, b))
    restored = joined.select(
        "stream_key", "event_ts", value.alias("value"),
        F.lit(metric_name).alias("metric_name"),
        *[F.nullif(F.col(k), F.lit("")).alias(k) for k in keys],
    )
    return _rebuilt(restored, keys, None)


# --- along a series -----------------------------------------------------------------


def _series_key() -> Column:
    """Exact identity of a series, usable as a grouping key."""
    entries = F.sort_array(
        F.map_entries(F.coalesce(F.col("labels"), F.create_map().cast("map<string,string>")))
    )
    return F.struct(
        "stream_key", "metric_name", "organization_id", "organization_identifier",
        entries.alias("labels"),
    )


def _series_columns(has_labels: str = "series.labels") -> list[Column]:
    return [
        F.col("series.stream_key").alias("stream_key"),
        F.col("series.metric_name").alias("metric_name"),
        F.col("value"),
        F.col("series.organization_id").alias("organization_id"),
        F.col("series.organization_identifier").alias("organization_identifier"),
        F.map_from_entries(has_labels).alias("labels"),
        F.col("event_ts"),
    ]


def _home_block(at: str, width: int) -> Column:
    """Block of an instant. Never null, so that joins on it add no null filters, which would
    keep Spark from sharing one shuffle between both sides."""
    return F.coalesce(F.floor(F.col(at) / F.lit(width)), F.lit(0).cast("bigint"))


def _in_blocks(rows: DataFrame, at: str, width: int, before: int = 0, after: int = 0) -> DataFrame:
    """Assign rows to blocks ``[b*width, (b+1)*width)`` of ``at``.

    A row is repeated, with ``own`` false, in each other block that looks at it: blocks
    starting less than ``before`` after it, and blocks ending at most ``after`` before it.
    """
    first = F.floor((F.col(at) - F.lit(after)) / F.lit(width))
    last = F.floor((F.col(at) + F.lit(before)) / F.lit(width))
    home = _home_block(at, width)
    return rows.withColumn("block", F.explode(F.sequence(first, last))).withColumn(
        "own", F.col("block") == home
    )


def _extrapolated(
    increase: Column, n: Column, first_us: Column, last_us: Column, first_value: Column,
    start_us: Column, end_us: Column,
) -> Column:
    """Increase stretched to the window borders the way Prometheus documents it: up to the
    border when that is within 1.1 sample distances, else by half a distance, and at the
    start no further than where the counter would have been zero."""
    sampled = (last_us - first_us).cast("double")
    apart = sampled / (n - 1)
    to_start, to_end = (first_us - start_us).cast("double"), (end_us - last_us).cast("double")

    def reach(gap: Column) -> Column:
        return F.when(gap >= apart * 1.1, apart / 2).otherwise(gap)

    to_zero = F.when(
        (increase > 0) & (first_value >= 0), F.try_divide(sampled * first_value, increase)
    )
    before = F.least(reach(to_start), F.coalesce(to_zero, reach(to_start)))
    return increase * F.try_divide(sampled + before + reach(to_end), sampled)


def _increase(value: Column, previous: Column) -> Column:
    """Increase of a counter over its previous reading; a drop is a reset, after which the
    reading counts whole."""
    return (
        F.when(previous.isNull(), F.lit(0.0)).when(value < previous, value)
        .otherwise(value - previous)
    )


def _up_to_here(*keys: str, order: Sequence[Column]):
    return (
        Window.partitionBy(*keys).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _running_increase(rows: DataFrame) -> DataFrame:
    """Add ``sum`` and ``no``: increase and number of samples since the start of the block."""
    order = Window.partitionBy("series", "block").orderBy("at", "value")
    step = rows.withColumn("step", _increase(F.col("value"), F.lag("value").over(order)))
    running = _up_to_here("series", "block", order=[F.col("at"), F.col("value")])
    return step.withColumn("sum", F.sum("step").over(running)).withColumn(
        "no", F.row_number().over(order).cast("bigint")
    )


def _running_increase_over_blocks(rows: DataFrame) -> DataFrame:
    """The same since the start of the series: each block's own sums, plus what the earlier
    blocks add up to, which takes one row per block."""
    local = _running_increase(rows)
    totals = local.groupBy("series", "block").agg(
        F.sum("step").alias("inside"),
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("at", "value")).getField("value").alias("first_value"),
        F.max(F.struct("at", "value")).getField("value").alias("last_value"),
    )
    order = Window.partitionBy("series").orderBy("block")
    bridge = _increase(F.col("first_value"), F.lag("last_value").over(order))
    bridged = totals.withColumn("bridge", bridge)
    to_here = _up_to_here("series", order=[F.col("block")])
    starts = bridged.select(
        "series",
        "block",
        (F.sum(F.col("inside") + F.col("bridge")).over(to_here) - F.col("inside")).alias("_sum0"),
        (F.sum("n").over(to_here) - F.col("n")).alias("_no0"),
    )
    return local.join(starts, ["series", "block"]).select(
        "series", "block", "at", "value",
        (F.col("sum") + F.col("_sum0")).alias("sum"), (F.col("no") + F.col("_no0")).alias("no"),
    )


def _sample() -> Column:
    """The row as a sample, null when it is a question."""
    return F.when(F.col("is_question") == 0, F.struct("pos", "at", "value", "sum", "no"))


def _first_in_window(posed: DataFrame) -> DataFrame:
    """Per question, ``first``: the first sample behind its ``pos`` within the block, found by
    reading the block backwards and keeping the last sample passed."""
    backwards = _up_to_here(
        "series", "block",
        # at one instant questions come first: a window does not hold its left end
        order=[F.desc("pos"), F.desc("is_question"), F.desc("value")],
    )
    first = F.last(_sample(), ignorenulls=True).over(backwards)
    return posed.withColumn("first", first).where(F.col("is_question") == 1)


def counter_rate(
    metrics: DataFrame, window_ms: int, block_ms: int | None = None, extrapolate: bool = False
) -> DataFrame:
    """Per-second rate of a counter at each of its samples, over the samples in
    ``(t - window, t]``. A drop of the counter is a reset: the new reading counts whole.
    The window's first sample is the base, so a window with one sample has rate zero.
    ``extrapolate`` stretches the increase to the window borders as Prometheus does, and
    leaves out windows with a single sample.

    Every sample knows the running increase, and asks for it at the first sample of its
    window; the difference is the answer. The cost is linear in the samples, whatever the
    window holds. Blocks of time spread a long series over tasks. By default they span four
    windows, and one shuffle does. For a series so dense that a window of it is too much
    for one task, give a ``block_ms`` below the window: blocks are then summed up on their
    own and linked through one row per block, at the price of a second shuffle.
    """
    window_us = window_ms * 1000
    width = (block_ms or 4 * window_ms) * 1000
    rows = metrics.select(
        _series_key().alias("series"), F.unix_micros("event_ts").alias("at"), "value"
    )
    if width >= window_us:
        summed = _running_increase(_in_blocks(rows, "at", width, before=window_us))
        asked = F.array(
            F.struct(F.col("at").alias("pos"), F.lit(0).alias("is_question")),
            F.struct((F.col("at") - window_us).alias("pos"), F.lit(1).alias("is_question")),
        )
        posed = summed.withColumn("_p", F.explode(asked)).select(
            "series", "block", "own", "at", "value", "sum", "no", "_p.*"
        )
        answered = _first_in_window(posed.where((F.col("is_question") == 0) | F.col("own")))
    else:
        home = rows.withColumn("block", _home_block("at", width))
        answered = _asked_across_blocks(_running_increase_over_blocks(home), window_us, width)
    total = F.col("sum") - F.col("first.sum")
    if extrapolate:
        n = F.col("no") - F.col("first.no") + 1
        answered = answered.where(n > 1)
        total = _extrapolated(
            total, n, F.col("first.at"), F.col("at"), F.col("first.value"),
            F.col("at") - window_us, F.col("at"),
        )
    return answered.select(
        "series",
        F.timestamp_micros("at").alias("event_ts"),
        (total / F.lit(window_ms / 1000.0)).alias("value"),
    ).select(*_series_columns())


def _asked_across_blocks(summed: DataFrame, window_us: int, width: int) -> DataFrame:
    """Samples moved forward by the window meet the questions of that time. A question with
    no sample behind it in its block takes the first sample of the next block that has one."""
    asked = F.array(
        F.struct((F.col("at") + window_us).alias("pos"), F.lit(0).alias("is_question")),
        F.struct(F.col("at").alias("pos"), F.lit(1).alias("is_question")),
    )
    posed = (
        summed.withColumn("_p", F.explode(asked))
        .select("series", "at", "value", "sum", "no", "_p.*")
        .withColumn("block", _home_block("pos", width))
        # shuffled once, for the heads as well as for the answers
        .repartition("series", "block")
    )
    heads = posed.groupBy("series", "block").agg(F.min(_sample()).alias("head"))
    later = (
        Window.partitionBy("series").orderBy(F.desc("block"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    following = heads.select(
        "series", "block", F.last("head", ignorenulls=True).over(later).alias("next")
    )
    answered = _first_in_window(posed).join(following, ["series", "block"])
    return answered.withColumn("first", F.coalesce("first", "next"))


def step_grid(
    metrics: DataFrame, start_ms: int, end_ms: int, step_ms: int, lookback_ms: int = 300_000
) -> DataFrame:
    """Value of each series at ``start, start + step, ...`` up to ``end``: its last sample in
    ``(t - lookback, t]``; instants without one have no row.

    No series is crossed with the grid. Samples are first reduced to the last one before
    each grid instant, which combines before the shuffle; each of those then fills the
    instants up to the next one.
    """
    first_us, step_us, look_us = start_ms * 1000, step_ms * 1000, lookback_ms * 1000
    slots = (end_ms - start_ms) // step_ms
    at = F.unix_micros("event_ts")
    in_reach = (at > F.lit(first_us - look_us)) & (at <= F.lit(first_us + slots * step_us))
    slot = F.greatest(
        F.lit(0).cast("bigint"), F.ceil((at - F.lit(first_us)) / F.lit(float(step_us)))
    )
    reduced = (
        metrics.where(in_reach)
        .groupBy(_series_key().alias("series"), slot.cast("bigint").alias("slot"))
        .agg(F.max(F.struct(at.alias("at"), F.col("value").alias("value"))).alias("s"))
        .select("series", "slot", "s.at", "s.value")
    )
    reach = -(-lookback_ms // step_ms)
    width = max(16 * reach, 1024)
    blocks = _in_blocks(reduced, "slot", width, after=reach)
    nxt = F.lead("slot").over(Window.partitionBy("series", "block").orderBy("slot"))
    # last slot still closer than the lookback to the sample
    stale = F.floor((F.col("at") + F.lit(look_us - 1) - F.lit(first_us)) / F.lit(float(step_us)))
    until = F.least(stale, F.coalesce(nxt - 1, F.lit(slots)), F.lit(slots)).cast("bigint")
    filled = (
        blocks.withColumn("_until", until)
        .where(F.col("own") & (F.col("_until") >= F.col("slot")))
        .select("series", "value", F.explode(F.sequence("slot", "_until")).alias("slot"))
    )
    grid_ts = F.timestamp_micros(F.lit(first_us) + F.col("slot") * F.lit(step_us))
    return filled.select("series", "value", grid_ts.alias("event_ts")).select(*_series_columns())


def rate_grid(
    metrics: DataFrame, start_ms: int, end_ms: int, step_ms: int, window_ms: int,
    extrapolate: bool = False, fold_ms: int | None = None,
) -> DataFrame:
    """Counter rate at ``start, start + step, ...`` up to ``end``, over the samples in
    ``(t - window, t]``. Instants whose window holds fewer than two samples have no row.
    ``extrapolate`` is as in ``counter_rate``.

    Samples are folded to one row per series and ``fold_ms`` first, which divides step and
    window; by default it is the longest time that does. The windows then run over those
    rows, however many samples a hot series has.
    """
    fold_ms = fold_ms or math.gcd(step_ms, window_ms)
    if window_ms % fold_ms or step_ms % fold_ms:
        raise ValueError("fold_ms must divide window_ms and step_ms")
    first_us, step_us, fold_us = start_ms * 1000, step_ms * 1000, fold_ms * 1000
    steps, parts = (end_ms - start_ms) // step_ms, step_ms // fold_ms
    span, slots = window_ms // fold_ms, steps * parts
    at = F.unix_micros("event_ts")
    slot = F.ceil((at - F.lit(first_us)) / F.lit(float(fold_us))).cast("bigint")
    rows = metrics.select(
        _series_key().alias("series"), at.alias("at"), "value", slot.alias("slot")
    ).where((F.col("slot") > -span) & (F.col("slot") <= slots))
    in_slot = Window.partitionBy("series", "slot").orderBy("at", "value")
    folded = (
        rows.withColumn("step", _increase(F.col("value"), F.lag("value").over(in_slot)))
        .groupBy("series", "slot")
        .agg(
            F.sum("step").alias("inside"),
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("at", "value")).getField("value").alias("first_value"),
            F.max(F.struct("at", "value")).getField("value").alias("last_value"),
            F.min("at").alias("first_at"),
            F.max("at").alias("last_at"),
        )
    )
    # a window looks back over `span` slots, so a block needs as many of its predecessor
    blocks = _in_blocks(folded, "slot", max(16 * span, 1024), before=span)
    order = Window.partitionBy("series", "block").orderBy("slot")
    bridged = blocks.withColumn(
        "bridge", _increase(F.col("first_value"), F.lag("last_value").over(order))
    )
    # instants (in steps) whose window holds the slot; rows of one series and block sit in one
    # task, where they combine per instant before the shuffle
    earliest = F.greatest(F.ceil(F.col("slot") / F.lit(float(parts))).cast("bigint"), F.lit(0))
    latest = F.least(
        F.floor((F.col("slot") + span - 1) / F.lit(float(parts))).cast("bigint"), F.lit(steps)
    )
    windows = (
        bridged.where(F.col("own") & (earliest <= latest))
        .withColumn("instant", F.explode(F.sequence(earliest, latest)))
        .groupBy("series", "instant")
        .agg(
            F.sum(F.col("inside") + F.col("bridge")).alias("total"),
            F.min_by("bridge", "slot").alias("base"),
            F.min_by("first_value", "slot").alias("first_value"),
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"),
            F.sum("n").alias("n"),
        )
        .where(F.col("n") > 1)
    )
    instant_us = F.lit(first_us) + F.col("instant") * F.lit(step_us)
    total = F.col("total") - F.col("base")
    if extrapolate:
        total = _extrapolated(
            total, F.col("n"), F.col("first_at"), F.col("last_at"), F.col("first_value"),
            instant_us - window_ms * 1000, instant_us,
        )
    return windows.select(
        "series",
        (total / F.lit(window_ms / 1000.0)).alias("value"),
        F.timestamp_micros(instant_us).alias("event_ts"),
    ).select(*_series_columns())


def histogram_quantile(
    buckets: DataFrame, q: float, labels: Sequence[str], metric_name: str = "quantile"
) -> DataFrame:
    """Quantile from cumulative buckets labelled ``le``, by ``labels`` and instant.

    Buckets are summed per bound first. The bucket in which the rank falls is interpolated
    linearly from its lower bound, zero for the first bucket; in the infinite bucket the
    highest finite bound is the answer. Without an infinite bucket, or without
    observations, the result is NaN.
    """
    keys = {f"_l{i}": name for i, name in enumerate(labels)}
    bound = label("le").try_cast("double")
    summed = (
        buckets.where(bound.isNotNull())
        .groupBy(
            "stream_key", "event_ts", *[label(n).alias(k) for k, n in keys.items()],
            bound.alias("le"),
        )
        .agg(F.sum("value").cast("double").alias("count"))
    )
    group = Window.partitionBy("stream_key", "event_ts", *keys)
    upward = group.orderBy("le")
    running = upward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # bucket counts may dip when scraped at different moments; a running maximum repairs them
    steady = (
        summed.withColumn("cum", F.max("count").over(running))
        .withColumn("top", F.max("le").over(group))
        .withColumn("total", F.max("cum").over(group))
        .withColumn("lower", F.lag("le").over(upward))
        .withColumn("below", F.coalesce(F.lag("cum").over(upward), F.lit(0.0)))
        .withColumn("place", F.row_number().over(upward))
    )
    infinite, nan = F.lit(float("inf")), F.lit(float("nan"))
    undefined = (F.col("top") < infinite) | (F.col("total") == 0) | F.isnan("total")
    rank = F.lit(float(q)) * F.col("total")
    first = F.col("place") == 1
    holds_rank = (F.col("cum") >= rank) & (first | (F.col("below") < rank))
    if q < 0 or q > 1:
        # outside [0, 1] the answer is an infinity, in one row per group
        chosen = steady.where(first)
        value = F.when(undefined, nan).otherwise(F.lit(float("-inf" if q < 0 else "inf")))
    else:
        chosen = steady.where(F.when(undefined, first).otherwise(holds_rank))
        lower = F.when(first, F.lit(0.0)).otherwise(F.col("lower"))
        share = F.try_divide(rank - F.col("below"), F.col("cum") - F.col("below"))
        inside = lower + (F.col("le") - lower) * F.coalesce(share, F.lit(0.0))
        value = (
            F.when(undefined, nan)
            .when(F.col("le") == infinite, F.when(first, nan).otherwise(F.col("lower")))
            .when(first & (F.col("le") <= 0), F.col("le"))
            .otherwise(inside)
        )
    named = chosen.select(
        "stream_key", "event_ts", F.lit(metric_name).alias("metric_name"), value.alias("value"),
        *keys,
    )
    return _rebuilt(named, keys, None)
