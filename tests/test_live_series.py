import random

import pytest
from test_series import close, increase, out, stretched

from tidegauge.streaming import live_grid, live_rates, run_available

STEP, START = 30_000, 10_000


def samples_in_time(rng, n):
    at = sorted(rng.sample(range(1_000, 2_000_000), n))
    return [(ms, float(rng.randrange(0, 50))) for ms in at]


@pytest.fixture(scope="module")
def samples():
    """A hot counter with resets, a sparse one, one that ends early and one with one sample."""
    rng = random.Random(8)
    series = {"hot": samples_in_time(rng, 500), "thin": samples_in_time(rng, 30), "one": [(700_000, 3.0)]}
    series["ends"] = [p for p in samples_in_time(rng, 60) if p[0] < 500_000]
    series["hot"].append((1_999_999, 7.0))
    return series


def streamed(spark, metrics, samples, tmp_path, build, late=()):
    """The rows that a stream gives which is stopped and started again after each of three parts
    of the time, each part in disorder; ``late`` samples come with the last part."""
    rng = random.Random(2)
    rows = [(ms, v, org) for org, points in samples.items() for ms, v in points]
    folder = str(tmp_path / "samples")
    for lower, upper in ((0, 600_000), (600_000, 1_300_000), (1_300_000, 2_000_001)):
        part = [("c", v, org, ms / 1000, {"l": "x"}) for ms, v, org in rows if lower <= ms < upper]
        if upper > 2_000_000:
            part += [("c", v, org, ms / 1000, {"l": "x"}) for ms, v, org in late]
        rng.shuffle(part)
        frame = metrics(*part)
        frame.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(frame.schema).parquet(folder)
        writer = build(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        writer = writer.option("checkpointLocation", str(tmp_path / "ck")).outputMode("append")
        query = run_available(writer.trigger(availableNow=True), 180)
    return spark.read.parquet(str(tmp_path / "out")), query


def rates(samples, window, until, value):
    expected = []
    for org, points in samples.items():
        for g in range(START - 3 * window // STEP * STEP, until + 1, STEP):
            inside = [p for p in points if g - window < p[0] <= g]
            if len(inside) > 1:
                expected.append(((org, g), value(inside, g) / (window / 1000)))
    return sorted(expected)


def gain(points, _):
    return increase([v for _, v in points])


# 1,999,999 and a microsecond less is 1,999,998 in the watermark's milliseconds
UNTIL = 1_999_998 - 60_000


@pytest.mark.parametrize("window,fold", [(300_000, 10_000), (50_000, None), (20_000, None)])
def test_live_rates_equal_brute_force_over_restarts(spark, metrics, samples, tmp_path, window, fold):
    got, _ = streamed(
        spark, metrics, samples, tmp_path,
        lambda s: live_rates(s, STEP, window, "60 seconds", START, fold_ms=fold),
    )
    close(out(got), rates(samples, window, UNTIL, gain))


def test_late_samples_are_not_counted_in(spark, metrics, samples, tmp_path):
    got, query = streamed(
        spark, metrics, samples, tmp_path,
        lambda s: live_rates(s, STEP, 60_000, "60 seconds", START, extrapolate=True),
        late=[(100_000, 9.0, "thin"), (200_000, 9.0, "hot"), (5_000, 1.0, "new")],
    )
    value = lambda points, g: stretched(points, g - 60_000, g)
    close(out(got), rates(samples, 60_000, UNTIL, value))
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped == 3
    # what the watermark has passed is gone from the state: at most a window of rows per series
    # of the last minutes is left
    assert query.lastProgress.stateOperators[0].numRowsTotal < 40


def test_one_batch_gives_all_instants(metrics, samples):
    frame = metrics(*[
        ("c", v, org, ms / 1000, {"l": "x"}) for org, points in samples.items() for ms, v in points
    ])
    got = live_rates(frame, STEP, 300_000, "0 seconds", START)
    close(out(got), rates(samples, 300_000, 2_400_000, gain))


@pytest.mark.parametrize("lookback", [300_000, 45_000, 10_000])
def test_live_grid_equals_brute_force_over_restarts(spark, metrics, samples, tmp_path, lookback):
    got, _ = streamed(
        spark, metrics, samples, tmp_path,
        lambda s: live_grid(s, STEP, "60 seconds", lookback, START),
    )
    expected = [
        ((org, g), inside[-1])
        for org, points in samples.items()
        for g in range(START, UNTIL + 1, STEP)
        if (inside := [v for ms, v in points if g - lookback < ms <= g])
    ]
    close(out(got), sorted(expected))


def test_empty_odd_and_repeated_samples(metrics):
    empty = metrics(("c", 1.0, "o", 1, None)).limit(0)
    assert live_rates(empty, STEP, 60_000, "0 seconds").count() == 0
    assert live_grid(empty, STEP, "0 seconds").count() == 0
    # a missing value takes no part, equal samples count as samples, ties take the largest
    odd = metrics(("c", None, "o", 2, None), ("c", 5.0, "o", 3, None), ("c", 5.0, "o", 3, None), ("c", 4.0, "o", 3, {}))
    assert out(live_rates(odd, STEP, STEP, "0 seconds")) == [(("o", 30_000), 1 / 30)]
    assert out(live_grid(odd, STEP, "0 seconds", STEP)) == [(("o", 30_000), 5.0)]
    with pytest.raises(ValueError):
        live_rates(odd, STEP, 60_000, "0 seconds", fold_ms=7_000)


def test_both_stages_are_plain_aggregations(metrics):
    frame = metrics(("c", 1.0, "o", 1, None))
    for plan in (live_rates(frame, STEP, 60_000, "0 seconds"), live_grid(frame, STEP, "0 seconds")):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Window [" not in text
