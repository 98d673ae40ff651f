import math
import random

import pytest
from pyspark.sql import functions as F

from tidegauge import operators as op
from tidegauge.functions import to_millis


def out(df, *labels):
    names = [F.try_element_at("labels", F.lit(n)).alias(f"l_{n}") for n in labels]
    rows = df.select(*names, "organization_id", to_millis(F.col("event_ts")).alias("ms"), "value").collect()
    return sorted((tuple(r)[:-1], r["value"]) for r in rows)


def close(got, expected):
    assert [k for k, _ in got] == [k for k, _ in expected]
    for (key, a), (_, b) in zip(got, expected):
        assert math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) or (math.isnan(a) and math.isnan(b)), (key, a, b)


def increase(values):
    """Increase over readings, counting a drop as a reset."""
    return sum(b if b < a else b - a for a, b in zip(values, values[1:]))


@pytest.fixture
def counters(metrics):
    """A hot series with most samples, two sparse ones, and one with a single sample."""
    rng = random.Random(3)
    series = {"hot": 600, "a": 40, "b": 25, "single": 1}
    data = {
        org: sorted({rng.randrange(0, 4_000_000) for _ in range(n)}) for org, n in series.items()
    }
    samples = {org: [(ms, float(rng.randrange(0, 50))) for ms in at] for org, at in data.items()}
    rows = [("c", v, org, ms / 1000, {"l": "x"}) for org, s in samples.items() for ms, v in s]
    rng.shuffle(rows)
    return metrics(*rows), samples


@pytest.mark.parametrize("block_ms", [None, 60_000, 10_000_000, 7_000, 25_000])
def test_counter_rate_equals_brute_force(counters, block_ms):
    frame, samples = counters
    window = 60_000
    expected = []
    for org, points in samples.items():
        for at, _ in points:
            inside = [v for ms, v in points if at - window < ms <= at]
            expected.append(((org, at), increase(inside) / 60))
    close(out(op.counter_rate(frame, window, block_ms)), sorted(expected))


def stretched(points, start, end):
    """Increase of ``(ms, value)`` points extrapolated to the window borders."""
    gain = increase([v for _, v in points])
    sampled = points[-1][0] - points[0][0]
    apart = sampled / (len(points) - 1)
    before, after = points[0][0] - start, end - points[-1][0]
    before = apart / 2 if before >= apart * 1.1 else before
    after = apart / 2 if after >= apart * 1.1 else after
    if gain > 0 and points[0][1] >= 0:
        before = min(before, sampled * points[0][1] / gain)
    return gain * (sampled + before + after) / sampled


def test_extrapolated_rates_equal_brute_force(counters):
    frame, samples = counters
    start, end, step, window = 100_000, 3_900_000, 30_000, 300_000
    grid, at_samples = [], []
    for org, points in samples.items():
        for g in range(start, end + 1, step):
            inside = [p for p in points if g - window < p[0] <= g]
            if len(inside) > 1:
                grid.append(((org, g), stretched(inside, g - window, g) / 300))
        for g, _ in points:
            inside = [p for p in points if g - window < p[0] <= g]
            if len(inside) > 1:
                at_samples.append(((org, g), stretched(inside, g - window, g) / 300))
    close(out(op.rate_grid(frame, start, end, step, window, extrapolate=True)), sorted(grid))
    close(out(op.counter_rate(frame, window, extrapolate=True)), sorted(at_samples))
    small = op.counter_rate(frame, window, block_ms=20_000, extrapolate=True)
    close(out(small), sorted(at_samples))


def test_counter_rate_window_is_open_at_its_start(metrics):
    frame = metrics(*[("c", v, "o", s, None) for s, v in [(0, 1.0), (60, 4.0), (61, 9.0)]])
    assert [v for _, v in out(op.counter_rate(frame, 60_000))] == [0.0, 0.0, 5.0 / 60]


def test_rate_grid_equals_brute_force(counters):
    frame, samples = counters
    start, end, step, window = 100_000, 3_900_000, 30_000, 300_000
    expected = []
    for org, points in samples.items():
        for g in range(start, end + 1, step):
            inside = [v for ms, v in points if g - window < ms <= g]
            if len(inside) > 1:
                expected.append(((org, g), increase(inside) / 300))
    for fold in (None, 10_000, 1_000):
        close(out(op.rate_grid(frame, start, end, step, window, fold_ms=fold)), sorted(expected))
    # a window that is no multiple of the step
    uneven = [
        ((org, g), increase(inside) / 250)
        for org, points in samples.items()
        for g in range(start, end + 1, step)
        if len(inside := [v for ms, v in points if g - 250_000 < ms <= g]) > 1
    ]
    close(out(op.rate_grid(frame, start, end, step, 250_000)), sorted(uneven))
    with pytest.raises(ValueError):
        op.rate_grid(frame, start, end, step, window, fold_ms=7_000)


@pytest.mark.parametrize("lookback", [300_000, 20_000])
def test_step_grid_equals_brute_force(counters, lookback):
    frame, samples = counters
    start, end, step = 100_000, 3_900_000, 30_000
    expected = []
    for org, points in samples.items():
        for g in range(start, end + 1, step):
            inside = [v for ms, v in points if g - lookback < ms <= g]
            if inside:
                expected.append(((org, g), inside[-1]))
    close(out(op.step_grid(frame, start, end, step, lookback)), sorted(expected))


def test_long_grids_cross_block_borders(metrics):
    hour = 3600
    frame = metrics(*[("c", float(i), "o", i * hour, None) for i in range(60)])
    end = 60 * hour * 1000
    got = out(op.step_grid(frame, 0, end, 15_000, 1_800_000))
    assert len(got) == 60 * 120
    assert got[-1] == (("o", 59 * hour * 1000 + 1_785_000), 59.0)


@pytest.mark.parametrize(
    "stat, expected",
    [("Average", 2.0), ("avg", 2.0), ("Minimum", 1.0), ("MAXIMUM", 3.0), ("sum", 6.0), ("SampleCount", 3)],
)
def test_rollup_statistics(metrics, stat, expected):
    frame = metrics(*[("c", v, "o", s, None) for s, v in [(0, 1.0), (30, 2.0), (59.9, 3.0), (60, 9.0)]])
    rows = op.rollup(frame, 60, stat, ["organization_id"]).orderBy("period_start").collect()
    assert rows[0]["value"] == expected and len(rows) == 2
    with pytest.raises(ValueError):
        op.rollup(frame, 60, "p99")


def test_several_statistics_take_one_pass(metrics):
    frame = metrics(*[("c", v, "o", s, None) for s, v in [(0, 1.0), (30, 2.0), (60, 9.0)]])
    rolled = op.rollup(frame, 60, ["avg", "max", "count"], ["organization_id"])
    assert rolled._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    got = sorted((r.period_start.minute, r.statistic, r.value) for r in rolled.collect())
    assert got == [(0, "avg", 1.5), (0, "count", 2.0), (0, "max", 2.0),
                   (1, "avg", 9.0), (1, "count", 1.0), (1, "max", 9.0)]


def test_match_labels(metrics):
    frame = metrics(
        ("m", 1.0, "o", 0.0, {"env": "prod", "host": "web-1"}), ("m", 2.0, "o", 0.0, {"env": "prod"}),
        ("m", 3.0, "o", 0.0, {"env": "production", "host": "web-12\n"}), ("m", 4.0, "p", 0.0, None),
    )

    def got(*args):
        return sorted(r.value for r in op.match_labels(frame, *args).collect())

    assert got({"env": "prod"}) == [1.0, 2.0]
    assert got({"env": ""}) == [4.0]
    assert got({"host": ""}) == [2.0, 4.0]
    assert got(None, {"env": "prod"}) == [1.0, 2.0]
    assert got(None, {"env": "prod.*"}) == [1.0, 2.0, 3.0]
    assert got(None, {"host": "web-.*|"}) == [1.0, 2.0, 3.0, 4.0]
    assert got({"organization_id": "p"}) == [4.0]


def test_shift(metrics):
    assert out(op.shift_series(metrics(("m", 1.0, "o", 10.0, None)), 60)) == [(("o", 70_000), 1.0)]


def test_select_series(spark, metrics):
    frame = metrics(
        ("m", 1.0, "o", 0.0, {"env": "prod", "host": "a"}), ("m", 2.0, "o", 0.0, {"env": "prod"}),
        ("m", 3.0, "o", 0.0, {"env": "dev", "host": "a"}),
    )
    specs = spark.createDataFrame(
        [("p", {"env": "prod"}), ("pa", {"host": "a", "env": "prod"}), ("d", {"env": "dev"}), ("n", {"x": "y"})],
        "spec_id string, dims map<string,string>",
    )
    chosen = op.select_series(frame, specs, [["env"], ["env", "host"], ["x"]])
    assert sorted((r.spec_id, r.value) for r in chosen.collect()) == [
        ("d", 3.0), ("p", 1.0), ("p", 2.0), ("pa", 1.0)
    ]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_aggregate_by_and_ratio(metrics):
    rows = [("m", 1.0, "o1", 0.0, {"s": "a", "x": "1"}), ("m", 3.0, "o1", 0.0, {"s": "a", "x": "2"}),
            ("m", 5.0, "o2", 0.0, {"s": "b"}), ("m", 0.0, "o2", 60.0, {"s": "b"}), ("m", 7.0, "o2", 0.0, None)]
    frame = metrics(*rows)
    sums = {
        (r.labels.get("s"), r.organization_id, r.event_ts.minute): r.value
        for r in op.aggregate_by(frame, ["s"], "sum").collect()
    }
    assert sums == {("a", None, 0): 4.0, ("b", None, 0): 5.0, ("b", None, 1): 0.0, (None, None, 0): 7.0}
    means = {r.organization_id: r.value for r in op.aggregate_by(frame, ["organization_id"], "avg").collect()
             if r.event_ts.minute == 0}
    assert means == {"o1": 2.0, "o2": 6.0}


def test_ratio_stays_within_a_stream_and_refuses_duplicates(metrics):
    one, two = (metrics(("a", v, "p", 0.0, None), stream_key=k) for k, v in (("x", 2.0), ("y", 8.0)))
    both = op.merge_streams(one, two)
    got = op.series_ratio(both, both, ["organization_id"]).collect()
    assert sorted((r.stream_key, r.value) for r in got) == [("x", 1.0), ("y", 1.0)]
    with pytest.raises(Exception, match="several values"):
        op.series_ratio(both, op.merge_streams(one, one), ["organization_id"]).collect()


def test_select_series_refuses_a_spec_of_unlisted_dimensions(spark, metrics):
    specs = spark.createDataFrame([(1, {"zone": "a"})], "spec_id int, dims map<string,string>")
    with pytest.raises(Exception, match="not in dimension_sets"):
        op.select_series(metrics(("m", 1.0, "p", 0.0, {"host": "a"})), specs, [["host"]]).collect()


def test_ratio_divides_like_floating_point(metrics):
    left = metrics(("a", 1.0, "p", 0.0, None), ("a", 0.0, "q", 0.0, None), ("a", -1.0, "r", 0.0, None),
                   ("a", 6.0, "s", 0.0, None), ("a", 1.0, "alone", 0.0, None))
    right = metrics(("b", 0.0, "p", 0.0, None), ("b", 0.0, "q", 0.0, None), ("b", 0.0, "r", 0.0, None),
                    ("b", 4.0, "s", 0.0, None), ("b", 4.0, "s", 60.0, None))
    got = {r.organization_id: r.value for r in
           op.series_ratio(left, right, ["organization_id"]).collect()}
    assert got["p"] == math.inf and got["r"] == -math.inf and math.isnan(got["q"]) and got["s"] == 1.5
    assert "alone" not in got and len(got) == 4


def buckets(metrics, groups):
    return metrics(*[
        ("b", float(n), "o", 0.0, {"le": le, "g": g, "pod": pod})
        for g, pod, counts in groups for le, n in counts
    ])


def test_histogram_quantile(metrics):
    frame = buckets(metrics, [
        ("plain", "1", [("1", 10), ("2", 30), ("4", 40), ("+Inf", 40)]),
        ("plain", "2", [("1", 10), ("2", 30), ("4", 40), ("+Inf", 40)]),
        ("tail", "1", [("1", 1), ("+Inf", 10)]),
        ("negative", "1", [("-1", 5), ("1", 10), ("+Inf", 10)]),
        ("empty", "1", [("1", 0), ("+Inf", 0)]),
        ("open", "1", [("1", 5), ("2", 9)]),
        ("dip", "1", [("1", 10), ("2", 8), ("+Inf", 20)]),
        ("only", "1", [("+Inf", 5)]),
    ])

    def at(q):
        rows = op.histogram_quantile(frame, q, ["g"]).collect()
        assert len(rows) == 7
        return {r.labels["g"]: r.value for r in rows}

    half = at(0.5)
    assert half["plain"] == pytest.approx(1 + (40 - 20) / (60 - 20))
    assert half["tail"] == 1.0
    assert half["negative"] == -1.0
    assert math.isnan(half["empty"]) and math.isnan(half["open"]) and math.isnan(half["only"])
    assert half["dip"] == 1.0
    assert at(0.05)["plain"] == pytest.approx(0.2)
    assert at(0.99)["plain"] == pytest.approx(2 + 2 * (79.2 - 60) / 20)
    assert at(0.0)["plain"] == 0.0
    assert at(1.0)["plain"] == 4.0
    assert at(-0.1)["plain"] == -math.inf and at(1.1)["plain"] == math.inf


def test_hot_series_is_split_over_blocks(metrics):
    frame = metrics(("c", 1.0, "o", 0.0, None))
    for plan in (op.counter_rate(frame, 60_000), op.rate_grid(frame, 0, 10**7, 30_000, 300_000),
                 op.step_grid(frame, 0, 10**7, 30_000)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(series" in text and "block" in text
        assert "Cartesian" not in text and "NestedLoop" not in text
