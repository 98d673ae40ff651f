import json

import pytest
from pyspark.sql import functions as F

from tidegauge import operators as op
from tidegauge.functions import object_text
from tidegauge.operators import OffsetTable
from tidegauge.plans.flow import build_flow, commit_ranges, fetch_ranges, input_table, next_ranges
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
    OutputSpec,
    PrometheusQuery,
)

ORG = LogField("organization_id", path="user")
LOGS = LogFilter((ORG, LogField("level", path="level"),
                  LogField("duration", path="ms", field_type="integer", hash=True)))
START = OffsetSpec(1_000)
QUERY = PrometheusQuery("q", "up", "customer", fallback_org_id="f")

CW_LOGS = InputSpec("cw", "CloudWatch", "logs", START, filters=LOGS)
DD_METRICS = InputSpec(
    "dd", "datadog", "metrics", START,
    datadog=DatadogMetrics("t.m", 60, "AVERAGE", "c",
                           (DatadogTagSet("c1", "c:c1"), DatadogTagSet("c2", "c:c2"))),
)
PROM = InputSpec("pm", "prometheus", "metrics", START, prometheus=(QUERY,),
                 filters=MetricFilter((MetricField("job"), MetricField("customer", hash=True))))


@pytest.fixture
def mixed(pages):
    logs = {"events": [
        {"eventId": "l1", "timestamp": 1000, "message": json.dumps({"user": "u", "level": "INFO", "ms": 250})},
        {"eventId": "l2", "timestamp": 2000, "message": json.dumps({"user": "v", "level": "WARN"})},
        {"eventId": "l3", "timestamp": 3000, "message": "noise"},
    ]}
    series = {"data": {"attributes": {"series": [{"query_index": 0}, {"query_index": 1}],
                                      "times": [1000, 2000], "values": [[1.0, 2.0], [3.0, 4.0]]}}}
    matrix = {"data": {"result": [{"metric": {"customer": "acme", "job": "j", "pod": "p"},
                                   "values": [[1, "5"]]}]}}
    return (
        pages("cloudwatch", "logs", logs, stream_key="cw")
        .unionAll(pages("datadog", "metrics", series, stream_key="dd"))
        .unionAll(pages("prometheus", "metrics", matrix, stream_key="pm"))
    )


def test_mixed_inputs(spark, mixed):
    flow = build_flow(spark, FlowSpec([CW_LOGS, DD_METRICS, PROM]), mixed)
    rows = flow.events.select("stream_key", "organization_id", object_text(F.col("entries")).alias("v")).collect()
    values = {(r.stream_key, r.organization_id, r.v) for r in rows}
    assert len(rows) == 7
    assert sum(s == "dd" and "t_m" in v for s, _, v in values) == 4
    logs = {o: json.loads(v) for s, o, v in values if s == "cw"}
    assert len(logs["u"]["duration"]) == 64 and "duration" not in logs["v"]
    prom = [(o, json.loads(v)) for s, o, v in values if s == "pm"]
    assert len(prom[0][0]) == 64 and prom[0][1] == {"up": 5.0, "job": "j"}
    assert [(r.stream_key, r.idempotency_key, r.reject_reason) for r in flow.rejects.collect()] == [
        ("cw", "l3", "parse_error")
    ]


def test_single_input_transform_predicate_and_delivery(spark, mixed, tmp_path):
    only = InputSpec("cw", "cloudwatch", "logs", START, filters=LOGS, predicate="content like '%WARN%'")
    out = OutputSpec("table", path=str(tmp_path / "out"))
    flow = build_flow(spark, FlowSpec([only], out), mixed.unionAll(mixed),
                      transforms=[lambda df: df.withColumn("organization_id", F.upper("organization_id"))])
    assert flow.events.count() == 2
    flow.deliver()
    stored = spark.read.parquet(out.path).collect()
    assert [(r.organization_id, r.idempotency_key) for r in stored] == [("V", "l2")]


def test_ranges_of_inputs(spark, tmp_path, mixed):
    shared = [
        InputSpec("cw", "cloudwatch", "logs", START, filters=LOGS),
        InputSpec("cw", "cloudwatch", "logs", OffsetSpec(50_000), filters=LOGS),
        InputSpec("pm", "prometheus", "metrics", OffsetSpec(10_000, store="delivered"), prometheus=(QUERY,)),
    ]
    spec = FlowSpec(shared)
    assert [r.offset_key for r in input_table(spark, spec).orderBy("pos").collect()] == ["cw_0", "cw_1", "pm"]
    table = OffsetTable(spark, str(tmp_path / "o"))
    delivered = build_flow(spark, FlowSpec([PROM]), mixed).events
    ranges = next_ranges(spark, spec, 100_000, offsets=table, delivered=delivered).collect()
    got = {}
    for r in ranges:
        got.setdefault(r.stream_key, []).append((r.start_ms, r.end_ms))
    assert {k: sorted(v) for k, v in got.items()} == {
        "cw_0": [(1_000, 25_000), (25_000, 49_000), (49_000, 73_000), (73_000, 97_000), (97_000, 100_000)],
        "cw_1": [(50_000, 74_000), (74_000, 98_000), (98_000, 100_000)],
        "pm": [(10_000, 70_000), (70_000, 100_000)],
    }
    with pytest.raises(ValueError):
        next_ranges(spark, spec, 100_000)


# --- specification checks -------------------------------------------------------------------


def refused(match, make):
    with pytest.raises(ValueError, match=match):
        make()


def test_log_filters():
    refused("cannot be empty", lambda: LogFilter(()))
    refused("organization_id", lambda: LogFilter((LogField("a", path="a"),)))
    refused("suit log format", lambda: LogFilter((ORG,), log_format="raw_text"))
    refused("suit log format", lambda: LogFilter((ORG, LogField("a", value="x"))))
    refused("log_format", lambda: LogFilter((ORG,), log_format="xml"))
    refused("log_example", lambda: LogFilter((ORG,), log_example="text"))
    refused("needs a format", lambda: LogField("t", path="t", field_type="timestamp"))
    refused("field_type", lambda: LogField("t", path="t", field_type="date"))
    refused("either", lambda: LogField("t", path="t", value="t"))
    assert LogFilter((ORG,), log_format="JSON_DICT", log_example={"a": 1}).log_format == "json_dict"
    refused("cannot be empty", lambda: MetricFilter(()))


def test_inputs():
    refused("mandatory", lambda: InputSpec("s", "datadog", "logs", START))
    refused("LogFilter", lambda: InputSpec("s", "datadog", "logs", START, filters=PROM.filters))
    refused("MetricFilter", lambda: InputSpec("s", "prometheus", "metrics", START, filters=LOGS))
    refused("configuration is missing", lambda: InputSpec("s", "prometheus", "metrics", START))
    refused("kind", lambda: InputSpec("s", "datadog", "traces", START))
    refused("blank", lambda: InputSpec(" ", "cloudwatch", "logs", START, filters=LOGS))
    refused("at least one", lambda: FlowSpec([]))


def test_statistics_in_every_spelling():
    for name in ("AVERAGE", "Average", "average"):
        assert CloudwatchMetrics("n", "m", 60, name, "c", [{"c": "1"}]).statistic == "Average"
        assert DatadogMetrics("m", 60, name, "c", [DatadogTagSet("1", "c:1")]).statistic == "avg"
    assert DatadogMetrics("m", 60, "avg", "c", [DatadogTagSet("1", "c:1")]).interval_ms == 60_000
    refused("statistic", lambda: CloudwatchMetrics("n", "m", 60, "p99", "c", [{"c": "1"}]))
    refused("statistic", lambda: DatadogMetrics("m", 60, "SampleCount", "c", [DatadogTagSet("1", "c:1")]))
    refused("dimension set", lambda: CloudwatchMetrics("n", "m", 60, "Sum", "c", [{"c": "1"}, {"d": "1"}]))
    refused("tag string", lambda: DatadogMetrics("m", 60, "SUM", "c", [DatadogTagSet("1", "d:1")]))


@pytest.mark.parametrize("step, ok", [
    ((15, "s"), True), ((20, "s"), True), ((30, "s"), True), ((1, "m"), True), ((1000, "ms"), True),
    ((500, "ms"), False), ((750, "ms"), False), ((45, "s"), False), ((90, "s"), False), ((2, "m"), False),
    ((1, "h"), False),
])
def test_steps(step, ok):
    if ok:
        assert 60_000 % PrometheusQuery("q", "m", "c", step=step).step_ms == 0
    else:
        refused("step", lambda: PrometheusQuery("q", "m", "c", step=step))


def test_prometheus_identifier_or_fallback():
    refused("fallback_org_id", lambda: PrometheusQuery("q", "m", "  "))
    refused("fallback_org_id", lambda: PrometheusQuery("q", "m", None, fallback_org_id=" "))
    query = PrometheusQuery("q", "m", " c ", fallback_org_id="")
    assert (query.organization_identifier, query.fallback_org_id) == ("c", None)


def test_offsets_and_outputs():
    for bad in ("2024-01-01", 1.5, None, True):
        refused("integer milliseconds", lambda bad=bad: OffsetSpec(bad))
    refused("offset store", lambda: OffsetSpec(1, store="etcd"))
    refused("output type", lambda: OutputSpec("null"))
    refused("path", lambda: OutputSpec("table"))
    refused("poster", lambda: OutputSpec("http"))


# --- inputs that share a stream key, resuming ------------------------------------------------


def record(key, at):
    return {"eventId": f"{key}-{at}", "timestamp": at, "message": json.dumps({"user": key, "level": "L"})}


def hourly(input_key, start_ms, end_ms):
    """One record at every full minute of the range."""
    times = range(-(-start_ms // 60_000) * 60_000, end_ms, 60_000)
    yield None, json.dumps({"events": [record(input_key, t) for t in times]})


def test_resumed_pulls_deliver_each_event_once(spark, tmp_path):
    minute = 60_000
    out = OutputSpec("table", path=str(tmp_path / "out"))
    spec = FlowSpec([
        InputSpec("cw", "cloudwatch", "logs", OffsetSpec(0), filters=LOGS),
        InputSpec("cw", "cloudwatch", "logs", OffsetSpec(50 * minute, store="keyed_table", suffix="at"),
                  filters=LOGS),
    ], out)
    offsets = OffsetTable(spark, str(tmp_path / "offsets"))
    for no, now in enumerate((70 * minute, 71 * minute, 200 * minute)):
        ranges = next_ranges(spark, spec, now, offsets=offsets)
        pulled = fetch_ranges(spark, spec, ranges, hourly)
        build_flow(spark, spec, pulled).deliver(run_id=f"run-{no}")
        commit_ranges(spark, spec, ranges, offsets)
        stored = op.read_delivered(spark, out.path).collect()
        wanted = [("cw_0", f"cw_0-{t}") for t in range(0, now, minute)]
        wanted += [("cw_1", f"cw_1-{t}") for t in range(50 * minute, now, minute)]
        assert sorted((r.organization_id, r.idempotency_key) for r in stored) == sorted(wanted)
    log = offsets.log().select("stream_key").distinct().collect()
    assert {r.stream_key for r in log} == {"cw_0", "cw_1:at"}


def test_an_override_counts_once(spark, tmp_path):
    spec = FlowSpec([InputSpec("cw", "cloudwatch", "logs", OffsetSpec(1_000, override_start_from=True),
                               filters=LOGS)])
    offsets = OffsetTable(spark, str(tmp_path / "o"))
    commit_ranges(spark, spec, next_ranges(spark, spec, 9_000, offsets=offsets), offsets)
    again = next_ranges(spark, spec, 9_500, offsets=offsets)
    assert [(r.start_ms, r.end_ms) for r in again.collect()] == [(1_000, 9_500)]
    later = next_ranges(spark, spec, 9_500, offsets=offsets, override=False)
    assert [(r.start_ms, r.end_ms) for r in later.collect()] == [(9_000, 9_500)]


def test_pages_of_shared_inputs_name_theirs(spark, pages):
    spec = FlowSpec([CW_LOGS, InputSpec("cw", "cloudwatch", "logs", START, filters=LOGS)])
    landed = pages("cloudwatch", "logs", {"events": [record("u", 1_000)]}, stream_key="cw")
    with pytest.raises(ValueError, match="input_key"):
        build_flow(spark, spec, landed)
    named = [landed.withColumn("input_key", F.lit(k).cast("string")) for k in ("cw_0", "cw_1", "cw_7", None)]
    flow = build_flow(spark, spec, op.merge_streams(*named))
    assert flow.events.count() == 2
    strays = [(r.reject_reason, json.loads(r.content)["events"][0]["eventId"]) for r in flow.rejects.collect()]
    assert strays == [("unknown_input", "u-1000")] * 2


def test_derived_offsets_by_organisation(spark):
    def of(org):
        offset = OffsetSpec(10_000, store="delivered", organization_id=org)
        return InputSpec("cw", "cloudwatch", "logs", offset, filters=LOGS)

    delivered = spark.createDataFrame(
        [("cw", "a", 100_000), ("cw", "b", 900_000), ("other", "a", 950_000)],
        "stream_key string, organization_id string, ms bigint",
    ).withColumn("event_ts", F.timestamp_millis("ms"))
    spec = FlowSpec([of("a"), of("b"), of("c"), of(None), of(" ")])
    ranges = next_ranges(spark, spec, 1_000_000, delivered=delivered)
    starts = {r.stream_key: r.at for r in ranges.groupBy("stream_key").agg(F.min("start_ms").alias("at")).collect()}
    assert starts == {"cw_0": 100_000, "cw_1": 900_000, "cw_2": 10_000, "cw_3": 900_000, "cw_4": 900_000}


def test_rejects_go_to_quarantine_with_their_content(spark, mixed, tmp_path):
    out = OutputSpec("table", path=str(tmp_path / "out"), quarantine=str(tmp_path / "rejects"))
    flow = build_flow(spark, FlowSpec([CW_LOGS, DD_METRICS, PROM], out), mixed)
    for _ in range(2):  # an attempt replaces the one before
        flow.deliver(run_id="r")
        assert op.read_delivered(spark, out.path).count() == 7
        held = op.read_rejects(spark, out.quarantine).collect()
        assert [(r.stream_key, r.idempotency_key, r.reject_reason, r.content) for r in held] == [
            ("cw", "l3", "parse_error", "noise")
        ]
