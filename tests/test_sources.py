import json
import random
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidegauge import sources
from tidegauge.functions import to_millis
from tidegauge.operators import metric_query_plan
from tidegauge.plans.flow import query_plan
from tidegauge.plans.spec import (
    CloudwatchMetrics,
    DatadogMetrics,
    DatadogTagSet,
    InputSpec,
    OffsetSpec,
    PrometheusQuery,
)
from tidegauge.schema import RAW_PAGES, ddl

START = OffsetSpec(0)


def by_id(df, key="log_id"):
    return {r[key]: r for r in df.collect()}


def samples(df):
    rows = df.select(
        "metric_name", "organization_id", to_millis(F.col("event_ts")).alias("ms"), "value",
        "reject_reason",
    ).collect()
    return sorted(tuple(r) for r in rows if r["reject_reason"] is None)


def reasons(df):
    return sorted(r["reject_reason"] for r in df.where("reject_reason is not null").collect())


# --- CloudWatch -------------------------------------------------------------------------


def test_cloudwatch_log_pages(pages):
    first = {
        "events": [
            {"eventId": "1", "timestamp": 1700000000123, "message": '{"a": 1}', "logStreamName": "x"},
            {"eventId": "2", "timestamp": 1700000000200, "message": "plain"},
            {"eventId": "3", "timestamp": 1700000000300, "message": "[1, 2]"},
        ],
        "nextToken": "more",
    }
    second = {"events": [{"eventId": "4", "timestamp": 1700000000400, "message": "42"}]}
    logs = by_id(sources.normalize_cloudwatch_logs(
        pages("cloudwatch", "logs", first, second, {"events": []})
    ))
    assert sorted(logs) == ["1", "2", "3", "4"]
    assert [logs[i]["is_json"] for i in "1234"] == [True, False, True, True]
    assert logs["1"]["metadata"]["log_stream_name"] == "x"
    assert logs["2"]["metadata"]["log_stream_name"] == ""
    assert logs["1"]["content"] == '{"a": 1}'
    assert logs["1"]["event_ts"].microsecond == 123000
    assert all(r["reject_reason"] is None for r in logs.values())


def test_cloudwatch_bad_records_and_pages_are_kept_with_a_reason(pages):
    body = {"events": [{"eventId": "1", "timestamp": 1, "message": "m"}, {"timestamp": 5, "message": "m"},
                       {"eventId": "3", "message": "m"}, {"eventId": "4", "timestamp": 5}]}
    rows = sources.normalize_cloudwatch_logs(
        pages("cloudwatch", "logs", body, "{truncated", '{"events": []} trailing')
    )
    assert reasons(rows) == ["bad_page", "bad_page", "bad_timestamp", "missing_id", "missing_message"]
    with pytest.raises(Exception, match="rejected: "):
        sources.normalize_cloudwatch_logs(
            pages("cloudwatch", "logs", "{truncated"), strict=True
        ).collect()


@pytest.mark.parametrize(
    "text, expected",
    [('{"a":1}', True), ("5", True), ('"t"', True), ("null", True), ("[]", True), ("", False),
     ("x", False), ('{"a":1} b', False), ('{"a":1},{"a":2}', False), ('{"a":1,"a":2}', True)],
)
def test_json_detection(spark, text, expected):
    from tidegauge.sources.pages import is_json_text

    assert spark.range(1).select(is_json_text(F.lit(text))).first()[0] is expected


CW = InputSpec(
    "s", "cloudwatch", "metrics", START,
    cloudwatch=CloudwatchMetrics(
        "Ns", "CPU", 60, "AVERAGE", "customer",
        [{"host": "h1", "customer": "c1"}, {"customer": "c2"}],
    ),
)


def test_cloudwatch_metric_pages(spark, pages):
    t = ["2024-01-01T00:00:00Z", "2024-01-01T00:01:00+00:00", "2024-01-01T00:02:00Z"]
    one = {"MetricDataResults": [
        {"Id": "cpu_query_0", "Timestamps": t[:2], "Values": [1.0, 0.0]},
        {"Id": "cpu_query_1", "Timestamps": t[1:], "Values": [3.5, 4]},
    ], "NextToken": "x"}
    two = {"MetricDataResults": [
        {"Id": "cpu_query_0", "Timestamps": [t[2]], "Values": [9.0]},
        {"Id": "cpu_query_1", "Timestamps": [], "Values": []},
    ]}
    rows = sources.normalize_cloudwatch_metrics(
        pages("cloudwatch", "metrics", one, two), query_plan(spark, CW)
    )
    base = 1704067200000
    assert samples(rows) == [
        ("CPU", "c1", base, 1.0, None), ("CPU", "c1", base + 60000, 0.0, None),
        ("CPU", "c1", base + 120000, 9.0, None), ("CPU", "c2", base + 60000, 3.5, None),
        ("CPU", "c2", base + 120000, 4.0, None),
    ]
    assert reasons(rows) == []


def test_cloudwatch_metric_times_as_numbers(spark, pages):
    seconds = 1_712_345_670
    numbers = [seconds, seconds + 30.5, (seconds + 60) * 1000, f"{seconds + 90}", "1e999"]
    page = {"MetricDataResults": [
        {"Id": "cpu_query_0", "Timestamps": numbers, "Values": [float(i) for i in range(5)]}
    ]}
    rows = sources.normalize_cloudwatch_metrics(
        pages("cloudwatch", "metrics", page), query_plan(spark, CW)
    )
    assert [(at - seconds * 1000, v) for _, _, at, v, _ in samples(rows)] == [
        (0, 0.0), (30_500, 1.0), (60_000, 2.0), (90_000, 3.0)
    ]
    assert reasons(rows) == ["bad_timestamp"]


def test_cloudwatch_metric_rejects(spark, pages):
    bad = {"MetricDataResults": [
        {"Id": "cpu_query_0", "Timestamps": ["2024-01-01T00:00:00Z"], "Values": [1.0, 2.0]},
        {"Id": "other", "Timestamps": ["2024-01-01T00:00:00Z"], "Values": [1.0]},
        {"Id": "cpu_query_1", "Timestamps": ["soon"], "Values": [1.0]},
    ]}
    rows = sources.normalize_cloudwatch_metrics(
        pages("cloudwatch", "metrics", bad, {"MetricDataResults": []}, "junk"), query_plan(spark, CW)
    )
    assert reasons(rows) == [
        "bad_page", "bad_timestamp", "length_mismatch", "no_results", "unknown_query"
    ]
    assert samples(rows) == []


def test_cloudwatch_query_plan(spark):
    plan = query_plan(spark, CW).orderBy("query_index").collect()
    assert [(r.query_id, r.organization_id, r.chunk_no) for r in plan] == [
        ("cpu_query_0", "c1", 0), ("cpu_query_1", "c2", 0)
    ]
    many = InputSpec(
        "s", "cloudwatch", "metrics", START,
        cloudwatch=CloudwatchMetrics(
            "Ns", "CPU", 60, "Sum", "customer", [{"customer": f"c{i}"} for i in range(1001)]
        ),
    )
    sizes = query_plan(spark, many).groupBy("chunk_no").count().orderBy("chunk_no").collect()
    assert [r["count"] for r in sizes] == [500, 500, 1]


def test_query_plan_is_a_sized_local_relation(spark):
    from tidegauge.session import config_table

    plan = config_table(spark, [{"a": 1, "b": ["x"]}], "a int, b array<string>")
    stats = plan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(stats)) < 1000


# --- Datadog ----------------------------------------------------------------------------


def test_datadog_log_pages(pages):
    body = {"data": [
        {"id": "1", "attributes": {"attributes": {"a": {"b": 1}}, "timestamp": "2024-05-01T10:00:00.5+02:00",
                                   "service": "api", "tags": ["x"]}},
        {"id": "2", "attributes": {"attributes": {}, "timestamp": "2024-05-01T10:00:00"}},
        {"id": "3"},
        {"id": "4", "attributes": {"attributes": {"a": 1}, "timestamp": "never"}},
    ], "meta": {"page": {"after": "c"}}}
    logs = by_id(sources.normalize_datadog_logs(pages("datadog", "logs", body)))
    assert json.loads(logs["1"]["content"]) == {"a": {"b": 1}}
    # the clock reading is taken as UTC whatever offset it names
    assert logs["1"]["event_ts"].replace(tzinfo=None) == datetime(2024, 5, 1, 10, 0, 0, 500000)
    assert (logs["1"]["is_json"], logs["2"]["is_json"]) == (True, False)
    assert logs["1"]["metadata"]["tags"] == ["x"] and logs["2"]["metadata"]["tags"] == []
    assert logs["2"]["metadata"]["status"] == ""
    assert logs["3"]["reject_reason"] == "missing_attributes"
    assert logs["4"]["reject_reason"] == "bad_timestamp"


DD = InputSpec(
    "s", "datadog", "metrics", START,
    datadog=DatadogMetrics(
        "app.m", 60, "AVERAGE", "customer",
        [DatadogTagSet("c1", "customer:c1"), DatadogTagSet("c2", "customer:c2,env:x")],
    ),
)


def timeseries(indices, times, values):
    return {"data": {"attributes": {
        "series": [{"query_index": i} for i in indices], "times": times, "values": values
    }}}


def test_datadog_timeseries(spark, pages):
    rng = random.Random(17)
    bodies, expected = [], []
    for page in range(4):
        times = sorted(rng.sample(range(1, 90_000), 7))
        columns = [[rng.uniform(0.5, 99) for _ in times] for _ in range(2)]
        order = [1, 0] if page % 2 else [0, 1]
        bodies.append(timeseries(order, times, [columns[k] for k in order]))
        expected += [
            ("app.m", f"c{k + 1}", ms, v, None)
            for k in order
            for ms, v in zip(times, columns[k], strict=True)
        ]
    rows = sources.normalize_datadog_metrics(
        pages("datadog", "metrics", *bodies), query_plan(spark, DD)
    )
    assert sorted(samples(rows)) == sorted(expected)


def test_datadog_drops_nulls_and_zeros_and_cuts_to_the_shorter(spark, pages):
    body = timeseries([1, 0], [1000, 2000], [[None, 0.0, 7.0], [5.0]])
    plan = query_plan(spark, DD)
    rows = sources.normalize_datadog_metrics(pages("datadog", "metrics", body), plan)
    assert samples(rows) == [("app.m", "c1", 1000, 5.0, None)]
    kept = sources.normalize_datadog_metrics(pages("datadog", "metrics", body), plan, keep_zero=True)
    assert samples(kept) == [("app.m", "c1", 1000, 5.0, None), ("app.m", "c2", 2000, 0.0, None)]


def test_datadog_rejects(spark, pages):
    body = timeseries([0, 5], [1000], [[1.0], [2.0]])
    short = timeseries([0, 1], [1000], [[1.0]])
    rows = sources.normalize_datadog_metrics(
        pages("datadog", "metrics", body, short, "nope"), query_plan(spark, DD)
    )
    assert reasons(rows) == ["bad_page", "missing_values", "unknown_query"]
    assert len(samples(rows)) == 2


def test_datadog_query_text(spark):
    plan = query_plan(spark, DD).orderBy("query_index").collect()
    assert [(r.query_text, r.organization_id) for r in plan] == [
        ("avg:app.m{customer:c1}", "c1"), ("avg:app.m{customer:c2,env:x}", "c2")
    ]
    assert metric_query_plan is not None


# --- Prometheus -------------------------------------------------------------------------


def matrix(*series):
    return {"status": "success", "data": {"resultType": "matrix", "result": [
        {"metric": labels, "values": values} for labels, values in series
    ]}}


def test_prometheus_matrix(pages):
    query = PrometheusQuery("up", "up_total", "customer", fallback_org_id="none")
    body = matrix(
        ({"__name__": "up", "customer": "c1", "job": "j"}, [[1700000000.123, "1.5"], [1700000030, "NaN"]]),
        ({"__name__": "up"}, [[1700000000, "+Inf"]]),
        ({"customer": ""}, [[1700000000, "1"]]),
        ({"customer": "c2"}, []),
        ({"customer": "c3"}, [["x", "1"]]),
    )
    rows = sources.normalize_prometheus_metrics(pages("prometheus", "metrics", body), query)
    got = {(r.organization_id, r.event_ts.microsecond if r.event_ts else None): r for r in rows.collect()}
    first = got[("c1", 123000)]
    assert (first.metric_name, first.value, first.labels) == ("up_total", 1.5, {"__name__": "up", "job": "j"})
    assert first.organization_identifier == "customer"
    assert got[("none", 0)].value == float("inf")
    assert str(got[("c1", 0)].value) == "nan"
    assert reasons(rows) == ["bad_timestamp", "missing_org"]
    assert rows.count() == 5
    with pytest.raises(Exception, match="missing_org"):
        sources.normalize_prometheus_metrics(
            pages("prometheus", "metrics", matrix(({"customer": ""}, [[1, "1"]]))), query, strict=True
        ).collect()


def test_prometheus_several_queries_and_fallback_only(pages):
    queries = [
        PrometheusQuery("a", "first", "customer", fallback_org_id="f"),
        PrometheusQuery("b", "second", None, fallback_org_id="g"),
    ]
    body = matrix(({"customer": "c"}, [[1, "1"]]))
    both = pages("prometheus", "metrics", body, query_index=0).unionAll(
        pages("prometheus", "metrics", body, query_index=1)
    ).unionAll(pages("prometheus", "metrics", body, query_index=7))
    rows = sources.normalize_prometheus_metrics(both, queries)
    got = {r.metric_name: r for r in rows.where("reject_reason is null").collect()}
    assert (got["first"].organization_id, got["first"].labels) == ("c", {})
    assert (got["second"].organization_id, got["second"].labels) == ("g", {"customer": "c"})
    assert reasons(rows) == ["unknown_query"]


# --- registry and landed table ------------------------------------------------------------


def test_normalizer_registry():
    with pytest.raises(ValueError, match="logs from prometheus"):
        sources.normalizer_for("prometheus", "logs")
    sources.register_normalizer("Custom", "logs", lambda pages, spec, plan: pages)
    assert sources.normalizer_for("custom", "LOGS")(1, None, None) == 1


def test_landed_table_prunes_to_one_stream(spark, pages, tmp_path):
    path = str(tmp_path / "pages")
    sources.land_pages(pages("cloudwatch", "logs", {"events": []}, stream_key="a"), path)
    sources.land_pages(pages("cloudwatch", "logs", {"events": []}, stream_key="b"), path)
    landed = sources.read_pages(spark, path)
    assert landed.count() == 2
    plan = landed.where("stream_key = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stream_key" in plan


def test_landed_pages_are_read_few_at_a_time(spark, tmp_path):
    # a task that reads Parquet holds the bodies of a row group, up to 4,096 rows
    path = tmp_path / "pages"
    rows = [("s", "cloudwatch", "logs", None, 0, 1, no, f"{no:09}" * 2_000) for no in range(200)]
    frame = spark.createDataFrame(rows, ddl(RAW_PAGES)).coalesce(1)
    sources.land_pages(frame, str(path))
    groups = [
        file.metadata.row_group(g).num_rows
        for file in map(pq.ParquetFile, path.rglob("*.parquet")) for g in range(file.num_row_groups)
    ]
    assert sum(groups) == 200 and max(groups) <= 64
    landed = sources.read_pages(spark, str(path)).select(*RAW_PAGES)
    assert sorted(landed.collect(), key=lambda r: r.page_no) == rows
