import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidegauge import operators as op
from tidegauge.functions import object_text
from tidegauge.plans.spec import LogField, LogFilter, MetricField, MetricFilter


def sha(value):
    return hashlib.sha256(str(value).encode()).hexdigest()


@pytest.fixture
def logs(spark):
    def make(*contents, stream_key="s"):
        rows = [
            (stream_key, str(i), c if c is None or isinstance(c, str) else json.dumps(c), i)
            for i, c in enumerate(contents)
        ]
        frame = spark.createDataFrame(rows, "stream_key string, log_id string, content string, s int")
        return frame.withColumn("event_ts", F.timestamp_seconds("s")).drop("s")

    return make


def values(events):
    rows = events.select("*", object_text(F.col("entries")).alias("text")).collect()
    return {r["idempotency_key"]: r for r in rows}


# --- logs -------------------------------------------------------------------------------

# records of a parcel scanner: a barcode, where it was scanned, what it weighs, when it leaves
FIELDS = (
    LogField("departs at", path="route.leaves", field_type="timestamp", format="%d.%m.%Y %H:%M"),
    LogField("grams", path="parcel.grams", field_type="float"),
    LogField("organization_id", path="depot.tenant"),
    LogField("barcode", path="parcel.code", field_type="integer", hash=True),
    LogField("belt", path="belt"),
)


def scan(number):
    """A generated record, and the values expected of it: every part may be missing."""
    record = {"depot": {"tenant": f"t{number % 4}"}, "shift": number}
    expected = {"organization_id": f"t{number % 4}"}
    if number % 2:
        record["parcel"] = {"code": 90_000 + number, "grams": number / 8}
        expected |= {"barcode": sha(90_000 + number), "grams": number / 8}
    elif number % 4:
        record["parcel"] = {"code": None}
    if number % 3:
        record["belt"] = expected["belt"] = chr(945 + number)
        record["route"] = {"leaves": f"{1 + number:02d}.07.2023 06:{number:02d}"}
        expected["departs_at"] = f"2023-07-{1 + number:02d}T06:{number:02d}:00+00:00"
    return record, expected


def test_json_fields_types_hash_and_missing(logs):
    scans = [scan(number) for number in range(18)]
    got = values(op.extract_log_events(logs(*[record for record, _ in scans]), LogFilter(FIELDS)))
    for number, (_, expected) in enumerate(scans):
        event = got[str(number)]
        assert json.loads(event["text"]) == expected
        assert [e["k"] for e in event["entries"]] == sorted(expected)
        assert event["organization_id"] == expected["organization_id"]
        assert event["reject_reason"] is None


def test_rejects_carry_a_reason_and_never_fail_the_job(logs):
    good = {"depot": {"tenant": "c"}}
    events = op.extract_log_events(
        logs(
            good, "not json", {"depot": {"tenant": ""}}, {"depot": {"tenant": None}}, {}, {"depot": 5},
            {"depot": {"tenant": "c"}, "parcel": {"code": "x"}}, "[1]", "5", None,
            json.dumps(good) + " tail", json.dumps(good) + "," + json.dumps(good),
        ),
        LogFilter(FIELDS),
    )
    got = {r.idempotency_key: r.reject_reason for r in events.collect()}
    assert got == {
        "0": None, "1": "parse_error", "2": "missing_org", "3": "missing_org", "4": "missing_org",
        "5": "missing_org", "6": "parse_error", "7": "parse_error", "8": "parse_error",
        "9": "parse_error", "10": "parse_error", "11": "parse_error",
    }
    accepted, rejected = op.split_rejects(events)
    assert accepted.count() == 1 and rejected.count() == 11
    stats = {r.reject_reason: r.n for r in op.run_stats(events).collect()}
    assert stats == {None: 1, "missing_org": 4, "parse_error": 7}


def test_cast_errors_can_null_the_field(logs):
    events = op.extract_log_events(
        logs({"depot": {"tenant": "c"}, "parcel": {"code": "x", "grams": 1}}), LogFilter(FIELDS),
        on_cast_error="null_field",
    )
    assert json.loads(values(events)["0"]["text"]) == {"organization_id": "c", "grams": 1.0}
    with pytest.raises(ValueError, match="on_cast_error"):
        op.extract_json_fields(logs({}), FIELDS, on_cast_error="other")


def test_numeric_org_zero_counts_as_missing(logs):
    spec = LogFilter((LogField("organization_id", path="id", field_type="integer"),))
    rows = op.extract_log_events(logs({"id": 0}, {"id": 7}, {"id": "0"}), spec).collect()
    assert [(r.organization_id, r.reject_reason) for r in rows] == [
        ("0", "missing_org"), ("7", None), ("0", "missing_org")
    ]


def test_paths_nested_overlapping_and_indexed(logs):
    fields = (
        LogField("whole", path="a"), LogField("inner", path="a.b.c"),
        LogField("indexed", path="list[0]"), LogField("deep", path="x.y.z", field_type="integer"),
    )
    row = op.extract_json_fields(
        logs({"a": {"b": {"c": "v"}}, "list": [1], "x": {"y": {"z": 3}}}), fields
    ).first()["fields"]
    assert json.loads(row["whole"]) == {"b": {"c": "v"}}
    assert (row["inner"], row["indexed"], row["deep"]) == ("v", None, 3)


def test_of_two_keys_that_sanitise_alike_the_later_wins(logs):
    fields = (
        LogField("organization_id", path="o"), LogField("a-b", path="x"), LogField("a b", path="y")
    )
    events = op.extract_log_events(logs({"o": "c", "x": "1", "y": "2"}), LogFilter(fields))
    assert json.loads(values(events)["0"]["text"]) == {"organization_id": "c", "a_b": "2"}


def test_text_fields(logs):
    fields = (
        LogField("organization_id", value=r"org=(\w+)"),
        LogField("status", value=r"\b[1-5]\d\d\b", field_type="integer"),
        LogField("at", value=r"\[([^\]]+)\]", field_type="timestamp", format="%d/%b/%Y:%H:%M:%S"),
    )
    text = "x " * 20_000 + "org=acme 404 [02/Jan/2024:03:04:05]"
    events = op.extract_log_events(
        logs(text, "org=acme", "no organisation"), LogFilter(fields, log_format="raw_text")
    )
    got = values(events)
    assert json.loads(got["0"]["text"]) == {
        "organization_id": "acme", "status": 404, "at": "2024-01-02T03:04:05+00:00"
    }
    assert json.loads(got["1"]["text"]) == {"organization_id": "acme"}
    assert got["2"]["reject_reason"] == "missing_org"


def test_content_is_parsed_once_even_below_a_filter(logs):
    events, _ = op.split_rejects(op.extract_log_events(logs({"depot": {"tenant": "c"}}), LogFilter(FIELDS)))
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_filter_logs(logs):
    rows = logs({"level": "ERROR"}, {"level": "WARN"}, {"level": "INFO"}, "junk")
    kept = op.filter_logs(rows, op.json_equals("level", "ERROR", "WARN"))
    assert sorted(r.log_id for r in kept.collect()) == ["0", "1"]
    assert op.filter_logs(rows, "stream_key = 's' and log_id > '1'").count() == 2


# --- metrics ----------------------------------------------------------------------------

LABELS = {"environment": "prod", "service": "api", "region": "eu"}


def test_no_filter_passes_all_labels(metrics):
    frame = metrics(("cpu.usage", 75.5, "o1", 0.0, LABELS), ("mem", 0.0, "o2", 60.5, None))
    rows = op.metric_events(frame).select("*", object_text(F.col("entries")).alias("text")).collect()
    got = {r.organization_id: r for r in rows}
    expected = {"cpu_usage": 75.5, **LABELS}
    assert got["o1"].text == json.dumps(expected, sort_keys=True)
    key = f"1970-01-01T00:00:00+00:00|o1|{json.dumps(expected, sort_keys=True)}"
    assert got["o1"].idempotency_key == sha(key)
    assert got["o2"].text == '{"mem": 0.0}'
    assert got["o2"].idempotency_key == sha('1970-01-01T00:01:00.500000+00:00|o2|{"mem": 0.0}')


def test_filter_selects_and_hashes_labels(metrics):
    spec = MetricFilter((MetricField("environment", True), MetricField("region"), MetricField("absent")))
    frame = metrics(("m", 1.0, "o", 0.0, LABELS), ("m", 2.0, "o", 0.0, {}), ("m", 3.0, "o", 0.0, {"z": "1"}))
    rows = op.metric_events(frame, spec).select(
        object_text(F.col("entries")).alias("text"), "reject_reason"
    ).collect()
    got = {json.loads(r.text)["m"]: r for r in rows}
    assert json.loads(got[1.0].text) == {"m": 1.0, "environment": sha("prod"), "region": "eu"}
    # without labels the filter does not apply; with labels of which none is listed it rejects
    assert (got[2.0].text, got[2.0].reject_reason) == ('{"m": 2.0}', None)
    assert got[3.0].reject_reason == "no_labels_matched"


def test_select_labels(metrics):
    fields = (MetricField("environment", True), MetricField("region"), MetricField("absent"))
    chosen = metrics(("m", 1.0, "o", 0.0, LABELS)).select(op.select_labels(F.col("labels"), fields))
    assert chosen.first()[0] == {"environment": sha("prod"), "region": "eu"}


def test_a_label_named_like_the_metric_overwrites_it(metrics):
    labels = F.create_map(F.lit("a-b"), F.lit("x"), F.lit("a b"), F.lit("y"))
    frame = metrics(("a.b", 1.0, "o", 0.0, None)).withColumn("labels", labels)
    text = op.metric_events(frame).select(object_text(F.col("entries"))).first()[0]
    assert text == '{"a_b": "y"}'


def test_org_is_hashed_through_its_label_but_the_key_is_not(metrics):
    spec = MetricFilter((MetricField("customer", True), MetricField("region")))
    rows = ("m", 1.0, "acme", 0.0, {"region": "eu"})
    hashed = op.metric_events(metrics(rows, identifier="customer"), spec).first()
    plain = op.metric_events(metrics(rows, identifier="other"), spec).first()
    assert hashed.organization_id == sha("acme") and plain.organization_id == "acme"
    assert hashed.idempotency_key == plain.idempotency_key
    assert hashed.idempotency_key == sha('1970-01-01T00:00:00+00:00|acme|{"m": 1.0, "region": "eu"}')


# --- streams of events ------------------------------------------------------------------


def test_merge_keeps_copies_and_dedupe_removes_them(metrics):
    events, _ = op.split_rejects(op.metric_events(metrics(*[("m", float(i), "o", i, None) for i in range(5)])))
    twice = op.merge_streams(events, events)
    assert twice.count() == 10
    once = op.dedupe_events(twice)
    assert once.columns == events.columns
    assert sorted(once.collect()) == sorted(events.collect())
    with pytest.raises(ValueError):
        op.merge_streams()


def test_dedupe_combines_copies_before_the_shuffle(metrics):
    events, _ = op.split_rejects(op.metric_events(metrics(("m", 1.0, "o", 0.0, None))))
    plan = op.dedupe_events(op.merge_streams(*[events] * 3))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_dedupe_keeps_the_same_row_whatever_the_order(spark):
    rows = [("s", "k", t, f"o{t}", []) for t in (3, 1, 2)]
    schema = "stream_key string, idempotency_key string, t int, organization_id string, entries array<struct<k:string,j:string>>"

    def kept(rows):
        frame = spark.createDataFrame(rows, schema).withColumn("event_ts", F.timestamp_seconds("t"))
        return op.dedupe_events(frame.drop("t")).first().organization_id

    assert kept(rows) == kept(rows[::-1]) == "o1"


def test_observed_counters(logs):
    rows = op.extract_log_events(logs({"depot": {"tenant": "c"}}, "x"), LogFilter(FIELDS))
    from pyspark.sql import Observation

    seen = Observation("run")
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 2
    assert op.observed(rows, "c").count() == 2
