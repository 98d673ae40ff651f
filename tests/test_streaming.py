import json

import pytest
from pyspark.sql import functions as F

from tidegauge import operators as op
from tidegauge.plans.flow import build_flow
from tidegauge.plans.spec import FlowSpec, InputSpec, LogField, LogFilter, OffsetSpec, OutputSpec
from tidegauge.sources import read_pages, read_ranges, register_paged_pull
from tidegauge.streaming import poll_trigger, run_available, stream_to

HOUR = 3_600_000
SPEC = InputSpec(
    "app", "cloudwatch", "logs", OffsetSpec(0),
    filters=LogFilter((LogField("organization_id", path="o"), LogField("n", path="n", field_type="integer"))),
)


def body(ids):
    return {"events": [
        {"eventId": f"e{i}", "timestamp": 1_700_000_000_000 + i * 1000, "message": json.dumps({"o": f"c{i % 3}", "n": i})}
        for i in ids
    ]}


@pytest.fixture
def landed(pages, tmp_path):
    """Pages in several files with overlapping records."""
    path = str(tmp_path / "landed")
    for ids in (range(0, 12), range(10, 22), range(20, 30)):
        pages("cloudwatch", "logs", body(ids), stream_key="app").coalesce(1).write.mode("append").parquet(path)
    return path


def rows(df):
    return sorted((r.idempotency_key, r.organization_id, str(r.entries)) for r in df.collect())


def test_stream_equals_batch_and_resumes(spark, pages, landed, tmp_path):
    out = OutputSpec("table", path=str(tmp_path / "out"))
    batch = op.dedupe_events(build_flow(spark, FlowSpec([SPEC]), read_pages(spark, landed)).events)
    assert batch.count() == 30

    def run():
        stream = read_pages(spark, landed, streaming=True, maxFilesPerTrigger="1")
        flow = build_flow(spark, FlowSpec([SPEC], out), stream)
        run_available(flow.stream(str(tmp_path / "ck"), watermark="1 hour", available_now=True), 120)

    run()
    assert rows(op.read_delivered(spark, out.path)) == rows(batch)
    run()  # nothing new, nothing repeated
    assert op.read_delivered(spark, out.path).count() == 30
    pages("cloudwatch", "logs", body(range(28, 33)), stream_key="app").coalesce(1).write.mode("append").parquet(landed)
    run()
    assert op.read_delivered(spark, out.path).count() == 33


@pytest.mark.parametrize("combine", [True, False])
def test_stream_dedupe_of_a_much_copied_event(spark, pages, tmp_path, combine):
    path = str(tmp_path / "copies")
    copies = [0] * 400 + list(range(5)) + [0] * 400
    pages("cloudwatch", "logs", body(copies), body(copies), stream_key="app").write.parquet(path)
    events = build_flow(spark, FlowSpec([SPEC]), read_pages(spark, path, streaming=True)).events
    unique = op.dedupe_events(events, "1 hour", combine=combine)
    out = str(tmp_path / "out")
    run_available(stream_to(unique, "table", str(tmp_path / "ck"), path=out, available_now=True), 120)
    assert [r[0] for r in rows(op.read_delivered(spark, out))] == [f"e{i}" for i in range(5)]


def test_http_stream_sends_each_event(spark, landed, tmp_path):
    folder = str(tmp_path / "box")

    def post(text):
        import os
        import uuid

        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(text)

    flow = build_flow(spark, FlowSpec([SPEC]), read_pages(spark, landed, streaming=True))
    events = op.dedupe_events(flow.events, "1 hour")
    run_available(stream_to(events, "http", str(tmp_path / "ck"), post=post, available_now=True), 120)
    import glob

    sent = [p["idempotency_key"] for f in glob.glob(folder + "/*") for p in json.load(open(f))]
    assert sorted(sent) == sorted(f"e{i}" for i in range(30))


def test_rollup_runs_on_a_stream(spark, landed, tmp_path):
    events = build_flow(spark, FlowSpec([SPEC]), read_pages(spark, landed, streaming=True)).events
    points = events.withWatermark("event_ts", "1 minute").withColumn("value", F.lit(1.0))
    rolled = op.rollup(points, 10, "sum", ["stream_key"])
    query = rolled.writeStream.format("memory").queryName("rolled").outputMode("complete").trigger(
        availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    assert query.awaitTermination(120)
    assert spark.table("rolled").agg(F.sum("value")).first()[0] == 34.0


def test_console_and_noop_streams(spark, landed, tmp_path):
    events = build_flow(spark, FlowSpec([SPEC]), read_pages(spark, landed, streaming=True)).events
    for mode in ("noop", "console"):
        run_available(stream_to(events, mode, str(tmp_path / mode), available_now=True), 120)
    with pytest.raises(ValueError, match="unknown delivery mode"):
        stream_to(events, "null", str(tmp_path / "x"))
    with pytest.raises(ValueError, match="watermark"):
        op.dedupe_events(events)
    with pytest.raises(ValueError, match="stream_to"):
        op.deliver(events, "noop")
    assert poll_trigger("logs") == {"processingTime": "24 seconds"}
    assert poll_trigger("metrics") == {"processingTime": "60 seconds"}


# --- pulled ranges --------------------------------------------------------------------------


def fetch(stream_key, start_ms, end_ms):
    """One record at every ten seconds of the range, in pages of a hundred."""
    times = range(-(-start_ms // 10_000) * 10_000, end_ms, 10_000)
    for at in range(0, max(1, len(times)), 100):
        events = [{"eventId": f"{stream_key}-{t}", "timestamp": t,
                   "message": json.dumps({"o": "c", "n": t})} for t in times[at : at + 100]]
        yield None, json.dumps({"events": events})


INPUTS = [{"stream_key": "app", "provider": "cloudwatch", "kind": "logs", "start_from": 0},
          {"stream_key": "late", "provider": "cloudwatch", "kind": "logs", "start_from": 3 * HOUR}]


def test_pulled_batch_tiles_the_time(spark):
    register_paged_pull(spark, fetch)
    now = 3 * HOUR + 100_000
    pulled = read_ranges(spark, inputs=json.dumps(INPUTS), now_ms=str(now))
    ranges = pulled.select("stream_key", "start_ms", "end_ms").distinct().orderBy("stream_key", "start_ms").collect()
    app = [(r.start_ms, r.end_ms) for r in ranges if r.stream_key == "app"]
    assert app[0] == (0, HOUR) and app[-1][1] == now
    assert all(a[1] == b[0] for a, b in zip(app, app[1:]))
    events = build_flow(spark, FlowSpec([SPEC]), pulled).events
    assert events.count() == events.select("idempotency_key").distinct().count() == now // 10_000
    # every range is a partition of its own
    assert pulled.rdd.getNumPartitions() == len(ranges)


@pytest.mark.parametrize("limit,per_task", [(None, 1), ("1", 2), ("3", 2)])
def test_pulled_stream_resumes_from_its_checkpoint(spark, tmp_path, limit, per_task):
    register_paged_pull(spark, fetch)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")

    def run(now):
        options = {"inputs": json.dumps(INPUTS), "now_ms": str(now), "ranges_per_task": str(per_task)}
        if limit:
            options["max_ranges_per_trigger"] = limit
        pulled = read_ranges(spark, streaming=True, **options)
        flow = build_flow(spark, FlowSpec([SPEC], OutputSpec("table", path=out)), pulled)
        query = flow.stream(checkpoint).trigger(processingTime="0 seconds").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    for now in (3 * HOUR + 50_000, 3 * HOUR + 120_000):
        # the second run starts from the checkpoint
        run(now)
        stored = op.read_delivered(spark, out)
        expected = now // 10_000
        assert stored.count() == stored.select("idempotency_key").distinct().count() == expected


def test_limited_stream_plans_whole_windows():
    from tidegauge.sources.pull import _StreamReader

    reader = _StreamReader(fetch, {"inputs": json.dumps(INPUTS), "now_ms": str(5 * HOUR),
                                   "max_ranges_per_trigger": "2"})
    start = reader.initialOffset()
    end = reader.latestOffset()
    parts = [(p.stream_key, p.start_ms, p.end_ms) for p in reader.partitions(start, end)]
    assert parts == [
        ("app", 0, HOUR), ("app", HOUR, 2 * HOUR),
        ("late", 3 * HOUR, 4 * HOUR), ("late", 4 * HOUR, 4 * HOUR + 24_000),
    ]
    later = reader.latestOffset()["heads"]
    assert later == {"app|cloudwatch|logs|0": 4 * HOUR, "late|cloudwatch|logs|1": 4 * HOUR + 72_000}
    assert reader.partitions(end, end) == []


def test_an_input_that_lags_behind_a_live_one_loses_nothing(spark, tmp_path):
    day = 86_400
    schema = "stream_key string, idempotency_key string, event_ts timestamp"
    folders = {name: str(tmp_path / name) for name in ("live", "lag")}

    def land(name, *seconds):
        rows = [(name, f"{name}-{s}", s) for s in seconds]
        frame = spark.createDataFrame(rows, "stream_key string, idempotency_key string, s bigint")
        frame = frame.withColumn("event_ts", F.timestamp_seconds("s")).drop("s")
        frame.write.mode("append").parquet(folders[name])

    land("live", 30 * day, 30 * day + 5)
    land("lag", 10)
    parts = [spark.readStream.schema(schema).parquet(f) for f in folders.values()]
    got = []
    for seconds in ((), (11, 12, 13), (day,)):
        if seconds:
            land("lag", *seconds)
            land("live", 31 * day + seconds[0])
        query = (
            op.dedupe_events(parts, "1 hour").writeStream
            .foreachBatch(lambda batch, _: got.extend(r.idempotency_key for r in batch.collect()))
            .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        )
        query.awaitTermination(120)
    assert sorted(got) == sorted(
        [f"lag-{s}" for s in (10, 11, 12, 13, day)]
        + [f"live-{s}" for s in (30 * day, 30 * day + 5, 31 * day + 11, 32 * day)]
    )
