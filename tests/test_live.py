"""Live flows: one fetch per range, each event stored once, nothing that vanishes."""

import json
from collections import Counter
from datetime import date, datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidegauge import operators as op
from tidegauge.files import Files
from tidegauge.operators.delivered import Delivered
from tidegauge.plans.flow import _mark_late, build_flow
from tidegauge.plans.live import _pulled_flow
from tidegauge.plans.spec import (
    FlowSpec, InputSpec, LogField, LogFilter, OffsetSpec, OutputSpec,
)
from tidegauge.plans.tables import PAGE_ROWS
from tidegauge.schema import INPUT_PAGES, ddl
from tidegauge.sources import PulledPages, read_pages, register_paged_pull
from tidegauge.sources.pull import _BatchReader, _StreamReader
from tidegauge.streaming import run_available

HOUR = 3_600_000
FILTER = LogFilter((LogField("organization_id", path="o"), LogField("n", path="n")))


def log_input(key):
    return InputSpec(key, "cloudwatch", "logs", OffsetSpec(0), filters=FILTER)


def flow_spec(tmp_path, *keys, **output):
    out = OutputSpec("table", path=str(tmp_path / "out"), **output)
    return FlowSpec([log_input(k) for k in keys], out)


def land(spark, folder, number, *records, key="app"):
    """A page of ``(id, seconds, org or None)`` records as the file of one batch."""
    events = [
        {"eventId": i, "timestamp": s * 1000, "message": json.dumps({"o": o, "n": i} if o else {"n": i})}
        for i, s, o in records
    ]
    row = (key, "cloudwatch", "logs", None, 0, 1, number, json.dumps({"events": events}), key)
    frame = spark.createDataFrame([row], ddl(INPUT_PAGES))
    frame.coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, spec, folder, checkpoint, **options):
    pages = read_pages(spark, str(folder), streaming=True, maxFilesPerTrigger="1")
    run_available(build_flow(spark, spec, pages).stream(str(checkpoint), available_now=True, **options), 200)


def stored(spark, spec):
    return Counter(
        (r.stream_key, r.idempotency_key) for r in op.read_delivered(spark, spec.output.path).collect()
    )


# --- fetches ----------------------------------------------------------------------------


@pytest.fixture
def counted(spark, tmp_path):
    """A registered source over three inputs that notes its fetches, and its options."""
    log = tmp_path / "fetched"
    log.mkdir()

    def fetch(key, start, end, folder=str(log)):
        with open(f"{folder}/{key}-{start}-{end}", "a") as file:
            file.write("x")
        event = {"eventId": f"{key}@{start}", "timestamp": start, "message": '{"o": "c"}'}
        yield None, json.dumps({"events": [event]})

    register_paged_pull(spark, fetch, "counted")
    inputs = [
        {"stream_key": k, "provider": "cloudwatch", "kind": "logs", "start_from": 0} for k in "abc"
    ]
    options = {"inputs": json.dumps(inputs), "now_ms": str(3 * HOUR + 24_000)}

    def fetched():
        sizes = {f.name: f.stat().st_size for f in log.iterdir()}
        for f in log.iterdir():
            f.write_text("")
        return {n: s for n, s in sizes.items() if s}

    return options, fetched


def test_every_range_is_fetched_once_in_batch_and_stream(spark, counted, tmp_path):
    options, fetched = counted
    spec = flow_spec(tmp_path, "a", "b", "c")
    build_flow(spark, spec, PulledPages(spark, options, "counted")).deliver("r1")
    times = fetched()
    assert len(times) == 3 * 4 and set(times.values()) == {1}
    assert sum(stored(spark, spec).values()) == 12
    live = PulledPages(spark, options, "counted", streaming=True)
    run_available(build_flow(spark, spec, live).stream(str(tmp_path / "ck"), available_now=True), 200)
    times = fetched()
    assert len(times) == 3 * 4 and set(times.values()) == {1}
    # what the batch stored is not stored again
    assert sum(stored(spark, spec).values()) == 12


def test_a_frame_of_one_input_fetches_nothing_else(spark, counted):
    options, fetched = counted
    pages = PulledPages(spark, options | {"from_ms": str(HOUR), "until_ms": str(3 * HOUR)}, "counted")
    found = pages.frame(stream_key="b").select("stream_key", "start_ms").collect()
    assert sorted(map(tuple, found)) == [("b", HOUR), ("b", 2 * HOUR)]
    assert set(fetched()) == {f"b-{HOUR}-{2 * HOUR}", f"b-{2 * HOUR}-{3 * HOUR}"}


def test_the_pages_of_a_batch_are_landed_in_small_row_groups(spark, tmp_path, monkeypatch):
    sizes, remove = [], Files.remove

    def look(self, path):
        if "/pages-" in path:
            for file in Path(path.removeprefix("file://")).rglob("*.parquet"):
                meta = pq.ParquetFile(file).metadata
                sizes.extend(meta.row_group(g).num_rows for g in range(meta.num_row_groups))
        remove(self, path)

    monkeypatch.setattr(Files, "remove", look)
    body = json.dumps({"events": [{"eventId": "e", "timestamp": 1000, "message": '{"o": "c"}'}]})
    rows = [("app", "cloudwatch", "logs", None, 0, 1, n, body + " " * 9_000, "app") for n in range(200)]
    spark.createDataFrame(rows, ddl(INPUT_PAGES)).coalesce(1).write.parquet(str(tmp_path / "in"))
    spec = flow_spec(tmp_path, "app")
    stream(spark, spec, tmp_path / "in", tmp_path / "ck")
    assert sum(sizes) == 200 and max(sizes) <= 64
    assert stored(spark, spec) == {("app", "e"): 1}


@pytest.mark.parametrize("kind", [_BatchReader, _StreamReader])
def test_pulled_pages_are_handed_over_in_bounded_batches(kind):
    def fetch(key, start, end):
        for page in range(3):
            yield (page or None), f"{start}-{page}".ljust(400_000)
        yield None, None

    inputs = [{"stream_key": 7, "provider": "cloudwatch", "kind": "logs", "start_from": 0}]
    reader = kind(fetch, {"inputs": json.dumps(inputs), "now_ms": str(4 * HOUR + 24_000), "ranges_per_task": "64"})
    if kind is _BatchReader:
        [task] = reader.partitions()
    else:
        [task] = reader.partitions(reader.initialOffset(), reader.latestOffset())
    batches = list(reader.read(task))
    assert max(sum(len(b or "") for b in batch["body"].to_pylist()) for batch in batches) < 1 << 21
    rows = [tuple(r.values()) for batch in batches for r in batch.to_pylist()]
    assert rows == [
        ("7", "cloudwatch", "logs", q, at, end, no, body, "7")
        for at, end in [*((h * HOUR, (h + 1) * HOUR) for h in range(4)), (4 * HOUR, 4 * HOUR + 24_000)]
        for no, (q, body) in enumerate(fetch("7", at, end))
    ]


def test_the_query_that_pulls_events_fetches_pages_of_bounded_length(spark, tmp_path):
    at = datetime(2024, 1, 1)
    rows = [(n, at + timedelta(seconds=n % 3_000), n % 7, "view", 1.5, '{"k": 2}') for n in range(2_400)]
    rows.append((2_400, at + timedelta(minutes=90), 1, "view", 1.5, '{"k": 2}'))
    rows.append((2_401, None, 1, "view", 1.5, '{"k": 2}'))
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    # row groups that each hold some of every range
    options = {"parquet.block.row.count.limit": "100"}
    spark.createDataFrame(rows, schema).repartition(3).write.options(**options).parquet(f"{tmp_path}/events.parquet")
    flow, _ = _pulled_flow(spark, str(tmp_path), "test")
    pages = [[e["eventId"] for e in json.loads(p.body)["events"]] for p in flow.pages.collect()]
    assert max(map(len, pages)) <= PAGE_ROWS
    assert sorted(int(i) for page in pages for i in page) == list(range(2_401))
    assert {int(page[0]) % 2 for page in pages} == {0, 1}
    assert all(len({int(i) % 2 for i in page}) == 1 for page in pages)


# --- polling ----------------------------------------------------------------------------


def reference_polls(start, step, begin, until):
    """Wake times and ranges of one input, a poll at a time, by the rules of the original."""
    at, wake, polls = start, begin, []
    while wake < until:
        window = HOUR if wake - at > HOUR else step
        head = min(at + window, wake)
        if head <= at:
            wake += step
            continue
        polls.append((wake, at, head))
        wake += 2_000 if wake - head > step + 60_000 else step
        at = head
    return polls


def test_each_input_is_polled_in_its_own_time():
    begin, until = 10 * HOUR, 10 * HOUR + 400_000
    starts = {"far": (0, "logs"), "near": (begin - 30_000, "metrics"), "edge": (begin - 84_001, "logs")}
    inputs = [
        {"stream_key": k, "provider": "cloudwatch", "kind": kind, "start_from": s}
        for k, (s, kind) in starts.items()
    ]
    reader = _StreamReader(None, {"inputs": json.dumps(inputs), "adaptive": "true"})
    seen = {k: [] for k in starts}
    offset = reader.initialOffset()
    for now in range(begin, until, 1_000):
        reader.inputs.now = lambda now=now: now
        latest = reader.latestOffset()
        for part in reader.partitions(offset, latest) if latest != offset else []:
            seen[part.stream_key].append((now, part.start_ms, part.end_ms))
        offset = latest
    for key, (start, kind) in starts.items():
        step = {"logs": 24_000, "metrics": 60_000}[kind]
        assert seen[key] == reference_polls(start, step, begin, until), key
    assert len(seen["far"]) > 20


def test_polls_of_a_small_table_are_made_by_all_tasks(spark):
    begin, until = 10 * HOUR, 10 * HOUR + 400_000
    lags = [-5_000, 0, 30_000, 84_001, HOUR, HOUR + 108_001, 3 * HOUR, 10 * HOUR]
    steps = [2_500, 24_000, 60_000, 2 * HOUR]
    rows = [(f"{g}-{s}", begin - g, s) for g in lags for s in steps] * 2
    rows += [("no offset", None, 24_000), ("no step", begin - 7, None)]
    inputs = spark.createDataFrame(rows, "stream_key string, offset_ms bigint, step_ms bigint")
    found = op.poll_times(inputs.coalesce(1), begin, until)
    expected = Counter({("no step", begin, begin - 7, begin): 1})
    for key, at, step in rows[:-2]:
        expected.update((key, *p) for p in reference_polls(at, step, begin, until))
    assert Counter(map(tuple, found.collect())) == expected
    assert found.select(F.spark_partition_id()).distinct().count() == 4


def test_adaptive_stream_resumes(spark, counted, tmp_path):
    options, fetched = counted
    spec = flow_spec(tmp_path, "a", "b", "c")
    seen = Counter()
    for now in (2 * HOUR, 4 * HOUR):
        live = PulledPages(
            spark, options | {"now_ms": str(now), "adaptive": "true"}, "counted", streaming=True
        )
        writer = build_flow(spark, spec, live).stream(str(tmp_path / "ck"))
        query = writer.trigger(processingTime="0 seconds").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        seen += Counter(fetched())
    # one range per input and run: the clock stands still, so all wait after it
    assert set(seen) == {f"{k}-{s}-{s + HOUR}" for k in "abc" for s in (0, HOUR)}


# --- what is stored ---------------------------------------------------------------------


def test_batch_and_streams_store_each_event_once(spark, tmp_path):
    spec, folder = flow_spec(tmp_path, "app"), tmp_path / "pages"
    land(spark, folder, 0, ("a", 10, "c"), ("b", 90_000, "c"), ("b", 90_000, "c"))
    build_flow(spark, spec, read_pages(spark, str(folder))).deliver("r1")
    land(spark, folder, 1, ("a", 10, "c"), ("d", 180_000, "c"))
    stream(spark, spec, folder, tmp_path / "ck")
    expected = Counter({("app", k): 1 for k in "abd"})
    assert stored(spark, spec) == expected
    # another checkpoint starts over and finds everything stored; the old runs stay
    stream(spark, spec, folder, tmp_path / "other")
    build_flow(spark, spec, read_pages(spark, str(folder))).deliver("r1")
    assert stored(spark, spec) == expected
    runs = {r.run_id for r in op.read_delivered(spark, spec.output.path).collect()}
    assert "r1" in runs and any(r.startswith("stream-") for r in runs)


def test_only_dates_at_hand_are_read(spark, tmp_path):
    spec, folder, day = flow_spec(tmp_path, "app", "web"), tmp_path / "pages", 86_400
    for number in range(4):
        land(spark, folder, number, (f"e{number}", number * day, "c"))
        build_flow(spark, spec, read_pages(spark, str(folder))).deliver(f"r{number}")
    index = Delivered(spark, spec.output.path)
    keys = index.keys([("app", date(1970, 1, 3)), ("web", date(1970, 1, 3))])
    assert [tuple(r) for r in keys.collect()] == [("app", date(1970, 1, 3), "e2")]
    assert len(keys.inputFiles()) == 1 and "event_date=1970-01-03" in keys.inputFiles()[0]
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert index.keys([("app", date(1970, 1, 3))], but_run="r2") is None
    assert index.keys([("app", date(1980, 1, 1))]) is None


def test_a_run_without_its_mark_still_counts(spark, tmp_path):
    spec, folder = flow_spec(tmp_path, "app"), tmp_path / "pages"
    land(spark, folder, 0, ("a", 10, "c"))
    build_flow(spark, spec, read_pages(spark, str(folder))).deliver("r1")
    index = Delivered(spark, spec.output.path)
    index.open_run("r1")  # as if the run were lost before it was closed
    build_flow(spark, spec, read_pages(spark, str(folder))).deliver("r2")
    assert stored(spark, spec) == {("app", "a"): 1}
    assert index.maxima().agg(F.sum("n")).first()[0] == 1


def test_a_smaller_rerun_frees_what_it_no_longer_holds(spark, tmp_path):
    spec, folder = flow_spec(tmp_path, "app"), tmp_path / "pages"
    land(spark, folder, 0, ("a", 10, "c"), ("b", 90_000, "c"))
    build_flow(spark, spec, read_pages(spark, str(folder))).deliver("r1")
    land(spark, tmp_path / "fewer", 0, ("a", 10, "c"))
    build_flow(spark, spec, read_pages(spark, str(tmp_path / "fewer"))).deliver("r1")
    build_flow(spark, spec, read_pages(spark, str(folder))).deliver("r2")
    assert stored(spark, spec) == {("app", "a"): 1, ("app", "b"): 1}


def test_offsets_come_from_maxima(spark, tmp_path):
    spec, folder = flow_spec(tmp_path, "app"), tmp_path / "pages"
    land(spark, folder, 0, ("a", 10, "c"), ("b", 900, "d"))
    build_flow(spark, spec, read_pages(spark, str(folder))).deliver("r1")
    land(spark, folder, 1, ("e", 500, "c"))
    build_flow(spark, spec, read_pages(spark, str(folder))).deliver("r2")
    maxima = Delivered(spark, spec.output.path).maxima()
    events = op.read_delivered(spark, spec.output.path)
    inputs = spark.createDataFrame(
        [("app", "i0", "c", 0, False), ("app", "i1", None, 0, False), ("none", "i2", None, 7, False)],
        "stream_key string, offset_key string, organization_id string, start_from bigint, override boolean",
    )
    assert not any("event_date" in f for f in maxima.inputFiles())

    def found(frame):
        return sorted(map(tuple, op.offsets_from_delivered(inputs, frame).collect()))

    assert found(maxima) == found(events) == [("i0", 500_000), ("i1", 900_000), ("i2", 7)]
    assert op.latest_ingested(maxima).collect() == op.latest_ingested(events).collect()


# --- what is not stored -----------------------------------------------------------------


def test_rejected_late_and_repeated_rows_of_a_stream_are_kept_or_counted(spark, tmp_path):
    spec = flow_spec(tmp_path, "app", "web", quarantine=str(tmp_path / "bad"))
    folder = tmp_path / "pages"
    land(spark, folder, 0, ("a", 10, "c"), ("b", 9_000, "c"), ("x", 20, None))
    land(spark, folder, 1, ("a", 10, "c"), ("late", 30, "c"), ("d", 8_000, "c"), ("d", 8_000, "c"))
    land(spark, folder, 2, ("w", 30, "c"), key="web")
    stream(spark, spec, folder, tmp_path / "ck", lateness="1 hour")
    # the repeated event is late as well, and so is kept as such
    assert stored(spark, spec) == {("app", "a"): 1, ("app", "b"): 1, ("app", "d"): 1, ("web", "w"): 1}
    bad = op.read_rejects(spark, spec.output.quarantine).collect()
    assert sorted((r.stream_key, r.idempotency_key, r.reject_reason) for r in bad) == [
        ("app", "a", "late"), ("app", "late", "late"), ("app", "x", "missing_org"),
    ]
    counts = Delivered(spark, spec.output.path).counts()
    total = {(r[0], r[1]): r[2] for r in counts.groupBy("stream_key", "outcome").agg(F.sum("n")).collect()}
    assert total == {
        ("app", "delivered"): 3, ("app", "late"): 2, ("app", "missing_org"): 1,
        ("app", "repeated"): 1, ("web", "delivered"): 1,
    }


def test_late_rows_need_a_place(spark, tmp_path):
    folder = tmp_path / "pages"
    land(spark, folder, 0, ("a", 10, "c"))
    flow = build_flow(spark, flow_spec(tmp_path, "app"), read_pages(spark, str(folder)))
    with pytest.raises(ValueError, match="quarantine"):
        flow.deliver("r1", lateness="1 hour")


def test_late_rows_of_one_stream_spread_over_tasks(spark):
    # the settings of large bars: no join is broadcast by its size, no partitions are merged
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    rows = spark.range(1_000).selectExpr(
        "if(id < 999, 'app', 'web') AS stream_key", "CAST(id AS string) AS idempotency_key",
        "timestamp_seconds(id * 60) AS event_ts", "CAST(NULL AS string) AS reject_reason",
    )
    maxima = spark.range(9).selectExpr(
        "if(id < 9, 'app', 'web') AS stream_key", "timestamp_seconds(36000 - id) AS event_ts"
    )
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = op.dedupe_events(_mark_late(rows, maxima, "1 hour"))
        found = found.withColumn("place", F.spark_partition_id()).collect()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    places = Counter(r.place for r in found)
    assert len(places) == 4 and max(places.values()) < 400
    # the other stream has no bar
    assert Counter(r.reject_reason for r in found) == {"late": 540, None: 460}
