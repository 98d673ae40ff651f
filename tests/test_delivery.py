import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidegauge import operators as op
from tidegauge.functions import json_string, object_text
from tidegauge.schema import EVENT, ddl

START = datetime(2024, 5, 1, 12, 0, 0, tzinfo=timezone.utc)


@pytest.fixture
def events(spark):
    def make(n, key="s", gap_ms=100, values=None):
        rows = [
            (key, f"id-{i:05d}", START + timedelta(milliseconds=gap_ms * i), f"org{i % 3}",
             sorted((values or {"n": str(i)}).items()))
            for i in range(n)
        ]
        return spark.createDataFrame(rows, ddl(EVENT))

    return make


def payloads(df):
    return [json.loads(r.payload) for r in op.to_payload(df).orderBy("idempotency_key").collect()]


def test_payload_shape(events):
    got = payloads(events(3))
    assert [sorted(p) for p in got] == [
        ["idempotency_key", "key", "organization_id", "timestamp", "values"]
    ] * 3
    # three events 100 ms apart share the second
    assert {p["timestamp"] for p in got} == {"2024-05-01T12:00:00Z"}
    assert got[1] == {"organization_id": "org1", "timestamp": "2024-05-01T12:00:00Z", "key": "s",
                      "idempotency_key": "id-00001", "values": {"n": 1}}


def test_reserved_names_are_left_out(events):
    values = {"key": "1", "organization_id": '"x"', "timestamp": "2", "idempotency_key": "3",
              "s_key": "4", "s_timestamp": "5", "other_key": "6", "keys": "7", "s_s_key": "8"}
    assert payloads(events(1, values=values))[0]["values"] == {"other_key": 6, "keys": 7, "s_s_key": 8}
    counts = op.reserved_fields(events(2, values=values), ("key", "timestamp")).collect()
    assert {(r.k, r.n) for r in counts} == {("key", 2), ("timestamp", 2)}


def test_default_key_and_odd_text(events):
    frame = events(1, key="").withColumn("organization_id", F.lit('o"\n😀'))
    got = payloads(frame)[0]
    assert got["key"] == "a_valid_source" and got["organization_id"] == 'o"\n😀'
    none = events(1).withColumn("stream_key", F.lit(None).cast("string"))
    assert payloads(none)[0]["key"] == "a_valid_source"


def test_prefix_values(events):
    frame = op.prefix_values(events(1, key=" k ", values={"b": "1", "a": '"x"'}))
    assert frame.select(object_text(F.col("entries"))).first()[0] == '{"k_a": "x", "k_b": 1}'
    assert op.prefix_values(events(1, key="  ")).first()["entries"][0]["k"] == "n"


def test_foreign_values(spark):
    texts = ['{"b": 1, "a": "1", "c": {"d": [1, 2.5]}}', "[1]", "5", "oops", None, "{}", '{"n": null}']
    frame = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string")
    rows = frame.select("i", object_text(op.entries_of(F.col("s"))).alias("o")).orderBy("i").collect()
    assert [json.loads(r.o) for r in rows] == [
        {"b": 1, "a": "1", "c": {"d": [1, 2.5]}}, {}, {}, {}, {}, {}, {"n": None}
    ]


@pytest.mark.parametrize("n, sizes", [(49, [49]), (50, [50]), (51, [50, 1]), (149, [50, 50, 49]), (0, [])])
def test_batches_of_fifty(events, n, sizes):
    batches = op.request_batches(op.to_payload(events(n)), slice_ms=1_000).orderBy("batch_no").collect()
    assert [b.n for b in batches] == sizes
    ids = [p["idempotency_key"] for b in batches for p in json.loads(b.body)]
    assert ids == [f"id-{i:05d}" for i in range(n)]


def test_batches_of_several_streams(events):
    both = op.merge_streams(events(60, "a"), events(55, "b"))
    got = op.request_batches(op.to_payload(both)).collect()
    assert sorted((b.stream_key, b.batch_no, b.n) for b in got) == [
        ("a", 0, 50), ("a", 1, 10), ("b", 0, 50), ("b", 1, 5)
    ]


class Outbox:
    """A poster that records requests as files and fails the first ``failures`` times."""

    def __init__(self, folder, failures=0):
        self.folder, self.failures = str(folder), failures

    def __call__(self, body):
        import os
        import uuid

        tries = os.path.join(self.folder, "tries")
        os.makedirs(tries, exist_ok=True)
        if len(os.listdir(tries)) < self.failures:
            open(os.path.join(tries, uuid.uuid4().hex), "w").close()
            raise OSError("unavailable")
        with open(os.path.join(self.folder, uuid.uuid4().hex + ".json"), "w") as out:
            out.write(body)

    def requests(self):
        import glob

        return [json.load(open(f)) for f in glob.glob(self.folder + "/*.json")]


def test_http_delivery_posts_every_event_once(events, tmp_path):
    box = Outbox(tmp_path)
    op.deliver(events(230).repartition(2), "http", post=box)
    sent = [p["idempotency_key"] for r in box.requests() for p in r]
    assert sorted(sent) == [f"id-{i:05d}" for i in range(230)]
    assert max(len(r) for r in box.requests()) == 50


def test_http_delivery_retries_then_fails(events, tmp_path):
    flaky = Outbox(tmp_path / "flaky", failures=4)
    rows = op.send_requests(events(10).coalesce(1), flaky, backoff_s=0.0).collect()
    assert [(r.n, r.attempts) for r in rows] == [(10, 5)]
    dead = Outbox(tmp_path / "dead", failures=5)
    with pytest.raises(Exception, match="unavailable"):
        op.send_requests(events(1), dead, backoff_s=0.0).collect()


def test_table_delivery_can_be_rerun(spark, events, tmp_path):
    path = str(tmp_path / "delivered")
    op.deliver(events(40), "table", path=path, run_id="r1")
    op.deliver(events(40), "table", path=path, run_id="r1")
    table = op.read_delivered(spark, path)
    assert table.count() == 40
    assert {"event_date", "stream_key", "run_id", "ingested_at"} <= set(table.columns)
    op.deliver(events(5, key="t"), "table", path=path, run_id="r2")
    assert spark.read.parquet(path).count() == 45
    latest = op.latest_ingested(spark.read.parquet(path), "s").first().event_ts
    assert latest.replace(tzinfo=timezone.utc) == START + timedelta(milliseconds=3900)


def test_console_noop_and_unknown_modes(events):
    op.deliver(events(1), "console")
    op.deliver(events(1), "noop")
    with pytest.raises(ValueError, match="unknown delivery mode"):
        op.deliver(events(1), "null")


def test_entries_survive_the_table(spark, events, tmp_path):
    path = str(tmp_path / "t")
    frame = events(1, values={"a": "1.5", "b": json.dumps("é")})
    op.write_table(frame, path, "r")
    back = spark.read.parquet(path).select(object_text(F.col("entries"))).first()[0]
    assert back == '{"a": 1.5, "b": "\\u00e9"}'
    assert spark.range(1).select(json_string(F.lit("é"))).first()[0] == '"\\u00e9"'


def test_a_changed_retry_leaves_nothing_of_the_first_attempt(spark, events, tmp_path):
    path = str(tmp_path / "t")
    first = events(9, "007").withColumn("event_ts", F.col("event_ts") + F.expr("interval 3 days"))
    op.write_table(first, path, "r")
    op.write_table(events(5, "007"), path, "r")
    stored = op.read_delivered(spark, path)
    assert {(r.stream_key, r.idempotency_key) for r in stored.collect()} == {
        ("007", f"id-{i:05d}") for i in range(5)
    }
    assert op.read_delivered(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError, match="run_id"):
        op.write_table(events(1), path, "a/b")


def test_only_new_events_of_an_overlapping_run(spark, events, tmp_path):
    path = str(tmp_path / "t")
    op.write_table(events(6), path, "r1")
    stored = op.read_delivered(spark, path)
    assert op.not_delivered(events(10), stored).count() == 4
    assert op.not_delivered(events(10), stored, "r1").count() == 10


class Lines:
    """Appends each payload to a file of its own."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, payload):
        import os
        import uuid

        with open(os.path.join(self.folder, uuid.uuid4().hex), "w") as out:
            out.write(payload)


def test_console_writes_every_payload_uncut(events, tmp_path):
    op.deliver(events(60), "console", write=Lines(tmp_path))
    payloads = [json.loads(f.read_text()) for f in tmp_path.iterdir()]
    assert sorted(p["idempotency_key"] for p in payloads) == [f"id-{i:05d}" for i in range(60)]
