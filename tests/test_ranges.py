import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegauge import operators as op
from tidegauge.operators import OffsetTable

HOUR = 3_600_000


def planned(spark, cases, step, **options):
    frame = spark.createDataFrame([(str(i), o, n) for i, (o, n) in enumerate(cases)],
                                  "stream_key string, offset_ms bigint, n bigint")
    rows = op.plan_ranges(frame, F.col("n"), step, **options).collect()
    out = [[] for _ in cases]
    for r in rows:
        out[int(r.stream_key)].append((r.start_ms, r.end_ms))
    return [sorted(x) for x in out]


def stepped(offset, now, step):
    """The planner as the loop it replaces."""
    out = []
    while offset < now:
        head = min(offset + (HOUR if now - offset > HOUR else step), now)
        out.append((offset, head))
        offset = head
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(10**9, 10**12), st.integers(-HOUR, 9 * HOUR)), min_size=20, max_size=40
    ),
    st.sampled_from([24_000, 60_000]),
)
def test_ranges_equal_the_loop(spark, cases, step):
    cases = [(offset, offset + lag) for offset, lag in cases]
    assert planned(spark, cases, step) == [stepped(o, n, step) for o, n in cases]


def test_edges(spark):
    start = 10**12
    lags = [0, -5, 1, HOUR - 1, HOUR, HOUR + 1, 61 * 60_000, 5 * HOUR // 2]
    cases = [(start, start + lag) for lag in lags]
    got = planned(spark, cases, 60_000)
    assert got == [stepped(o, n, 60_000) for o, n in cases]
    assert got[0] == got[1] == []
    assert got[4][0] == (start, start + 60_000)  # exactly an hour behind: steps
    assert got[5][0] == (start, start + HOUR)
    assert got[6] == [(start, start + HOUR), (start + HOUR, start + HOUR + 60_000)]


def test_overlap_rereads_the_tail(spark):
    got = planned(spark, [(1_000_000, 1_060_000)], 24_000, overlap_ms=5_000)
    assert got == [[(995_000, 1_024_000), (1_019_000, 1_048_000), (1_043_000, 1_060_000)]]


INPUTS = "stream_key string, start_from bigint, override boolean"


def offsets_of(df):
    return {r.stream_key: r.offset_ms for r in df.collect()}


def test_resolve_offsets(spark):
    inputs = spark.createDataFrame(
        [("new", 10, False), ("ahead", 10, False), ("behind", 10, False), ("forced", 10, True)], INPUTS
    )
    stored = spark.createDataFrame(
        [("ahead", 99), ("behind", 5), ("forced", 99), ("other", 1)], "stream_key string, offset_ms bigint"
    )
    assert offsets_of(op.resolve_offsets(inputs, stored)) == {
        "new": 10, "ahead": 99, "behind": 10, "forced": 10
    }


def test_current_offsets_take_the_last_write(spark):
    log = spark.createDataFrame(
        [("a", 5, 1), ("a", 3, 2), ("b", 7, 1)], "stream_key string, offset_ms bigint, t int"
    ).withColumn("updated_at", F.timestamp_seconds("t"))
    assert offsets_of(op.current_offsets(log)) == {"a": 3, "b": 7}


DELIVERED = [("s", "o1", 1717171717171999), ("s", "o2", 1717171717999000), ("t", "o1", 5_000_000)]


@pytest.fixture
def delivered(spark):
    frame = spark.createDataFrame(DELIVERED, "stream_key string, organization_id string, us bigint")
    return frame.withColumn("event_ts", F.timestamp_micros("us"))


def test_offsets_from_delivered_events(spark, delivered):
    inputs = spark.createDataFrame(
        [("s", 10, False), ("t", 9_000, False), ("empty", 42, False)], INPUTS
    )
    assert offsets_of(op.offsets_from_delivered(inputs, delivered)) == {
        "s": 1717171717999, "t": 9_000, "empty": 42
    }
    forced = spark.createDataFrame([("s", 10, True)], INPUTS)
    assert offsets_of(op.offsets_from_delivered(forced, delivered)) == {"s": 10}


def test_latest_ingested(delivered):
    def ms(df):
        return [r[0] for r in df.select(F.unix_millis("event_ts")).collect()]

    assert ms(op.latest_ingested(delivered, "s", "o1")) == [1717171717171]
    assert ms(op.latest_ingested(delivered, "s")) == [1717171717999]
    assert ms(op.latest_ingested(delivered, "s", "  ")) == [1717171717999]
    assert ms(op.latest_ingested(delivered, "none")) == []
    digest = hashlib.sha256(b"o1").hexdigest()
    hashed = delivered.withColumn("organization_id", F.sha2("organization_id", 256))
    assert hashed.where(F.col("organization_id") == digest).count() == 2
    assert ms(op.latest_ingested(hashed, "s", "hash:o1")) == [1717171717171]


@pytest.mark.parametrize("suffix", [None, "current_offset"])
def test_offset_table(spark, tmp_path, suffix):
    table = OffsetTable(spark, str(tmp_path / "offsets"), suffix)
    assert table.current().count() == 0
    inputs = spark.createDataFrame([("a", 100, False), ("b", 200, False)], INPUTS)
    table.seed(inputs)
    assert offsets_of(table.current()) == {"a": 100, "b": 200}
    ranges = spark.createDataFrame(
        [("a", 100, 150), ("a", 150, 180), ("b", 200, 260)],
        "stream_key string, start_ms bigint, end_ms bigint",
    )
    done = spark.createDataFrame([("a",)], "stream_key string")
    table.commit(op.commit_offsets(ranges, done))
    assert offsets_of(table.current()) == {"a": 180, "b": 200}
    table.seed(inputs)  # nothing moves back
    assert offsets_of(table.current()) == {"a": 180, "b": 200}
    table.seed(spark.createDataFrame([("a", 100, True)], INPUTS))
    assert offsets_of(table.current()) == {"a": 100, "b": 200}
    if suffix:
        stored = spark.read.parquet(str(tmp_path / "offsets"))
        assert {r.stream_key for r in stored.collect()} == {f"a:{suffix}", f"b:{suffix}"}


def test_offset_keys_and_duplicates(spark):
    names = ["x", "y", "x", "z", "x", "y"]
    inputs = spark.createDataFrame(list(enumerate(names)), "pos bigint, stream_key string")
    # small slices, so that one key spans several
    rows = op.offset_keys(inputs, slice_rows=2).orderBy("pos").collect()
    assert [r.offset_key for r in rows] == ["x_0", "y_0", "x_1", "z", "x_2", "y_1"]
    assert {(r.stream_key, r.n) for r in op.duplicate_streams(inputs).collect()} == {("x", 3), ("y", 2)}


def test_number_rows_equals_row_number_on_a_hot_key(spark):
    frame = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("key"),
        ((F.col("id") * 7919) % 5000).alias("at"),
    )
    numbered = op.number_rows(frame, ["key"], ["at"], F.floor(F.col("at") / 100), total="all")
    frame.createOrReplaceTempView("frame")
    plain = spark.sql(
        "select key, at, cast(row_number() over (partition by key order by at) as bigint) row_no, "
        "count(*) over (partition by key) `all` from frame"
    )
    assert numbered.exceptAll(plain).count() == 0 and plain.exceptAll(numbered).count() == 0
    # no task orders a whole key: the sorting window is over key and slice
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "row_number() windowspecdefinition(_key" in plan and "_slice" in plan


def test_number_rows_counts_rows_without_a_key(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "key string, at int")
    rows = op.number_rows(frame, ["key"], ["at"], F.floor(F.col("at") / 2)).collect()
    assert sorted((r.key or "", r.at, r.row_no) for r in rows) == [("", 1, 1), ("", 2, 2), ("a", 1, 1)]


def test_number_rows_shuffles_the_rows_once(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = spark.range(100).selectExpr("id % 3 as key", "id as at")
        numbered = op.number_rows(frame, ["key"], ["at"], F.floor(F.col("at") / 10))
        plan = numbered._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # rows by (key, slice); counts by (key, slice), by key, and back for the join
    assert plan.count("Exchange hashpartitioning") <= 4 and "SortMergeJoin" in plan
