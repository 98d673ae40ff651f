"""Committed offsets under several writers, conditions and long histories."""

import threading
from datetime import UTC, datetime

import pytest

from tidegauge.operators.ledger import Conflict, Ledger, OffsetStore
from tidegauge.operators.ranges import OffsetTable


def rows(spark, *offsets):
    data = [(k, o, datetime.fromtimestamp(at, UTC)) for k, o, at in offsets]
    return spark.createDataFrame(data, "stream_key string, offset_ms bigint, updated_at timestamp")


def stored(store):
    return {r.stream_key: r.offset_ms for r in store.current().collect()}


def test_store_upserts_like_the_appended_log(spark, tmp_path):
    store, table = (
        OffsetStore(spark, str(tmp_path / "store")), OffsetTable(spark, str(tmp_path / "table")),
    )
    commits = [
        [("a", 100, 10), ("b", 50, 10)], [("a", 300, 20)], [("a", 200, 15), ("c", 7, 15)],
        [("b", 40, 30)], [("c", 7, 40), ("c", 9, 40)],
    ]
    for batch in commits:
        store.commit(rows(spark, *batch))
        table.commit(rows(spark, *batch))
    assert stored(store) == stored(table) == {"a": 300, "b": 40, "c": 9}


def test_suffixes_share_a_store(spark, tmp_path):
    path = str(tmp_path / "store")
    plain, keyed = OffsetStore(spark, path), OffsetStore(spark, path, "current_offset")
    keyed.commit(rows(spark, ("a", 5, 1)))
    plain.commit(rows(spark, ("b", 6, 1)))
    assert stored(keyed) == {"a": 5}
    assert stored(plain) == {"a:current_offset": 5, "b": 6}


def test_seed_keeps_later_offsets(spark, tmp_path):
    store = OffsetStore(spark, str(tmp_path / "store"))
    store.commit(rows(spark, ("a", 100, 1), ("b", 100, 1), ("c", 100, 1)))
    inputs = spark.createDataFrame(
        [("a", 50, False), ("b", 150, False), ("c", 20, True), ("d", 1, False)],
        "stream_key string, start_from bigint, override boolean",
    )
    store.seed(inputs)
    assert stored(store) == {"a": 100, "b": 150, "c": 20, "d": 1}


def test_long_histories_read_one_file(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    for n in range(60):
        assert ledger.commit(lambda state, n=n: state | {"n": n}) == n + 1
    assert ledger.commit(lambda state: state) == 60
    opened = []
    read = ledger.files.read
    ledger.files.read = lambda path: opened.append(path) or read(path)
    assert ledger.read() == (60, {"n": 59})
    assert len(opened) == 1
    assert len(list((tmp_path / "ledger").glob("[0-9]*.json"))) <= 12


def test_racing_writers_lose_nothing(spark, tmp_path):
    path, made = str(tmp_path / "ledger"), []

    def add(name):
        ledger = Ledger(spark, path)
        for n in range(8):
            made.append(ledger.commit(lambda state, n=n: state | {f"{name}{n}": n}, tries=1000))

    writers = [threading.Thread(target=add, args=(name,)) for name in "abcd"]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    version, state = Ledger(spark, path).read()
    assert version == 32 and len(state) == 32
    assert sorted(made) == list(range(1, 33))


def test_of_two_writers_one_retries(spark, tmp_path):
    path, seen = str(tmp_path / "ledger"), []
    slow, fast = Ledger(spark, path), Ledger(spark, path)

    def change(state):
        seen.append(dict(state))
        if len(seen) == 1:
            fast.commit(lambda s: s | {"fast": 1})
        return state | {"slow": 1}

    assert slow.commit(change) == 2
    assert seen == [{}, {"fast": 1}]
    assert slow.read() == (2, {"fast": 1, "slow": 1})


def test_conditional_commits(spark, tmp_path):
    store = OffsetStore(spark, str(tmp_path / "store"))
    store.commit(rows(spark, ("a", 1, 1)), expected={"a": None})
    store.commit(rows(spark, ("a", 2, 2), ("b", 1, 2)), expected={"a": 1})
    with pytest.raises(Conflict):
        store.commit(rows(spark, ("a", 3, 3), ("b", 9, 3)), expected={"a": 1})
    assert stored(store) == {"a": 2, "b": 1}
