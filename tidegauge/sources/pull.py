"""A data source that pulls pages per time range, in batch and as a stream.

The transport is a callable the user supplies: ``fetch(input_key, start_ms, end_ms)``, where
the input key is the stream key, numbered if several inputs share one (``input_keys``). It
yields ``(query_index, body)`` for every page of that range, both ends as in
``[start, end)``. One range is one Spark partition, so a long catch-up runs on all
executors, and a lost executor re-reads only its own ranges. The stream's offset is the
next unread millisecond per input and lives in the checkpoint.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from tidegauge.plans.spec import (
    CATCH_UP_MS,
    CATCH_UP_WAIT_MS,
    LAG_BUFFER_MS,
    STEP_MS,
    input_keys,
)
from tidegauge.schema import INPUT_PAGES, ddl

PageFetcher = Callable[[str, int, int], Iterable[tuple[int | None, str]]]

#: Characters of page bodies after which an Arrow batch is handed over.
BATCH_CHARS = 1 << 20
_ARROW = {"bigint": pa.int64(), "int": pa.int32()}
_PAGES = pa.schema([(c, _ARROW.get(t, pa.string())) for c, t in INPUT_PAGES.items()])


class TimeRange(InputPartition):
    def __init__(
        self, stream_key: str, provider: str, kind: str, input_key: str, start_ms: int, end_ms: int
    ):
        self.stream_key, self.provider, self.kind = stream_key, provider, kind
        self.input_key, self.start_ms, self.end_ms = input_key, start_ms, end_ms


class TimeRanges(InputPartition):
    """Ranges that one task fetches one after another."""

    def __init__(self, ranges: list[TimeRange]):
        self.ranges = ranges


def next_head(at: int, now: int, step_ms: int) -> int:
    """End of the range that starts at ``at``: a catch-up window while more than one behind."""
    width = CATCH_UP_MS if now - at > CATCH_UP_MS else step_ms
    return min(at + width, now)


def wait_after(end: int | None, now: int, step_ms: int) -> int:
    """How long an input waits after a poll whose range ended at ``end`` (``None``: nothing was
    left to fetch): shortly while it still lags by more than a step and a buffer."""
    lags = end is not None and now - end > step_ms + LAG_BUFFER_MS
    return CATCH_UP_WAIT_MS if lags else step_ms


class _Inputs:
    """The ``inputs`` option: a JSON list of ``{stream_key, provider, kind, start_from}``.

    ``only`` cuts it down to inputs by a JSON object of column and value, and ``from_ms`` and
    ``until_ms`` a batch to the ranges that start within; nothing else is fetched.
    ``ranges_per_task`` lets a task fetch several ranges of an input, where a long lag would
    otherwise start very many short tasks.
    """

    def __init__(self, options: dict[str, str]):
        self.rows = json.loads(options["inputs"])
        for row, key in zip(self.rows, input_keys([r["stream_key"] for r in self.rows]), strict=True):
            row.setdefault("input_key", key)
        for pos, row in enumerate(self.rows):
            row["name"] = f"{row['stream_key']}|{row['provider']}|{row['kind']}|{pos}"
        only = json.loads(options.get("only", "{}"))
        self.rows = [r for r in self.rows if all(r[c] == v for c, v in only.items())]
        self.since = int(options.get("from_ms") or 0)
        self.until = int(options.get("until_ms") or 0)
        self.fixed_now = options.get("now_ms") or options.get("nowMs") or options.get("nowms")
        self.limit = int(
            options.get("max_ranges_per_trigger") or options.get("maxRangesPerTrigger") or 0
        )
        self.per_task = int(options.get("ranges_per_task") or 1)
        self.adaptive = options.get("adaptive", "false").lower() == "true"

    def named(self) -> Iterator[tuple[str, dict]]:
        """The inputs by names that also tell inputs of one stream key apart."""
        for row in self.rows:
            yield row["name"], row

    def now(self) -> int:
        return int(self.fixed_now) if self.fixed_now else time.time_ns() // 1_000_000

    def ranges(self, row: dict, start: int, end: int, now: int) -> Iterator[TimeRange]:
        """Ranges from ``start`` to ``end`` as planned at the moment ``now``."""
        step, at = STEP_MS[row["kind"]], start
        while at < end:
            head = min(next_head(at, now, step), end)
            if self.since <= at and (not self.until or at < self.until):
                yield TimeRange(
                    row["stream_key"], row["provider"], row["kind"], row["input_key"], at, head
                )
            at = head


def _read(fetch: PageFetcher, part: TimeRange) -> Iterator[tuple]:
    pages = fetch(part.input_key, part.start_ms, part.end_ms)
    for page_no, (query_index, body) in enumerate(pages):
        yield (
            part.stream_key, part.provider, part.kind, query_index,
            part.start_ms, part.end_ms, page_no, body, part.input_key,
        )


def _batches(pages: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Pages in batches bounded by their text. Of tuples Spark would make batches of 10,000 pages,
    so a task would hold the bodies of all its ranges, several times over."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [
            pa.array([v if v is None or isinstance(v, str) else str(v) for v in values], f.type)
            if f.type == pa.string() else pa.array(values, f.type)
            for values, f in zip(zip(*rows, strict=True), _PAGES, strict=True)
        ]
        return pa.RecordBatch.from_arrays(columns, schema=_PAGES)

    body = _PAGES.get_field_index("body")
    rows, chars = [], 0
    for page in pages:
        rows.append(page)
        chars += len(page[body] or "")
        if chars >= BATCH_CHARS or len(rows) >= 1_000:
            yield batch(rows)
            rows, chars = [], 0
    if rows:
        yield batch(rows)


def pull_ranges(ranges: DataFrame, fetch: PageFetcher, tasks: int | None = None) -> DataFrame:
    """The pages of planned ranges ``(stream_key, provider, kind, input_key, start_ms, end_ms)``.

    The ranges are dealt to ``tasks`` tasks, as many as there are shuffle partitions by
    default, which fetch one range after another; a task holds one page at a time. The ranges
    themselves never pass through the driver, however long the lag is.
    """
    columns = ["stream_key", "provider", "kind", "input_key", "start_ms", "end_ms"]

    def pull(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for page in _read(fetch, TimeRange(**row)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], f.type) for v, f in zip(page, _PAGES, strict=True)],
                        schema=_PAGES,
                    )

    tasks = tasks or int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ranges.select(*columns).repartition(tasks, "input_key", "start_ms")
    return dealt.mapInArrow(pull, ddl(INPUT_PAGES))


class _BatchReader(DataSourceReader):
    def __init__(self, fetch: PageFetcher, options: dict[str, str]):
        self.fetch, self.inputs = fetch, _Inputs(options)

    def partitions(self) -> list[TimeRanges]:
        now, size = self.inputs.now(), self.inputs.per_task
        tasks = []
        for row in self.inputs.rows:
            ranges = list(self.inputs.ranges(row, row["start_from"], now, now))
            tasks += [TimeRanges(ranges[at : at + size]) for at in range(0, len(ranges), size)]
        return tasks

    def read(self, partition: TimeRanges) -> Iterator[pa.RecordBatch]:
        return _batches(page for part in partition.ranges for page in _read(self.fetch, part))


class _StreamReader(DataSourceStreamReader):
    """Offsets are ``{"heads": {input: next unread ms}, "now": planning time}``; an input is
    named by its stream key, provider, kind and place. With the planning time in the offset, a
    replayed batch is cut into the same ranges.

    With the ``adaptive`` option every input has times of its own at which it is polled for one
    range: shortly after the last one while it lags, else after a step. An input that waits adds
    nothing to a batch, and no batch starts while all wait. A restart polls all inputs at once.
    """

    def __init__(self, fetch: PageFetcher, options: dict[str, str]):
        self.fetch, self.inputs = fetch, _Inputs(options)
        self.reached: dict[str, int] = {}
        self.wakes: dict[str, int] = {}
        self.offered: dict | None = None

    def initialOffset(self) -> dict:
        return {"heads": {k: r["start_from"] for k, r in self.inputs.named()}, "now": 0}

    def _polled(self) -> dict:
        """The offset with one more range for each input whose time has come."""
        now = self.inputs.now()
        heads, due = {}, False
        for name, row in self.inputs.named():
            at = heads[name] = max(self.reached.get(name, 0), row["start_from"])
            if now < self.wakes.get(name, now):
                continue
            step = STEP_MS[row["kind"]]
            head = next_head(at, now, step)
            # waits add up from the first poll, whatever a batch took meanwhile
            wait = wait_after(head if head > at else None, now, step)
            self.wakes[name] = self.wakes.get(name, now) + wait
            if head > at:
                heads[name], due = head, True
        if due or self.offered is None:
            self.offered = {"heads": heads, "now": now}
        self.reached = {k: max(v, self.reached.get(k, v)) for k, v in heads.items()}
        return self.offered

    def latestOffset(self) -> dict:
        if self.inputs.adaptive:
            return self._polled()
        now, limit = self.inputs.now(), self.inputs.limit
        heads = {}
        for name, row in self.inputs.named():
            at = max(self.reached.get(name, 0), row["start_from"])
            if not limit:
                at = max(at, now)
            # a limited trigger advances every input by up to `limit` ranges
            for _ in range(limit):
                if at < now:
                    at = next_head(at, now, STEP_MS[row["kind"]])
            heads[name] = at
        return {"heads": heads, "now": now}

    def partitions(self, start: dict, end: dict) -> list[TimeRange | TimeRanges]:
        self.reached = dict(end["heads"])
        size, tasks = self.inputs.per_task, []
        for name, row in self.inputs.named():
            if name not in end["heads"]:
                continue
            since = start["heads"].get(name, row["start_from"])
            ranges = list(self.inputs.ranges(row, since, end["heads"][name], end["now"]))
            if size > 1:
                ranges = [TimeRanges(ranges[at : at + size]) for at in range(0, len(ranges), size)]
            tasks += ranges
        return tasks

    def read(self, partition: TimeRange | TimeRanges) -> Iterator[pa.RecordBatch]:
        ranges = partition.ranges if isinstance(partition, TimeRanges) else [partition]
        return _batches(page for part in ranges for page in _read(self.fetch, part))

    def commit(self, end: dict) -> None:
        self.reached = dict(end["heads"])


@dataclass(frozen=True)
class PulledPages:
    """Pages of a registered pull source, as a frame of all inputs or of one.

    A flow takes each input's pages from a frame of its own, whose source fetches nothing else.
    That is done by options of the source: filters that Spark 4.1 pushes into a Python source stay
    with the frame, so a frame used under two filters would lose rows.
    """

    spark: SparkSession
    options: Mapping[str, str]
    source: str = "paged_pull"
    streaming: bool = False

    def frame(self, **only: str) -> DataFrame:
        """Pages of all inputs, or of those with the given stream key, provider, kind, input key."""
        reader = self.spark.readStream if self.streaming else self.spark.read
        chosen = dict(self.options) | ({"only": json.dumps(only)} if only else {})
        return reader.format(self.source).options(**chosen).load()


def paged_pull_source(fetch: PageFetcher, source: str = "paged_pull") -> type[DataSource]:
    """A data source class around a fetcher, to register under its name."""

    class PagedPull(DataSource):
        @classmethod
        def name(cls) -> str:
            return source

        def schema(self):
            return ddl(INPUT_PAGES)

        def reader(self, schema) -> DataSourceReader:
            return _BatchReader(fetch, self.options)

        def streamReader(self, schema) -> DataSourceStreamReader:
            return _StreamReader(fetch, self.options)

    return PagedPull


def register_paged_pull(
    spark: SparkSession, fetch: PageFetcher, source: str = "paged_pull"
) -> None:
    spark.dataSource.register(paged_pull_source(fetch, source))
