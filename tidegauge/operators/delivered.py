"""What a delivered table holds, kept beside it when a run is written.

Below the table, in folders that readers of the table pass over:

``_dates/event_date=D/stream_key=S/R``   run R stored events of stream S on date D
``_maxima/run_id=R``                     latest event and number of events per stream and organisation
``_counts/run_id=R``                     rows of a flow's run by outcome
``_done/R``                              run R is stored whole, and where

A run without its ``_done`` mark, left by a crash or by older code, is looked up in its own
folders, so nothing that is stored counts as new.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.files import Files
from tidegauge.schema import ENTRIES, ddl

#: What makes two stored events the same one; a repeated event has its time, so its date, again.
STORED_KEY = ["stream_key", "event_date", "idempotency_key"]
_KEYS = {
    "idempotency_key": "string", "event_ts": "timestamp", "organization_id": "string",
    "entries": ENTRIES, "run_id": "string", "stream_key": "string", "event_date": "date",
}
_MAXIMA = {
    "stream_key": "string", "organization_id": "string", "event_ts": "timestamp", "n": "bigint",
    "run_id": "string",
}
COUNTS = {"stream_key": "string", "outcome": "string", "n": "bigint", "run_id": "string"}


class Delivered:
    """The index of a delivered table at a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)

    # --- writing ----------------------------------------------------------------------

    def open_run(self, run_id: str) -> None:
        """Before a run is written: until ``close_run`` it is in doubt."""
        self.files.remove(f"{self.path}/_done/{run_id}.open")
        done = f"{self.path}/_done/{run_id}"
        if self.files.exists(done):
            # the marks of an earlier attempt, to be cleared when this one stands
            self.files.create(f"{self.path}/_done/{run_id}.open", self.files.read(done))
            self.files.remove(done)

    def close_run(self, run_id: str) -> None:
        """After a run is written: note its dates and maxima, then that it is whole."""
        root = f"{self.path}/run_id={run_id}"
        places = [
            [day, stream]
            for stream in self.files.names(root)
            if stream.startswith("stream_key=")
            for day in self.files.names(f"{root}/{stream}")
        ]
        stored = self._read([root]) if places else self.spark.createDataFrame([], ddl(_KEYS))
        stored.groupBy("stream_key", "organization_id").agg(
            F.max("event_ts").alias("event_ts"), F.count(F.lit(1)).alias("n")
        ).write.mode("overwrite").parquet(f"{self.path}/_maxima/run_id={run_id}")
        for day, stream in places:
            self.files.mark(f"{self.path}/_dates/{day}/{stream}/{run_id}")
        earlier = f"{self.path}/_done/{run_id}.open"
        if self.files.exists(earlier):
            for day, stream in json.loads(self.files.read(earlier)):
                if [day, stream] not in places:
                    self.files.remove(f"{self.path}/_dates/{day}/{stream}/{run_id}")
            self.files.remove(earlier)
        self.files.create(f"{self.path}/_done/{run_id}", json.dumps(places))

    # --- looking up -------------------------------------------------------------------

    def _in_doubt(self) -> list[str]:
        runs = [n.removeprefix("run_id=") for n in self.files.names(self.path) if n.startswith("run_id=")]
        if not runs:
            return []
        return sorted(set(runs).difference(self.files.names(f"{self.path}/_done")))

    def _read(self, paths: list[str]) -> DataFrame:
        # explicit folders: neither other dates nor other runs are listed
        return self.spark.read.schema(ddl(_KEYS)).option("basePath", self.path).parquet(*paths)

    def _folders(self, places: list[tuple[str | None, date]], but_run: str | None) -> Iterator[str]:
        doubtful = [r for r in self._in_doubt() if r != but_run]
        for stream, day in places:
            folder = f"{self.files.partition('stream_key', stream)}/event_date={day}"
            marks = f"{self.path}/_dates/event_date={day}/{self.files.partition('stream_key', stream)}"
            for run in self.files.names(marks):
                if run != but_run and run not in doubtful:
                    yield f"{self.path}/run_id={run}/{folder}"
            for run in doubtful:
                if self.files.exists(found := f"{self.path}/run_id={run}/{folder}"):
                    yield found

    def keys(
        self, places: list[tuple[str | None, date]], but_run: str | None = None
    ) -> DataFrame | None:
        """Stored keys of these streams and dates by other runs, or ``None`` if there are none.

        Only folders of these streams and dates are listed and read, and of them only the key.
        """
        folders = list(self._folders(places, but_run))
        if not folders:
            return None
        days = sorted({day for _, day in places if day is not None})
        stored = self._read(folders)
        return stored.where(F.col("event_date").isin(days)).select(*STORED_KEY)

    def not_delivered(self, events: DataFrame, run_id: str | None = None) -> DataFrame:
        """Events whose key no other run stored; what ``run_id`` itself stored doesn't count.

        ``events`` is read twice, so it should be a landed table. The dates at hand come to the
        driver, one row per partition that the events will be written to. Stored keys are first
        cut down to those at hand: beside few new events the stored keys are only scanned, and
        the shuffle holds no more than the repeats.
        """
        dated = events.withColumn("event_date", F.to_date("event_ts"))
        places = [tuple(r) for r in dated.select("stream_key", "event_date").distinct().collect()]
        known = self.keys(places, run_id)
        if known is None:
            return events
        repeats = known.join(dated.select(*STORED_KEY), STORED_KEY, "left_semi")
        return dated.join(repeats, STORED_KEY, "left_anti").select(*events.columns)

    def maxima(self, but_run: str | None = None) -> DataFrame:
        """``(stream_key, organization_id, event_ts, n)`` per run: latest event and their number.

        What ``latest_ingested`` and ``offsets_from_delivered`` take instead of the events; no
        event is read but those of runs in doubt.
        """
        doubtful = self._in_doubt()
        rows = self.spark.createDataFrame([], ddl(_MAXIMA))
        if self.files.names(f"{self.path}/_maxima"):
            known = self.spark.read.schema(ddl(_MAXIMA)).parquet(f"{self.path}/_maxima")
            rows = known.where(~F.col("run_id").isin(doubtful)) if doubtful else known
        if doubtful:
            late = self._read([f"{self.path}/run_id={r}" for r in doubtful])
            rows = rows.unionByName(
                late.groupBy("stream_key", "organization_id", "run_id").agg(
                    F.max("event_ts").alias("event_ts"), F.count(F.lit(1)).alias("n")
                )
            )
        return rows if but_run is None else rows.where(F.col("run_id") != but_run)

    # --- outcomes ---------------------------------------------------------------------

    def write_counts(self, counts: DataFrame, run_id: str) -> None:
        counts.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_counts/run_id={run_id}")

    def counts(self) -> DataFrame:
        """``(stream_key, outcome, n, run_id)`` of all runs of flows into the table."""
        if not self.files.names(f"{self.path}/_counts"):
            return self.spark.createDataFrame([], ddl(COUNTS))
        return self.spark.read.schema(ddl(COUNTS)).parquet(f"{self.path}/_counts")
