"""Versioned small state that several writers may change: committed offsets.

Each version is one file with the whole state, made only if its name is free, so of two writers
that read one version just one makes the next; the other reads again and tries anew. A reader
opens one file however many commits came before; versions long passed are removed.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.files import Files
from tidegauge.operators.ranges import resolve_offsets
from tidegauge.schema import OFFSETS
from tidegauge.session import config_table

#: Versions that stay behind the newest, for readers that are under way.
KEPT_VERSIONS = 10
#: How often a writer tries again after another was faster.
TRIES = 50


class Conflict(RuntimeError):
    """A condition of a commit did not hold, or other writers were faster every time."""


class Ledger:
    """A JSON document at a path, as a chain of whole versions."""

    def __init__(self, spark: SparkSession, path: str, kept: int = KEPT_VERSIONS):
        self.files, self.path, self.kept = Files(spark), path.rstrip("/"), kept

    def _versions(self) -> list[int]:
        names = self.files.names(self.path)
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]

    def _file(self, version: int) -> str:
        return f"{self.path}/{version:020d}.json"

    def read(self) -> tuple[int, dict]:
        """The newest version and its state; version 0 is empty."""
        versions = self._versions()
        if not versions:
            return 0, {}
        return versions[-1], json.loads(self.files.read(self._file(versions[-1])))

    def commit(self, change: Callable[[dict], dict], tries: int = TRIES) -> int:
        """Make the next version by ``change``, which sees the newest state and may run again.

        Returns the version made, or the newest one if nothing changes.
        """
        for _ in range(tries):
            version, state = self.read()
            changed = change(json.loads(json.dumps(state)))
            if changed == state:
                return version
            if self.files.create(self._file(version + 1), json.dumps(changed, sort_keys=True)):
                for old in self._versions():
                    if old <= version - self.kept:
                        self.files.remove(self._file(old))
                return version + 1
        raise Conflict(f"{self.path} changed under each of {tries} tries")


class OffsetStore:
    """Offsets by stream key in a ledger: what ``OffsetTable`` does, upserted instead of appended.

    One number per input, so the state is as small as the configuration that names the inputs.
    ``suffix`` keys it like a key-value store would, ``stream:suffix``.
    """

    def __init__(self, spark: SparkSession, path: str, suffix: str | None = None):
        self.spark, self.ledger = spark, Ledger(spark, path)
        self.tail = "" if suffix is None else f":{suffix}"

    def _rows(self, state: dict) -> list[dict]:
        return [
            {
                "stream_key": key.removesuffix(self.tail) if self.tail else key,
                "offset_ms": offset,
                "updated_at": datetime.fromtimestamp(at / 1e6, UTC),
            }
            for key, (offset, at) in state.items()
            if key.endswith(self.tail)
        ]

    def current(self) -> DataFrame:
        """``(stream_key, offset_ms, updated_at)``, one row per stream."""
        schema = ", ".join(f"{c} {t}" for c, t in OFFSETS.items())
        return config_table(self.spark, self._rows(self.ledger.read()[1]), schema)

    def commit(self, rows: DataFrame, expected: dict[str, int | None] | None = None) -> int:
        """Store offsets in one version, all or none; per stream the latest ``updated_at`` counts,
        the larger offset at equal times.

        With ``expected`` the commit holds only while those streams are still at those offsets
        (``None``: have none); otherwise ``Conflict`` is raised and nothing is stored.
        """
        micros = F.unix_micros("updated_at").alias("at")
        new: dict[str, list[int]] = {}
        for key, offset, at in rows.select("stream_key", F.col("offset_ms").cast("bigint"), micros).collect():
            if key is not None and offset is not None:
                stored = f"{key}{self.tail}"
                new[stored] = _later([offset, at], new.get(stored))

        def change(state: dict) -> dict:
            for key, offset in (expected or {}).items():
                found = state.get(f"{key}{self.tail}", [None])[0]
                if found != offset:
                    raise Conflict(f"{key} is at {found}, not {offset}")
            return state | {k: _later(v, state.get(k)) for k, v in new.items()}

        return self.ledger.commit(change)

    def seed(self, inputs: DataFrame) -> int:
        """Store the resolved start of inputs that have no offset yet, lie behind their
        ``start_from``, or override it."""
        known = self.current().select("stream_key", "offset_ms")
        fresh = resolve_offsets(inputs, known)
        return self.commit(fresh.withColumn("updated_at", F.current_timestamp()))


def _later(new: list[int], old: list[int] | None) -> list[int]:
    # equal offsets keep their time, so a commit that moves nothing makes no version
    if old is None:
        return new
    if new[0] == old[0]:
        return old
    return max(new, old, key=lambda v: (v[1], v[0]))
