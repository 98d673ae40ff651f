"""URL filter rules by a sort-merge range join over reversed-host keys."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rules are configuration that the caller holds; beyond this number they don't fit every task.
MOST_RULES = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and the paths that start with a path."""

    verdict: str  # allow or block
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def key(self) -> str:
        """Reversed host with a dot behind each label: a prefix of the keys of all hosts below."""
        return "".join(f"{label}." for label in reversed(self.host.split(".")))


def host_of(url: Column) -> Column:
    """Behind the first ``://`` up to a slash, question mark, hash or the end; A-Z lower-cased."""
    host = F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """Behind the host up to a question mark, hash or the end."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_key(host: Column) -> Column:
    """The canonical sort key of a host; see ``Rule.key``."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


class Sweep:
    """Rules that are active at the current key of an ascending sequence of keys."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = sorted(rules, key=lambda r: (r.key, len(r.path)))
        self.next = 0
        self.stack: list[Rule] = []

    def move(self, key: str) -> None:
        """Go on to a key: leave intervals that end before it, enter those that begin."""
        while self.next < len(self.rules) and self.rules[self.next].key <= key:
            rule = self.rules[self.next]
            while self.stack and not rule.key.startswith(self.stack[-1].key):
                self.stack.pop()
            self.stack.append(rule)
            self.next += 1
        while self.stack and not key.startswith(self.stack[-1].key):
            self.stack.pop()

    def best(self, path: str) -> Rule | None:
        """The longest active rule that the path starts with; of equals a block."""
        fits = [r for r in self.stack if path.startswith(r.path)]
        return max(fits, key=lambda r: (len(r.text), r.verdict == "block"), default=None)


def judge_urls(
    frame: DataFrame,
    rules: Sequence[Rule],
    default: str = "allow",
    no_host: str = "block",
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """Rows of ``(id, host, path, rule, verdict)``, one for each row.

    Rows are dealt out by ranges of the reversed host and, within a host, of a hash of the row,
    so that a host with most of the rows is spread; each task sweeps its sorted keys once and keeps the
    stack of nested rules. Without a fitting rule the verdict is ``default``, or ``no_host`` if
    the URL is null, has no ``://`` or an empty host. Repeated rows each give their row; other
    columns are left behind.
    """
    rules = list(rules)
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules: judge by parts of them")
    url = F.col(url_column)
    keyed = frame.select(
        F.col(id_column), host_of(url).alias("host"), path_of(url).alias("path")
    ).withColumn("key", host_key(F.col("host")))
    dealt = keyed.repartitionByRange("key", F.xxhash64("path", id_column))
    kind = frame.schema[id_column].dataType.simpleString()
    schema = T.StructType.fromDDL(
        f"`{id_column}` {kind}, host string, path string, rule string, verdict string"
    )
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep, last = Sweep(rules), None
        for batch in batches:
            texts, verdicts = [], []
            hosts, paths, keys = (batch.column(i).to_pylist() for i in (1, 2, 3))
            for host, path, key in zip(hosts, paths, keys, strict=True):
                if key != last:
                    sweep.move(key)
                    last = key
                rule = sweep.best(path)
                texts.append(rule.text if rule else None)
                verdicts.append(rule.verdict if rule else default if host else no_host)
            columns = [batch.column(0), batch.column(1), batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array(verdicts, pa.string())],
                schema=arrow_schema,
            )

    return dealt.sortWithinPartitions("key").mapInArrow(run, schema)
