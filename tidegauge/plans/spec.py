"""Plan-time specifications of inputs and outputs, checked when they are built."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

# Accepted names.
PROVIDERS = ("cloudwatch", "datadog", "prometheus")
KINDS = ("logs", "metrics")
FIELD_TYPES = ("string", "integer", "float", "timestamp")
LOG_FORMATS = ("json_dict", "raw_text")
OUTPUTS = ("console", "http", "noop", "table")
OFFSET_STORES = ("table", "keyed_table", "delivered")

# Provider statistics, by the spellings users write.
CLOUDWATCH_STATISTICS = {
    "average": "Average",
    "minimum": "Minimum",
    "maximum": "Maximum",
    "sum": "Sum",
    "samplecount": "SampleCount",
    "sample_count": "SampleCount",
}
DATADOG_STATISTICS = {
    "average": "avg",
    "avg": "avg",
    "minimum": "min",
    "min": "min",
    "maximum": "max",
    "max": "max",
    "sum": "sum",
}
# Milliseconds of a step unit.
STEP_UNITS = {"ms": 1, "s": 1_000, "m": 60_000}

#: Length of one fetched range while an input keeps up, and while it catches up.
STEP_MS = {"logs": 24_000, "metrics": 60_000}
CATCH_UP_MS = 3_600_000
#: How long an input waits before its next range while it lags by more than a step and this buffer.
CATCH_UP_WAIT_MS = 2_000
LAG_BUFFER_MS = 60_000


def input_keys(stream_keys: Sequence[str]) -> list[str]:
    """A key per input: its stream key, with ``_0``, ``_1``, ... in their order where several
    inputs share one."""
    seen: dict[str, int] = {}
    keys = []
    for key in stream_keys:
        shared = stream_keys.count(key) > 1
        keys.append(f"{key}_{seen.get(key, 0)}" if shared else key)
        seen[key] = seen.get(key, 0) + 1
    return keys


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


def _one_of(value: str, names: Sequence[str], what: str) -> None:
    _require(value in names, f"{what} must be one of {', '.join(names)}: {value!r}")


@dataclass(frozen=True)
class LogField:
    """One declared field of a log: a JSON dot ``path`` or a regex ``value``."""

    key: str
    path: str | None = None
    value: str | None = None
    field_type: str = "string"
    format: str | None = None
    hash: bool = False

    def __post_init__(self) -> None:
        _one_of(self.field_type, FIELD_TYPES, "field_type")
        _require(
            (self.path is None) != (self.value is None),
            f"field {self.key!r} needs either a JSON path or a text pattern",
        )
        _require(
            self.field_type != "timestamp" or bool(self.format),
            f"timestamp field {self.key!r} needs a format",
        )


@dataclass(frozen=True)
class LogFilter:
    fields: Sequence[LogField]
    log_format: str = "json_dict"
    version: int = 1
    log_example: str | Mapping | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "log_format", self.log_format.lower())
        _one_of(self.log_format, LOG_FORMATS, "log_format")
        _require(len(self.fields) > 0, "filter fields cannot be empty")
        _require(
            any(f.key == "organization_id" for f in self.fields),
            "an organization_id field is required for logs",
        )
        is_text = self.log_format == "raw_text"
        _require(
            all((f.value is not None) == is_text for f in self.fields),
            f"every field must suit log format {self.log_format}",
        )
        if self.log_example is not None:
            _require(
                isinstance(self.log_example, str if is_text else Mapping),
                f"log_example does not suit log format {self.log_format}",
            )


@dataclass(frozen=True)
class MetricField:
    key: str
    hash: bool = False


@dataclass(frozen=True)
class MetricFilter:
    fields: Sequence[MetricField]
    version: int = 1

    def __post_init__(self) -> None:
        _require(len(self.fields) > 0, "filter fields cannot be empty")


@dataclass(frozen=True)
class CloudwatchMetrics:
    """One metric selected by several dimension sets; one query per set."""

    namespace: str
    metric_name: str
    period: int
    statistic: str
    organization_identifier: str
    metric_queries: Sequence[Mapping[str, str]]

    def __post_init__(self) -> None:
        stat = CLOUDWATCH_STATISTICS.get(self.statistic.lower())
        _require(stat is not None, f"invalid statistic {self.statistic!r}")
        object.__setattr__(self, "statistic", stat)
        _require(self.period > 0, "period must be positive")
        _require(
            all(self.organization_identifier in dims for dims in self.metric_queries),
            "every dimension set must hold the organization identifier",
        )


@dataclass(frozen=True)
class DatadogTagSet:
    customer_value: str
    tag_string: str


@dataclass(frozen=True)
class DatadogMetrics:
    """One metric selected by several tag sets; ``interval`` is in seconds."""

    metric_name: str
    interval: int
    statistic: str
    organization_identifier: str
    metric_tag_data: Sequence[DatadogTagSet]

    def __post_init__(self) -> None:
        stat = DATADOG_STATISTICS.get(self.statistic.lower())
        _require(stat is not None, f"invalid statistic {self.statistic!r}")
        object.__setattr__(self, "statistic", stat)
        _require(self.interval > 0, "interval must be positive")
        _require(len(self.metric_tag_data) > 0, "metric_tag_data cannot be empty")
        _require(
            all(
                f"{self.organization_identifier}:{tag.customer_value}" in tag.tag_string
                for tag in self.metric_tag_data
            ),
            "every tag string must hold the organization identifier and value",
        )

    @property
    def interval_ms(self) -> int:
        return self.interval * 1000


def _blank_to_none(text: str | None) -> str | None:
    return (text.strip() or None) if isinstance(text, str) else None


@dataclass(frozen=True)
class PrometheusQuery:
    query: str
    metric_name: str
    organization_identifier: str | None = None
    fallback_org_id: str | None = None
    step: tuple[int, str] | None = None

    def __post_init__(self) -> None:
        for name in ("organization_identifier", "fallback_org_id"):
            object.__setattr__(self, name, _blank_to_none(getattr(self, name)))
        _require(
            self.organization_identifier is not None or self.fallback_org_id is not None,
            "fallback_org_id is required without organization_identifier",
        )
        if self.step is not None:
            _one_of(self.step[1], tuple(STEP_UNITS), "step unit")
            millis = self.step[0] * STEP_UNITS[self.step[1]]
            _require(1000 <= millis <= 60_000, "step must be between 1 and 60 seconds")
            _require(60_000 % millis == 0, "step must divide 60 seconds evenly")

    @property
    def step_ms(self) -> int | None:
        return None if self.step is None else self.step[0] * STEP_UNITS[self.step[1]]


@dataclass(frozen=True)
class OffsetSpec:
    """Where an input resumes. ``store`` is the offset table, the same table keyed with a
    ``suffix``, or the delivered events themselves."""

    start_from: int
    store: str = "table"
    override_start_from: bool = False
    suffix: str = "current_offset"
    organization_id: str | None = None

    def __post_init__(self) -> None:
        _require(
            isinstance(self.start_from, int) and not isinstance(self.start_from, bool),
            "start_from must be integer milliseconds",
        )
        _one_of(self.store, OFFSET_STORES, "offset store")


@dataclass(frozen=True)
class OutputSpec:
    """Where events go; ``quarantine`` is a folder for rejected rows, which are dropped without."""

    type: str = "table"
    path: str | None = None
    post: Callable[[str], None] | None = None
    quarantine: str | None = None

    def __post_init__(self) -> None:
        _one_of(self.type, OUTPUTS, "output type")
        _require(self.type != "table" or bool(self.path), "a table output needs a path")
        _require(self.type != "http" or self.post is not None, "an http output needs a poster")


@dataclass(frozen=True)
class InputSpec:
    stream_key: str
    provider: str
    kind: str
    offset: OffsetSpec
    filters: LogFilter | MetricFilter | None = None
    cloudwatch: CloudwatchMetrics | None = None
    datadog: DatadogMetrics | None = None
    prometheus: Sequence[PrometheusQuery] = ()
    predicate: str | None = None
    keep_zero: bool = False

    def __post_init__(self) -> None:
        object.__setattr__(self, "provider", self.provider.lower())
        object.__setattr__(self, "kind", self.kind.lower())
        _require(bool(re.search(r"\S", self.stream_key)), "stream_key cannot be blank")
        _one_of(self.kind, KINDS, "kind")
        if self.kind == "logs":
            _require(self.filters is not None, "filters are mandatory for logs")
            _require(isinstance(self.filters, LogFilter), "logs need a LogFilter")
        else:
            _require(
                self.filters is None or isinstance(self.filters, MetricFilter),
                "metrics need a MetricFilter",
            )
            if self.provider in PROVIDERS:
                _require(
                    bool(getattr(self, self.provider)),
                    f"{self.provider} metrics configuration is missing",
                )


@dataclass(frozen=True)
class FlowSpec:
    inputs: Sequence[InputSpec]
    output: OutputSpec = field(default_factory=lambda: OutputSpec("noop"))

    def __post_init__(self) -> None:
        _require(len(self.inputs) > 0, "a flow needs at least one input")
