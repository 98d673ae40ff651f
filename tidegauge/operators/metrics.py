"""Metric entries to events: label choice, hashing, value assembly, keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import (
    entry_list,
    hash_value,
    idempotency_key,
    json_double,
    json_string,
    last_per_key,
    sanitize_key,
    sanitize_name,
    sorted_entries,
)
from tidegauge.plans.spec import MetricField, MetricFilter
from tidegauge.schema import CONTENT, REJECT


def select_labels(labels: Column, fields: Sequence[MetricField]) -> Column:
    """Labels that the filter lists, hashed where it says so."""
    listed = F.map_filter(labels, lambda name, _: name.isin(*[f.key for f in fields]))
    hashed = [f.key for f in fields if f.hash]
    if not hashed:
        return listed
    return F.transform_values(
        listed, lambda name, v: F.when(name.isin(*hashed), hash_value(v)).otherwise(v)
    )


def metric_org(organization_id: Column, identifier: Column, fields: Sequence[MetricField]) -> Column:
    """The organisation, hashed when a hashed field is the label that names it."""
    # the first field of a key decides
    first: dict[str, bool] = {}
    for f in fields:
        first.setdefault(f.key, f.hash)
    hashed = [key for key, is_hashed in first.items() if is_hashed]
    if not hashed:
        return organization_id
    applies = F.coalesce(identifier.isin(*hashed), F.lit(False))
    return F.when(applies, hash_value(organization_id)).otherwise(organization_id)


def _label_entries(labels: Column, fields: Sequence[MetricField]) -> Column:
    """Entries of the listed labels. The names are known here, so they are sanitised now and
    looked up one by one; of names that become equal the last present one counts."""
    found: dict[str, Column] = {}
    for f in fields:
        value = F.try_element_at(labels, F.lit(f.key))
        value = hash_value(value) if f.hash else value
        name = sanitize_name(f.key)
        found[name] = F.coalesce(value, found[name]) if name in found else value
    return entry_list([(name, value, json_string(value)) for name, value in found.items()])


def _all_label_entries(labels: Column) -> Column:
    return F.transform(
        F.map_entries(labels),
        lambda e: F.struct(sanitize_key(e["key"]).alias("k"), json_string(e["value"]).alias("j")),
    )


def metric_events(
    metrics: DataFrame, spec: MetricFilter | None = None, stream_key: str | None = None
) -> DataFrame:
    """Metric entries to events plus ``reject_reason``.

    Values are the metric under its sanitised name and the chosen labels; a label of the
    same name overwrites the metric. The key hashes the organisation as it came, before
    any hashing of the column. Rows with labels of which none is listed are rejected; a
    rejected row keeps its sample as JSON text in ``content``.
    """
    fields = spec.fields if spec else ()
    labels = F.coalesce(F.col("labels"), F.create_map().cast("map<string,string>"))
    chosen = _label_entries(labels, fields) if spec else _all_label_entries(labels)
    base = F.array(
        F.struct(
            sanitize_key(F.col("metric_name")).alias("k"), json_double(F.col("value")).alias("j")
        )
    )
    prior = F.col(REJECT) if REJECT in metrics.columns else F.lit(None).cast("string")
    reason = prior
    if spec:
        listed = [F.lit(f.key) for f in fields]
        none_listed = (F.size(labels) > 0) & ~reduce(
            lambda a, b: a | b, [F.map_contains_key(labels, key) for key in listed]
        )
        reason = F.coalesce(prior, F.when(none_listed, F.lit("no_labels_matched")))
    # entries in two steps: the second reads the list of the first several times
    rows = metrics.select(
        (F.lit(stream_key) if stream_key else F.col("stream_key")).alias("stream_key"),
        "event_ts",
        "organization_id",
        "organization_identifier",
        F.concat(base, chosen).alias("_listed"),
        F.when(reason.isNotNull(), F.to_json(F.struct("metric_name", "value", "labels"))).alias(
            CONTENT
        ),
        reason.alias(REJECT),
    ).withColumn("entries", sorted_entries(last_per_key(F.col("_listed"))))
    return rows.select(
        "stream_key",
        idempotency_key(F.col("event_ts"), F.col("organization_id"), F.col("entries")).alias(
            "idempotency_key"
        ),
        "event_ts",
        metric_org(F.col("organization_id"), F.col("organization_identifier"), fields).alias(
            "organization_id"
        ),
        "entries",
        CONTENT,
        REJECT,
    )
