"""Events to request bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import drop_keys, json_string, object_text, prefix_keys, second_utc
from tidegauge.functions.entries import sorted_entries
from tidegauge.operators.numbering import number_rows

# Names a value may not use, bare or prefixed with the stream key.
RESERVED_KEYS = ("key", "organization_id", "timestamp", "idempotency_key")
# Fixed value: the key of events that carry none.
DEFAULT_KEY = "a_valid_source"
# Events per request, and seconds after which a stream flushes anyway.
BATCH_SIZE = 50
BATCH_SECONDS = 10


def entries_of(text: Column) -> Column:
    """Entries of a JSON object held as text, for rows made elsewhere. Text that is not an
    object gives no entries."""
    variant = F.try_parse_json(text)
    is_object = F.startswith(F.schema_of_variant(variant), F.lit("OBJECT"))
    keys = F.json_object_keys(text)
    as_map = F.try_variant_get(variant, "$", "map<string,variant>")
    pairs = F.transform(
        keys, lambda k: F.struct(k.alias("k"), F.to_json(F.try_element_at(as_map, k)).alias("j"))
    )
    none = F.array().cast("array<struct<k:string,j:string>>")
    return F.coalesce(F.when(is_object, sorted_entries(pairs)), none)


def prefix_values(events: DataFrame) -> DataFrame:
    """Put ``<stream_key>_`` before every value key."""
    return events.withColumn(
        "entries", sorted_entries(prefix_keys(F.col("entries"), F.col("stream_key")))
    )


def payload_struct(events: DataFrame) -> DataFrame:
    """The delivered fields as columns: reserved names removed from the values, after the
    idempotency key was formed over all of them. ``values_json`` is the object's text."""
    # prefixed names use the stream key as it is, not the default
    own = F.coalesce(F.col("stream_key"), F.lit("None"))
    kept = events.withColumn("entries", drop_keys(F.col("entries"), RESERVED_KEYS, own))
    return kept.select(
        "stream_key",
        "event_ts",
        "organization_id",
        second_utc(F.col("event_ts")).alias("timestamp"),
        F.coalesce(F.nullif(F.col("stream_key"), F.lit("")), F.lit(DEFAULT_KEY)).alias("key"),
        "idempotency_key",
        object_text(F.col("entries")).alias("values_json"),
    )


def to_payload(events: DataFrame) -> DataFrame:
    """``(stream_key, event_ts, idempotency_key, payload)`` with the payload as JSON text."""

    def quoted(name: str) -> Column:
        return F.coalesce(json_string(F.col(name)), F.lit("null"))

    rows = payload_struct(events)
    body = F.concat(
        F.lit('{"organization_id": '), quoted("organization_id"),
        F.lit(', "timestamp": '), quoted("timestamp"),
        F.lit(', "key": '), quoted("key"),
        F.lit(', "idempotency_key": '), quoted("idempotency_key"),
        F.lit(', "values": '), F.col("values_json"), F.lit("}"),
    )
    return rows.select("stream_key", "event_ts", "idempotency_key", body.alias("payload"))


def request_batches(
    payloads: DataFrame, size: int = BATCH_SIZE, by: str = "stream_key", slice_ms: int = 60_000
) -> DataFrame:
    """``(by, batch_no, n, body)``: consecutive batches of at most ``size`` payloads per
    stream in event order, the body a JSON array.

    Numbering runs over time slices of ``slice_ms`` and collecting over single batches, so
    a stream with most of the events still spreads over all tasks.
    """
    numbered = number_rows(
        payloads.select(by, "event_ts", "idempotency_key", "payload"),
        by=[by],
        order=["event_ts", "idempotency_key", "payload"],
        slice_by=F.floor(F.unix_millis("event_ts") / slice_ms),
    )
    in_order = F.sort_array(F.collect_list(F.struct("row_no", "payload")))
    return (
        numbered.withColumn("batch_no", F.floor((F.col("row_no") - 1) / size).cast("bigint"))
        .groupBy(by, "batch_no")
        .agg(F.count(F.lit(1)).alias("n"), in_order.alias("_rows"))
        .select(
            by,
            "batch_no",
            "n",
            F.concat(
                F.lit("["),
                F.array_join(F.transform("_rows", lambda r: r["payload"]), ", "),
                F.lit("]"),
            ).alias("body"),
        )
    )
