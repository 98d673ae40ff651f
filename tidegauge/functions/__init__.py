"""Column functions: text, JSON, time and key helpers, all evaluated inside the JVM."""

from tidegauge.functions.entries import (
    drop_keys,
    entry_list,
    last_per_key,
    object_text,
    prefix_keys,
    sorted_entries,
    values_variant,
)
from tidegauge.functions.keys import (
    hash_value,
    idempotency_key,
    resolve_org_filter,
    sanitize_key,
    sanitize_name,
)
from tidegauge.functions.text import json_double, json_string
from tidegauge.functions.times import (
    from_millis,
    iso_utc,
    ntz_as_utc,
    second_utc,
    strptime_pattern,
    to_millis,
)

__all__ = [
    "drop_keys", "entry_list", "from_millis", "hash_value", "idempotency_key", "iso_utc", "json_double",
    "json_string", "last_per_key", "ntz_as_utc", "object_text", "prefix_keys",
    "resolve_org_filter", "sanitize_key", "sanitize_name", "second_utc", "sorted_entries",
    "strptime_pattern", "to_millis", "values_variant",
]
