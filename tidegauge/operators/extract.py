"""Log entries to events: declared fields, types, hashing, organisation check."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import (
    entry_list,
    hash_value,
    iso_utc,
    json_double,
    json_string,
    sanitize_name,
    strptime_pattern,
)
from tidegauge.plans.spec import LogField, LogFilter
from tidegauge.schema import CONTENT, REJECT
from tidegauge.sources.pages import with_record


def filter_logs(entries: DataFrame, predicate: Column | str) -> DataFrame:
    """Keep entries that satisfy a Column or SQL predicate. Applied before extraction, so
    conditions on plain columns reach the scan."""
    return entries.where(predicate)


def json_equals(path: str, *values: str, content: str = "content") -> Column:
    """Predicate: the JSON field at a dot path equals one of the values."""
    return F.get_json_object(F.col(content), "$." + path).isin(*values)


# --- plan-time shape of the JSON record ------------------------------------------


def _leaf_tree(paths: Sequence[str]) -> dict:
    """Nested dict of the paths; a path that is also a parent stays a leaf."""
    tree: dict = {}
    for path in sorted(paths, key=lambda p: p.count(".")):
        node, parts = tree, path.split(".")
        for part in parts[:-1]:
            node = node.setdefault(part, {})
            if node is None:
                break
        else:
            node.setdefault(parts[-1], None)
    return tree


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _ddl(tree: dict) -> str:
    return ", ".join(
        f"{_quoted(k)} " + ("string" if sub is None else f"struct<{_nested(sub)}>")
        for k, sub in tree.items()
    )


def _nested(tree: dict) -> str:
    return ", ".join(
        f"{_quoted(k)}: " + ("string" if sub is None else f"struct<{_nested(sub)}>")
        for k, sub in tree.items()
    )


def _leaf(record: Column, tree: dict, path: str) -> Column:
    parts, column, node = path.split("."), record, tree
    for depth, part in enumerate(parts):
        column, node = column.getField(part), node[part]
        if node is None and depth + 1 < len(parts):
            return F.get_json_object(column, "$." + ".".join(parts[depth + 1 :]))
    return column


def _is_indexed(path: str) -> bool:
    return bool(re.search(r"\[.*\]", path))


# --- casting ----------------------------------------------------------------------


def _typed(text: Column, spec: LogField) -> Column:
    if spec.field_type == "integer":
        return text.try_cast("bigint")
    if spec.field_type == "float":
        # NaN comes out of the parse in quotes
        return F.replace(text, F.lit('"'), F.lit("")).try_cast("double")
    if spec.field_type == "timestamp":
        return F.try_to_timestamp(text, F.lit(strptime_pattern(spec.format)))
    return text


def _plain(value: Column, spec: LogField) -> Column:
    """The text a value is hashed as."""
    if spec.field_type == "float":
        return json_double(value)
    if spec.field_type == "timestamp":
        return F.replace(iso_utc(value), F.lit("T"), F.lit(" "))
    return value.cast("string")


def _json_text(value: Column, spec: LogField) -> Column:
    """The value as JSON text for the event's entries."""
    if spec.hash:
        return F.concat(F.lit('"'), value, F.lit('"'))
    if spec.field_type == "integer":
        return value.cast("string")
    if spec.field_type == "float":
        return json_double(value)
    if spec.field_type == "timestamp":
        return json_string(iso_utc(value))
    return json_string(value)


def _with_fields(
    entries: DataFrame,
    raw: dict[str, tuple[LogField, Column]],
    unreadable: Column,
    on_cast_error: str,
) -> DataFrame:
    """Cast the raw texts and collect them in ``fields``. Every cast value is a column of
    its own first, so that later uses read it instead of casting again."""
    if on_cast_error not in ("reject", "null_field"):
        raise ValueError("on_cast_error must be 'reject' or 'null_field'")
    kept = [c for c in entries.columns if not c.startswith("_") and c != REJECT]
    prior = F.col(REJECT) if REJECT in entries.columns else F.lit(None).cast("string")
    columns = {name: f"_v{i}" for i, name in enumerate(raw)}
    failed = unreadable
    if on_cast_error == "reject":
        for spec, text in raw.values():
            if spec.field_type != "string":
                failed = failed | (text.isNotNull() & _typed(text, spec).isNull())
    cast = entries.select(
        *kept,
        prior.alias("_prior"),
        F.when(failed, F.lit("parse_error")).alias("_failed"),
        *[_typed(text, spec).alias(columns[name]) for name, (spec, text) in raw.items()],
    )
    values = F.struct(
        *[
            (hash_value(_plain(F.col(columns[name]), spec)) if spec.hash else F.col(columns[name]))
            .alias(name)
            for name, (spec, _) in raw.items()
        ]
    )
    return cast.select(
        *kept, values.alias("fields"), F.coalesce(F.col("_prior"), F.col("_failed")).alias(REJECT)
    )


def _by_key(fields: Sequence[LogField]) -> dict[str, LogField]:
    """Fields by sanitised key; of two keys that become equal the later field wins."""
    return {sanitize_name(f.key): f for f in fields}


def extract_json_fields(
    entries: DataFrame, fields: Sequence[LogField], on_cast_error: str = "reject"
) -> DataFrame:
    """Add ``fields``, a struct with one typed column per declared field.

    The content is parsed once, with a schema of just the declared paths. Absent fields
    are null. Paths with array indexes are never found. Content that is not one JSON
    object, or a value that does not cast, sets ``reject_reason``.
    """
    by_key = _by_key(fields)
    tree = _leaf_tree([f.path for f in by_key.values() if not _is_indexed(f.path)])
    ddl = _ddl(tree) or "`_none` string"
    parsed = with_record(entries, "content", ddl, "_record")
    record = F.col("_record")
    raw = {
        name: (
            spec,
            F.lit(None).cast("string") if _is_indexed(spec.path) else _leaf(record, tree, spec.path),
        )
        for name, spec in by_key.items()
    }
    return _with_fields(parsed, raw, record.isNull(), on_cast_error)


def extract_text_fields(
    entries: DataFrame, fields: Sequence[LogField], on_cast_error: str = "reject"
) -> DataFrame:
    """Like ``extract_json_fields`` for raw text: each field is the first capture group of
    its pattern, or the whole match when it has none."""
    raw = {}
    for name, spec in _by_key(fields).items():
        group = 1 if re.compile(spec.value).groups else 0
        found = F.regexp_extract(F.col("content"), spec.value, group)
        raw[name] = (spec, F.nullif(found, F.lit("")))
    return _with_fields(entries, raw, F.col("content").isNull(), on_cast_error)


def require_org(events: DataFrame, numeric: bool = False) -> DataFrame:
    """Mark rows without an organisation as ``missing_org``. Empty text counts as absent,
    and zero does when the field is declared numeric."""
    org = F.col("organization_id")
    missing = org.isNull() | (org == "")
    if numeric:
        missing = missing | F.coalesce(org.try_cast("double") == 0, F.lit(False))
    reason = F.coalesce(F.col(REJECT), F.when(missing, F.lit("missing_org")))
    return events.withColumn(REJECT, reason)


def extract_log_events(
    entries: DataFrame,
    spec: LogFilter,
    stream_key: str | None = None,
    on_cast_error: str = "reject",
) -> DataFrame:
    """Log entries to events plus ``reject_reason``.

    The provider's log id is the idempotency key and its event time is kept. Declared
    fields that a log lacks are left out of its entries. A rejected row keeps its ``content``.
    """
    extract = extract_text_fields if spec.log_format == "raw_text" else extract_json_fields
    rows = extract(entries, spec.fields, on_cast_error)
    by_key = _by_key(spec.fields)
    found = {name: F.col("fields").getField(name) for name in by_key}
    pairs = [(name, found[name], _json_text(found[name], f)) for name, f in by_key.items()]
    org = by_key["organization_id"]
    numeric = org.field_type in ("integer", "float") and not org.hash
    org_value = found["organization_id"]
    events = rows.select(
        (F.lit(stream_key) if stream_key else F.col("stream_key")).alias("stream_key"),
        F.col("log_id").alias("idempotency_key"),
        "event_ts",
        (org_value if org.hash else _plain(org_value, org)).alias("organization_id"),
        entry_list(pairs).alias("entries"),
        F.col("content").alias(CONTENT),
        REJECT,
    )
    # accepted rows let their text go
    rejected = F.when(F.col(REJECT).isNotNull(), F.col(CONTENT))
    return require_org(events, numeric).withColumn(CONTENT, rejected)
