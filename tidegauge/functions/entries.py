"""The values object of an event as ``array<struct<k, j>>``.

Streams carry different fields, so values meet in one schema only as key plus JSON
text. Numbers stay numbers and strings stay strings, and dropping, prefixing or
printing the object are plain array expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.text import NEEDS_ESCAPE, json_string


def entry_list(pairs: list[tuple[str, Column, Column]]) -> Column:
    """Entries from ``(key, value, JSON text)`` of keys known at plan time, in key order,
    absent values left out. Built from arrays that are empty or hold one entry, which stays
    inside generated code."""
    none = F.array().cast("array<struct<k:string,j:string>>")
    cells = [
        F.when(value.isNotNull(), F.array(F.struct(F.lit(key).alias("k"), json.alias("j"))))
        .otherwise(none)
        for key, value, json in sorted(pairs, key=lambda pair: pair[0])
    ]
    return F.flatten(F.array(*cells))


def last_per_key(entries: Column) -> Column:
    """Keep the last entry of each key. Label sets rarely collide, so the quadratic
    branch runs only for rows that have a repeated key."""
    keys = F.transform(entries, lambda e: e["k"])
    deduped = F.filter(
        entries,
        lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.size(entries)), lambda later: later["k"] == e["k"]
        ),
    )
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(deduped)


def sorted_entries(entries: Column) -> Column:
    """Entries in key order (code points), without absent values."""
    return F.sort_array(F.filter(entries, lambda e: e["j"].isNotNull()))


def drop_keys(entries: Column, names: tuple[str, ...], prefix: Column) -> Column:
    """Entries whose key is none of ``names``, bare or behind ``prefix_``."""
    head = F.concat(prefix, F.lit("_"))

    def bare(key: Column) -> Column:
        return F.when(F.startswith(key, head), F.substr(key, F.length(head) + 1)).otherwise(key)

    return F.filter(entries, lambda e: ~(e["k"].isin(*names) | bare(e["k"]).isin(*names)))


def prefix_keys(entries: Column, prefix: Column) -> Column:
    """Entries with ``prefix_`` before each key; a blank prefix changes nothing."""
    name = F.trim(prefix)
    return F.when(
        F.coalesce(name, F.lit("")) != "",
        F.transform(
            entries,
            lambda e: F.struct(F.concat(name, F.lit("_"), e["k"]).alias("k"), e["j"].alias("j")),
        ),
    ).otherwise(entries)


def object_text(entries: Column) -> Column:
    """JSON object text of the entries in their order. Keys are checked for characters to
    escape all at once, since sanitised names hardly ever hold any."""

    def members(quoted) -> Column:
        return F.transform(entries, lambda e: F.concat(quoted(e["k"]), F.lit(": "), e["j"]))

    plain = members(lambda key: F.concat(F.lit('"'), key, F.lit('"')))
    odd = F.concat_ws("", entries["k"]).rlike(NEEDS_ESCAPE)
    text = F.when(odd, F.array_join(members(json_string), ", ")).otherwise(
        F.array_join(plain, ", ")
    )
    return F.concat(F.lit("{"), text, F.lit("}"))


def values_variant(entries: Column) -> Column:
    """The values object as VARIANT, for reading; never hash or group by it."""
    return F.try_parse_json(object_text(entries))
