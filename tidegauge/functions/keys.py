"""Key names, hashes and idempotency keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.entries import object_text
from tidegauge.functions.times import iso_utc

#: Everything but letters, numbers, underscore and slash. Spelled with Unicode
#: categories because Java's ``\w`` leaves out characters such as superscript digits.
NOT_IN_KEY = r"[^\p{L}\p{N}_/]"


def sanitize_key(name: Column) -> Column:
    """Replace each character a key may not hold with one underscore."""
    return F.regexp_replace(name, NOT_IN_KEY, "_")


def sanitize_name(name: str) -> str:
    """``sanitize_key`` for a name known when the plan is built."""
    return "".join(c if c.isalnum() or c in "_/" else "_" for c in name)


def hash_value(value: Column) -> Column:
    """SHA-256 hex digest of the value's text."""
    return F.sha2(value.cast("string"), 256)


def idempotency_key(ts: Column, organization_id: Column, entries: Column) -> Column:
    """Digest of time, unhashed organisation and the full sorted values object."""
    return F.sha2(
        F.concat(
            iso_utc(ts),
            F.lit("|"),
            F.coalesce(organization_id, F.lit("None")),
            F.lit("|"),
            object_text(entries),
        ),
        256,
    )


def resolve_org_filter(value: Column) -> Column:
    """Organisation to look up: ``hash:v`` becomes the digest of ``v``, blank becomes null."""
    return (
        F.when(F.trim(F.coalesce(value, F.lit(""))) == "", F.lit(None).cast("string"))
        .when(F.startswith(value, F.lit("hash:")), F.sha2(F.substr(value, F.lit(6)), 256))
        .otherwise(value)
    )
