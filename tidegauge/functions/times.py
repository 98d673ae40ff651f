"""Instants: epoch milliseconds, UTC labels and text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strptime directives and the Spark datetime letters that read them.
STRPTIME_LETTERS = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%j": "DDD",
    "%H": "HH",
    "%I": "hh",
    "%p": "a",
    "%M": "mm",
    "%S": "ss",
    "%b": "MMM",
    "%B": "MMMM",
    "%a": "E",
    "%A": "EEEE",
    "%z": "[XXX][XX][X]",
    "%Z": "z",
    "%%": "'%'",
}


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def to_millis(ts: Column) -> Column:
    """Epoch milliseconds, rounded down."""
    return F.unix_millis(ts)


def ntz_as_utc(ts: Column) -> Column:
    """Label a zone-less timestamp as UTC without shifting it (session zone is UTC)."""
    return ts.cast("timestamp_ntz").cast("timestamp")


def iso_utc(ts: Column) -> Column:
    """ISO-8601 with ``+00:00``; the fraction is six digits, absent when zero."""
    whole = F.unix_micros(ts) % F.lit(1_000_000) == 0
    return F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    )


def second_utc(ts: Column) -> Column:
    """ISO-8601 to the second with a ``Z`` suffix."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def strptime_pattern(fmt: str) -> str:
    """Spark datetime pattern of a strptime format; unknown directives are refused."""
    out, literal, i = [], "", 0

    def flush() -> None:
        nonlocal literal
        if literal:
            quoted = literal.replace("'", "''")
            out.append(f"'{quoted}'" if any(c.isalpha() or c in "'[]{}#" for c in literal) else literal)
            literal = ""

    while i < len(fmt):
        if fmt[i] != "%":
            literal += fmt[i]
            i += 1
            continue
        directive = fmt[i : i + 2]
        if directive == "%f":
            # strptime reads one to six digits
            flush()
            out.append("[SSSSSS][SSSSS][SSSS][SSS][SS][S]")
        elif directive in STRPTIME_LETTERS:
            flush()
            out.append(STRPTIME_LETTERS[directive])
        else:
            raise ValueError(f"Unsupported timestamp directive {directive!r} in {fmt!r}")
        i += 2
    flush()
    return "".join(out)
