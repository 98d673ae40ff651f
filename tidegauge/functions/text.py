"""JSON text of scalars, byte for byte what Python's ``json.dumps`` prints.

Idempotency keys hash this text, so the escapes and the number format have to agree
with the systems that already hold such keys. Everything is a built-in expression;
the common case (printable ASCII, ordinary magnitudes) stays on a short branch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Short escapes of JSON control characters, by their UTF-16 code.
SHORT_ESCAPES = {
    "\\u0008": "\\b",
    "\\u0009": "\\t",
    "\\u000a": "\\n",
    "\\u000c": "\\f",
    "\\u000d": "\\r",
}


#: Anything but printable ASCII without the quote and the backslash.
NEEDS_ESCAPE = r"[^ !#-\[\]-~]"


def _escape_quotes(text: Column) -> Column:
    return F.regexp_replace(text, r'(["\\])', r"\\$1")


def _escape_units(run: Column) -> Column:
    """A run without printable ASCII as ``\\uXXXX`` units, surrogate pairs included."""
    units = F.lower(F.hex(F.encode(run, "UTF-16BE")))
    text = F.regexp_replace(units, "(.{4})", r"\\u$1")
    for long, short in SHORT_ESCAPES.items():
        text = F.replace(text, F.lit(long), F.lit(short))
    return text


def json_string(text: Column) -> Column:
    """Quoted JSON string with non-ASCII characters escaped."""
    runs = F.regexp_extract_all(text, F.lit(r"([ -~]+|[^ -~]+)"), F.lit(1))
    escaped = F.transform(
        runs,
        lambda run: F.when(run.rlike("^[ -~]"), _escape_quotes(run)).otherwise(_escape_units(run)),
    )
    body = (
        F.when(~text.rlike(NEEDS_ESCAPE), text)
        .when(~text.rlike("[^ -~]"), _escape_quotes(text))
        .otherwise(F.array_join(escaped, ""))
    )
    return F.concat(F.lit('"'), body, F.lit('"'))


def json_double(value: Column) -> Column:
    """A double in its shortest round-trip form, as Python's ``repr`` prints it.

    Up to 15 significant digits the JVM's own text is already the shortest; otherwise
    the fewest digits that still read back as the same number are picked.
    """
    text = value.cast("string")
    size = F.abs(value)
    as_is = (
        value.isNull()
        | F.isnan(value)
        | (size == F.lit(float("inf")))
        | (value == F.lit(0.0))
        | ((size >= F.lit(1e-3)) & (size < F.lit(1e7)) & (F.length(text) <= 16))
    )
    return F.when(as_is, text).otherwise(_shortest(value))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once, however often the body reads it."""
    return F.transform(F.array(value), body)[0]


def _shortest(value: Column) -> Column:
    def fewest(v: Column) -> Column:
        def tries(places) -> Column:
            texts = F.array(*[F.format_string(f"%.{n}e", v) for n in places])
            return F.get(F.filter(texts, lambda t: t.try_cast("double") == v), F.lit(0))

        # subnormal numbers have fewer digits than the usual fifteen
        short = F.when(F.abs(v) < F.lit(2.2250738585072014e-308), tries(range(14)))
        return F.coalesce(short, tries((14, 15)), F.format_string("%.16e", v))

    def split(text: Column) -> Column:
        digits = F.regexp_replace(F.substring_index(text, "e", 1), "[-.]", "")
        return F.struct(
            F.regexp_replace(digits, "0+$", "").alias("digits"),
            F.substring_index(text, "e", -1).cast("int").alias("exponent"),
            F.when(F.startswith(text, F.lit("-")), F.lit("-")).otherwise(F.lit("")).alias("sign"),
        )

    return _let(_let(_let(value, fewest), split), _placed)


def _placed(number: Column) -> Column:
    """Sign, digits and exponent as positional text, or scientific outside 1e-4 to 1e16."""
    digits, exponent = number["digits"], number["exponent"]
    count = F.length(digits)
    scientific = F.concat(
        F.substring(digits, 1, 1),
        F.when(count > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise(F.lit("")),
        F.lit("e"),
        F.format_string("%+03d", exponent),
    )
    below_one = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    whole = F.concat(digits, F.repeat(F.lit("0"), exponent - count + 1), F.lit(".0"))
    mixed = F.concat(
        F.substr(digits, F.lit(1), exponent + 1), F.lit("."), F.substr(digits, exponent + 2)
    )
    text = (
        F.when((exponent < -4) | (exponent >= 16), scientific)
        .when(exponent < 0, below_one)
        .when(exponent >= count - 1, whole)
        .otherwise(mixed)
    )
    return F.concat(number["sign"], text)
