import hashlib
import json
import math
import random
import re
import string
import struct
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegauge.functions import (
    entry_list,
    idempotency_key,
    iso_utc,
    json_double,
    json_string,
    last_per_key,
    object_text,
    prefix_keys,
    resolve_org_filter,
    sanitize_key,
    sanitize_name,
    second_utc,
    sorted_entries,
    strptime_pattern,
    values_variant,
)

FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def column(spark, values, kind, fn):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = frame.select("i", fn(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]


# decomposed accents, other scripts, digits that are numbers but not decimal
UNICODE_NAMES = ["é.ñ-x", "²x", "αβ٣", "e\u0301", "a_b", "\u200dz", "ｆ／ｗ"]


def generated_names():
    rng = random.Random(29)
    alphabet = string.ascii_letters + string.digits + string.punctuation + " \t\n" + "жß語🧭"
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 24))) for _ in range(400)]


def test_sanitize_key_replaces_each_foreign_character(spark):
    names = generated_names() + UNICODE_NAMES
    expected = [re.sub(r"[^\w/]", "_", name) for name in names]
    assert column(spark, names, "string", sanitize_key) == expected
    assert [sanitize_name(name) for name in names] == expected


@FEW
@given(st.lists(st.text(max_size=12), min_size=20, max_size=60))
def test_json_string_equals_python(spark, texts):
    texts = [s.encode("utf-8", "ignore").decode() for s in texts]
    assert column(spark, texts, "string", json_string) == [json.dumps(s) for s in texts]


def test_json_string_of_controls_and_long_text(spark):
    texts = ["".join(map(chr, range(0, 300))), 'q"\\/', "\x7f", "😀 a 😀", "x" * 50_000 + "é"]
    assert column(spark, texts, "string", json_string) == [json.dumps(s) for s in texts]


def test_json_double_equals_python_repr(spark):
    rng = random.Random(7)
    values = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(8_000)]
    values += [rng.uniform(-1e3, 1e3) for _ in range(4_000)]
    values += [round(rng.uniform(0, 1e9), rng.randint(0, 6)) for _ in range(4_000)]
    values += [10.0**e for e in range(-320, 309)] + [rng.random() * 10**e for e in range(-9, 22)]
    values += [0.0, -0.0, 1e16, 123456789.125, 5e-324, 1.7976931348623157e308, 0.1 + 0.2, 2e-3]
    values += [float("inf"), float("-inf")]
    values = [v for v in values if not math.isnan(v)]
    got = column(spark, values, "double", json_double)
    wrong = [(v, g) for v, g in zip(values, got) if g != json.dumps(v)]
    assert wrong == []
    assert column(spark, [float("nan")], "double", json_double) == ["NaN"]


def test_iso_and_second_text(spark):
    start = datetime(2024, 3, 1, tzinfo=timezone.utc)
    times = [start, start + timedelta(microseconds=1), start + timedelta(milliseconds=120)]
    assert column(spark, times, "timestamp", iso_utc) == [t.isoformat() for t in times]
    assert set(column(spark, times, "timestamp", second_utc)) == {"2024-03-01T00:00:00Z"}


@FEW
@given(
    st.lists(
        st.tuples(
            st.datetimes(datetime(2000, 1, 1), datetime(2100, 1, 1)),
            st.text("abcé1", max_size=4),
            st.dictionaries(st.text("aZ_é/", min_size=1, max_size=3), st.text(max_size=5), max_size=4),
            st.floats(allow_nan=False, allow_infinity=False),
        ),
        min_size=10,
        max_size=30,
    )
)
def test_idempotency_key_equals_python(spark, rows):
    rows = [
        (t, o, {k: v.encode("utf-8", "ignore").decode() for k, v in d.items()}, x)
        for t, o, d, x in rows
    ]
    frame = spark.createDataFrame(
        [(i, t.replace(tzinfo=timezone.utc), o, d, x) for i, (t, o, d, x) in enumerate(rows)],
        "i int, t timestamp, o string, d map<string,string>, x double",
    )
    labels = F.transform(
        F.map_entries("d"),
        lambda e: F.struct(e["key"].alias("k"), json_string(e["value"]).alias("j")),
    )
    base = F.array(F.struct(F.lit("m").alias("k"), json_double(F.col("x")).alias("j")))
    entries = sorted_entries(last_per_key(F.concat(base, labels)))
    got = frame.select("i", idempotency_key(F.col("t"), F.col("o"), entries).alias("r")).collect()
    for row in got:
        t, o, d, x = rows[row["i"]]
        iso = t.replace(tzinfo=timezone.utc).isoformat()
        text = f"{iso}|{o}|{json.dumps({'m': x, **d}, sort_keys=True)}"
        assert row["r"] == hashlib.sha256(text.encode()).hexdigest()


def test_entries_helpers(spark):
    one = spark.range(1)
    pairs = [("b", F.lit(1), F.lit("1")), ("a", F.lit("x"), json_string(F.lit("x"))),
             ("gone", F.lit(None), F.lit("2"))]
    entries = entry_list(pairs)
    text, prefixed, blank = one.select(
        object_text(entries), object_text(prefix_keys(entries, F.lit(" p "))),
        object_text(prefix_keys(entries, F.lit("  "))),
    ).first()
    assert text == '{"a": "x", "b": 1}'
    assert prefixed == '{"p_a": "x", "p_b": 1}'
    assert blank == text
    variant = one.select(values_variant(entries).alias("v")).selectExpr(
        "try_variant_get(v, '$.b', 'int')"
    )
    assert variant.first()[0] == 1


def test_last_entry_of_a_key_wins(spark):
    entries = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(j).alias("j"))
                        for k, j in [("a", "1"), ("b", "2"), ("a", "3"), ("a", "4")]])
    kept = spark.range(1).select(last_per_key(entries).alias("e")).first()["e"]
    assert [(e["k"], e["j"]) for e in kept] == [("b", "2"), ("a", "4")]


def test_resolve_org_filter(spark):
    values = ["hash:acme", "acme", "  ", "", None, "hash:"]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert column(spark, values, "string", resolve_org_filter) == [
        digest("acme"), "acme", None, None, None, digest("")
    ]


def test_strptime_patterns_read_what_python_writes(spark):
    draw = random.Random(31)
    formats = [
        "%d.%m.%Y %H-%M-%S", "%H:%M:%S on %Y/%m/%d", "%Y%m%dT%H%M%S", "at %d %b %Y, %H.%M",
        "%B %d %Y %I:%M %p", "%Y week of %d/%m",
    ]
    rows = []
    for fmt in formats:
        for _ in range(5):
            at = datetime(draw.randint(1971, 2037), draw.randint(1, 12), draw.randint(1, 28),
                          draw.randint(0, 23), draw.randint(0, 59), draw.randint(0, 59))
            text = at.strftime(fmt)
            rows.append((fmt, text, str(datetime.strptime(text, fmt))))
        rows.append((fmt, "neither a date nor a time", None))
    frame = spark.createDataFrame(rows, "fmt string, text string, expected string")
    for fmt in formats:
        parsed = F.try_to_timestamp("text", F.lit(strptime_pattern(fmt))).cast("string")
        for r in frame.where(F.col("fmt") == fmt).select("text", "expected", parsed.alias("got")).collect():
            assert r.got == r.expected, r.text


def test_unknown_strptime_directive_is_refused():
    with pytest.raises(ValueError, match="%Q"):
        strptime_pattern("%Y %Q")
