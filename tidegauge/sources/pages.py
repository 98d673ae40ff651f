"""Shared steps of reading landed provider responses.

A page body is parsed once with a fixed schema. Parsing it as the only element of an
array makes trailing or truncated text detectable: the parse then yields no array, or
more than one element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERMISSIVE = {"mode": "PERMISSIVE"}

#: Options of Parquet files that hold whole pages. Spark's reader holds up to 4,096 rows of a row
#: group at once, hundreds of megabytes of bodies, so a group has few rows. Sizes are looked at
#: from the first row on, by default only after a hundred.
PAGE_FILES = {
    "parquet.block.row.count.limit": "64",
    "parquet.block.size": str(8 << 20),
    "parquet.block.size.row.check.min": "1",
    "parquet.page.size.row.check.min": "1",
}


def with_record(rows: DataFrame, text: str, ddl: str, name: str) -> DataFrame:
    """Add the JSON object held by a text column, null when the text is anything else.

    The parse is an array of one element, taken out by a generator. A projected column
    would do, but Spark copies a projection into every filter it moves below it, and each
    copy would parse the text again; it does not move filters on a generator's output.
    """
    wrapped = F.concat(F.lit("["), F.col(text), F.lit("]"))
    parsed = rows.withColumn("_parsed", F.from_json(wrapped, f"array<struct<{ddl}>>", PERMISSIVE))
    single = F.when(F.size("_parsed") <= 1, F.col("_parsed"))
    return parsed.select(*rows.columns, F.explode_outer(single).alias(name))


def is_json_text(text: Column) -> Column:
    """True when the text is exactly one JSON value of any kind."""
    wrapped = F.concat(F.lit("["), text, F.lit("]"))
    return F.coalesce(F.json_array_length(wrapped) == 1, F.lit(False))


def page_items(
    pages: DataFrame,
    ddl: str,
    items: str,
    keep: tuple[str, ...] = (),
    shared: dict[str, str] | None = None,
) -> DataFrame:
    """One row per item of each page: ``stream_key, <keep>, <shared>, item, reject_reason``.

    ``items`` and the ``shared`` values are expressions over ``page``; the page itself is
    not carried into the exploded rows. An unreadable page gives a single row with a
    reason instead of vanishing; an empty page gives none.
    """
    shared = shared or {}
    body = with_record(pages.select("stream_key", *keep, "body"), "body", ddl, "page")
    listed = body.select(
        "stream_key",
        *keep,
        *[F.expr(text).alias(name) for name, text in shared.items()],
        F.expr(items).alias("items"),
        F.when(F.col("page").isNull(), F.lit("bad_page")).alias("reject_reason"),
    )
    # the outer form: for a plain explode Spark adds a size filter that parses pages twice
    exploded = listed.select(
        "stream_key", *keep, *shared, F.explode_outer("items").alias("item"), "reject_reason"
    )
    return exploded.where(F.col("item").isNotNull() | F.col("reject_reason").isNotNull())


def first_reason(*checks: tuple[Column, str]) -> Column:
    """Reason of the first check that holds, null when none does."""
    return F.coalesce(*[F.when(F.coalesce(test, F.lit(False)), F.lit(why)) for test, why in checks])


def explode_points(series: DataFrame, points: Column, point_type: str) -> DataFrame:
    """One row per point of each series as ``point``; a series with a ``series_reason``
    keeps a single row without a point."""
    wanted = F.when(F.col("series_reason").isNull(), points).otherwise(
        F.array(F.lit(None).cast(point_type))
    )
    rows = series.withColumn("point", F.explode_outer(wanted))
    return rows.where(F.col("point").isNotNull() | F.col("series_reason").isNotNull())


def fail_on(df: DataFrame) -> DataFrame:
    """Strict mode: a rejected row fails the job instead of going to quarantine."""
    checked = F.when(
        F.col("reject_reason").isNotNull(),
        F.raise_error(F.concat(F.lit("rejected: "), F.col("reject_reason"))).cast("string"),
    )
    return df.withColumn("reject_reason", checked)
