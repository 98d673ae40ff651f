"""Session settings and shared folders the engine relies on."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators assume; idempotent.

    All instants are UTC, so the session time zone is pinned. AQE re-plans joins
    from measured sizes and splits skewed partitions.
    """
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="tidegauge-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, the storage all executors see.

    A local session may run without that setting and then gets a temporary folder;
    on a cluster the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = _local_base()
    return f"{base.rstrip('/')}/tidegauge/{purpose}-{uuid.uuid4().hex}"


def config_table(spark: SparkSession, rows: list[dict], schema: str | T.StructType) -> DataFrame:
    """A driver-held configuration list as a local relation.

    A local relation carries its exact size, so Spark broadcasts it only while it is
    below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides beyond that.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrow_schema = to_arrow_schema(schema)
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=arrow_schema), schema=schema)
