import os
import sys

import pytest
from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
# test posters and fetchers run in the workers too
os.environ["PYTHONPATH"] = os.pathsep.join([HERE, os.environ.get("PYTHONPATH", "")])

from tidegauge import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()


@pytest.fixture
def pages(spark):
    """Build landed pages: ``pages(provider, kind, body, ...)``."""
    import json

    from tidegauge.schema import RAW_PAGES, ddl

    def make(provider, kind, *bodies, stream_key="s", query_index=None):
        rows = [
            (
                stream_key, provider, kind, query_index, 0, 1, no,
                body if isinstance(body, str) else json.dumps(body),
            )
            for no, body in enumerate(bodies)
        ]
        return spark.createDataFrame(rows, ddl(RAW_PAGES))

    return make


@pytest.fixture
def metrics(spark):
    """Build metric entries from ``(name, value, org, seconds, labels)`` tuples."""
    from tidegauge.schema import METRIC_ENTRY, ddl

    def make(*rows, stream_key="m", identifier=None):
        from pyspark.sql import functions as F

        kind = dict(METRIC_ENTRY, event_ts="double")
        data = [(stream_key, n, v, o, identifier, labels, float(s)) for n, v, o, s, labels in rows]
        frame = spark.createDataFrame(data, ddl(kind))
        micros = F.round(F.col("event_ts") * 1_000_000).cast("bigint")
        return frame.withColumn("event_ts", F.timestamp_micros(micros))

    return make
