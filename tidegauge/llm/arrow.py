"""Small helpers of the text operators: Arrow batches in bounded slices, cut lineage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegauge.session import shared_dir

#: Rows and characters a task holds at a time besides the batch it was given.
SLICE_ROWS = 1024
SLICE_CHARS = 4_000_000


def slices(
    batch: pa.RecordBatch, text_column: str, chars: int | None = None
) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that together hold a bounded amount of text.

    ``chars`` is that bound where it isn't the common one. A single text longer than the bound
    forms a slice of its own.
    """
    chars = chars or SLICE_CHARS
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text_column)), 0)
    start, held = 0, 0
    for row, length in enumerate(lengths.to_pylist()):
        if row > start and (held + length > chars or row - start >= SLICE_ROWS):
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += length
    if start < batch.num_rows:
        yield batch.slice(start)


def map_texts(
    frame: DataFrame,
    text_column: str,
    make: Callable[[], Callable[[pa.RecordBatch], dict | pa.RecordBatch]],
    schema: str | T.StructType,
) -> DataFrame:
    """Run a function over slices of a frame; ``make`` builds it once per task."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, text_column):
                out = work(part)
                if isinstance(out, dict):
                    out = pa.RecordBatch.from_pydict(out, schema=arrow_schema)
                yield out

    return frame.mapInArrow(run, schema)


def cut(frame: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder and read from there."""
    context = frame.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(frame.sparkSession, "checkpoints"))
    return frame.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
