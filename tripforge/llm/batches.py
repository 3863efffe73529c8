"""Running numpy code over the texts of a table, in Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows and bytes in one Arrow batch, and bytes of text that one numpy step works on. A text
# longer than a step is its own step.
BATCH_ROWS = 1024
BATCH_BYTES = 2 << 20
STEP_BYTES = 1 << 20


def bound_batches(df: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Keep the session's Arrow batches small: worker memory follows them, not the table."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    return df


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, shuffle files go when the write that needed them has ended.

    Else they stay on disk until the driver happens to collect its garbage. For writes only: nothing may read
    such a shuffle later.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts one after another, and len + 1 offsets; a null has no bytes."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(batch: pa.RecordBatch, column: int, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with at most ``limit`` bytes of text, or one row."""
    _, offsets = utf8(batch.column(column))
    first = 0
    while first < len(batch):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(batch))
        yield batch.slice(first, last - first)
        first = last


def map_texts(
    df: DataFrame,
    keep: list[str],
    text: str,
    fields: list[T.StructField],
    compute: Callable[[pa.Array], list[pa.Array]],
) -> DataFrame:
    """The ``keep`` columns of every row, and after them what ``compute`` makes of its text.

    Columns are passed by place, so names in ``df`` may equal the new ones as long as the
    caller does not keep both. A text that is kept is sent to Python once and handed back as it came.
    """
    kept = bound_batches(df).select(*[F.col(f"`{c}`") for c in keep])
    if text in keep and isinstance(df.schema[text].dataType, T.StringType):
        source, place = kept, keep.index(text)
    else:
        source, place = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("text_")), len(keep)
    schema = T.StructType([*kept.schema.fields, *fields])
    names = [f.name for f in schema.fields]
    count = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, place):
                made = compute(step.column(place))
                yield pa.RecordBatch.from_arrays([*step.columns[:count], *made], names=names)
        # Workers live on: what the task has freed goes back to the system.
        pa.default_memory_pool().release_unused()

    return source.mapInArrow(run, schema)
