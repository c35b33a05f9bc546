"""Arrow batches in Python workers, kept small."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BATCH_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def release() -> None:
    """Give freed memory back to the system: workers stay idle for a while after a task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def map_batches(df: DataFrame, run: Run, schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow`` over batches of at most ``BATCH_ROWS`` rows, as whole texts are large.

    The limit is a setting of the session, which this lowers.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_ROWS, "10000")) <= BATCH_ROWS:
        conf.set(_ROWS, str(BATCH_ROWS))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return df.mapInArrow(whole, schema)
