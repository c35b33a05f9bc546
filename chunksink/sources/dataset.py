"""Reading the committed chunks of a destination."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunksink.operators.tables import Table
from chunksink.sources.dest import Dest
from chunksink.streaming.state import StateHooks, TextState

FOLDER = re.compile(r"(\d+)-(\d+)")


def committed(dest: Dest, hooks: StateHooks | None = None) -> list[tuple[int, int, str]]:
    """(from, to, folder) of the chunks that the state covers, in order."""
    state = (hooks or TextState()).on_state_read(dest)
    height = state.height if state else -1
    found = [(int(m[1]), int(m[2]), n) for n in dest.readdir() if (m := FOLDER.fullmatch(n))]
    return sorted(x for x in found if x[0] <= height)


def read_chunks(dest: Dest, table: Table, start: int | None = None, end: int | None = None, hooks: StateHooks | None = None) -> DataFrame:
    """Rows of ``table`` in committed chunks that overlap [start, end]; other chunks are pruned before the scan.

    ``_chunk`` names the folder of each row.
    """
    folders = [n for a, b, n in committed(dest, hooks) if (end is None or a <= end) and (start is None or b >= start)]
    if not folders:
        return _nothing(dest, table)
    with _listing(dest):
        rows = table.read(dest.spark, [dest.path(n, table.name) for n in folders])
    return rows.withColumn("_chunk", F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+-\d+)/[^/]*$", 1))


@contextmanager
def _listing(dest: Dest) -> Iterator[None]:
    """Files are looked up by a few tasks a core, not by a task each."""
    conf, key = dest.spark.conf, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = conf.get(key)
    conf.set(key, str(min(int(before), 4 * dest.spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        conf.set(key, before)


def _nothing(dest: Dest, table: Table) -> DataFrame:
    schema = getattr(table, "schema", None)
    fields = ", ".join(f"`{n}` {c.type.spark.simpleString()}" for n, c in schema.items()) if schema else getattr(table, "read_schema", None)
    return dest.spark.createDataFrame([], f"{fields}, _chunk string" if fields else "_chunk string")
