"""Tables: a name, a schema and a format that renders rows, sizes them and writes one file a chunk."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chunksink.functions.csv_quoting import EXCEL, Dialect, line, quote_field
from chunksink.functions.text import json_text, snake_case
from chunksink.functions.types import List, Struct, Type
from chunksink.plans.spec import Column, Schema, conform

CHUNK, ORDER = "_chunk", "_order"


class Table(Protocol):
    """A format. ``render`` makes the rows that are stored, ``size`` their bytes, ``write`` one file for each chunk.

    ``write`` gets rows with ``_chunk`` (folder name) and ``_order``, and the
    folders of all chunks; it leaves files at ``path/_chunk=<folder>/part-*``.
    """

    name: str

    def render(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame: ...

    def size(self) -> SparkColumn: ...

    def write(self, rows: DataFrame, folders: DataFrame, path: str) -> None: ...

    def read(self, spark, paths: list[str]) -> DataFrame: ...


#: Tasks move their files themselves, not the driver one by one at the end; nothing reads them before the job is through.
MOVES = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def in_chunks(rows: DataFrame) -> DataFrame:
    """Each chunk, which is bounded by the chunk size, in one task and in order."""
    return rows.repartition(CHUNK).sortWithinPartitions(CHUNK, ORDER)


@dataclass
class CsvTable:
    """CSV: a header (names in snake case) at the top of each file, then quoted rows."""

    name: str
    schema: Schema
    dialect: Dialect = EXCEL
    header: bool = True

    def render(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        rows = conform(df, self.schema, keep)
        fields = [(c.type.csv(F.col(f"`{n}`")), c.type.numeric) for n, c in self.schema.items()]
        return rows.select(*keep, line(fields, self.dialect).alias("line"))

    def size(self) -> SparkColumn:
        return F.octet_length("line").cast("long") + len(self.dialect.terminator.encode("utf-8"))

    def header_line(self) -> SparkColumn:
        return F.concat_ws(self.dialect.delimiter, *(quote_field(F.lit(snake_case(n)), False, self.dialect) for n in self.schema))

    def write(self, rows: DataFrame, folders: DataFrame, path: str) -> None:
        rows = rows.select(CHUNK, F.col(ORDER), F.lit(1).alias("_part"), "line")
        if self.header:
            first = folders.select(CHUNK, F.lit(None).cast(rows.schema[ORDER].dataType).alias(ORDER), F.lit(0).alias("_part"), self.header_line().alias("line"))
            rows = rows.unionByName(first)
        placed = rows.repartition(CHUNK).sortWithinPartitions(CHUNK, "_part", ORDER)
        placed.select(CHUNK, "line").write.partitionBy(CHUNK).options(**MOVES).option("lineSep", self.dialect.terminator).text(path)

    def read(self, spark, paths: list[str]) -> DataFrame:
        """Columns as text, in declared order and under their declared names."""
        d = self.dialect
        options = {"sep": d.delimiter, "quote": d.quote, "escape": d.escape_with, "multiLine": "true", "header": str(self.header).lower(), "nullValue": "\0", "emptyValue": "", "enforceSchema": "true"}
        if d.terminator not in ("\r\n", "\n"):
            options["lineSep"] = d.terminator
        return spark.read.options(**options).schema(", ".join(f"`{n}` string" for n in self.schema)).csv(paths)


@dataclass
class JsonTable:
    """JSON: all fields of every row, as one array a file or, with ``lines``, one object a line."""

    name: str
    lines: bool = False
    wide_as_text: bool = False
    read_schema: str | None = None

    def render(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        def one(name: str) -> SparkColumn:
            kind, value = df.schema[name].dataType.simpleString(), F.col(f"`{name}`")
            return (value.cast("string") if self.wide_as_text and (kind == "bigint" or kind.startswith("decimal")) else value).alias(name)

        return df.select(*keep, json_text(F.struct(*(one(c) for c in df.columns if c not in keep))).alias("line"))

    def size(self) -> SparkColumn:
        """Length in UTF-16 units."""
        return (F.octet_length(F.encode("line", "UTF-16BE")) / 2).cast("long")

    def write(self, rows: DataFrame, folders: DataFrame, path: str) -> None:
        if self.lines:
            # Every row ends in a brace, which serves as the separator: no line break after the last row.
            rank = F.row_number().over(Window.partitionBy(CHUNK).orderBy(ORDER))
            text = F.concat(F.when(rank > 1, F.lit("\n")).otherwise(F.lit("")), F.regexp_replace("line", r"\}$", ""))
            placed = rows.repartition(CHUNK).select(CHUNK, rank.alias("_rank"), text.alias("line")).sortWithinPartitions(CHUNK, "_rank")
            placed.select(CHUNK, "line").write.partitionBy(CHUNK).options(**MOVES).option("lineSep", "}").text(path)
            return
        joined = rows.groupBy(CHUNK).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(ORDER, "line"))), lambda x: x["line"]), ",").alias("line"))  # a chunk is bounded
        whole = folders.select(CHUNK).join(joined, CHUNK, "left").select(CHUNK, F.concat(F.lit("["), F.coalesce("line", F.lit(""))).alias("line"))
        whole.repartition(CHUNK).write.partitionBy(CHUNK).options(**MOVES).option("lineSep", "]").text(path)

    def read(self, spark, paths: list[str]) -> DataFrame:
        reader = spark.read.option("multiLine", str(not self.lines).lower())
        if self.read_schema:
            reader = reader.schema(self.read_schema)
        return reader.json(paths)


CODECS = {"UNCOMPRESSED": "uncompressed", "GZIP": "gzip", "SNAPPY": "snappy", "ZSTD": "zstd", "LZ4": "lz4_raw"}


def codec(name: str) -> str:
    if name.upper() not in CODECS:
        raise ValueError(f"compression {name} is not available; choose one of {', '.join(CODECS)}")
    return CODECS[name.upper()]


@dataclass
class ParquetTable:
    """Parquet with declared types; plain encoding, as dictionary pages are off."""

    name: str
    schema: Schema
    compression: str = "UNCOMPRESSED"
    row_group_size: int = 32 * 1024 * 1024
    page_size: int = 8 * 1024
    dictionary: bool = False
    codecs: dict[str, str] = field(init=False)

    def __post_init__(self) -> None:
        codec(self.compression)
        self.codecs = {n: codec(c.compression) for n, c in self.schema.items() if c.compression}

    def render(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        return conform(df, self.schema, keep)

    def size(self) -> SparkColumn:
        out = F.lit(0).cast("long")
        for n, c in self.schema.items():
            out = out + c.type.size(F.col(f"`{n}`"))
        return out

    def write(self, rows: DataFrame, folders: DataFrame, path: str) -> None:
        if self.codecs:
            self._write_by_column(rows, path)
            return
        options = {
            "compression": codec(self.compression),
            "parquet.block.size": str(self.row_group_size),
            "parquet.page.size": str(self.page_size),
            "parquet.enable.dictionary": str(self.dictionary).lower(),
        }
        spark = rows.sparkSession
        key, before = "spark.sql.parquet.outputTimestampType", spark.conf.get("spark.sql.parquet.outputTimestampType")
        spark.conf.set(key, "TIMESTAMP_MILLIS")
        try:
            in_chunks(rows).drop(ORDER).write.partitionBy(CHUNK).options(**MOVES, **options).parquet(path)
        finally:
            spark.conf.set(key, before)

    def _write_by_column(self, rows: DataFrame, path: str) -> None:
        """Codecs of single columns: the Arrow library writes each chunk, row group by row group."""
        names, own, default, group, page, dictionary = list(self.schema), self.codecs, codec(self.compression), self.row_group_size, self.page_size, self.dictionary
        nested = {n: leaves(n, c.type) for n, c in self.schema.items()}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import pyarrow.parquet as pq
            from pyarrow import fs

            store, base = fs.FileSystem.from_uri(path)
            arrow = {"uncompressed": "none", "lz4_raw": "lz4"}
            chosen = {leaf: arrow.get(own.get(n, default), own.get(n, default)) for n in names for leaf in nested[n]}

            def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
                """Runs of rows of one chunk."""
                for batch in batches:
                    chunk = batch.column(CHUNK)
                    ends = [i for i in range(1, batch.num_rows) if chunk[i] != chunk[i - 1]]
                    for a, b in zip([0, *ends], [*ends, batch.num_rows], strict=True):
                        if b > a:
                            yield chunk[a].as_py(), batch.select(names).slice(a, b - a)

            for chunk, runs in groupby(rows_of(batches), lambda x: x[0]):
                folder = f"{base}/{CHUNK}={chunk}"
                store.create_dir(folder)
                with store.open_output_stream(f"{folder}/.writing") as f:
                    writer, held, size = None, [], 0
                    for _, part in runs:
                        writer = writer or pq.ParquetWriter(f, part.schema, compression=chosen, use_dictionary=dictionary, data_page_size=page, coerce_timestamps="ms", allow_truncated_timestamps=True)
                        held.append(part)
                        size += part.nbytes
                        if size >= group:  # one row group is held at a time
                            writer.write_table(pa.Table.from_batches(held))
                            held, size = [], 0
                    if held:
                        writer.write_table(pa.Table.from_batches(held))
                    writer.close()
                store.move(f"{folder}/.writing", f"{folder}/part-00000.parquet")
            yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32())], ["done"])

        in_chunks(rows).drop(ORDER).mapInArrow(run, "done int").count()

    def read(self, spark, paths: list[str]) -> DataFrame:
        found = spark.read.schema(", ".join(f"`{n}` {c.type.spark.simpleString()}" for n, c in self.schema.items())).parquet(*paths)
        return found


def leaves(path: str, kind: Type) -> list[str]:
    """Paths of the stored columns below a column."""
    if isinstance(kind, List):
        return leaves(f"{path}.list.element", kind.item)
    if isinstance(kind, Struct):
        return [leaf for n, t, _ in kind.fields for leaf in leaves(f"{path}.{n}", t)]
    return [path]


RESERVED = {"set_force_flush", "forced", "tables"}


def check_tables(tables: dict[str, Table]) -> None:
    """Aliases must be free names, and file names distinct."""
    for alias in tables:
        if alias in RESERVED or not re.fullmatch(r"[A-Za-z]\w*", alias):
            raise ValueError(f"{alias!r} cannot be the alias of a table")
    names = [t.name for t in tables.values()]
    if len(set(names)) < len(names):
        raise ValueError("two tables have the same file name")


__all__ = ["CHUNK", "ORDER", "Column", "CsvTable", "JsonTable", "ParquetTable", "Table", "check_tables", "codec", "in_chunks"]
