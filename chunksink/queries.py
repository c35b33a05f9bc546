"""Registered queries of the sink's operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunksink.functions import types as t
from chunksink.functions import words
from chunksink.functions.csv_quoting import EXCEL_TAB, Dialect, Quote
from chunksink.functions.text import json_text, number_text
from chunksink.operators.database import Database
from chunksink.operators.tables import Column, CsvTable, JsonTable, ParquetTable
from chunksink.plans.chunk_plan import batch_sizes, chunk_plan, chunks, folder_name
from chunksink.plans.spec import conform, violations
from chunksink.sources.dataset import read_chunks
from chunksink.sources.dest import Dest
from chunksink.sources.shared import shared_dir
from chunksink.streaming.state import Head

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _store(spark: SparkSession, tables: dict, chunk_size_mb: float = 20) -> Database:
    db = Database(Dest(spark, shared_dir(spark, "store")), tables, chunk_size_mb)
    db.connect()
    return db


def _all_flushed(df: DataFrame, height: str = "height") -> DataFrame:
    """The last height, forced."""
    return df.agg(F.max(height).alias("height")).withColumn("forced", F.lit(True)).where("height is not null")


def _through(spark: SparkSession, df: DataFrame, made, order: list[str], chunk_size_mb: float = 20) -> DataFrame:
    """Rows of ``df`` (with ``height``) written in chunks and read back."""
    db = _store(spark, {"rows": made}, chunk_size_mb)
    db.run_batches(df, {"rows": lambda d: d}, forced=_all_flushed(df), order=order)
    return read_chunks(db.dest, made).drop("_chunk")


LINEITEM = {
    "l_orderkey": Column(t.Int64()), "l_partkey": Column(t.Int64()), "l_suppkey": Column(t.Int64()), "l_linenumber": Column(t.Int32()), "l_quantity": Column(t.Double()),
    "l_extendedprice": Column(t.Double()), "l_discount": Column(t.Double()), "l_tax": Column(t.Double()), "l_returnflag": Column(t.String()), "l_linestatus": Column(t.String()), "l_shipdate": Column(t.Timestamp()),
}


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("height", F.expr("l_orderkey div 100"))
    return _through(spark, rows, ParquetTable("lineitem.parquet", LINEITEM, "ZSTD"), ["l_orderkey", "l_linenumber"])


def parquet_column_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = {"o_orderkey": Column(t.Int64(), compression="GZIP"), "o_orderstatus": Column(t.String()), "o_orderpriority": Column(t.String(), compression="ZSTD"), "o_orderdate": Column(t.Timestamp())}
    rows = table(spark, sf_dir, "orders").withColumn("height", F.expr("o_orderkey div 1000"))
    return _through(spark, rows, ParquetTable("orders.parquet", schema), ["o_orderkey"])


def parquet_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = {"vec_id": Column(t.Int64()), "embedding": Column(t.List(t.Float()))}
    rows = table(spark, sf_dir, "embeddings").withColumn("height", F.expr("vec_id div 100"))
    back = _through(spark, rows, ParquetTable("vectors.parquet", schema), ["vec_id"])
    return back.select("vec_id", F.posexplode("embedding").alias("pos", "value")).withColumn("value", F.col("value").cast("double")).withColumn("pos", F.col("pos").cast("long"))


def parquet_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = {"c_custkey": Column(t.Int64()), "who": Column(t.Struct((("name", t.String(), False), ("segment", t.String(), True))), nullable=True)}
    who = F.struct(F.col("c_name").alias("name"), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 != 0, who).alias("who"), F.expr("c_custkey div 100 as height"))
    back = _through(spark, rows, ParquetTable("customer.parquet", schema), ["c_custkey"])
    return back.select("c_custkey", F.col("who.name").alias("name"), F.col("who.segment").alias("segment"))


def parquet_decimal_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 2 == 0, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).cast("decimal(18,4)").alias("price"))
    made = conform(rows, {"l_orderkey": Column(t.Int64()), "l_linenumber": Column(t.Int32()), "price": Column(t.Decimal(12, 1))})
    return made.withColumn("price", F.col("price").cast("double"))


def parquet_decimal_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of more than 20 digits, cut to the scale, through Parquet."""
    digits = F.concat(F.when(F.col("o_orderkey") % 2 == 0, "-").otherwise(""), F.lit("1"), F.col("o_orderkey").cast("string"), F.lit("12345678901234567.99999999999999999999"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", digits.alias("wide"), digits.alias("whole"), F.expr("o_orderkey div 1000 as height"))
    schema = {"o_orderkey": Column(t.Int64()), "wide": Column(t.Decimal(38, 11)), "whole": Column(t.Decimal(38, 0))}
    back = _through(spark, rows, ParquetTable("orders.parquet", schema), ["o_orderkey"])
    return back.select("o_orderkey", *(F.col(c).cast("string").alias(c) for c in ("wide", "whole")))


def csv_other_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Booleans and JSON as CSV text."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") > 0).alias("rich"), F.struct("c_name", "c_mktsegment").alias("doc")).withColumn("_id", F.col("c_custkey"))
    schema = {"c_custkey": Column(t.Numeric()), "rich": Column(t.Boolean()), "doc": Column(t.JSON())}
    return CsvTable("customer.csv", schema).render(rows, ("_id",)).select(F.col("_id").alias("c_custkey"), "line")


def parquet_json_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Booleans and JSON through Parquet, with a codec each."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal") > 0).alias("rich"), F.struct("c_name", "c_mktsegment").alias("doc"), F.expr("c_custkey div 100 as height"))
    schema = {"c_custkey": Column(t.Int64()), "rich": Column(t.Boolean(), nullable=True), "doc": Column(t.JSON())}
    return _through(spark, rows, ParquetTable("customer.parquet", schema, "SNAPPY"), ["c_custkey"]).select("c_custkey", "rich", "doc")


def parquet_timestamp_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("height", F.expr("event_id div 50"))
    back = _through(spark, rows, ParquetTable("events.parquet", {"event_id": Column(t.Int64()), "ts": Column(t.Timestamp())}), ["event_id"])
    return back.select("event_id", F.unix_millis("ts").alias("ms"))


def parquet_unsigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = lambda k: (F.col("p_size").cast("decimal(20,0)") * F.lit(k).cast("decimal(20,0)")).cast("decimal(20,0)")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("u8"), wide(1000).alias("u16"), wide(80_000_000).alias("u32"), wide(360_000_000_000_000_000).alias("u64"), F.expr("p_partkey div 100 as height"))
    schema = {"p_partkey": Column(t.Int64()), "u8": Column(t.Uint8()), "u16": Column(t.Uint16()), "u32": Column(t.Uint32()), "u64": Column(t.Uint64())}
    back = _through(spark, rows, ParquetTable("part.parquet", schema), ["p_partkey"])
    return back.select("p_partkey", *(F.col(c).cast("string").alias(c) for c in ("u8", "u16", "u32", "u64")))


def parquet_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.expr("nullif(event_type, 'purchase')").alias("event_type"), F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("user_id"), F.expr("event_id div 50 as height"))
    schema = {"event_id": Column(t.Int64()), "event_type": Column(t.String(), nullable=True), "user_id": Column(t.Int64(), nullable=True)}
    return _through(spark, rows, ParquetTable("events.parquet", schema), ["event_id"])


def _csv_lines(dialect: Dialect) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        schema = {"doc_id": Column(t.Numeric()), "text": Column(t.String()), "lang": Column(t.String()), "source": Column(t.String())}
        rows = table(spark, sf_dir, "documents").withColumn("_id", F.col("doc_id"))
        return CsvTable("documents.csv", schema, dialect).render(rows, ("_id",)).select(F.col("_id").alias("doc_id"), "line")

    return run


CUSTOM = Dialect("-", "'", Quote.MINIMAL, ";", "^")


def csv_null_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("_id", F.col("doc_id"))
    schema = {"doc_id": Column(t.Numeric()), "quality": Column(t.Numeric(), nullable=True), "toxic": Column(t.Numeric(), nullable=True)}
    return CsvTable("labels.csv", schema, Dialect(quoting=Quote.ALL)).render(rows, ("_id",)).select(F.col("_id").alias("doc_id"), "line")


def csv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = CsvTable("x.csv", {c: Column(t.String()) for c in ("blockNumber", "extrinsicHash", "from", "to,or", "HTTPCode2Name")})
    return table(spark, sf_dir, "region").select("r_regionkey", made.header_line().alias("line"))


def csv_datetime_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(table(spark, sf_dir, "events"), {"event_id": Column(t.Int64()), "ts": Column(t.DateTime())})


def csv_datetime_strftime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(table(spark, sf_dir, "orders"), {"o_orderkey": Column(t.Int64()), "o_orderdate": Column(t.DateTime("%d/%m/%Y at %H:%M:%S, day %j"))})


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = {"doc_id": Column(t.Numeric()), "text": Column(t.String()), "lang": Column(t.String()), "source": Column(t.String())}
    rows = table(spark, sf_dir, "documents").withColumn("height", F.expr("doc_id div 20"))
    back = _through(spark, rows, CsvTable("documents.csv", schema), ["doc_id"], 0.5)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "lang", "source")


def csv_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles as text, read again as numbers."""
    rows = table(spark, sf_dir, "lineitem")
    read = lambda c: number_text(F.col(c), "double").cast("double").alias(c)
    return rows.select("l_orderkey", "l_linenumber", read("l_extendedprice"), read("l_discount"), number_text(F.col("l_quantity"), "double").alias("quantity"))


EVENT = "event_id bigint, event_type string, user_id bigint, value double, props string"


def _json_rows(lines: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value", "props", "ts", F.expr("event_id div 50 as height"))
        made = JsonTable("events.jsonl" if lines else "events.json", lines, read_schema=f"{EVENT}, ts timestamp, height bigint")
        return _through(spark, rows, made, ["event_id"], 0.02).select("event_id", "event_type", "user_id", "value", "props", F.unix_millis("ts").alias("ms"))

    return run


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    made = rows.select("conv_id", "turn", json_text(F.struct("role", "turn", "text")).alias("doc"))
    return made


def bson_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.struct("role", F.col("turn").cast("int").alias("turn"), "text").alias("doc"))
    made = conform(rows, {"conv_id": Column(t.Int64()), "turn": Column(t.Int64()), "doc": Column(t.BSON())})
    return made.select("conv_id", "turn", F.lower(F.hex("doc")).alias("doc"))


def size_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = CsvTable("customer.csv", {"c_custkey": Column(t.Numeric()), "c_name": Column(t.String()), "c_mktsegment": Column(t.String())})
    rows = table(spark, sf_dir, "customer").withColumn("height", F.expr("c_custkey div 100"))
    return made.render(rows, ("height",)).groupBy("height").agg(F.sum(made.size()).alias("bytes"))


def size_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = JsonTable("customer.json")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", F.expr("c_custkey div 100 as height"))
    return made.render(rows, ("height",)).groupBy("height").agg(F.sum(made.size()).alias("bytes"))


SIZED = {"event_id": Column(t.Int64()), "ts": Column(t.Timestamp()), "user_id": Column(t.Int64()), "event_type": Column(t.String()), "value": Column(t.Double())}


def _sized_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = ParquetTable("events.parquet", SIZED)
    rows = table(spark, sf_dir, "events").withColumn("height", F.expr("event_id div 50"))
    return made.render(rows, ("height",)).groupBy("height").agg(F.sum(made.size()).alias("bytes"))


def size_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sized_events(spark, sf_dir)


def chunk_plan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks(chunk_plan(batch_sizes([_sized_events(spark, sf_dir)]), 8192))


def chunk_plan_forced(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = _sized_events(spark, sf_dir)
    return chunks(chunk_plan(batch_sizes([sized], sized.select("height", (F.col("height") % 37 == 0).alias("forced"))), 8192))


def chunk_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", folder_name(F.col("o_orderkey"), F.col("o_orderkey") * 1_000_000_007).alias("folder"))


def recovery_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks above the recorded height are gone after ``connect``; the rest is read."""
    made = ParquetTable("events.parquet", SIZED)
    rows = table(spark, sf_dir, "events").withColumn("height", F.expr("event_id div 50"))
    db = _store(spark, {"events": made}, 8192 / 1024 / 1024)
    db.run_batches(rows, {"events": lambda d: d}, forced=rows.select("height").distinct().withColumn("forced", F.col("height") % 4 == 3), order=["event_id"])
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] // 50
    height = last // 2 // 4 * 4 + 3
    db.hooks.on_state_update(db.dest, Head(height, "0xback"), db.state)
    db.connect()
    return read_chunks(db.dest, made).select("event_id", "user_id")


def fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    pq = ParquetTable("events.parquet", {"event_id": Column(t.Int64()), "event_type": Column(t.String())})
    csv = CsvTable("events.csv", {"event_id": Column(t.Numeric()), "event_type": Column(t.String())})
    rows = table(spark, sf_dir, "events").withColumn("height", F.expr("event_id div 50"))
    db = _store(spark, {"pq": pq, "csv": csv}, 0.01)
    db.run_batches(rows, {"pq": lambda d: d, "csv": lambda d: d.where("event_type = 'purchase'")}, forced=_all_flushed(rows), order=["event_id"])
    a = read_chunks(db.dest, pq).select(F.lit("pq").alias("sink"), "event_id", "event_type")
    b = read_chunks(db.dest, csv).select(F.lit("csv").alias("sink"), F.col("event_id").cast("long").alias("event_id"), "event_type")
    return a.unionByName(b)


def range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    asked = {"int8": (t.Int8(), "c_custkey"), "uint8": (t.Uint8(), "c_custkey"), "uint16": (t.Uint16(), "c_acctbal"), "int16": (t.Int16(), "c_acctbal"), "uint32": (t.Uint32(), "c_custkey")}
    return violations(rows, {name: kind.fits(F.col(c), rows.schema[c].dataType) for name, (kind, c) in asked.items()})


def null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return violations(rows, {c: F.col(c).isNotNull() for c in ("doc_id", "quality", "toxic")})


def event_filter_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log scan: filter by topic and finality, decode two words of data."""
    logs = table(spark, sf_dir, "events").select("event_id", "event_type", F.expr("event_id div 50 as height"), F.concat(F.lit("0x"), words.encode_unsigned(F.col("user_id")), words.encode_unsigned(F.col("event_id") * 1_000_003)).alias("data"))
    head = table(spark, sf_dir, "events").agg(F.expr("max(event_id div 50)").alias("head"))
    final = logs.crossJoin(F.broadcast(head)).where((F.col("event_type") == "purchase") & (F.col("height") <= F.col("head") - 10))  # one row
    return final.select("event_id", "height", words.as_unsigned(words.word(F.col("data"), 0)).cast("long").alias("user_id"), words.as_unsigned(words.word(F.col("data"), 1)).cast("long").alias("amount"), words.as_address(words.word(F.col("data"), 0)).alias("address"))


def flat_map_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of records, flattened into rows."""
    blocks = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("turns"))
    return blocks.select("conv_id", F.explode("turns").alias("t")).select("conv_id", "t.turn", "t.role")


def dataset_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Committed chunks read for a range of heights."""
    made = ParquetTable("events.parquet", SIZED)
    rows = table(spark, sf_dir, "events").withColumn("height", F.expr("event_id div 50"))
    db = _store(spark, {"events": made}, 0.01)
    db.run_batches(rows, {"events": lambda d: d}, forced=_all_flushed(rows), order=["event_id"])
    return read_chunks(db.dest, made, 3, 11).where("event_id div 50 between 3 and 11").select("event_id", "event_type", "value")


def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of files, one micro-batch a file, through staging and chunks."""
    source = shared_dir(spark, "stream")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", F.expr("event_id div 50 as height"))
    top = events.agg(F.max("height")).first()[0]
    cuts = [top * k // 4 for k in range(1, 5)]
    low = -1
    for high in cuts:
        events.where((F.col("height") > low) & (F.col("height") <= high)).coalesce(1).write.mode("append").parquet(source)
        low = high
    made = ParquetTable("events.parquet", {"event_id": Column(t.Int64()), "user_id": Column(t.Int64()), "event_type": Column(t.String()), "value": Column(t.Double())})
    db = Database(Dest(spark, shared_dir(spark, "store")), {"events": made}, 20)

    def body(df: DataFrame, batch) -> None:
        batch.events.write(df.orderBy("event_id"))
        batch.set_force_flush(df.agg(F.max("height")).first()[0] in cuts[1::2])

    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    db.run_stream(stream, body, shared_dir(spark, "offsets")).awaitTermination()
    return read_chunks(db.dest, made).drop("_chunk")


QUERIES: dict[str, Query] = {
    "parquet_roundtrip": parquet_roundtrip,
    "parquet_column_codec": parquet_column_codec,
    "parquet_list": parquet_list,
    "parquet_struct": parquet_struct,
    "parquet_decimal_trunc": parquet_decimal_trunc,
    "parquet_decimal_wide": parquet_decimal_wide,
    "csv_other_types": csv_other_types,
    "parquet_json_boolean": parquet_json_boolean,
    "parquet_timestamp_ms": parquet_timestamp_ms,
    "parquet_unsigned": parquet_unsigned,
    "parquet_optional": parquet_optional,
    "csv_minimal_lines": _csv_lines(Dialect()),
    "csv_tab_lines": _csv_lines(EXCEL_TAB),
    "csv_custom_lines": _csv_lines(CUSTOM),
    "csv_quote_all": _csv_lines(Dialect(quoting=Quote.ALL)),
    "csv_quote_nonnumeric": _csv_lines(Dialect(quoting=Quote.NONNUMERIC)),
    "csv_quote_none": _csv_lines(Dialect(quoting=Quote.NONE)),
    "csv_null_empty": csv_null_empty,
    "csv_header": csv_header,
    "csv_datetime_iso": csv_datetime_iso,
    "csv_datetime_strftime": csv_datetime_strftime,
    "csv_roundtrip": csv_roundtrip,
    "csv_numbers": csv_numbers,
    "jsonl_rows": _json_rows(True),
    "json_array": _json_rows(False),
    "json_documents": json_documents,
    "bson_documents": bson_documents,
    "size_csv": size_csv,
    "size_json": size_json,
    "size_parquet": size_parquet,
    "chunk_plan": chunk_plan_query,
    "chunk_plan_forced": chunk_plan_forced,
    "chunk_folders": chunk_folders,
    "recovery_prune": recovery_prune,
    "fanout": fanout,
    "range_violations": range_violations,
    "null_violations": null_violations,
    "event_filter_decode": event_filter_decode,
    "flat_map_turns": flat_map_turns,
    "dataset_range": dataset_range,
    "stream_equals_batch": stream_equals_batch,
}


def _sql_lines(delimiter: str, quote: str, escape: str, terminator: str, quoting: str) -> str:
    q = "'" + quote.replace("'", "''") + "'"

    def escaped(x: str, marks: list[str]) -> str:
        out = x
        for m in sorted(dict.fromkeys(marks), key=lambda m: m != escape):  # the escape character first, as the others bring it in
            lit = "'" + m.replace("'", "''") + "'" if m not in ("\r\n", "\t") else {"\r\n": "chr(13) || chr(10)", "\t": "chr(9)"}[m]
            out = f"replace({out}, {lit}, '{escape.replace(chr(39), chr(39) * 2)}' || {lit})"
        return out

    def field(x: str, numeric: bool) -> str:
        quoted = f"{q} || {escaped(x, [quote, escape])} || {q}"
        bare = escaped(x, [delimiter, quote, escape, terminator])
        if quoting == "all" or (quoting == "nonnumeric" and not numeric):
            return quoted
        if quoting in ("none", "nonnumeric"):
            return bare
        marks = [delimiter, quote, terminator]
        tests = " OR ".join(f"contains({x}, {a})" for a in [*("'" + m.replace("'", "''") + "'" for m in marks if m not in ("\r\n", "\t")), "chr(13)", "chr(10)", *(["chr(9)"] if delimiter == "\t" else [])])
        return f"CASE WHEN {tests} THEN {quoted} ELSE {x} END"

    d = "chr(9)" if delimiter == "\t" else f"'{delimiter}'"
    parts = f" || {d} || ".join(field(x, n) for x, n in (("doc_id::VARCHAR", True), ("text", False), ("lang", False), ("source", False)))
    return f"SELECT doc_id, {parts} AS line FROM documents"


def _little(n: str) -> str:
    """Hexadecimal text of a little-endian 32-bit number."""
    return "(" + " || ".join(f"printf('%02x', (({n}) // {256**k}) % 256)" for k in range(4)) + ")"


_FOLD = """
WITH RECURSIVE sizes AS (
  SELECT event_id // 50 AS height, sum(8 + 8 + 8 + strlen(event_type) + 8)::BIGINT AS bytes, {forced} AS forced FROM events GROUP BY 1
), ordered AS (SELECT *, row_number() OVER (ORDER BY height) AS r FROM sizes),
fold AS (
  SELECT 0::BIGINT AS r, -1::BIGINT AS previous, 0::BIGINT AS buf, NULL::BIGINT AS chunk_from, NULL::BIGINT AS chunk_to, NULL::BIGINT AS chunk_bytes
  UNION ALL
  SELECT o.r, CASE WHEN o.forced OR f.buf + o.bytes >= 8192 THEN o.height ELSE f.previous END,
         CASE WHEN o.forced OR f.buf + o.bytes >= 8192 THEN 0 ELSE f.buf + o.bytes END,
         CASE WHEN o.forced OR f.buf + o.bytes >= 8192 THEN f.previous + 1 END,
         CASE WHEN o.forced OR f.buf + o.bytes >= 8192 THEN o.height END,
         CASE WHEN o.forced OR f.buf + o.bytes >= 8192 THEN f.buf + o.bytes END
  FROM fold f JOIN ordered o ON o.r = f.r + 1
)
SELECT chunk_from, chunk_to, chunk_bytes FROM fold WHERE chunk_bytes > 0"""

_EVENTS = "SELECT event_id, event_type, user_id, value, props, epoch_us(ts) // 1000 AS ms FROM events"

ORACLES: dict[str, str] = {
    "parquet_roundtrip": "SELECT * FROM lineitem",
    "parquet_column_codec": "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderdate FROM orders",
    "parquet_list": "SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS value FROM embeddings",
    "parquet_struct": "SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS name, CASE WHEN c_custkey % 5 <> 0 AND c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment FROM customer",
    "parquet_decimal_trunc": """
SELECT l_orderkey, l_linenumber, (CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END * floor(abs(l_extendedprice::DECIMAL(18,4)) * 10)::DECIMAL(18,1) / 10)::DOUBLE AS price FROM lineitem""",
    "parquet_decimal_wide": """
SELECT o_orderkey, sign || '1' || o_orderkey || '12345678901234567.99999999999' AS wide, sign || '1' || o_orderkey || '12345678901234567' AS whole
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE '' END AS sign FROM orders)""",
    "csv_other_types": """
SELECT c_custkey, c_custkey || ',' || CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END || ',"' || replace('{"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}', '"', '""') || '"' AS line FROM customer""",
    "parquet_json_boolean": """
SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal > 0 END AS rich, '{"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}' AS doc FROM customer""",
    "parquet_timestamp_ms": "SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events",
    "parquet_unsigned": """
SELECT p_partkey, p_size::UTINYINT::VARCHAR AS u8, (p_size * 1000)::USMALLINT::VARCHAR AS u16, (p_size * 80000000::BIGINT)::UINTEGER::VARCHAR AS u32,
       (p_size * 360000000000000000::HUGEINT)::UBIGINT::VARCHAR AS u64 FROM part""",
    "parquet_optional": "SELECT event_id, nullif(event_type, 'purchase') AS event_type, CASE WHEN user_id % 3 <> 0 THEN user_id END AS user_id FROM events",
    "csv_minimal_lines": _sql_lines(",", '"', '"', "\r\n", "minimal"),
    "csv_tab_lines": _sql_lines("\t", '"', '"', "\r\n", "minimal"),
    "csv_custom_lines": _sql_lines("-", "'", "^", ";", "minimal"),
    "csv_quote_all": _sql_lines(",", '"', '"', "\r\n", "all"),
    "csv_quote_nonnumeric": _sql_lines(",", '"', '"', "\r\n", "nonnumeric"),
    "csv_quote_none": _sql_lines(",", '"', '"', "\r\n", "none"),
    "csv_null_empty": """
SELECT d.doc_id, '"' || d.doc_id || '","' || coalesce(quality::VARCHAR, '') || '","' || coalesce(toxic::VARCHAR, '') || '"' AS line FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "csv_header": """SELECT r_regionkey, 'block_number,extrinsic_hash,from,"to,or",http_code2_name' AS line FROM region""",
    "csv_datetime_iso": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS ts FROM events",
    "csv_datetime_strftime": "SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y at %H:%M:%S, day %j') AS o_orderdate FROM orders",
    "csv_roundtrip": "SELECT doc_id, coalesce(text, '') AS text, lang, source FROM documents",
    "csv_numbers": "SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, l_quantity::BIGINT::VARCHAR AS quantity FROM lineitem",
    "jsonl_rows": _EVENTS,
    "json_array": _EVENTS,
    "json_documents": """SELECT conv_id, turn, '{"role":"' || role || '","turn":' || turn || coalesce(',"text":' || to_json(text)::VARCHAR, '') || '}' AS doc FROM conversations""",
    "bson_documents": f"""
WITH parts AS (
  SELECT conv_id, turn, '02' || hex('role') || '00' || {_little('strlen(role) + 1')} || hex(role) || '00' || '10' || hex('turn') || '00' || {_little('turn')}
         || CASE WHEN text IS NULL THEN '0A' || hex('text') || '00' ELSE '02' || hex('text') || '00' || {_little('strlen(text) + 1')} || hex(text) || '00' END || '00' AS body
  FROM conversations
) SELECT conv_id, turn, lower({_little('length(body) // 2 + 4')} || body) AS doc FROM parts""",
    "size_csv": "SELECT c_custkey // 100 AS height, sum(strlen(c_custkey::VARCHAR) + 1 + strlen(c_name) + 1 + strlen(c_mktsegment) + 2)::BIGINT AS bytes FROM customer GROUP BY 1",
    "size_json": """
SELECT c_custkey // 100 AS height, sum(length('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}'))::BIGINT AS bytes FROM customer GROUP BY 1""",
    "size_parquet": "SELECT event_id // 50 AS height, sum(8 + 8 + 8 + strlen(event_type) + 8)::BIGINT AS bytes FROM events GROUP BY 1",
    "chunk_plan": _FOLD.format(forced="false"),
    "chunk_plan_forced": _FOLD.format(forced="(event_id // 50) % 37 = 0"),
    "chunk_folders": """
SELECT o_orderkey, lpad(o_orderkey::VARCHAR, greatest(10, length(o_orderkey::VARCHAR))::INTEGER, '0') || '-' || lpad((o_orderkey * 1000000007)::VARCHAR, greatest(10, length((o_orderkey * 1000000007)::VARCHAR))::INTEGER, '0') AS folder FROM orders""",
    "recovery_prune": "SELECT event_id, user_id FROM events WHERE event_id // 50 <= (SELECT max(event_id) // 50 // 2 // 4 * 4 + 3 FROM events)",
    "fanout": "SELECT 'pq' AS sink, event_id, event_type FROM events UNION ALL SELECT 'csv', event_id, event_type FROM events WHERE event_type = 'purchase'",
    "range_violations": """
SELECT count(*) FILTER (WHERE NOT c_custkey BETWEEN -128 AND 127) AS int8, count(*) FILTER (WHERE NOT c_custkey BETWEEN 0 AND 255) AS uint8,
       count(*) FILTER (WHERE NOT (c_acctbal BETWEEN 0 AND 65535 AND c_acctbal = floor(c_acctbal))) AS uint16, count(*) FILTER (WHERE NOT (c_acctbal BETWEEN -32768 AND 32767 AND c_acctbal = floor(c_acctbal))) AS int16,
       count(*) FILTER (WHERE NOT c_custkey BETWEEN 0 AND 4294967295) AS uint32 FROM customer""",
    "null_violations": """
SELECT count(*) FILTER (WHERE d.doc_id IS NULL) AS doc_id, count(*) FILTER (WHERE quality IS NULL) AS quality, count(*) FILTER (WHERE toxic IS NULL) AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "event_filter_decode": """
SELECT event_id, event_id // 50 AS height, user_id, event_id * 1000003 AS amount, '0x' || lpad(lower(hex(user_id)), 40, '0') AS address
FROM events WHERE event_type = 'purchase' AND event_id // 50 <= (SELECT max(event_id) // 50 FROM events) - 10""",
    "flat_map_turns": "SELECT conv_id, turn, role FROM conversations",
    "dataset_range": "SELECT event_id, event_type, value FROM events WHERE event_id // 50 BETWEEN 3 AND 11",
    "stream_equals_batch": "SELECT event_id, user_id, event_type, value FROM events",
}
