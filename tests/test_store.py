import json
import os

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from chunksink.functions import types as t
from chunksink.operators.database import Database
from chunksink.operators.tables import Column, CsvTable, JsonTable, ParquetTable
from chunksink.sources.dataset import committed, read_chunks
from chunksink.sources.dest import Dest, create_dest, s3_settings
from chunksink.streaming.state import Head, JsonState

SCHEMA = {"id": Column(t.Int64()), "name": Column(t.String(), nullable=True)}


@pytest.fixture
def tables():
    return {"pq": ParquetTable("rows.parquet", SCHEMA), "csv": CsvTable("rows.csv", {"id": Column(t.Numeric()), "name": Column(t.String(), nullable=True)}), "js": JsonTable("rows.json"), "jl": JsonTable("rows.jsonl", lines=True)}


def rows(spark, n, per=2):
    return spark.range(n).select("id", F.concat(F.lit("n"), "id").alias("name"), F.expr(f"id div {per} as height"))


def read(path, *parts):
    with open(os.path.join(path, *parts), newline="", encoding="utf-8") as f:
        return f.read()


def ids(db, alias="pq"):
    return sorted(int(r.id) for r in read_chunks(db.dest, db.tables[alias]).collect())


ROUTES = {a: (lambda d: d.select("id", "name", "height")) for a in ("pq", "csv", "js", "jl")}


def test_batches_to_chunks_in_every_format(spark, tmp_path, tables):
    db = Database(create_dest(spark, str(tmp_path)), tables, 20)
    assert db.connect() == Head(-1, "0x")
    forced = spark.createDataFrame([(1, True), (4, True)], "height long, forced boolean")
    df = rows(spark, 12)
    routes = ROUTES | {"js": lambda d: d.where("id > 7").select("id", "height"), "jl": lambda d: d.where("id < 4").select("id", "height")}
    state = db.run_batches(df, routes, forced=forced, order=["id"])
    assert state.height == 4
    assert sorted(n for n in os.listdir(tmp_path) if n[0] != ".") == ["0000000000-0000000001", "0000000002-0000000004", "status.txt"]
    first, second = "0000000000-0000000001", "0000000002-0000000004"
    assert read(tmp_path, first, "rows.csv") == "id,name\r\n0,n0\r\n1,n1\r\n2,n2\r\n3,n3\r\n"
    assert read(tmp_path, second, "rows.csv").startswith("id,name\r\n4,n4\r\n")
    assert read(tmp_path, first, "rows.json") == "[]"
    assert json.loads(read(tmp_path, second, "rows.json")) == [{"id": 8, "height": 4}, {"id": 9, "height": 4}]
    assert read(tmp_path, first, "rows.jsonl") == "\n".join(f'{{"id":{i},"height":{i // 2}}}' for i in range(4))
    assert read(tmp_path, second, "rows.jsonl") == ""
    found = pq.read_table(os.path.join(tmp_path, second, "rows.parquet"))
    assert found["id"].to_pylist() == [4, 5, 6, 7, 8, 9]
    assert duckdb.sql(f"select count(*) from read_parquet('{tmp_path}/*/rows.parquet')").fetchall() == [(10,)]
    assert ids(db) == list(range(10)) and ids(db, "csv") == list(range(10))
    # The rest comes with the next run, from the state on.
    forced = spark.createDataFrame([(5, True)], "height long, forced boolean")
    assert db.run_batches(df, ROUTES, forced=forced, order=["id"]).height == 5
    assert ids(db) == list(range(12))
    assert ids(db) == sorted(set(ids(db)))
    assert [x[:2] for x in committed(db.dest)] == [(0, 1), (2, 4), (5, 5)]
    assert sorted(r.id for r in read_chunks(db.dest, tables["pq"], 5, 9).collect()) == [10, 11]
    assert not any(n.startswith("_work") for n in os.listdir(tmp_path))


def test_size_cuts_chunks_after_the_batch(spark, tmp_path):
    db = Database(create_dest(spark, str(tmp_path)), {"pq": ParquetTable("p", {"id": Column(t.Int64())})}, 40 / 1024 / 1024)
    db.connect()
    assert db.run_batches(rows(spark, 13), {"pq": lambda d: d}, order=["id"]).height == 5
    assert [x[:2] for x in committed(db.dest)] == [(0, 2), (3, 5)]
    assert ids(db) == list(range(12))


def test_transact(spark, tmp_path, tables):
    db = Database(create_dest(spark, str(tmp_path)), tables)
    db.connect()
    frame = lambda *x: spark.createDataFrame([(i, None) for i in x], "id long, name string")
    db.transact(Head(3, "0xa"), lambda b: b.pq.write(frame(1, 2)).write(frame(3)))
    assert committed(db.dest) == [] and db.state.height == -1
    kept = []

    def body(b):
        b.set_force_flush(False)
        b.pq.write_many(frame(4))
        b.csv.write(frame(4))
        b.set_force_flush(True)
        kept.append(b)

    db.transact(Head(5, "0xb"), body)
    assert [x[:2] for x in committed(db.dest)] == [(0, 5)] and db.state == Head(5, "0xb")
    assert read(tmp_path, "status.txt") == "5\n0xb"
    assert [r.id for r in read_chunks(db.dest, tables["pq"]).collect()] == [1, 2, 3, 4]
    assert read(tmp_path, "0000000000-0000000005", "rows.csv") == "id,name\r\n4,\r\n"
    with pytest.raises(RuntimeError, match="too late"):
        kept[0].pq
    with pytest.raises(RuntimeError, match="too late"):
        kept[0].set_force_flush(True)
    with pytest.raises(ValueError, match="does not follow"):
        db.transact(Head(5, "0xc"), lambda b: None)
    with pytest.raises(ValueError, match="hash"):
        db.transact(Head(6, "0xb"), lambda b: None)
    # A callback that fails leaves nothing behind.
    with pytest.raises(ZeroDivisionError):
        db.transact(Head(7, "0xd"), lambda b: (b.pq.write(frame(9)), 1 / 0))
    db.transact(Head(7, "0xd"), lambda b: b.set_force_flush(True))
    assert db.state == Head(7, "0xd") and [x[:2] for x in committed(db.dest)] == [(0, 5)]
    db.transact(Head(8, "0xe"), lambda b: (b.js.write(frame(5)), b.set_force_flush(True)))
    assert [x[:2] for x in committed(db.dest)] == [(0, 5), (8, 8)]
    assert ids(db) == [1, 2, 3, 4]


@pytest.mark.parametrize("fail", ["write", "rename", "state"])
def test_crashes_lose_and_repeat_nothing(spark, tmp_path, fail, monkeypatch):
    made = {"pq": ParquetTable("rows.parquet", SCHEMA)}
    db = Database(create_dest(spark, str(tmp_path)), made)
    db.connect()
    forced = lambda *h: spark.createDataFrame([(x, True) for x in h], "height long, forced boolean")
    db.run_batches(rows(spark, 4), {"pq": lambda d: d}, forced=forced(1), order=["id"])

    def broken(*a, **k):
        raise OSError("crash")

    broke = Database(create_dest(spark, str(tmp_path)), made, threads=1)
    broke.connect()
    if fail == "write":
        monkeypatch.setattr(ParquetTable, "write", broken)
    elif fail == "rename":
        real, calls = broke.dest.rename, []

        def rename(a, b):
            calls.append(a)
            if len(calls) == 4:
                raise OSError("crash")
            real(a, b)

        broke.dest.rename = rename
    else:
        broke._advance = broken
    with pytest.raises(OSError, match="crash"):
        broke.run_batches(rows(spark, 12), {"pq": lambda d: d}, forced=forced(3, 5), order=["id"])
    monkeypatch.undo()
    os.makedirs(tmp_path / "0000000009-0000000010-temp-123", exist_ok=True)
    again = Database(create_dest(spark, str(tmp_path)), made)
    assert again.connect().height == 1
    assert ids(again) == [0, 1, 2, 3]
    assert sorted(n for n in os.listdir(tmp_path) if n[0] != "." and n != "status.txt") == ["0000000000-0000000001"]
    again.run_batches(rows(spark, 12), {"pq": lambda d: d}, forced=forced(3, 5), order=["id"])
    assert ids(again) == list(range(12))


def test_another_writer_is_noticed(spark, tmp_path, tables):
    a = Database(create_dest(spark, str(tmp_path)), tables)
    a.connect()
    a.hooks.on_state_update(a.dest, Head(4, "0xz"), a.state)
    with pytest.raises(RuntimeError, match="another writer"):
        a.transact(Head(5, "0x1"), lambda b: None)
    with pytest.raises(RuntimeError, match="another writer"):
        a.run_batches(rows(spark, 2), ROUTES)


def test_stream_resumes_with_its_open_chunk(spark, tmp_path):
    source, store, log = (str(tmp_path / x) for x in ("in", "store", "log"))
    made = {"pq": ParquetTable("rows.parquet", SCHEMA)}
    put = lambda a, b: rows(spark, b).where(f"id >= {a}").coalesce(1).write.mode("append").parquet(source)

    def run(force):
        db = Database(create_dest(spark, store), made)
        stream = spark.readStream.schema("id long, name string, height long").option("maxFilesPerTrigger", 1).parquet(source)
        db.run_stream(stream, lambda df, b: (b.pq.write(df.orderBy("id")), b.set_force_flush(force)), log).awaitTermination()
        return db

    put(0, 4)
    db = run(False)
    assert committed(db.dest) == [] and db.head.height == 1
    put(4, 8)
    db = run(True)
    assert [x[:2] for x in committed(db.dest)] == [(0, 3)] and ids(db) == list(range(8))
    db = run(True)
    assert ids(db) == list(range(8))


def test_json_state_and_settings(spark, tmp_path, tables):
    db = Database(create_dest(spark, str(tmp_path)), tables, hooks=JsonState())
    db.connect()
    db.transact(Head(0, "0x1"), lambda b: b.set_force_flush(True))
    assert json.loads(read(tmp_path, "status.json")) == {"height": 0, "hash": "0x1", "previous": {"height": -1, "hash": "0x"}}
    assert Database(db.dest, tables, hooks=JsonState()).connect() == Head(0, "0x1")
    with pytest.raises(ValueError, match="alias"):
        Database(db.dest, {"set_force_flush": tables["pq"]})
    with pytest.raises(ValueError, match="same file name"):
        Database(db.dest, {"a": tables["pq"], "b": tables["pq"]})
    with pytest.raises(ValueError, match="positive"):
        Database(db.dest, tables, 0)
    with pytest.warns(DeprecationWarning):
        Database(db.dest, tables, sync_interval_blocks=5)
    assert s3_settings("eu", "http://x", "k", "s")["spark.hadoop.fs.s3a.endpoint"] == "http://x"
    with pytest.raises(ValueError, match="no file system"):
        create_dest(spark, "nosuch://bucket/x")


def test_dest(spark, tmp_path):
    d = create_dest(spark, str(tmp_path))
    assert d.readdir("missing") == [] and not d.exists("a")
    d.write_file("a/b/c.txt", "é")
    assert d.read_file("a/b/c.txt") == "é" and d.exists("a/") and d.exists("a/b/c.txt") and not d.exists("a/b/c.txt/")
    assert d.path("a", "../x", "./y") == f"file://{tmp_path}/x/y"
    with d.transact("a/b") as temp:
        d.write_file(f"{temp}/new", "1")
    assert [n for n in d.readdir("a/b") if n[0] != "."] == ["new"]
    with pytest.raises(KeyError), d.transact("a/b") as temp:
        d.write_file(f"{temp}/other", "1")
        raise KeyError
    assert d.readdir("a") == ["b"]
    d.rm("a")
    d.rm("a")
    assert not d.exists("a")


def test_column_codecs(spark, tmp_path):
    schema = {"id": Column(t.Int64(), compression="GZIP"), "tags": Column(t.List(t.String()), compression="ZSTD"), "name": Column(t.String(), nullable=True)}
    db = Database(create_dest(spark, str(tmp_path)), {"pq": ParquetTable("rows.parquet", schema)})
    db.connect()
    df = rows(spark, 6).withColumn("tags", F.array("name"))
    db.run_batches(df, {"pq": lambda d: d}, forced=spark.createDataFrame([(0, True), (2, True)], "height long, forced boolean"), order=["id"])
    meta = pq.ParquetFile(tmp_path / "0000000001-0000000002" / "rows.parquet").metadata.row_group(0)
    assert [meta.column(i).compression for i in range(3)] == ["GZIP", "ZSTD", "UNCOMPRESSED"]
    assert ids(db) == list(range(6))


class Counting(Dest):
    """Counts the calls that a store would be asked."""

    def __init__(self, spark, root):
        super().__init__(spark, root)
        self.calls = {"readdir": 0, "files": 0, "rename": 0}

    def readdir(self, path=""):
        self.calls["readdir"] += 1
        return super().readdir(path)

    def files(self, path=""):
        self.calls["files"] += 1
        return super().files(path)

    def rename(self, source, target):
        self.calls["rename"] += 1
        return super().rename(source, target)


@pytest.mark.parametrize("copies", [False, True])
def test_listings_do_not_grow_with_the_chunks(spark, tmp_path, copies):
    seen = []
    for n in (3, 12):
        dest = Counting(spark, f"file://{tmp_path}/{copies}-{n}")
        dest.copies = copies
        made = {a: ParquetTable(f"{a}.parquet", {"height": Column(t.Int64())}) for a in ("one", "two")}
        db = Database(dest, made)
        db.connect()
        rows = spark.range(n).select(F.col("id").alias("height"))
        dest.calls = dict.fromkeys(dest.calls, 0)
        db.run_batches(rows, {"one": lambda d: d, "two": lambda d: d.where("height > 0")}, forced=rows.withColumn("forced", F.lit(True)))
        assert sorted(r.height for r in read_chunks(db.dest, made["one"]).collect()) == list(range(n))
        assert sorted(r.height for r in read_chunks(db.dest, made["two"]).collect()) == list(range(1, n))
        seen.append(dict(dest.calls))
    assert seen[0]["files"] == seen[1]["files"]
    assert seen[1]["rename"] - seen[0]["rename"] == 9 * (2 if copies else 3)  # a file moves once; only a true rename swaps folders too


def test_listings_take_the_same_calls_for_many_files(spark, tmp_path, monkeypatch):
    client, asked = spark.sparkContext._gateway._gateway_client, []
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda *a, **k: asked.append(a) or send(*a, **k))
    calls = []
    for n in (2, 80):
        root = tmp_path / str(n)
        for i in range(n):
            (root / f"_chunk={i}").mkdir(parents=True)
            (root / f"_chunk={i}" / "part-0, a").write_text("")
        (root / "_SUCCESS").write_text("")
        dest = Dest(spark, f"file://{root}")
        asked.clear()
        assert dest.files() == {f"_chunk={i}": ["part-0, a"] for i in range(n)}
        assert dest.readdir() == sorted(["_SUCCESS", *(f"_chunk={i}" for i in range(n))])
        calls.append(len([a for a in asked if a[0].startswith("c\n")]))
    assert calls[0] == calls[1]
    (tmp_path / "none").mkdir()
    assert Dest(spark, f"file://{tmp_path}/none").files() == {} == Dest(spark, f"file://{tmp_path}/missing").files()
