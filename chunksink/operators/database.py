"""The store: batches in, chunks out, resumable after any failure.

Data come first and the state second: a crash in between leaves chunks that
start above the recorded height, which ``connect`` removes. One writer at a time
is required; another writer is noticed by its state, not locked out.
"""

from __future__ import annotations

import re
import uuid
import warnings
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunksink.operators.tables import CHUNK, ORDER, Table, check_tables
from chunksink.plans.chunk_plan import MB, batch_sizes, chunk_plan, folder_name
from chunksink.sources.dataset import FOLDER
from chunksink.sources.dest import TEMP, Dest
from chunksink.streaming.state import Head, StateHooks, TextState

STAGING, WORK = "_staging", "_work-"
_STAGED = re.compile(r"batch-(\d+)-(\d+)-(forced|open)")


class TableHandle:
    """What a batch callback writes rows to."""

    def __init__(self, batch: Batch) -> None:
        self._batch = batch
        self.frames: list[DataFrame] = []

    def write(self, df: DataFrame) -> TableHandle:
        self._batch._check_open()
        self.frames.append(df)
        return self

    def write_many(self, *frames: DataFrame) -> TableHandle:
        for f in frames:
            self.write(f)
        return self


class Batch:
    """One batch: a handle for each alias, and the force flag; it closes when the callback returns."""

    def __init__(self, aliases: list[str]) -> None:
        self._open, self.forced = True, False
        self.tables = {a: TableHandle(self) for a in aliases}

    def __getattr__(self, alias: str) -> TableHandle:
        tables = self.__dict__.get("tables", {})
        if alias not in tables:
            raise AttributeError(alias)
        self._check_open()
        return tables[alias]

    def set_force_flush(self, value: bool) -> None:
        self._check_open()
        self.forced = value

    def _check_open(self) -> None:
        if not self._open:
            raise RuntimeError("the batch is over, too late to write")


class Database:
    """Tables by alias, written to ``dest`` in chunks of about ``chunk_size_mb``."""

    def __init__(self, dest: Dest, tables: dict[str, Table], chunk_size_mb: float = 20, hooks: StateHooks | None = None, sync_interval_blocks: int | None = None, threads: int = 16) -> None:
        check_tables(tables)
        if chunk_size_mb <= 0:
            raise ValueError("chunk_size_mb must be positive")
        if sync_interval_blocks is not None:
            warnings.warn("sync_interval_blocks has no effect; use set_force_flush", DeprecationWarning, stacklevel=2)
        self.dest, self.tables, self.hooks, self.threads = dest, tables, hooks or TextState(), threads
        self.limit = int(chunk_size_mb * MB)
        self.spark = dest.spark
        self.state: Head | None = None
        self.head = Head()
        self._pending: list[tuple[str, int]] = []

    # Recovery

    def connect(self, keep_staged: bool = False) -> Head:
        """Read or create the state and remove what a crash left behind.

        Batches that no chunk holds yet go too, as a source replays them from the
        state on; a stream, whose offsets are past them, keeps them.
        """
        state = self.hooks.on_state_read(self.dest)
        if state is None:
            state = Head()
            self.hooks.on_state_update(self.dest, state, state)
        if state.height < -1:
            raise ValueError(f"{state.height} is not a height")
        gone = [n for n in self.dest.readdir() if TEMP in n or n.startswith(WORK) or ((m := FOLDER.fullmatch(n)) and int(m[1]) > state.height)]
        with ThreadPoolExecutor(self.threads) as pool:
            list(pool.map(self.dest.rm, gone))
        self.state = self.head = state
        self._pending = []
        forced = False
        for name in self.dest.readdir(STAGING):
            m = _STAGED.fullmatch(name)
            if not keep_staged or not m or int(m[1]) <= state.height:
                self.dest.rm(f"{STAGING}/{name}")
                continue
            self._pending.append((name, int(m[2])))
            self.head = Head(int(m[1]), self.dest.read_file(f"{STAGING}/{name}/hash"))
            forced |= m[3] == "forced"
        total = sum(n for _, n in self._pending)
        if forced or total >= self.limit:
            self._flush(self.head, total)
        return self.state

    def _require_state(self) -> Head:
        if self.state is None:
            self.connect()
        found = self.hooks.on_state_read(self.dest)
        if found != self.state:
            raise RuntimeError(f"another writer has moved the state from {self.state} to {found}")
        return self.state

    def _advance(self, state: Head) -> None:
        self.hooks.on_state_update(self.dest, state, self.state or Head())
        self.state = state

    # Many batches at once

    def run_batches(self, df: DataFrame, routes: dict[str, Callable[[DataFrame], DataFrame]], height: str = "height", forced: DataFrame | None = None, order: list[str] | None = None, hashes: DataFrame | None = None) -> Head:
        """Write all rows above the state, batch by batch of equal ``height``, in one job a table.

        ``routes`` maps aliases to functions that make a table's rows and keep
        the height column. ``forced`` (height, forced) ends chunks; ``order``
        sorts the rows of a height. Heights after the last flush stay unwritten,
        as a source replays them. ``hashes`` (height, hash) gives block hashes.
        """
        state = self._require_state()
        df = df.where(F.col(height) > state.height)
        made: dict[str, DataFrame] = {}
        for alias, route in routes.items():
            rows = route(df)
            keys = [c for c in order or [] if c in rows.columns]
            place = F.struct(F.col(height).cast("long").alias("height"), *(F.col(k) for k in keys))
            rows = rows.withColumn(ORDER, place).withColumn("_height", F.col(height).cast("long"))
            if height not in getattr(self.tables[alias], "schema", {height: None}):
                rows = rows.drop(height)
            made[alias] = self.tables[alias].render(rows, ("_height", ORDER))
        sized = [rows.select(F.col("_height").alias("height"), self.tables[a].size().alias("bytes")).groupBy("height").agg(F.sum("bytes").alias("bytes")) for a, rows in made.items()]
        if forced is not None:
            forced = forced.where(F.col("height") > state.height)
        sizes = batch_sizes(sized, forced)
        work = f"{WORK}{uuid.uuid4().hex}"
        chunk_plan(sizes, self.limit, state.height).write.parquet(self.dest.path(work, "plan"))
        plan = self.spark.read.parquet(self.dest.path(work, "plan"))
        last = plan.agg(F.max("chunk_to")).first()[0]
        if last is None:
            self.dest.rm(work)
            return state
        written = plan.where("chunk_bytes > 0").select(F.col("height").alias("_height"), folder_name(F.col("chunk_from"), F.col("chunk_to")).alias(CHUNK))
        folders = written.select(CHUNK).distinct()
        names = sorted(r[0] for r in folders.collect())  # one name a chunk
        self._write(made, lambda rows: rows.join(written, "_height").drop("_height"), folders, names, work)
        hash_ = hashes.where(F.col("height") == last).first() if hashes is not None else None
        self._advance(Head(last, hash_["hash"] if hash_ else f"0x{last:x}"))
        self.head = self.state
        self.dest.rm(work)
        return self.state

    def _write(self, made: dict[str, DataFrame], place: Callable[[DataFrame], DataFrame], folders: DataFrame, names: list[str], work: str) -> None:
        """Write every table, then move the files of each chunk into its folder."""
        for alias, rows in made.items():
            self.tables[alias].write(place(rows), folders, self.dest.path(work, "out", alias))
        found = {alias: self._parts(work, alias) for alias in self.tables}  # one listing a table
        for alias in self.tables:
            if any(n not in found[alias] for n in names):
                self._write_empty(alias, work)
                found[alias] |= {"empty": self._parts(work, alias)["empty"]}

        def commit(name: str) -> None:
            with self.dest.transact(name) as temp:
                for alias, table in self.tables.items():
                    parts = found[alias].get(name, [])
                    if len(parts) > 1:
                        raise RuntimeError(f"{len(parts)} files for {table.name} in {name}")
                    if parts:
                        self.dest.rename(parts[0], f"{temp}/{table.name}")
                    else:
                        self.dest.copy(found[alias]["empty"][0], f"{temp}/{table.name}")

        with ThreadPoolExecutor(self.threads) as pool:
            list(pool.map(commit, names))

    def _parts(self, work: str, alias: str) -> dict[str, list[str]]:
        """Paths of the written files of a table by chunk."""
        base = f"{work}/out/{alias}"
        all_ = self.dest.files(base)
        kept = {folder: [n for n in names if n.startswith("part-")] for folder, names in all_.items()}
        return {folder.split("=", 1)[1]: [f"{base}/{folder}/{n}" for n in names] for folder, names in kept.items() if "=" in folder and names}

    def _write_empty(self, alias: str, work: str) -> None:
        """A file of ``alias`` without rows, for chunks in which the table has none."""
        table, folder = self.tables[alias], f"{work}/out/{alias}/{CHUNK}=empty"
        if "empty" in self._parts(work, alias):
            return
        schema = getattr(table, "schema", None)
        if schema is not None and hasattr(table, "compression"):
            fields = ", ".join(f"`{n}` {c.type.spark.simpleString()}" for n, c in schema.items())
            self.spark.createDataFrame([], fields).coalesce(1).write.parquet(self.dest.path(work, "empty", alias))
            part = next(n for n in self.dest.readdir(f"{work}/empty/{alias}") if n.startswith("part-"))
            self.dest.rename(f"{work}/empty/{alias}/{part}", f"{folder}/{part}")
        elif schema is not None:
            head = self.spark.range(1).select(table.header_line()).first()[0] + table.dialect.terminator if table.header else ""
            self.dest.write_file(f"{folder}/part-0", head)
        else:
            self.dest.write_file(f"{folder}/part-0", "" if table.lines else "[]")

    # One batch after the other

    def transact(self, head: Head, body: Callable[[Batch], None]) -> Head:
        """One batch up to ``head``. Its rows count only if ``body`` returns."""
        self._require_state()
        if head.height <= self.head.height:
            raise ValueError(f"height {head.height} does not follow {self.head.height}")
        if head.hash == self.head.hash:
            raise ValueError(f"hash {head.hash} is that of the batch before")
        batch = Batch(list(self.tables))
        try:
            body(batch)
        finally:
            batch._open = False
        self._stage(head, batch)
        self.head = head
        total = sum(n for _, n in self._pending)
        if batch.forced or total >= self.limit:
            self._flush(head, total)
        return self.state

    def _stage(self, head: Head, batch: Batch) -> None:
        """Rows of a batch, kept in the destination until their chunk is written."""
        temp, total = f"{STAGING}/writing-{uuid.uuid4().hex}", 0
        for alias, handle in batch.tables.items():
            for k, df in enumerate(handle.frames):
                rows = self.tables[alias].render(df.withColumn(ORDER, F.monotonically_increasing_id()), (ORDER,))
                path = self.dest.path(temp, alias, str(k))
                rows.write.parquet(path)
                total += self.spark.read.schema(rows.schema).parquet(path).agg(F.sum(self.tables[alias].size())).first()[0] or 0
        self.dest.write_file(f"{temp}/hash", head.hash)
        name = f"batch-{head.height:020d}-{total}-{'forced' if batch.forced else 'open'}"
        self.dest.rm(f"{STAGING}/{name}")
        self.dest.rename(temp, f"{STAGING}/{name}")
        self._pending.append((name, total))

    def _flush(self, head: Head, total: int) -> None:
        state = self.state or Head()
        if total > 0:
            name = self.spark.range(1).select(folder_name(F.lit(state.height + 1), F.lit(head.height))).first()[0]
            made: dict[str, DataFrame] = {}
            for alias in self.tables:
                parts: list[DataFrame] = []
                for n, (staged, _) in enumerate(self._pending):
                    for k in self.dest.readdir(f"{STAGING}/{staged}/{alias}"):
                        at: Column = F.struct(F.lit(n).alias("batch"), F.lit(int(k)).alias("frame"), F.col(ORDER).alias("row"))
                        parts.append(self.spark.read.parquet(self.dest.path(STAGING, staged, alias, k)).withColumn(ORDER, at))
                for p in parts:
                    made[alias] = made[alias].unionByName(p) if alias in made else p
            work = f"{WORK}{uuid.uuid4().hex}"
            self._write(made, lambda rows: rows.withColumn(CHUNK, F.lit(name)), self.spark.createDataFrame([(name,)], f"{CHUNK} string"), [name], work)
            self.dest.rm(work)
        self._advance(head)
        for staged, _ in self._pending:
            self.dest.rm(f"{STAGING}/{staged}")
        self._pending = []

    # Streams

    def run_stream(self, stream: DataFrame, body: Callable[[DataFrame, Batch], None], checkpoint: str, height: str = "height", **trigger):
        """Start a stream whose micro-batches are batches; heights must rise and not be split.

        A micro-batch that Spark repeats after a failure is skipped if it was
        staged before, so chunks hold each row once.
        """
        self.connect(keep_staged=True)

        def one(df: DataFrame, number: int) -> None:
            df = df.persist()
            try:
                row = df.agg(F.min(height), F.max(height)).first()
                if row[0] is None or row[1] <= self.head.height:
                    return
                if row[0] <= self.head.height:
                    raise ValueError(f"heights {row[0]} to {row[1]} overlap the batch that ended at {self.head.height}")
                self.transact(Head(int(row[1]), f"0x{int(row[1]):x}"), lambda batch: body(df, batch))
            finally:
                df.unpersist()

        writer = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()
