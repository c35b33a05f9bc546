"""Folders that the driver and all executors share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunksink.sources.dest import Dest
from chunksink.sources.shared import shared_dir


_open: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Folders that ``cut`` writes inside the block go when it ends, but for those to ``keep``."""
    own: list[str] = []
    token = _open.set((*_open.get(), own))
    try:
        yield
    finally:
        _open.reset(token)
        for path in own:
            Dest(spark, path).rm("")


def cut(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written to a shared folder and read again: short lineage that outlives executors.

    With ``keep`` the folder outlives the innermost ``temporary`` block.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    blocks = _open.get()[: -1 if keep else None]
    if blocks:
        blocks[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def cut_apart(df: DataFrame, name: str, flag: str) -> tuple[DataFrame, DataFrame, Callable[[], None]]:
    """As ``cut``, but rows whose boolean ``flag`` is false and those where it is true lie apart; and a call that removes the latter."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    if _open.get():
        _open.get()[-1].append(path)
    before = spark.conf.get(_WRITERS, "0")
    spark.conf.set(_WRITERS, "2")  # two files at once, so that no task has to sort its rows
    try:
        df.write.partitionBy(flag).parquet(path)
    finally:
        spark.conf.set(_WRITERS, before)
    dest, schema = Dest(spark, path), df.drop(flag).schema
    for value in ("false", "true"):
        dest.mkdir(f"{flag}={value}")  # none is missing
    no, yes = (spark.read.schema(schema).parquet(dest.path(f"{flag}={v}")) for v in ("false", "true"))
    return no, yes, lambda: dest.rm(f"{flag}=true")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of our own: those given, with underscores before them as long as ``df`` has one of that name."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


#: Rows, or list elements, up to which a side of a join is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 400_000


def small(df: DataFrame, bound: int = BROADCAST_ROWS, lists: str | None = None) -> DataFrame:
    """``df``, which should be written already, marked for broadcast if its rows, or the elements of ``lists``, are within ``bound``."""
    held = df.agg(F.sum(F.greatest(F.size(lists), F.lit(1)) if lists else F.lit(1)).alias("n")).first()["n"] or 0
    return F.broadcast(df) if held <= bound else df.hint("shuffle_hash")


#: A key with more than one of so many rows is hot, so there are no more hot keys than that.
HOT_SHARE = 1000
WAYS = 64


def hot_keys(one: DataFrame, keys: list[str], count: str) -> DataFrame | None:
    """The keys of ``one`` (a row each, with its ``count``; written already) that hold over one in ``HOT_SHARE`` of the rows; None if none does."""
    total = one.agg(F.sum(count).alias("n")).first()["n"] or 0
    hot = one.where(F.col(count) * HOT_SHARE > total).select(*keys)
    return None if hot.isEmpty() else hot


def split_join(many: DataFrame, one: DataFrame, keys: list[str], hot: DataFrame | None, spread: list[str]) -> DataFrame:
    """``many`` joined with ``one``, which has one row a key; the rows of ``hot`` keys (``HOT_SHARE`` at most) go to ``WAYS`` tasks each, by ``spread``."""
    if hot is None:
        return many.join(one, keys)
    (part,) = unused(many, "part")
    flag = F.broadcast(hot.withColumn(part, F.lit(True)))
    many = many.join(flag, keys, "left").withColumn(part, F.when(F.col(part), F.pmod(F.xxhash64(*spread), F.lit(WAYS)).cast("int")).otherwise(0))
    each = F.when(F.col(part), F.sequence(F.lit(0), F.lit(WAYS - 1))).otherwise(F.array(F.lit(0)))
    return many.join(one.join(flag, keys, "left").withColumn(part, F.explode(each)), [*keys, part]).drop(part)


__all__ = ["BROADCAST_ROWS", "cut", "cut_apart", "hot_keys", "shared_dir", "small", "split_join", "temporary", "unused"]
