"""Destinations: folders of any file system that Hadoop knows."""

from __future__ import annotations

import os
import posixpath
import time
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import SparkSession

TEMP = "-temp-"


#: Schemes of stores in which a rename copies.
OBJECT_STORES = ("s3a", "s3", "s3n", "gs", "abfs", "abfss", "wasb", "wasbs", "oss", "cosn", "obs")


class Dest:
    """A root folder with small driver-side file operations; relative paths are below the root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/") or "/"
        jvm = spark.sparkContext._jvm
        self._path_of = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path_of(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._jvm = jvm
        self.copies = (urlparse(self.root).scheme or "file") in OBJECT_STORES

    def path(self, *parts: str) -> str:
        joined = posixpath.normpath(posixpath.join("/", *parts)).lstrip("/")
        return f"{self.root}/{joined}" if joined else self.root

    def _at(self, *parts: str):
        return self._path_of(self.path(*parts))

    def exists(self, path: str) -> bool:
        found = self._at(path)
        if not self._fs.exists(found):
            return False
        return not path.endswith("/") or self._fs.getFileStatus(found).isDirectory()

    def read_file(self, path: str) -> str:
        stream = self._fs.open(self._at(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def write_file(self, path: str, content: str | bytes) -> None:
        """Write whole, creating parent folders."""
        stream = self._fs.create(self._at(path), True)
        try:
            stream.write(bytearray(content.encode("utf-8") if isinstance(content, str) else content))
        finally:
            stream.close()

    def readdir(self, path: str = "") -> list[str]:
        """Sorted names; a missing folder is empty."""
        at = self._at(path)
        return sorted(self._below(self._paths(at))) if self._fs.exists(at) else []

    def files(self, path: str = "") -> dict[str, list[str]]:
        """Names in the folders of ``path`` by folder: a few calls for all, as one for each name would take long.

        An object store lists all below a prefix at once, so there one recursive listing is less.
        """
        at, out = self._at(path), {}
        if not self._fs.exists(at):
            return out
        if self.copies:
            found = self._fs.listFiles(at, True)
            while found.hasNext():
                whole = found.next().getPath()
                out.setdefault(whole.getParent().getName(), []).append(whole.getName())
        else:
            folders = self._paths(at)
            for below in self._below(self._paths(folders), folders) if len(folders) else []:
                folder, _, name = below.partition("/")
                if name:
                    out.setdefault(folder, []).append(name)
        return out

    def _paths(self, at):
        """What a folder, or each of an array of folders, holds: an array of paths; a file stands for itself."""
        return self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(self._fs.listStatus(at))

    def _below(self, paths, beside=None) -> list[str]:
        """What paths have below the folder of ``beside`` (their own, if not given), from one text of all."""
        if not len(paths):
            return []
        above = (beside or paths)[0].toString().rsplit("/", 1)[0] + "/"
        whole = self._jvm.org.apache.commons.lang3.ArrayUtils.toString(paths)[1:-1]
        return whole.removeprefix(above).split("," + above)  # no name holds a slash

    def mkdir(self, path: str) -> None:
        self._fs.mkdirs(self._at(path))

    def rm(self, path: str) -> None:
        self._fs.delete(self._at(path), True)

    def rename(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._at(target).getParent())
        if not self._fs.rename(self._at(source), self._at(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def copy(self, source: str, target: str) -> None:
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        self._jvm.org.apache.hadoop.fs.FileUtil.copy(self._fs, self._at(source), self._fs, self._at(target), False, True, conf)

    @contextmanager
    def transact(self, folder: str) -> Iterator[str]:
        """A sibling folder that replaces ``folder`` when the block ends well, and goes when it fails.

        In an object store, which renames by copying, it is ``folder`` itself: nothing
        reads a chunk before the state is past it, and recovery removes what a crash left.
        """
        if self.copies:
            self.rm(folder)
            try:
                yield folder
            except BaseException:
                self.rm(folder)
                raise
            return
        temp = f"{folder.rstrip('/')}{TEMP}{time.time_ns() // 1_000_000}"
        self.mkdir(temp)
        try:
            yield temp
            self.rm(folder)
            self.rename(temp, folder)
        except BaseException:
            self.rm(temp)
            raise


def create_dest(spark: SparkSession, target: str) -> Dest:
    """A destination for a local path or a URL of a scheme that Hadoop can resolve."""
    if "://" not in target and not target.startswith("file:"):
        return Dest(spark, f"file://{os.path.abspath(target)}")
    scheme = urlparse(target).scheme
    if scheme == "s3":
        target = "s3a" + target[2:]
    try:
        return Dest(spark, target)
    except Exception as e:
        raise ValueError(f"no file system for {scheme!r}: {target}") from e


def s3_settings(region: str | None = None, endpoint: str | None = None, access_key: str | None = None, secret_key: str | None = None, session_token: str | None = None) -> dict[str, str]:
    """Spark settings for an S3-compatible store; missing values come from the usual environment variables."""
    env = os.environ.get
    values = {
        "fs.s3a.endpoint.region": region or env("AWS_REGION") or env("AWS_DEFAULT_REGION"),
        "fs.s3a.endpoint": endpoint or env("AWS_S3_ENDPOINT") or env("AWS_ENDPOINT_URL"),
        "fs.s3a.access.key": access_key or env("AWS_ACCESS_KEY_ID"),
        "fs.s3a.secret.key": secret_key or env("AWS_SECRET_ACCESS_KEY"),
        "fs.s3a.session.token": session_token or env("AWS_SESSION_TOKEN"),
    }
    return {f"spark.hadoop.{k}": v for k, v in values.items() if v}
