"""A log of numbered commits: each is a small JSON file that comes into being whole, and only if its number is free.

A commit holds the whole state of a table (which folders it consists of, how far its keys have got), so only the newest one is
read. Data is written to folders of its own first and becomes visible with the commit that names it; what a failed or beaten
attempt has written is never named. Two writers cannot take one number: the second one finds it taken and starts again
from the newer state.
"""

from __future__ import annotations

import json
import os
import uuid
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

ATTEMPTS = 20


class Conflict(Exception):
    """Another writer has taken the number."""


class Files:
    """The few operations on folders that Spark itself does not offer, on any store that the session reaches."""

    def __init__(self, spark: SparkSession, folder: str):
        context = spark.sparkContext
        self.hadoop = context._jvm.org.apache.hadoop.fs
        self.java = context._jvm.java
        self.conf = context._jsc.hadoopConfiguration()
        self.folder = folder
        self.system = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.hadoop.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self) -> list[str]:
        top = self.path("")
        return sorted(s.getPath().getName() for s in self.system.listStatus(top)) if self.system.exists(top) else []

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.system.create(self.path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def put_if_absent(self, name: str, text: str) -> None:
        """Write beside and move into place; raises ``Conflict`` if there is such a file.

        The move must be atomic and must not replace: a link on a local disk, a rename on HDFS. Stores without either need a lock around loads.
        """
        beside = f".{name}.{uuid.uuid4().hex}"
        self.write(beside, text)
        source, target = self.path(beside), self.path(name)
        try:
            if self.system.getUri().getScheme() == "file":
                plain = [p.toUri().getPath() for p in (source, target)]
                try:
                    os.link(*plain)
                except FileExistsError:
                    raise Conflict(name) from None
                return
            if self.system.exists(target) or not self.system.rename(source, target):
                raise Conflict(name)
        finally:
            self.system.delete(source, False)

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)


class CommitLog:
    """The commits in a folder, numbered from 1."""

    def __init__(self, spark: SparkSession, folder: str):
        self.files = Files(spark, folder)

    def latest(self) -> tuple[int, dict[str, Any]]:
        """The newest commit's number and state; 0 and nothing before the first."""
        numbers = [int(n.removesuffix(".json")) for n in self.files.names() if n.endswith(".json") and not n.startswith(".")]
        if not numbers:
            return 0, {}
        return max(numbers), json.loads(self.files.read(self._name(max(numbers))))

    def commit(self, number: int, state: dict[str, Any]) -> None:
        self.files.put_if_absent(self._name(number), json.dumps(state, sort_keys=True))

    @staticmethod
    def _name(number: int) -> str:
        return f"{number:020d}.json"


def read_folders(spark: SparkSession, base: str, folders: list[str]) -> DataFrame | None:
    """One table out of the named folders below ``base``; None if there are none."""
    if not folders:
        return None
    return spark.read.option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])


def publish(spark: SparkSession, store_dir: str, table: str, rows: int) -> int:
    """Give the table that a stage has just written its next version number; returns it.

    The number says that the folder below ``store_dir`` holds a new state of the whole table, so that a load replaces what it has of it.
    """
    log = CommitLog(spark, f"{store_dir}/_versions/{table}")
    for _ in range(ATTEMPTS):
        number, _ = log.latest()
        try:
            log.commit(number + 1, {"rows": rows})
            return number + 1
        except Conflict:
            continue
    raise Conflict(f"{table}: no free version after {ATTEMPTS} attempts")


def published_version(spark: SparkSession, store_dir: str, table: str) -> int:
    """The version of a published table; 0 for one that no stage has published."""
    try:
        return CommitLog(spark, f"{store_dir}/_versions/{table}").latest()[0]
    except AnalysisException:
        return 0
