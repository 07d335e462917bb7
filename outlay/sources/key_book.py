"""A dictionary of surrogate keys that lasts between runs.

An id keeps the key that it got first. Ids that the book does not have get the numbers above the highest one ever given, in the order of
the ids; ids that vanish from the input keep their keys. The first assignment is therefore the rank by id, and a later one with
other ids in between changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outlay.functions import dense_key
from outlay.sources.commits import ATTEMPTS, CommitLog, Conflict, read_folders
from outlay.sources.writers import write_table

MOST_FOLDERS = 32


class KeyBook:
    """The keys of one dimension, in a folder of their own."""

    def __init__(self, spark: SparkSession, folder: str, id_column: str, key: str):
        self.spark, self.folder, self.id_column, self.key = spark, folder, id_column, key
        self.log = CommitLog(spark, f"{folder}/_commits")

    def read(self) -> DataFrame | None:
        """(id, key) of all ids that have one; None before the first assignment."""
        return read_folders(self.spark, self.folder, self.log.latest()[1].get("folders", []))

    def assign(self, ids: DataFrame) -> DataFrame:
        """(id, key) of the book after all of ``ids`` have a key. NULL is an id like any other."""
        wanted = ids.select(self.id_column).groupBy(self.id_column).agg(F.count(F.lit(1)).alias("_uses")).drop("_uses")
        for _ in range(ATTEMPTS):
            number, state = self.log.latest()
            folders, last = state.get("folders", []), state.get("last", 0)
            known = read_folders(self.spark, self.folder, folders)
            unseen = wanted
            if known is not None:
                ids_known = known.select(F.col(self.id_column).alias("_known"))
                unseen = wanted.join(ids_known, F.col(self.id_column).eqNullSafe(F.col("_known")), "left_anti")
            name = f"keys-{number + 1}-{uuid.uuid4().hex}"
            # Written first: the numbering reads its input twice.
            rows = write_table(unseen, f"{self.folder}/_unseen-{name}")
            if rows:
                settled = self.spark.read.schema(unseen.schema).parquet(f"{self.folder}/_unseen-{name}")
                numbered = dense_key(settled, self.id_column, self.key).select(
                    self.id_column, (F.col(self.key) + last).cast("bigint").alias(self.key))
                if len(folders) >= MOST_FOLDERS:
                    numbered, folders = known.select(self.id_column, self.key).unionByName(numbered), []
                write_table(numbered, f"{self.folder}/{name}")
            self.log.files.system.delete(self.log.files.hadoop.Path(f"{self.folder}/_unseen-{name}"), True)
            if not rows:
                return known if known is not None else _nothing(self, unseen)
            try:
                self.log.commit(number + 1, {"folders": [*folders, name], "last": last + rows})
                return self.read()
            except Conflict:
                self.log.files.system.delete(self.log.files.hadoop.Path(f"{self.folder}/{name}"), True)
        raise Conflict(f"{self.key}: no free number after {ATTEMPTS} attempts")

    def numbered(self, members: DataFrame, id_column: str, key: str) -> DataFrame:
        """``members``, one row for each id, with their lasting keys; stands in for ``dense_key``."""
        if (id_column, key) != (self.id_column, self.key):
            raise ValueError(f"the book has {self.key} of {self.id_column}")
        return self.look_up(members, self.assign(members))

    def look_up(self, rows: DataFrame, book: DataFrame) -> DataFrame:
        """``rows`` with the key of their id, NULL for an id that the book does not have."""
        keys = book.select(F.col(self.id_column).alias("_id"), F.col(self.key).alias("_key"))
        return rows.drop(self.key).join(keys, F.col(self.id_column).eqNullSafe(F.col("_id")), "left").withColumn(
            self.key, F.col("_key")).drop("_id", "_key")


def _nothing(book: KeyBook, ids: DataFrame) -> DataFrame:
    return ids.withColumn(book.key, F.lit(None).cast("bigint"))
