"""What the operators share: picking columns, row numbers, stored intermediate tables, small batches."""

from __future__ import annotations

import atexit
import gc
import tempfile
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDERS: dict[str, str] = {}
_NUMBERS = count(1)
SLICE_BYTES = 4 << 20


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The columns ``names`` alone: found by the exact name, else in any case; of equal names the first."""
    columns = df.columns

    def place(name: str) -> int:
        for same in (lambda c: c == name, lambda c: c.lower() == name.lower()):
            for i, column in enumerate(columns):
                if same(column):
                    return i
        raise ValueError(f"no column {name}; there are {', '.join(columns)}")

    by_position = df.toDF(*[f"c{i}" for i in range(len(columns))])
    return by_position.select(*[F.col(f"c{place(n)}").alias(n) for n in names])


def shared_folder(spark: SparkSession) -> str:
    """This application's folder in ``spark.checkpoint.dir``; a temporary one where that is unset in local mode."""
    context = spark.sparkContext
    key = context.applicationId
    if key not in _FOLDERS:
        configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
            configured = tempfile.mkdtemp(prefix="outlay-llm-")
        _FOLDERS[key] = f"{configured.rstrip('/')}/outlay-llm-{key}"
        atexit.register(_remove, spark, _FOLDERS[key])
    return _FOLDERS[key]


def _remove(spark: SparkSession, path: str) -> None:
    """Delete one of the application's own folders, if the session still runs."""
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


class Store:
    """Intermediate tables of one run, written to the shared folder: lineage ends there, and lost executors cost nothing.

    ``free`` deletes tables that nothing will read again; the rest goes when the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, f"{shared_folder(spark)}/{name}-{next(_NUMBERS)}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def settle(self) -> None:
        """Let Spark's cleaner drop the shuffle files of finished steps now: it does so when the driver collects garbage."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def free(self, *names: str) -> None:
        for name in names:
            _remove(self.spark, f"{self.folder}/{name}")


ROW_BITS = 40  # rows of a file
MOST_FILES = 1 << 20


def numbered(docs: DataFrame, store: Store, name: str = "row") -> DataFrame:
    """``docs`` with a row number in front that is the same in each read, however the input is split or scheduled.

    Of a table read from Parquet files, the number is the file's place among all files and the row's place in its file; there is a row for each file,
    a million at most, to look the place up. Any other table, and one of more files, is written once with its numbers.
    """
    columns = docs.columns
    plain = [f"c{i}" for i in range(len(columns))]
    located = None
    if "_metadata" not in (c.lower() for c in columns):
        try:
            located = docs.select("*", "_metadata.file_path", "_metadata.row_index").toDF(*plain, "_path", "_place")
            paths = sorted(r[0] for r in located.select("_path").distinct().limit(MOST_FILES + 1).collect())
        except AnalysisException:
            located = None
    if located is None or len(paths) > MOST_FILES:
        rows = docs.toDF(*plain).select(F.monotonically_increasing_id().alias("_row"), "*")
        return store.put("numbered", rows).toDF(name, *columns)
    if len(paths) <= 1:
        return located.select(F.col("_place").alias("_row"), *plain).toDF(name, *columns)
    files = docs.sparkSession.createDataFrame(
        pa.table({"_path": pa.array(paths, pa.string()), "_file": pa.array(range(len(paths)), pa.int64())}), "_path string, _file long")
    row = F.shiftleft("_file", ROW_BITS).bitwiseOR(F.col("_place"))
    return located.join(F.broadcast(files), "_path").select(row.alias("_row"), *plain).toDF(name, *columns)


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows of about ``limit`` bytes of ``text``; a longer row stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


class Tally:
    """Sums of counts by 64-bit key, merged whenever they outgrow ``limit`` pairs; memory follows the distinct keys."""

    def __init__(self, limit: int = 500_000):
        self.limit, self.size, self.parts = limit, 0, []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.size += len(keys)
        if self.size > self.limit:
            self.total()
            self.limit = max(self.limit, 2 * self.size)

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys = np.concatenate([k for k, _ in self.parts])
        counts = np.concatenate([c for _, c in self.parts])
        unique, place = np.unique(keys, return_inverse=True)
        sums = np.bincount(place, weights=counts, minlength=len(unique)).astype(np.int64)
        self.parts, self.size = [(unique, sums)], len(unique)
        return unique, sums
