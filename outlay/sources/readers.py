"""CSV and Parquet readers."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outlay import schemas


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema; a cell that does not parse becomes NULL."""
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE")


MALFORMED = "_malformed_line"


def read_csv_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, every cell as the text that it is; ``_malformed_line`` has the lines with too few or too many cells."""
    text = T.StructType([T.StructField(name, T.StringType()) for name in [*schema.names, MALFORMED]])
    return spark.read.csv(path, header=True, schema=text, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and inferred types: a second pass over the file, for exploration."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A plain or Hive-partitioned Parquet table."""
    return spark.read.parquet(path)


def fallback_budgets(spark: SparkSession) -> DataFrame:
    fields = ["dept_id", "dept_name", "budget_month", "budget_amount"]
    rows = spark.createDataFrame(
        list(schemas.FALLBACK_BUDGETS), "dept_id int, dept_name string, budget_month string, amount int"
    ).withColumnRenamed("amount", "budget_amount")
    return rows.select(*[F.col(f).cast(schemas.BUDGETS[f].dataType) for f in fields])


def load_budgets(spark: SparkSession, path: str) -> DataFrame:
    """The budget table at ``path``, or the fixed fallback rows if there is no such path; other errors are raised."""
    try:
        return read_table(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return fallback_budgets(spark)


def spread_if_few_splits(df: DataFrame, *by: str) -> DataFrame:
    """Spread a table that arrives in fewer splits than there are cores; leave any other as it is.

    Meant for small single-file inputs, which would otherwise run as one task up to their
    first shuffle. A large table has many splits and is not touched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, *by)
    return df


@contextmanager
def tasks_of_rows(spark: SparkSession, rows: int, each: int) -> Iterator[None]:
    """Within it, a table of ``rows`` rows is read and exchanged in so many tasks that one has about ``each`` of them, down to a file or row group.

    Splits are cut by bytes, which say little of the rows: of values that repeat, Parquet packs millions into a split; and the session's number of
    shuffle partitions knows nothing of them. For what sorts its rows as they come. Adaptive execution still joins small partitions. The session's
    settings are put back at the end; higher ones stay. Its other threads see the changed ones meanwhile, which alters no result.
    """
    files, exchanges = "spark.sql.files.minPartitionNum", "spark.sql.shuffle.partitions"
    before = {name: spark.conf.get(name, None) for name in (files, exchanges)}
    cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
    # Without a value of its own, a setting's default comes from a get that names none.
    least = {files: before[files] or cores, exchanges: spark.conf.get(exchanges)}
    try:
        for name, value in least.items():
            spark.conf.set(name, str(max(int(value), -(-rows // each))))
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
