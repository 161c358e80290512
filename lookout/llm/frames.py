"""Small DataFrame helpers of the llm operators."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lookout.session import prepare, work_dir

# Bytes of rows that go to a Python worker at once (one row at least); as much as
# the operators handle at once.
BATCH_BYTES = 4 * 1024 * 1024
# Rows that are read from Parquet at once.
BATCH_ROWS = 512

# Added columns that a caller never sees start with this.
OWN = "_llm_"


def bound_batches(spark: SparkSession) -> None:
    """From here on the session sends rows to Python workers in batches of at
    most ``BATCH_BYTES``: with ten thousand whole texts at once an executor
    holds a batch several times over. For the same reason Parquet is read
    ``BATCH_ROWS`` rows at a time. Smaller bounds of the session's hold."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)i?b?", spark.conf.get(key).lower()).groups()
    if int(number) << 10 * " kmgtp".index(unit or " ") > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    key = "spark.sql.parquet.columnarReaderBatchSize"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(name: str) -> Column:
    """The text column, null as empty."""
    return F.coalesce(col(name), F.lit(""))


def col(name: str) -> Column:
    """A column by its exact name (dots and other signs included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def joinable(df: DataFrame, most: int) -> DataFrame:
    """A computed table (cut off by ``checkpoint()``) as the small side of a
    join: it is counted, and broadcast if it has ``most`` rows or fewer;
    beyond that the join shuffles."""
    return F.broadcast(df) if df.count() <= most else df


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a job go when it ends, not when the driver
    happens to collect its garbage. For jobs that write a table and whose
    frames aren't run again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


class Tables:
    """Tables of the work folder that an operator reads more than once."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name, self.paths = spark, name, {}

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` written and read back."""
        path = work_dir(self.spark, self.name)
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = (path, back)
        return back

    def drop(self, *frames: DataFrame) -> None:
        """Deletes kept tables that nothing reads any more."""
        for frame in frames:
            remove_table(self.spark, self.paths.pop(id(frame))[0])


def remove_table(spark: SparkSession, path: str) -> None:
    """Deletes a table that this package has written to the work folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


__all__ = ["OWN", "Tables", "bound_batches", "col", "freeing_shuffles", "documents", "joinable", "prepare", "remove_table", "whole_text", "work_dir"]
