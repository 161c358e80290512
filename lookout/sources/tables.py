"""Reading the driver tables and the prediction / metrics tables the stream
writes (S6, S7, S8, S15)."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookout.session import prepare
from lookout.sources.commits import committed_folders, csv_options, has_log, read_committed

# Schema of the prediction table written by the stream (one row per image).
PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("image", T.StringType(), True),
        T.StructField("prediction", T.StringType(), True),
        T.StructField("batch_id", T.LongType(), True),
        T.StructField("modification_time", T.TimestampType(), True),
    ]
)

# Schema of the per-batch timing table (one row per micro-batch).
METRICS_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType(), True),
        T.StructField("num_images", T.LongType(), True),
        T.StructField("duration_ms", T.LongType(), True),
        T.StructField("ms_per_image", T.DoubleType(), True),
    ]
)

# The same tables as the page reads them: rows of several runs (checkpoints) are
# told apart; in tables of other writers the run is null.
RUN_FIELD = T.StructField("run_id", T.StringType(), True)
RUN_PREDICTION_SCHEMA = T.StructType([*PREDICTION_SCHEMA.fields, RUN_FIELD])
RUN_METRICS_SCHEMA = T.StructType([*METRICS_SCHEMA.fields, RUN_FIELD])

# Header layouts of one folder of part files; more are files without headers.
MOST_LAYOUTS = 1000

# The CSV layout of the reference sink (header, two text columns).
PREDICTION_CSV_SCHEMA = T.StructType(
    [
        T.StructField("image", T.StringType(), True),
        T.StructField("prediction", T.StringType(), True),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, lazily: Catalyst prunes columns and pushes filters
    into the Parquet scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the session (works
    for any scheme the cluster has configured); without a JVM handle (Spark
    Connect) it asks ``pyarrow.fs``."""
    try:
        jvm = spark.sparkContext._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(jpath))
    except Exception:  # noqa: BLE001
        import pyarrow.fs as pafs

        from lookout.session import local_fs_path

        local = local_fs_path(path)
        fs, p = (pafs.LocalFileSystem(), local) if local else pafs.FileSystem.from_uri(path)
        return fs.get_file_info(p).type != pafs.FileType.NotFound


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options) -> DataFrame:
    """A result table that does not exist yet is an empty view, not an error
    (S15); a declared schema keeps the view's columns stable. Of a table with a
    commit log the committed rows are read."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    if fmt == "parquet" and has_log(spark, path):
        return read_committed(spark, path, schema)
    reader = spark.read.format(fmt).schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


@contextmanager
def listing_in_few_tasks(spark: SparkSession) -> Iterator[None]:
    """Inside, folders and lists of files are listed in as many tasks as the
    session shuffles with, not in a task for every folder or file."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key, None)
    spark.conf.set(key, spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _first_lines(paths: pd.DataFrame) -> pd.DataFrame:
    import pyarrow.fs as pafs

    from lookout.session import local_fs_path

    heads = []
    for p in paths["path"]:
        if p.startswith("file:") or "://" not in p:
            fs, fp = pafs.LocalFileSystem(), local_fs_path(p)
        else:
            fs, fp = pafs.FileSystem.from_uri(p)
        # Read until the end of the first line (the header), however long.
        buf = b""
        with fs.open_input_stream(fp) as f:
            while b"\n" not in buf:
                chunk = f.read(65536)
                if not chunk:
                    break
                buf += chunk
        head = buf.split(b"\n", 1)[0].rstrip(b"\r")
        heads.append(head.decode("utf-8", "replace"))
    return pd.DataFrame({"path": paths["path"], "header": heads})


def _names(header: str) -> list[str]:
    """Column names of a header line (quoted names included); a name that
    comes again gets a number, so that the first one counts."""
    names = [c.strip() for c in next(csv.reader([header]), [])]
    return [c if c not in names[:i] else f"{c}~{i}" for i, c in enumerate(names)]


def read_part_csvs(spark: SparkSession, path: str, schema: T.StructType, with_file_info: bool = False) -> DataFrame:
    """The ``part-*.csv`` files of a folder as one table, columns matched by
    header name (S7/S8, U1). The files are those that Spark's own sources see
    there: the top level, and hive partition folders such as ``batch_id=N``;
    of a table with a commit log, those of its committed batches.

    A file's layout is its header line (a distributed read of each file's
    first line). Files of one layout are one CSV scan over their own list, and
    the scans are united by column name, so a row is read alike whatever other
    layouts there are -- a part lacking a column yields nulls in it. Empty
    (0-byte) and header-only parts add no rows; doubled quotes are undone.
    With ``with_file_info`` the file's name, path and modification time and the
    row's place in it are kept, so rows can be ordered as they were written
    (W4)."""
    extra = [
        T.StructField("file_name", T.StringType()),
        T.StructField("file_modification_time", T.TimestampType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("block_start", T.LongType()),
        T.StructField("row_in_block", T.LongType()),
    ]
    out_schema = T.StructType(list(schema.fields) + (extra if with_file_info else []))
    empty = spark.createDataFrame([], out_schema)
    if not path_exists(spark, path):
        return empty
    prepare(spark)
    folders = committed_folders(spark, path) if has_log(spark, path) else [path]
    if not folders:
        return empty
    with listing_in_few_tasks(spark):
        return _read_parts(spark, path, folders, schema, out_schema, with_file_info)


def _read_parts(
    spark: SparkSession, path: str, folders: list[str], schema: T.StructType, out_schema: T.StructType, with_file_info: bool
) -> DataFrame:
    """:func:`read_part_csvs` over the folders that count."""
    # The folder names below the table are columns; with a list of files Spark
    # has to be told where they begin.
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.csv").option("basePath", path)
    heads = (
        listing.load(folders)
        .where(F.col("length") > 0)
        .select("path")
        .mapInPandas(lambda it: (_first_lines(b) for b in it), "path string, header string")
        .checkpoint()
    )
    # Distinct headers = schema versions of the writer: a handful of rows.
    some = heads.select("header").distinct().limit(MOST_LAYOUTS + 1).collect()
    if len(some) > MOST_LAYOUTS:
        raise ValueError(f"over {MOST_LAYOUTS} different first lines in {path}: do its files have headers?")
    headers = sorted(r["header"] for r in some)
    if not headers:
        return spark.createDataFrame([], out_schema)
    by_name = {f.name: f for f in schema.fields}
    places = [
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("file_modification_time"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        # A block is read by one task from its first row to its last, so these
        # numbers rise with the rows of a block (they mean nothing beyond it).
        F.monotonically_increasing_id().alias("row_in_block"),
    ]
    frames = []
    for header in headers:
        names = _names(header)
        fields = [T.StructField(c, by_name[c].dataType if c in by_name else T.StringType()) for c in names]
        reader = spark.read.schema(T.StructType(fields)).options(**csv_options("csv")).option("basePath", path)
        if len(headers) == 1:
            rows = reader.option("pathGlobFilter", "part-*.csv").csv(folders)
        else:
            # The scan's own list of files; the driver holds a scan's files anyhow.
            rows = reader.csv([r["path"] for r in heads.where(F.col("header") == header).select("path").collect()])
        wanted = [
            (F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
        frames.append(rows.select(*wanted, *(places if with_file_info else [])))
    return reduce(DataFrame.unionByName, frames)
