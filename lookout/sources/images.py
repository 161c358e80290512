"""Image sources.

Scans are Spark's ``binaryFile`` and ``image`` sources: listing and reading
are distributed, ``pathGlobFilter`` prunes files before they are opened,
and a listing that selects no ``content`` never reads file bodies.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookout.classes import class_dim
from lookout.functions.images import IMAGE_SCHEMA, pixel_vector
from lookout.functions.paths import STREAM_GLOB, has_supported_suffix, url_unquote
from lookout.session import prepare

# Class folders whose table is broadcast (it is counted first).
BROADCAST_CLASSES = 100_000

# Files of a listing that a stream keeps for its next batches. When they are used
# up, every file of the folder is compared with those read already.
LISTED_AHEAD = 100_000

BINARY_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), True),
        T.StructField("modificationTime", T.TimestampType(), True),
        T.StructField("length", T.LongType(), True),
        T.StructField("content", T.BinaryType(), True),
    ]
)


def read_images(spark: SparkSession, path: str, glob: str | None = STREAM_GLOB, recursive: bool = False) -> DataFrame:
    """Batch scan of decoded images (F1 in the JVM): the ``image`` struct plus
    ``path`` (plain, percent-decoded: ``image.origin`` is a URI) and the
    file's modification time. Undecodable files stay as rows with height
    -1 (see :func:`split_valid`)."""
    reader = spark.read.format("image").option("dropInvalid", False)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return _with_identity(reader.load(path))


class StreamLimits(NamedTuple):
    """What a file stream admits, and what becomes of files that were read.

    ``max_files`` and ``max_bytes`` (one of them) bound a micro-batch (S13);
    images differ in size, so bytes say more about the work. ``newest_first``
    takes the latest files first, and ``max_age`` ("7d") leaves out files that
    are so much older than the newest one seen. ``clean`` is "archive" (files
    of finished batches move below ``archive_dir``, which must lie outside the
    input folder) or "delete"; without it the folder only grows, and so does
    the listing of every trigger. Spark cleans the files of a batch after the
    next one has been planned, on threads of its own, and tries again in the
    next batch what it could not move."""

    max_files: int | None = None
    max_bytes: int | str | None = None
    newest_first: bool = False
    max_age: str | None = None
    clean: str | None = None
    archive_dir: str | None = None

    def options(self) -> dict:
        if self.max_files and self.max_bytes:
            raise ValueError("a batch is bounded by files or by bytes, not by both")
        if self.clean not in (None, "archive", "delete"):
            raise ValueError(f"clean is archive or delete: {self.clean!r}")
        if (self.clean == "archive") != bool(self.archive_dir):
            raise ValueError("archive_dir goes with clean='archive'")
        named = {
            "maxFilesPerTrigger": self.max_files and int(self.max_files),
            "maxBytesPerTrigger": self.max_bytes,
            "latestFirst": self.newest_first or None,
            "maxFileAge": self.max_age,
            "cleanSource": self.clean,
            "sourceArchiveDir": self.archive_dir,
        }
        return {k: v for k, v in named.items() if v}


def read_image_stream(
    spark: SparkSession,
    path: str,
    glob: str | None = STREAM_GLOB,
    max_files_per_trigger: int | None = None,
    limits: StreamLimits = StreamLimits(),
) -> DataFrame:
    """Streaming scan of a folder of images with the declared
    image schema; top-level files only; each path is read once (the
    checkpoint remembers it)."""
    reader = spark.readStream.format("image").schema(IMAGE_SCHEMA).option("dropInvalid", False)
    return _with_identity(_limited(reader, glob, max_files_per_trigger, limits).load(path))


def read_binary_stream(
    spark: SparkSession,
    path: str,
    glob: str | None = STREAM_GLOB,
    max_files_per_trigger: int | None = None,
    limits: StreamLimits = StreamLimits(),
) -> DataFrame:
    """S1 as declared: a ``binaryFile`` stream with the fixed schema
    ``path, modificationTime, length, content`` (raw bytes, for scorers that
    decode themselves); ``path`` is plain, not URL-encoded."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_SCHEMA)
    return _limited(reader, glob, max_files_per_trigger, limits).load(path)


def _limited(reader, glob: str | None, max_files: int | None, limits: StreamLimits):
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        limits = limits._replace(max_files=max_files)
    return reader.option("maxCachedFiles", LISTED_AHEAD).options(**limits.options())


def _with_identity(df: DataFrame) -> DataFrame:
    # Normalise the identity once at ingest (Q12): image.origin is a
    # percent-encoded URI, the listing path is not.
    return df.select(
        "image",
        url_unquote(F.col("image.origin")).alias("path"),
        F.col("_metadata.file_modification_time").alias("modification_time"),
    )


def read_binary_listing(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """File listing without bodies: ``path, modificationTime, length``.
    Selecting no ``content`` prunes the file reads from the scan."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(path).select("path", "modificationTime", "length")


def split_valid(images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(decodable rows, rejects). Rejects keep the path and a reason; the
    batch never fails on a bad file (Q9)."""
    ok = F.col("image.height") > 0
    good = images.where(ok)
    bad = images.where(~ok | F.col("image.height").isNull()).select(
        "path", F.lit("undecodable_image").alias("reason")
    )
    return good, bad


def image_features(images: DataFrame, height: int = 64, width: int = 64, antialias: bool | str = False) -> DataFrame:
    """Decodable images -> ``path, pixels`` (float vector
    ``height*width*3``, RGB interleaved, [0, 1]). The pixel UDF runs in
    Arrow batches; the raw struct is dropped right after."""
    prepare(images.sparkSession)
    good, _ = split_valid(images)
    return good.select("path", "modification_time", pixel_vector("image", height, width, antialias).alias("pixels"))


def _plain(path: Column) -> Column:
    """A path without scheme and authority (``file:/a``, ``hdfs://host/a`` -> ``/a``)."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "/")


def _below(spark: SparkSession, path: Column, root: str) -> Column:
    """The part of ``path`` below ``root``; null outside it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    prefix = fs.makeQualified(where).toUri().getPath().rstrip("/") + "/"
    plain = _plain(path)
    return F.when(F.startswith(plain, F.lit(prefix)), F.substring(plain, len(prefix) + 1, 1 << 30))


class LabelledFolders(NamedTuple):
    """``rows`` (path, label, maybe pixels), ``rejects`` (path, reason) and the
    classes of the dimension without any row (``missing``)."""

    rows: DataFrame
    rejects: DataFrame
    missing: DataFrame


def labelled_folders(
    spark: SparkSession, root: str, images: bool = False, height: int = 64, width: int = 64, antialias: bool | str = False
) -> LabelledFolders:
    """``<root>/c0..c9/*`` -> ``(path, label)`` with the case-insensitive
    suffix filter (S3). Only files directly inside a class folder of the
    dimension count; every other file is a reject with its reason, and so is
    a file that can't be decoded when ``images`` are asked for. ``missing``:
    the classes with no folder or no usable file."""
    known = read_labelled(spark, root, images, height, width, antialias)
    rows = known.where(F.col("reason").isNull()).drop("reason")
    rejects = known.where(F.col("reason").isNotNull()).select("path", "reason")
    found = known.where(F.col("reason").isNull()).select(F.col("label").alias("class_id")).distinct()
    return LabelledFolders(rows, rejects, class_dim(spark).join(found, "class_id", "left_anti"))


def read_labelled(
    spark: SparkSession,
    root: str,
    images: bool = False,
    height: int = 64,
    width: int = 64,
    antialias: bool | str = False,
) -> DataFrame:
    """Every file below ``root`` with its ``label``, and the ``reason`` why it
    is none of the dataset (null for usable files); with ``images`` their
    ``pixels`` too. What :func:`labelled_folders` divides."""
    prepare(spark)
    if images:
        scan = read_images(spark, root, glob=None, recursive=True)
        broken = ~F.coalesce(F.col("image.height") > 0, F.lit(False))
    else:
        scan = read_binary_listing(spark, root, recursive=True)
        broken = F.lit(False)
    below = _below(spark, F.col("path"), root)
    label = F.regexp_extract(below, r"^c(\d)/[^/]+$", 1).try_cast("int")
    reason = (
        F.when(label.isNull(), "outside_class_folders")
        .when(~has_supported_suffix(F.col("path")), "unsupported_suffix")
        .when(broken, "undecodable_image")
    )
    known = scan.withColumns({"label": label, "reason": reason})
    columns = ["path", "label", "reason"]
    if images:  # null where the file can't be decoded
        columns.append(pixel_vector("image", height, width, antialias).alias("pixels"))
    return known.select(*columns)


def labelled_images(
    spark: SparkSession, root: str, height: int = 64, width: int = 64, antialias: bool | str = False
) -> LabelledFolders:
    """:func:`labelled_folders` with decoded and resized ``pixels``."""
    return labelled_folders(spark, root, True, height, width, antialias)


def split_folders(
    spark: SparkSession, root: str, images: bool = False, height: int = 224, width: int = 224, antialias: bool | str = False
) -> DataFrame:
    """``<root>/<split>/<class>/<file>`` -> ``(path, split, class_folder,
    label)``, with ``pixels`` of the target size if ``images``; files at any
    other depth are left out. The label is the class folder's index in sorted
    order (as a directory dataset numbers them), from a dense rank over the
    distinct class folders -- a table of one row per class, not the data."""
    prepare(spark)
    parts = F.split(_below(spark, F.col("path"), root), "/")

    def placed(scan: DataFrame, *more) -> DataFrame:
        inside = scan.where(has_supported_suffix(F.col("path")) & (F.size(parts) == 3))
        return inside.select("path", parts[0].alias("split"), parts[1].alias("class_folder"), *more)

    listing = placed(read_binary_listing(spark, root, recursive=True))
    classes = listing.select("class_folder").distinct()
    ranked = classes.withColumn("label", (F.dense_rank().over(Window.orderBy("class_folder")) - 1).cast("int")).checkpoint()
    if ranked.count() <= BROADCAST_CLASSES:  # keeps the pixel rows where they are
        ranked = F.broadcast(ranked)
    rows, columns = listing, ["path", "split", "class_folder", "label"]
    if images:
        good, _ = split_valid(read_images(spark, root, glob=None, recursive=True))
        rows = placed(good, pixel_vector("image", height, width, antialias).alias("pixels"))
        columns.append("pixels")
    return rows.join(ranked, "class_folder").select(*columns)
