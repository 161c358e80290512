"""Dataset preparation as distributed jobs: splits (W9, W10, A13), class
statistics (A6-A9), first sample per class (W3), augmentation copies (U2)
and feature-table persistence (S6, S11, S12).

Wide columns (pixel vectors) never enter a shuffle here: ranks and splits
are computed on ``(id, label)`` and joined back on the id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lookout.classes import class_dim
from lookout.operators.ranking import BROADCAST_GROUPS, first_by_rank, shuffle_key
from lookout.session import prepare, work_dir
from lookout.sources.commits import Files

SEED = 42


def stratified_split(
    df: DataFrame,
    id_col: str,
    label_col: str,
    val_fraction_tenths: int = 2,
    seed: int = SEED,
    keep_all: bool = False,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Exact stratified split. Inside each label, rows are ordered by the
    seeded shuffle key; the first ``v = (val_tenths * n + 5) div 10`` rows
    (``round(0.2 * n)``; ``10 * rank <= 2 * n + 5``) go to ``val``, the rest
    to ``train``.

    Only key counts and the boundary buckets are ranked
    (:func:`~lookout.operators.ranking.rank_thresholds`); every row is then
    classified by comparing its key with its label's threshold, so wide
    columns (pixels) stay in place -- no join back by id. With ``keep_all``
    all input columns are returned, else ``(id, label, split)``. ``keys_from``
    names a narrow table of the same (id, label) rows for the key counts."""
    cut = lambda n: F.floor((n * val_fraction_tenths + 5) / 10)
    flagged = first_by_rank(df, id_col, cut, seed, [label_col], "_val", keys_from)
    out = flagged.withColumn("split", F.when(F.col("_val"), "val").otherwise("train")).drop("_val")
    return out if keep_all else out.select(id_col, label_col, "split")


def plain_split(df: DataFrame, id_col: str, train_tenths: int = 8, seed: int = SEED, keep_all: bool = False) -> DataFrame:
    """The first ``int(0.8 N)`` rows of the seeded shuffle are ``train``,
    the rest ``val`` (one threshold key, then a map over the rows)."""
    cut = lambda n: F.floor(n * train_tenths / 10)
    flagged = first_by_rank(df, id_col, cut, seed, (), "_train")
    out = flagged.withColumn("split", F.when(F.col("_train"), "train").otherwise("val")).drop("_train")
    return out if keep_all else out.select(id_col, "split")


def split_sizes(split_df: DataFrame) -> DataFrame:
    """Rows per split."""
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def class_distribution(df: DataFrame, label_col: str = "label", spark: SparkSession | None = None) -> DataFrame:
    """A6 + J3: rows per class over the whole dimension (zero for an empty
    class)."""
    spark = spark or df.sparkSession
    counts = df.groupBy(F.col(label_col).alias("class_id")).agg(F.count(F.lit(1)).alias("n_rows"))
    return (
        class_dim(spark)
        .join(counts, "class_id", "left")
        .select("class_id", "class_name", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"))
    )


def distinct_labels(df: DataFrame, label_col: str = "label") -> DataFrame:
    """A7."""
    return df.select(label_col).distinct()


def class_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Balanced weights ``N / (K * n_c)`` over the K classes present.
    The per-class table has at most K rows; N and K come from a window over
    it, never from a pass over the data."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_rows"))
    allw = Window.partitionBy()
    return counts.select(
        label_col,
        "n_rows",
        (F.sum("n_rows").over(allw) / (F.count(F.lit(1)).over(allw) * F.col("n_rows"))).alias("weight"),
    )


def with_weights(df: DataFrame, weights: DataFrame, label_col: str = "label") -> DataFrame:
    """Weight column for a fit (D6): the weight table has one row per label
    present. It is counted, and broadcast up to ``BROADCAST_GROUPS`` rows, so
    the vectors are not shuffled; a larger one is joined by a shuffle."""
    prepare(df.sparkSession)
    table = weights.select(label_col, "weight").checkpoint()
    if table.count() <= BROADCAST_GROUPS:
        table = F.broadcast(table)
    return df.join(table, label_col, "left")


def dataset_profile(df: DataFrame, vec_col: str) -> DataFrame:
    """Rows, vector length range and value range, in one pass."""
    v = F.col(vec_col)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.size(v)).alias("min_len"),
        F.max(F.size(v)).alias("max_len"),
        F.min(F.array_min(v)).cast("double").alias("min_value"),
        F.max(F.array_max(v)).cast("double").alias("max_value"),
    )


def first_per_class(df: DataFrame, id_col: str, label_col: str = "label", seed: int = SEED) -> DataFrame:
    """The first sample of each class in seeded-shuffle order, ``null``
    for an empty class. The smallest leading 15 hex digits of a class's keys
    are found by a hash aggregate on a number (no sort, hot classes combined
    per task); the full key decides among the few rows that have them."""
    key = shuffle_key(id_col, seed)
    rows = df.select(
        F.col(label_col).alias("class_id"),
        F.col(id_col),
        key.alias("_key"),
        F.conv(F.substring(key, 1, 15), 16, 10).cast("long").alias("_head"),
    )
    dim = class_dim(df.sparkSession)
    lowest = rows.groupBy("class_id").agg(F.min("_head").alias("_head")).join(dim.select("class_id"), "class_id", "left_semi")
    # At most one row per class of the dimension: a proven bound.
    firsts = (
        rows.join(F.broadcast(lowest), ["class_id", "_head"])
        .groupBy("class_id")
        .agg(F.min_by(F.col(id_col), F.col("_key")).alias(id_col))
    )
    return dim.join(firsts, "class_id", "left").select("class_id", "class_name", id_col)


def augmented_rows(df: DataFrame, factor: int = 2) -> DataFrame:
    """Each row plus ``factor`` augmented copies with the same label;
    ``aug_index`` 0 is the original (originals never depend on the
    augmentation, Q10)."""
    return df.withColumn("aug_index", F.explode(F.sequence(F.lit(0), F.lit(factor))))


def augmented_counts(split_df: DataFrame, label_col: str = "label", factor: int = 2) -> DataFrame:
    """Rows per class: originals, whole-set augmentation (the reference's
    order, Q16) and train-only augmentation (ours), with validation rows
    left as they are. One pass: conditional counts over the exploded rows."""
    rows = augmented_rows(split_df, factor)
    orig = F.col("aug_index") == 0
    train = F.col("split") == "train"
    return rows.groupBy(label_col).agg(
        F.count(F.when(orig, 1)).alias("n_original"),
        F.count(F.lit(1)).alias("n_whole_augmented"),
        F.count(F.when(train, 1)).alias("n_train_augmented"),
        F.count(F.when(orig & (F.col("split") == "val"), 1)).alias("n_val"),
    )


# --- persistence ---------------------------------------------------------------


# Rows of one file of a feature table.
FILE_ROWS = 100_000


def save_features(df: DataFrame, path: str, label_col: str = "label", mode: str = "overwrite") -> None:
    """The feature table as Parquet, one folder per label (hive
    partitions). ``overwrite`` replaces the whole table, so a label that is
    gone leaves nothing behind. The rows are written where they are (no
    shuffle of pixels), in files of at most ``FILE_ROWS`` rows."""
    (
        df.write.mode(mode)
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", FILE_ROWS)
        .partitionBy(label_col)
        .parquet(path)
    )


def load_features(spark: SparkSession, path: str, columns=("pixels", "label"), label_col: str = "label") -> DataFrame:
    """Read back with partition discovery and only the needed
    columns; the label is cast to INT (P6). A missing folder is an error
    (PATH_NOT_FOUND), as in the reference."""
    df = spark.read.parquet(path).select(*columns)
    if label_col in columns:
        df = df.withColumn(label_col, F.col(label_col).cast("int"))
    return df


def storage_report(spark: SparkSession, path: str, glob: str = "*.parquet", by: str | None = None) -> DataFrame:
    """Files and bytes of a saved dataset; the listing selects no
    ``content``, so file bodies are never read. ``by``: a pattern whose first
    group, found in a file's path, is its ``folder``; one row for each."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("length", *([F.regexp_extract("path", by, 1).alias("folder")] if by else []))
    )
    return listing.groupBy(*(["folder"] if by else [])).agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("length").alias("total_bytes"),
        F.round(F.sum("length") / (1024.0 * 1024.0), 6).alias("size_mb"),
    )


def prepare_dataset(
    spark: SparkSession,
    root: str,
    out_path: str,
    height: int = 64,
    width: int = 64,
    factor: int = 2,
    val_tenths: int = 2,
    seed: int = SEED,
    antialias: bool | str = False,
    rejects_path: str | None = None,
    missing_path: str | None = None,
) -> DataFrame:
    """The dataset job end to end (S4 -> F1-F3 -> W9 -> U2/F14 -> S11):
    class folders ``c0..c9`` are decoded and resized to pixel vectors, split
    on the originals (stratified, seeded), the train split gets ``factor``
    augmented copies per image (validation images are kept as they are, so
    no copy of a validation image reaches training, Q16), and the table is
    saved as Parquet partitioned by label. Returns the saved table, read
    back. ``rejects_path`` gets the files left out, with the reason, and
    ``missing_path`` the classes without any usable file. With ``antialias``
    set to ``EIGHT_BIT`` images are reduced to the byte as the reference's job
    reduces them.

    An image's id is its path, so splits and augmentation seeds do not depend
    on listing order or partitioning. Every image is decoded once: the pass
    that decodes writes all files, usable or not, with their pixels (small,
    and the reason for those left out) to the work folder. Split, rejects and
    missing classes read the narrow columns of that table; the pixel rows go
    from it to the saved table without a shuffle. It is deleted at the end."""
    from lookout.functions.images import augment_udf
    from lookout.sources.images import read_labelled

    prepare(spark)
    decoded = work_dir(spark, "decoded")
    read_labelled(spark, root, True, height, width, antialias).write.parquet(decoded)
    every = spark.read.parquet(decoded)
    good = every.where(F.col("reason").isNull()).select("path", "label", "pixels")
    keys = good.select("path", "label")
    split = stratified_split(good, "path", "label", val_tenths, seed, keep_all=True, keys_from=keys)
    copies = augmented_rows(split, factor).where((F.col("split") == "train") | (F.col("aug_index") == 0))
    aug = augment_udf(height, width, seed=seed)
    table = copies.select(
        "path",
        "split",
        F.col("aug_index").cast("int").alias("aug_index"),
        aug(F.col("pixels"), F.col("path"), F.col("aug_index")).alias("pixels"),
        "label",
    )
    save_features(table, out_path)
    if rejects_path:
        rejects = every.where(F.col("reason").isNotNull()).select("path", "reason")
        rejects.write.mode("overwrite").parquet(rejects_path)
    if missing_path:
        found = keys.select(F.col("label").alias("class_id")).distinct()
        class_dim(spark).join(found, "class_id", "left_anti").coalesce(1).write.mode("overwrite").parquet(missing_path)
    Files(spark, decoded).delete(decoded)
    return load_features(spark, out_path, columns=("path", "split", "aug_index", "pixels", "label"))
