"""Result views over the prediction and metrics tables (the live page's
queries, A1-A5, W1, W2, W5, W6, J1-J3, P4-P9, U1).

Each view is one lazy DataFrame over the tables the stream writes. Class
names are attached *after* aggregation (at most 11 keys), so the broadcast
side is the fixed 10-row class dimension and the data side never shuffles
for the lookup. Row-level views use the in-expression lookup instead of a
join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lookout.classes import NUM_CLASSES, class_dim, class_label_of, class_name_of, class_number, short_label
from lookout.functions.paths import base_name, to_local_path, with_local_path
from lookout.session import prepare

# Total order of predictions: later batch, later file, then name.
ORDER_COLS = ["batch_id", "modification_time", "image"]


def status_of(class_id) -> F.Column:
    """Attentive / alert predicate (P7): class 0 is normal driving."""
    return F.when(class_id == 0, F.lit("attentive")).otherwise(F.lit("alert"))


def has_required_columns(df: DataFrame, required=("image", "prediction")) -> bool:
    """Required-columns guard (P4): the view is shown only when the table has
    the columns and at least one row."""
    return all(c in df.columns for c in required) and not df.isEmpty()


def total_images(pred: DataFrame) -> DataFrame:
    """A1: number of analysed images."""
    return pred.agg(F.count(F.lit(1)).alias("total_images"))


def _class_totals(pred: DataFrame) -> DataFrame:
    # Partial aggregation per task, then a shuffle of at most 11 keys per task.
    return (
        pred.select(F.col("prediction").try_cast("int").alias("class_id"))
        .groupBy("class_id")
        .agg(F.count(F.lit(1)).alias("n_images"))
    )


def class_counts(pred: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """A2: images per known class, ordered by class number (W6); unknown and
    unparsable classes are left out, as a value count over names drops
    nulls."""
    spark = spark or pred.sparkSession
    counts = _class_totals(pred).join(F.broadcast(class_dim(spark)), "class_id", "inner")
    # At most 10 rows: sort them in one partition (no range-partitioning
    # exchange and sampling job for a global sort).
    return (
        counts.select("class_id", "class_name", "n_images")
        .coalesce(1)
        .sortWithinPartitions(class_number(F.col("class_name")))
    )


def class_share(pred: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """A3: share (%) of each known class among the named predictions."""
    counts = class_counts(pred, spark)
    # The window runs over the <= 10-row aggregate, never over data rows.
    total = F.sum("n_images").over(Window.partitionBy())
    return counts.select(
        "class_id",
        "class_name",
        "n_images",
        F.round(F.col("n_images") * 100.0 / total, 6).alias("share_pct"),
    )


def class_counts_dense(pred: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """J3 + A6: every class of the dimension, zero when it has no row."""
    spark = spark or pred.sparkSession
    # Only ids inside the dimension can match: at most NUM_CLASSES rows, a
    # proven bound for the broadcast.
    known = _class_totals(pred).where(F.col("class_id").between(0, NUM_CLASSES - 1))
    return (
        class_dim(spark)
        .join(F.broadcast(known), "class_id", "left")
        .select("class_id", "class_name", F.coalesce("n_images", F.lit(0)).cast("bigint").alias("n_images"))
        .coalesce(1)
        .sortWithinPartitions("class_id")
    )


def _describe(df: DataFrame, project_root: str = "/app", extra=()) -> DataFrame:
    cid = F.col("prediction").try_cast("int")
    label = class_label_of(cid)
    local = to_local_path(F.col("image"), project_root)
    return df.select(
        *extra,
        "image",
        "prediction",
        *[c for c in ORDER_COLS if c != "image"],
        label.alias("class_label"),
        short_label(label).alias("short_label"),
        status_of(cid).alias("status"),
        local.alias("local_path"),
        base_name(local).alias("file_name"),
    )


def _newest_first(pred: DataFrame):
    """Newest run first (where the table has runs), then the newest batch."""
    cols = (["run_id"] if "run_id" in pred.columns else []) + ORDER_COLS
    return [F.col(c).desc_nulls_last() for c in cols]


def newest_batches(pred: DataFrame, n: int, batch_index: DataFrame | None) -> DataFrame:
    """Restrict ``pred`` to the batches that can hold its ``n`` newest rows.

    ``batch_index`` is the metrics table (one row per non-empty batch). The
    ``n`` newest (run, batch) pairs should hold at least ``n`` rows, so the
    smallest of them becomes a literal filter on the partition columns, and
    the scan reads those partitions instead of the whole history. Where the
    index names batches that the table no longer has (metrics outlive a
    reset), fewer rows come back, and the whole table is used."""
    if batch_index is None:
        return pred
    keys = [c for c in ("run_id", "batch_id") if c in pred.columns and c in batch_index.columns]
    top = batch_index.select(*keys).where(F.col("batch_id").isNotNull()).distinct()
    oldest = top.orderBy(*[F.col(c).desc() for c in keys]).limit(n).orderBy(*keys).limit(1).collect()
    if not oldest:
        return pred
    cut = oldest[0]
    newer = F.col("batch_id") >= F.lit(int(cut["batch_id"]))
    if "run_id" in keys:
        newer = (F.col("run_id") > cut["run_id"]) | ((F.col("run_id") == cut["run_id"]) & newer)
    pruned = pred.where(newer)
    return pruned if len(pruned.select("batch_id").take(n)) == n else pred


def latest_prediction(pred: DataFrame, project_root: str = "/app", batch_index: DataFrame | None = None) -> DataFrame:
    """The newest prediction with its label, status and file name.

    ``orderBy + limit`` plans as TakeOrderedAndProject: each task keeps its
    top row, only those reach the final merge. With ``batch_index`` only the
    newest partition is scanned."""
    pred = newest_batches(pred, 1, batch_index)
    return _describe(pred.orderBy(*_newest_first(pred)).limit(1), project_root)


def recent_predictions(
    pred: DataFrame, n: int = 8, columns: int = 4, project_root: str = "/app", batch_index: DataFrame | None = None
) -> DataFrame:
    """The last ``n`` predictions, newest first, with gallery slot
    ``(rank-1) % columns``. The rank window runs over the ``n`` rows left
    after the top-k; with ``batch_index`` only the newest partitions are
    scanned."""
    pred = newest_batches(pred, n, batch_index)
    top = pred.orderBy(*_newest_first(pred)).limit(n)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*_newest_first(pred))))
    return _describe(ranked, project_root, extra=("rank",)).select(
        "rank",
        ((F.col("rank") - 1) % columns).alias("slot"),
        "image",
        "prediction",
        "class_label",
        "short_label",
        "status",
        "file_name",
    )


def prediction_history(pred: DataFrame) -> DataFrame:
    """(image, class_name) for every row; unknown classes are null."""
    return pred.select("image", class_name_of(F.col("prediction").try_cast("int")).alias("class_name"))


def driver_status(pred: DataFrame) -> DataFrame:
    """P7 per row: class label (``Inconnu`` when unknown), short label,
    attentive / alert."""
    cid = F.col("prediction").try_cast("int")
    label = class_label_of(cid)
    return pred.select(
        "image",
        cid.alias("class_id"),
        label.alias("class_label"),
        short_label(label).alias("short_label"),
        status_of(cid).alias("status"),
    )


def rejects(pred: DataFrame) -> DataFrame:
    """P5 side output: rows whose class text does not parse or whose class
    is not in the dimension."""
    cid = F.col("prediction").try_cast("int")
    reason = F.when(cid.isNull(), F.lit("unparsable_class")).when(class_name_of(cid).isNull(), F.lit("unknown_class"))
    return pred.select("image", "prediction", reason.alias("reason")).where(F.col("reason").isNotNull())


# --- metrics views -----------------------------------------------------------


def metrics_kpis(metrics: DataFrame) -> DataFrame:
    """A4: mean ms per batch, mean ms per image (unweighted mean of per-batch
    ratios, Q5), the weighted value, metric rows and distinct batch ids (Q6).
    One aggregation pass."""
    return metrics.agg(
        F.round(F.avg("duration_ms"), 6).alias("avg_batch_ms"),
        F.round(F.avg("ms_per_image"), 6).alias("avg_image_ms"),
        F.round(F.sum("duration_ms") / F.sum("num_images"), 6).alias("weighted_image_ms"),
        F.count(F.lit(1)).alias("n_batches"),
        F.countDistinct("batch_id").alias("n_distinct_batches"),
    )


def metrics_by_batch(metrics: DataFrame) -> DataFrame:
    """The timing table ordered by batch id."""
    return metrics.select(
        "batch_id", "num_images", "duration_ms", F.round("ms_per_image", 6).alias("ms_per_image")
    ).orderBy("batch_id")


def metrics_display(metrics: DataFrame) -> DataFrame:
    """the KPI texts as shown: thousands separator, no decimals."""
    k = metrics.agg(
        F.avg("duration_ms").alias("b"), F.avg("ms_per_image").alias("i"), F.count(F.lit(1)).alias("n")
    )
    return k.select(
        F.concat(F.format_number("b", 0), F.lit(" ms")).alias("avg_batch_text"),
        F.concat(F.format_number("i", 0), F.lit(" ms")).alias("avg_image_text"),
        F.format_number("n", 0).alias("batches_text"),
    )


# --- existence of images (J2) ------------------------------------------------


def _keyed(df: DataFrame, src: str, project_root: str) -> DataFrame:
    # Join key: the normalised path, made non-nullable so that no
    # "key is not null" filter is inferred (which would re-evaluate the
    # whole normalisation); null paths get "" and never match a file.
    staged = with_local_path(df, src, "local_path", project_root)
    return staged.withColumn("_key", F.coalesce(F.col("local_path"), F.lit("")))


def _existence(pred: DataFrame, listing: DataFrame, how: str, project_root: str) -> DataFrame:
    p = _keyed(pred.select("image"), "image", project_root)
    files = _keyed(listing.select("path"), "path", project_root).select("_key").distinct()
    # A file listing grows with the data: AQE decides broadcast vs shuffle
    # from its measured size, and splits skewed join partitions.
    return p.join(files, "_key", how).select("image", "local_path", base_name(F.col("local_path")).alias("file_name"))


def images_present(pred: DataFrame, listing: DataFrame, project_root: str = "/app") -> DataFrame:
    """Predictions whose image is still in the folder listing. Both sides
    are normalised once (URI vs plain path, Q12) and semi-joined; the
    listing is de-duplicated first so the build side is one row per file."""
    return _existence(pred, listing, "left_semi", project_root)


def images_missing(pred: DataFrame, listing: DataFrame, project_root: str = "/app") -> DataFrame:
    """Predictions whose image file is gone (anti join)."""
    return _existence(pred, listing, "left_anti", project_root)


def union_parts(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


FILE_ORDER = ["file_modification_time", "file_name", "file_path", "block_start", "row_in_block"]


def in_file_order(rows: DataFrame) -> DataFrame:
    """Rows in the order of the files they came from (modification
    time, then name) and of the lines inside a file, as the page concatenates
    part files; needs the columns that
    :func:`lookout.sources.tables.read_part_csvs` adds (``with_file_info``)."""
    return rows.orderBy(*FILE_ORDER)


def newest_in_files(rows: DataFrame, n: int = 1) -> DataFrame:
    """W4 + W1: the last ``n`` rows in file order, last one first -- the last
    row of the newest part file, and those before it."""
    return rows.orderBy(*[F.col(c).desc() for c in FILE_ORDER]).limit(n)


def page(spark: SparkSession, predictions_dir: str, metrics_dir: str, fmt: str = "parquet", recent: int = 8) -> dict:
    """Every view of the live page over the tables the stream writes.

    A folder that does not exist yet gives empty views (S15); the
    prediction views are built only when the table has its required
    columns and rows (P4), else the dict holds ``None`` for them. Rows of a
    later run are newer than those of an earlier one, in Parquet and in CSV."""
    from lookout.sources.tables import RUN_METRICS_SCHEMA, RUN_PREDICTION_SCHEMA, read_or_empty, read_part_csvs

    prepare(spark)
    if fmt == "csv":
        pred = read_part_csvs(spark, predictions_dir, RUN_PREDICTION_SCHEMA)
        metrics = read_part_csvs(spark, metrics_dir, RUN_METRICS_SCHEMA)
    else:
        pred = read_or_empty(spark, predictions_dir, RUN_PREDICTION_SCHEMA)
        metrics = read_or_empty(spark, metrics_dir, RUN_METRICS_SCHEMA)
    ok = has_required_columns(pred)
    views = {
        "total_images": total_images(pred) if ok else None,
        "latest": latest_prediction(pred, batch_index=metrics) if ok else None,
        "class_counts": class_counts(pred, spark) if ok else None,
        "class_share": class_share(pred, spark) if ok else None,
        "recent": recent_predictions(pred, n=recent, batch_index=metrics) if ok else None,
        "history": prediction_history(pred) if ok else None,
        "rejects": rejects(pred) if ok else None,
        "metrics_kpis": metrics_kpis(metrics),
        "metrics_by_batch": metrics_by_batch(metrics),
        "metrics_display": metrics_display(metrics),
    }
    return views
