"""Stand-in tables derived from the driver tables (FIXTURES.md B).

The reference ships no prediction, metrics or image data, so its tables are
derived from ``events`` and ``embeddings``; every query therefore grows with
the driver tables. Each builder has a DuckDB twin (``*_SQL``) used as a CTE
by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lookout.classes import NUM_CLASSES
from lookout.functions.arrays import linear_scores
from lookout.plans.sqlfrag import linear_sql
from lookout.sources.tables import table

# Prefix of the stand-in image URIs: a URI form with an encoded space.
URI_PREFIX = "file:///mnt/c/data%20set/"
LISTING_PREFIX = "/mnt/c/data set/"
# Rows per stand-in micro-batch.
BATCH_ROWS = 500


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pred``: one prediction row per event; class ``user_id % 11`` so that
    class 10 exercises the unknown label."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(
            F.lit(URI_PREFIX), F.col("event_type"), F.lit("+"), F.col("event_id").cast("string"), F.lit(".jpg")
        ).alias("image"),
        (F.col("user_id") % 11).cast("string").alias("prediction"),
        F.expr(f"event_id div {BATCH_ROWS}").alias("batch_id"),
        F.col("ts").alias("modification_time"),
        F.col("event_id"),
    )


PRED_SQL = f"""pred AS (
  SELECT concat('{URI_PREFIX}', event_type, '+', CAST(event_id AS VARCHAR), '.jpg') AS image,
         CAST(user_id % 11 AS VARCHAR) AS prediction,
         event_id // {BATCH_ROWS} AS batch_id,
         ts AS modification_time,
         event_id
  FROM events)"""


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``metrics``: one timing row per stand-in batch; integer durations so the
    averages are exact in both engines."""
    ev = table(spark, sf_dir, "events")
    return (
        ev.groupBy(F.expr(f"event_id div {BATCH_ROWS}").alias("batch_id"))
        .agg(
            F.count(F.lit(1)).alias("num_images"),
            F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("duration_ms"),
        )
        .withColumn("ms_per_image", F.col("duration_ms").cast("double") / F.col("num_images"))
    )


METRICS_SQL = f"""metrics AS (
  SELECT batch_id, num_images, duration_ms, CAST(duration_ms AS DOUBLE) / num_images AS ms_per_image
  FROM (SELECT event_id // {BATCH_ROWS} AS batch_id, CAST(count(*) AS BIGINT) AS num_images,
               CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS duration_ms
        FROM events GROUP BY 1))"""


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``existing_paths``: the image folder as a file listing would show it
    (plain, not URL-encoded paths). Files of ``error`` events were removed."""
    ev = table(spark, sf_dir, "events")
    return ev.where(F.col("event_type") != "error").select(
        F.concat(
            F.lit("file:" + LISTING_PREFIX), F.col("event_type"), F.lit("+"), F.col("event_id").cast("string"),
            F.lit(".jpg"),
        ).alias("path")
    )


LISTING_SQL = f"""listing AS (
  SELECT concat('file:{LISTING_PREFIX}', event_type, '+', CAST(event_id AS VARCHAR), '.jpg') AS path
  FROM events WHERE event_type <> 'error')"""


def uri_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image identities in every form the viewer meets: encoded URIs, drive
    letters, relative paths, backslashes, upper-case suffixes. One form per
    event type."""
    ev = table(spark, sf_dir, "events")
    n = F.col("event_id").cast("string")
    et = F.col("event_type")
    uri = (
        F.when(et == "click", F.concat(F.lit("file:///mnt/c/data%20set/c"), (F.col("user_id") % 10).cast("string"), F.lit("/img_"), n, F.lit(".jpg")))
        .when(et == "view", F.concat(F.lit("C:/Users/pilot/img "), n, F.lit(".PNG")))
        .when(et == "error", F.concat(F.lit("data/test-images/sub\\img_"), n, F.lit(".Jpeg")))
        .when(et == "purchase", F.concat(F.lit("file:/D:/shots/img%2B"), n, F.lit(".bmp")))
        .otherwise(F.concat(F.lit("////var/img/"), n, F.lit(".txt")))
    )
    return ev.select(F.col("event_id"), uri.alias("image"))


URI_FORMS_SQL = """uris AS (
  SELECT event_id,
    CASE WHEN event_type = 'click' THEN concat('file:///mnt/c/data%20set/c', CAST(user_id % 10 AS VARCHAR), '/img_', CAST(event_id AS VARCHAR), '.jpg')
         WHEN event_type = 'view' THEN concat('C:/Users/pilot/img ', CAST(event_id AS VARCHAR), '.PNG')
         WHEN event_type = 'error' THEN concat('data/test-images/sub\\img_', CAST(event_id AS VARCHAR), '.Jpeg')
         WHEN event_type = 'purchase' THEN concat('file:/D:/shots/img%2B', CAST(event_id AS VARCHAR), '.bmp')
         ELSE concat('////var/img/', CAST(event_id AS VARCHAR), '.txt') END AS image
  FROM events)"""


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``feat``: a labelled feature table, 0..255 integer pixels (an 8x8x1
    tensor per row)."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id"),
        F.col("label"),
        F.transform("embedding", lambda x: F.floor((x.cast("double") + 1) * 127.5).cast("int")).alias("pixels"),
    )


FEAT_SQL = """feat AS (
  SELECT vec_id, label,
         list_transform(embedding, lambda x: CAST(floor((CAST(x AS DOUBLE) + 1) * 127.5) AS INTEGER)) AS pixels
  FROM embeddings)"""


# One row in so many has a true label outside the class dimension.
ODD_LABEL_EVERY = 97


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scored``: an evaluation set. The class scores are those of the
    rule-defined linear head over the whole vector; some true labels lie
    outside 0..9, as in real label files."""
    emb = table(spark, sf_dir, "embeddings")
    odd = F.when(F.col("vec_id") % ODD_LABEL_EVERY == 0, 10).otherwise(0)
    return emb.select(
        F.col("vec_id"),
        (F.col("label") + odd).cast("int").alias("y_true"),
        linear_scores("embedding", NUM_CLASSES).alias("scores"),
    )


SCORED_SQL = f"""scored AS (
  SELECT vec_id, CAST(label + CASE WHEN vec_id % {ODD_LABEL_EVERY} = 0 THEN 10 ELSE 0 END AS INTEGER) AS y_true,
         {linear_sql("embedding")} AS scores FROM embeddings)"""


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
