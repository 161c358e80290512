"""Registered queries: the live views over predictions and batch timings."""

from __future__ import annotations

from pyspark.sql import functions as F

from lookout.functions.paths import base_name, file_suffix, has_supported_suffix, matches_stream_glob, with_local_path
from lookout.operators import views as V
from lookout.plans import sqlfrag as Q
from lookout.plans import standins as S
from lookout.plans.catalog import register

W = S.with_ctes
P = S.PRED_SQL
CID = "TRY_CAST(prediction AS INTEGER)"


@register("total_images", W("SELECT CAST(count(*) AS BIGINT) AS total_images FROM pred", P))
def total_images(spark, sf):
    """A1: images analysed."""
    return V.total_images(S.predictions(spark, sf))


@register(
    "class_counts",
    W(
        f"""SELECT c.class_id, c.class_name, CAST(count(*) AS BIGINT) AS n_images
FROM pred p JOIN classes c ON {CID} = c.class_id GROUP BY c.class_id, c.class_name""",
        P,
        Q.classes_cte(),
    ),
)
def class_counts(spark, sf):
    """A2 + J1 + W6: images per known class, by class number."""
    return V.class_counts(S.predictions(spark, sf), spark)


@register(
    "class_share",
    W(
        f"""SELECT class_id, class_name, n_images,
       round(CAST(n_images AS DOUBLE) * 100.0 / CAST(sum(n_images) OVER () AS DOUBLE), 6) AS share_pct
FROM (SELECT c.class_id, c.class_name, CAST(count(*) AS BIGINT) AS n_images
      FROM pred p JOIN classes c ON {CID} = c.class_id GROUP BY c.class_id, c.class_name)""",
        P,
        Q.classes_cte(),
    ),
)
def class_share(spark, sf):
    """A3: share (%) per known class."""
    return V.class_share(S.predictions(spark, sf), spark)


@register(
    "class_counts_dense",
    W(
        f"""SELECT c.class_id, c.class_name, CAST(coalesce(t.n, 0) AS BIGINT) AS n_images
FROM classes c LEFT JOIN (SELECT {CID} AS class_id, count(*) AS n FROM pred GROUP BY 1) t
  ON c.class_id = t.class_id""",
        P,
        Q.classes_cte(),
    ),
)
def class_counts_dense(spark, sf):
    """J3 + A6: every class, zero when absent."""
    return V.class_counts_dense(S.predictions(spark, sf), spark)


def _describe_sql(src: str, extra: str = "") -> str:
    lp = Q.local_path("image")
    return f"""SELECT {extra} image, prediction, batch_id,
       {Q.class_label(CID)} AS class_label,
       {Q.short_label(Q.class_label(CID))} AS short_label,
       {Q.status(CID)} AS status,
       {lp} AS local_path,
       {Q.base_name(lp)} AS file_name
FROM {src}"""


@register(
    "latest_prediction",
    W(
        _describe_sql(
            "(SELECT * FROM pred ORDER BY batch_id DESC NULLS LAST, modification_time DESC NULLS LAST, "
            "image DESC NULLS LAST LIMIT 1)"
        ),
        P,
    ),
)
def latest_prediction(spark, sf):
    """W1 + P7 + F9-F11: newest prediction with label, status, file name."""
    return V.latest_prediction(S.predictions(spark, sf)).drop("modification_time")


@register(
    "recent_predictions",
    W(
        f"""SELECT rank, (rank - 1) % 4 AS slot, image, prediction, class_label, short_label, status, file_name
FROM ({_describe_sql(
            "(SELECT *, CAST(row_number() OVER (ORDER BY batch_id DESC NULLS LAST, modification_time DESC NULLS LAST, "
            "image DESC NULLS LAST) AS INTEGER) AS rank FROM pred QUALIFY rank <= 8)", "rank,")})""",
        P,
    ),
)
def recent_predictions(spark, sf):
    """Last 8 predictions, newest first, with gallery slot."""
    return V.recent_predictions(S.predictions(spark, sf), n=8, columns=4)


@register("prediction_history", W(f"SELECT image, {Q.class_name(CID)} AS class_name FROM pred", P))
def prediction_history(spark, sf):
    """(image, class name) for every row."""
    return V.prediction_history(S.predictions(spark, sf))


@register(
    "driver_status",
    W(
        f"""SELECT image, {CID} AS class_id, {Q.class_label(CID)} AS class_label,
       {Q.short_label(Q.class_label(CID))} AS short_label, {Q.status(CID)} AS status FROM pred""",
        P,
    ),
)
def driver_status(spark, sf):
    """P7 + F11: attentive / alert per row."""
    return V.driver_status(S.predictions(spark, sf))


@register(
    "unknown_rejects",
    W(
        f"""SELECT image, prediction, reason FROM (
  SELECT image, prediction,
         CASE WHEN {CID} IS NULL THEN 'unparsable_class'
              WHEN {Q.class_name(CID)} IS NULL THEN 'unknown_class' END AS reason
  FROM pred) WHERE reason IS NOT NULL""",
        P,
    ),
)
def unknown_rejects(spark, sf):
    """P5: unparsable or unknown classes."""
    return V.rejects(S.predictions(spark, sf))


M = S.METRICS_SQL


@register(
    "metrics_kpis",
    W(
        """SELECT round(avg(duration_ms), 6) AS avg_batch_ms,
       round(avg(ms_per_image), 6) AS avg_image_ms,
       round(CAST(sum(duration_ms) AS DOUBLE) / CAST(sum(num_images) AS DOUBLE), 6) AS weighted_image_ms,
       CAST(count(*) AS BIGINT) AS n_batches,
       CAST(count(DISTINCT batch_id) AS BIGINT) AS n_distinct_batches
FROM metrics""",
        M,
    ),
)
def metrics_kpis(spark, sf):
    """A4 (Q5, Q6): timing KPIs."""
    return V.metrics_kpis(S.metrics(spark, sf))


@register(
    "metrics_by_batch",
    W("SELECT batch_id, num_images, duration_ms, round(ms_per_image, 6) AS ms_per_image FROM metrics", M),
)
def metrics_by_batch(spark, sf):
    """W5 + A5: timings by batch id."""
    return V.metrics_by_batch(S.metrics(spark, sf))


@register(
    "metrics_display",
    W(
        """SELECT format('{:,.0f} ms', avg(duration_ms)) AS avg_batch_text,
       format('{:,.0f} ms', avg(ms_per_image)) AS avg_image_text,
       format('{:,}', count(*)) AS batches_text
FROM metrics""",
        M,
    ),
)
def metrics_display(spark, sf):
    """KPI texts as displayed."""
    return V.metrics_display(S.metrics(spark, sf))


def _exists_sql(kind: str) -> str:
    lp = Q.local_path("image")
    ll = Q.local_path("path")
    return W(
        f"""SELECT image, local_path, {Q.base_name('local_path')} AS file_name
FROM (SELECT image, {lp} AS local_path FROM pred) p
WHERE local_path {kind} (SELECT {ll} FROM listing)""",
        P,
        S.LISTING_SQL,
    )


@register("images_present", _exists_sql("IN"))
def images_present(spark, sf):
    """Predictions whose image file still exists."""
    return V.images_present(S.predictions(spark, sf), S.file_listing(spark, sf))


@register("images_missing", _exists_sql("NOT IN"))
def images_missing(spark, sf):
    """Predictions whose image file is gone."""
    return V.images_missing(S.predictions(spark, sf), S.file_listing(spark, sf))


@register(
    "normalised_paths",
    W(f"SELECT event_id, image, {Q.local_path('image')} AS local_path FROM uris", S.URI_FORMS_SQL),
)
def normalised_paths(spark, sf):
    """image URI -> local path."""
    return with_local_path(S.uri_forms(spark, sf), "image").select("event_id", "image", "local_path")


@register(
    "path_parts",
    W(
        f"""SELECT event_id, {Q.base_name('lp')} AS file_name, {Q.suffix('lp')} AS suffix,
       {Q.suffix('lp')} IN ('.jpg', '.jpeg', '.png', '.bmp') AS is_supported,
       (ends_with({Q.base_name('lp')}, '.png') OR ends_with({Q.base_name('lp')}, '.jpg')
        OR ends_with({Q.base_name('lp')}, '.jpeg')) AS matches_glob
FROM (SELECT event_id, {Q.local_path('image')} AS lp FROM uris)""",
        S.URI_FORMS_SQL,
    ),
)
def path_parts(spark, sf):
    """F10 + F12 + S2 + S3: base name, suffix, filters."""
    lp = F.col("local_path")
    return with_local_path(S.uri_forms(spark, sf), "image").select(
        "event_id",
        base_name(lp).alias("file_name"),
        file_suffix(lp).alias("suffix"),
        has_supported_suffix(lp).alias("is_supported"),
        matches_stream_glob(lp).alias("matches_glob"),
    )


# Parts written before the writer carried ``batch_id`` (the first
# UNION_CUT batches) lack that column.
UNION_CUT = 10


@register(
    "union_parts",
    W(
        f"""SELECT image, prediction, batch_id FROM pred WHERE batch_id >= {UNION_CUT}
UNION ALL SELECT image, prediction, NULL FROM pred WHERE batch_id < {UNION_CUT}""",
        P,
    ),
)
def union_parts(spark, sf):
    """Union by name, missing column null."""
    p = S.predictions(spark, sf)
    new = p.where(F.col("batch_id") >= UNION_CUT).select("image", "prediction", "batch_id")
    old = p.where(F.col("batch_id") < UNION_CUT).select("image", "prediction")
    return V.union_parts(new, old)
