"""Registered queries: scores, argmax, softmax, the linear head, and the
evaluation tables over the ``scored`` stand-in."""

from __future__ import annotations

from pyspark.sql import functions as F

from lookout.classes import NUM_CLASSES
from lookout.functions import arrays as A
from lookout.operators import evaluation as E
from lookout.plans import sqlfrag as Q
from lookout.plans import standins as S
from lookout.plans.catalog import register
from lookout.sources.tables import table

W = S.with_ctes
K = NUM_CLASSES
# scored + y_pred as the first argmax of the scores.
SCORED_PRED = (
    "scored_pred AS (SELECT vec_id, y_true, scores, "
    "CAST(list_position(scores, list_max(scores)) - 1 AS INTEGER) AS y_pred FROM scored)"
)


def scored_with_pred(spark, sf):
    s = S.scored(spark, sf)
    return s.withColumn("y_pred", A.argmax("scores"))


@register(
    "argmax_class",
    W(
        "SELECT vec_id, y_pred, CAST(y_pred AS VARCHAR) AS prediction FROM scored_pred",
        S.SCORED_SQL,
        SCORED_PRED,
    ),
)
def argmax_class(spark, sf):
    """F5 + F6: first argmax as class index and text."""
    s = scored_with_pred(spark, sf)
    return s.select("vec_id", "y_pred", F.col("y_pred").cast("string").alias("prediction"))


SOFTMAX_SQL = """SELECT vec_id, list_transform(e, lambda x: round(x / list_sum(e), 6)) AS probs
FROM (SELECT vec_id, list_transform(s, lambda x: exp(x - list_max(s))) AS e
      FROM (SELECT vec_id, list_transform(scores, lambda x: CAST(x AS DOUBLE)) AS s FROM scored))"""


@register("softmax_scores", W(SOFTMAX_SQL, S.SCORED_SQL))
def softmax_scores(spark, sf):
    """F8: softmax of the scores."""
    s = S.scored(spark, sf)
    return s.select("vec_id", A.round_all(A.softmax("scores"), 6).alias("probs"))


@register(
    "linear_scores",
    f"""SELECT vec_id, list_transform(sc, lambda x: round(x, 6)) AS scores,
       CAST(list_position(sc, list_max(sc)) - 1 AS INTEGER) AS prediction
FROM (SELECT vec_id, {Q.linear_sql('embedding')} AS sc FROM embeddings)""",
)
def linear_scores(spark, sf):
    """Rule-defined linear head as expressions."""
    emb = table(spark, sf, "embeddings")
    sc = emb.select("vec_id", A.linear_scores("embedding", K).alias("sc"))
    return sc.select("vec_id", A.round_all("sc", 6).alias("scores"), A.argmax("sc").alias("prediction"))


# The class axis: 0..K-1 and every label that the counts hold.
GRID = (
    f"axis AS (SELECT CAST(i AS INTEGER) AS c FROM range({K}) t(i) UNION SELECT y_true FROM scored_pred "
    "UNION SELECT y_pred FROM scored_pred), "
    "grid AS (SELECT t.c AS y_true, p.c AS y_pred FROM axis t, axis p)"
)
CM_CTE = (
    "cm AS (SELECT g.y_true, g.y_pred, coalesce(c.n, 0) AS n FROM grid g LEFT JOIN "
    "(SELECT y_true, y_pred, count(*) AS n FROM scored_pred GROUP BY 1, 2) c "
    "ON g.y_true = c.y_true AND g.y_pred = c.y_pred)"
)
CM_SQL = W(
    """SELECT g.y_true, g.y_pred, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM grid g LEFT JOIN (SELECT y_true, y_pred, count(*) AS n FROM scored_pred GROUP BY 1, 2) c
  ON g.y_true = c.y_true AND g.y_pred = c.y_pred""",
    S.SCORED_SQL,
    SCORED_PRED,
    GRID,
)


@register("confusion_long", CM_SQL)
def confusion_long(spark, sf):
    """A10: confusion matrix, long form, dense."""
    return E.confusion_long(scored_with_pred(spark, sf), K)


@register(
    "confusion_wide",
    W(
        "SELECT y_true, "
        + ", ".join(f"CAST(sum(CASE WHEN y_pred = {i} THEN n ELSE 0 END) AS BIGINT) AS p{i}" for i in range(K))
        + " FROM cm GROUP BY y_true",
        S.SCORED_SQL,
        SCORED_PRED,
        GRID,
        CM_CTE,
    ),
)
def confusion_wide(spark, sf):
    """A10: confusion matrix, pivoted."""
    return E.confusion_wide(scored_with_pred(spark, sf), K)


REPORT_SQL = W(
    """SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1_score, 6) AS f1_score, CAST(support AS BIGINT) AS support
FROM (
  SELECT class_name AS label, precision, recall, f1 AS f1_score, support FROM stats
  UNION ALL
  SELECT 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
         CASE WHEN sum(support) > 0 THEN CAST(sum(tp) AS DOUBLE) / sum(support) ELSE 0 END, sum(support) FROM stats
  UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM stats
  UNION ALL
  SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(f1 * support) / sum(support), sum(support) FROM stats)""",
    S.SCORED_SQL,
    SCORED_PRED,
    GRID,
    CM_CTE,
    Q.classes_cte(),
    """base AS (
  SELECT t.class_id, t.tp, t.support, p.predicted,
         CASE WHEN p.predicted > 0 THEN CAST(t.tp AS DOUBLE) / p.predicted ELSE 0.0 END AS precision,
         CASE WHEN t.support > 0 THEN CAST(t.tp AS DOUBLE) / t.support ELSE 0.0 END AS recall
  FROM (SELECT y_true AS class_id, sum(CASE WHEN y_true = y_pred THEN n ELSE 0 END) AS tp, sum(n) AS support
        FROM cm GROUP BY 1) t
  JOIN (SELECT y_pred AS class_id, sum(n) AS predicted FROM cm GROUP BY 1) p ON t.class_id = p.class_id)""",
    """stats AS (
  SELECT b.*, coalesce(c.class_name, CAST(b.class_id AS VARCHAR)) AS class_name,
         CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM base b LEFT JOIN classes c ON b.class_id = c.class_id)""",
)


@register("classification_report", REPORT_SQL)
def classification_report(spark, sf):
    """Precision / recall / F1 / support + averages."""
    return E.classification_report(scored_with_pred(spark, sf), K)


@register(
    "evaluate_loss_accuracy",
    W(
        """SELECT round(avg(-ln(least(greatest(p_true, 1e-7), 1 - 1e-7))), 6) AS loss,
       round(avg(CASE WHEN y_pred = y_true THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT y_true, y_pred, coalesce(e[y_true + 1], 0) / list_sum(e) AS p_true
      FROM (SELECT y_true, y_pred,
                   list_transform(s, lambda x: exp(x - list_max(s))) AS e
            FROM (SELECT y_true, y_pred, list_transform(scores, lambda x: CAST(x AS DOUBLE)) AS s FROM scored_pred)))""",
        S.SCORED_SQL,
        SCORED_PRED,
    ),
)
def evaluate_loss_accuracy(spark, sf):
    """Cross-entropy loss and accuracy."""
    return E.loss_accuracy(scored_with_pred(spark, sf), from_logits=True)
