"""Model evaluation tables (A10-A12): confusion matrix, classification
report, loss and accuracy.

One aggregation over the scored rows produces the (true, predicted) count
table -- at most K x K rows, partial-aggregated per task, so a hot class
costs nothing extra; everything after it runs on that small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.classes import NUM_CLASSES, class_dim
from lookout.functions.arrays import softmax
from lookout.session import prepare

# Keras clips probabilities to [eps, 1 - eps] before the log.
EPSILON = 1e-7


def _axis(counts: DataFrame, k: int) -> DataFrame:
    """One row with the class axis as a sorted array: 0..k-1 and every label
    that the (true, predicted) counts hold (one entry per label)."""
    seen = counts.agg(F.collect_set("y_true").alias("t"), F.collect_set("y_pred").alias("p"))
    return seen.select(
        F.array_sort(F.array_distinct(F.concat(F.sequence(F.lit(0), F.lit(k - 1)), "t", "p"))).alias("axis")
    )


def class_grid(counts: DataFrame, k: int = NUM_CLASSES) -> DataFrame:
    """All (y_true, y_pred) pairs of the class axis, by two generators over
    the one-row axis (no join)."""
    rows = _axis(counts, k).select(F.explode("axis").alias("y_true"), "axis")
    return rows.select("y_true", F.explode("axis").alias("y_pred"))


def _counts(scored: DataFrame) -> DataFrame:
    """Rows per (true, predicted) pair; rows without either label belong to
    no cell."""
    known = scored.where(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())
    return known.groupBy(F.col("y_true").cast("int").alias("y_true"), F.col("y_pred").cast("int").alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_long(scored: DataFrame, k: int = NUM_CLASSES) -> DataFrame:
    """A10, long form: one row per (true, predicted) pair incl. zeros, for
    the classes 0..k-1 and every other label that occurs."""
    prepare(scored.sparkSession)
    counts = _counts(scored).checkpoint()  # one row per pair: a small table, read twice
    return (
        class_grid(counts, k)
        .join(counts, ["y_true", "y_pred"], "left")
        .select("y_true", "y_pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    )


def confusion_wide(scored: DataFrame, k: int = NUM_CLASSES) -> DataFrame:
    """A10, matrix form: rows = true class, columns ``p<c>`` = predicted
    class, for 0..k-1 and every other label that occurs on either side of
    its axis."""
    prepare(scored.sparkSession)
    counts = _counts(scored).checkpoint()
    rows = _axis(counts, k).select(F.explode("axis").alias("y_true"))
    predicted = sorted({*range(k), *(r["y_pred"] for r in counts.select("y_pred").distinct().collect())})
    wide = counts.groupBy("y_true").pivot("y_pred", predicted).agg(F.sum("n"))
    return rows.join(wide, "y_true", "left").select(
        "y_true", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint").alias(f"p{c}") for c in predicted]
    )


def _ratio(num, den):
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def classification_report(scored: DataFrame, k: int = NUM_CLASSES, digits: int = 6) -> DataFrame:
    """Precision, recall, F1 and support per class (0 when undefined),
    then ``accuracy``, ``macro avg`` and ``weighted avg`` rows.

    The scored rows are aggregated once into the (true, predicted) table,
    which :func:`confusion_long` has cut off by a checkpoint; the branches
    below work on that small table and never on the data."""
    cm = confusion_long(scored, k)
    per = cm.groupBy(F.col("y_true").alias("class_id")).agg(
        F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum("n").alias("support"),
    )
    predicted = cm.groupBy(F.col("y_pred").alias("class_id")).agg(F.sum("n").alias("predicted"))
    stats = per.join(predicted, "class_id")
    p = _ratio(F.col("tp"), F.col("predicted"))
    r = _ratio(F.col("tp"), F.col("support"))
    stats = stats.select("class_id", "tp", "support", p.alias("precision"), r.alias("recall"))
    stats = stats.withColumn(
        "f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )
    names = class_dim(scored.sparkSession)
    # A label outside the dimension is shown as its number.
    per_class = stats.join(names, "class_id", "left").select(
        F.coalesce("class_name", F.col("class_id").cast("string")).alias("label"), "precision", "recall", F.col("f1").alias("f1_score"), "support"
    )
    totals = stats.agg(
        F.sum("tp").alias("tp"),
        F.sum("support").alias("n"),
        F.avg("precision").alias("mp"),
        F.avg("recall").alias("mr"),
        F.avg("f1").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"),
    )
    acc = totals.select(
        F.lit("accuracy").alias("label"),
        F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
        _ratio(F.col("tp"), F.col("n")).alias("f1_score"),
        F.col("n").alias("support"),
    )
    macro = totals.select(
        F.lit("macro avg").alias("label"), F.col("mp"), F.col("mr"), F.col("mf"), F.col("n")
    ).toDF("label", "precision", "recall", "f1_score", "support")
    weighted = totals.select(
        F.lit("weighted avg").alias("label"),
        _ratio(F.col("wp"), F.col("n")),
        _ratio(F.col("wr"), F.col("n")),
        _ratio(F.col("wf"), F.col("n")),
        F.col("n"),
    ).toDF("label", "precision", "recall", "f1_score", "support")
    out = per_class.unionByName(acc).unionByName(macro).unionByName(weighted)
    return out.select(
        "label",
        *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f1_score")],
        F.col("support").cast("bigint").alias("support"),
    )


def loss_accuracy(scored: DataFrame, from_logits: bool = True, digits: int = 6) -> DataFrame:
    """Mean sparse categorical cross-entropy (probabilities clipped to
    ``[1e-7, 1 - 1e-7]``) and accuracy of a scored set, in one pass. With
    ``from_logits`` the scores go through softmax first."""
    probs = softmax("scores") if from_logits else F.col("scores")
    # A true label without a score has probability 0.
    p_true = F.coalesce(F.get(probs, F.col("y_true").cast("int")), F.lit(0.0))
    clipped = F.least(F.greatest(p_true, F.lit(EPSILON)), F.lit(1 - EPSILON))
    return scored.agg(
        F.round(F.avg(-F.log(clipped)), digits).alias("loss"),
        F.round(F.avg((F.col("y_pred") == F.col("y_true")).cast("double")), digits).alias("accuracy"),
        F.count(F.lit(1)).alias("n_rows"),
    )
