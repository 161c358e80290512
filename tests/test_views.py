"""Live views on edge tables: empty, fewer rows than the gallery, only
unknown classes, Q5/Q6 metric semantics."""

from lookout.operators import views as V
from lookout.sources.tables import METRICS_SCHEMA, PREDICTION_SCHEMA


def _pred(spark, rows):
    return spark.createDataFrame(rows, PREDICTION_SCHEMA)


def test_empty_tables(spark):
    pred = _pred(spark, [])
    assert not V.has_required_columns(pred)
    assert V.total_images(pred).first().total_images == 0
    assert V.class_counts(pred).count() == 0
    dense = V.class_counts_dense(pred).collect()
    assert len(dense) == 10 and all(r.n_images == 0 for r in dense)
    assert V.latest_prediction(pred).count() == 0 and V.recent_predictions(pred).count() == 0
    k = V.metrics_kpis(spark.createDataFrame([], METRICS_SCHEMA)).first()
    assert k.n_batches == 0 and k.avg_batch_ms is None


def test_fewer_rows_than_gallery_and_unknown_only(spark):
    pred = _pred(spark, [("file:/i/a.png", "10", 0, None), ("file:/i/b.png", "x", 1, None)])
    recent = V.recent_predictions(pred, n=8).orderBy("rank").collect()
    assert [r.file_name for r in recent] == ["b.png", "a.png"] and [r.slot for r in recent] == [0, 1]
    assert all(r.class_label == "Inconnu" and r.status == "alert" for r in recent)
    assert V.class_counts(pred).count() == 0 and V.class_share(pred).count() == 0
    assert sorted(r.reason for r in V.rejects(pred).collect()) == ["unknown_class", "unparsable_class"]


def test_metric_kpis_semantics(spark):
    # Q5: the mean of per-batch ratios is not total ms / total images;
    # Q6: metric rows and distinct batch ids are both reported.
    rows = [(0, 1, 100, 100.0), (1, 3, 30, 10.0), (0, 1, 50, 50.0)]
    k = V.metrics_kpis(spark.createDataFrame(rows, METRICS_SCHEMA)).first()
    assert k.avg_image_ms == round((100 + 10 + 50) / 3, 6)
    assert k.weighted_image_ms == round(180 / 5, 6)
    assert k.avg_batch_ms == 60.0 and k.n_batches == 3 and k.n_distinct_batches == 2
    d = V.metrics_display(spark.createDataFrame(rows, METRICS_SCHEMA)).first()
    assert (d.avg_batch_text, d.avg_image_text, d.batches_text) == ("60 ms", "53 ms", "3")
