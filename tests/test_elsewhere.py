"""README's usage from a session that knows the library on the driver's path
only, in another folder."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

RUN = """
import sys
sys.path.append(sys.argv[1])
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local-cluster[1,2,1024]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[2] + "/ckpt").config("spark.sql.shuffle.partitions", "2").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
import numpy as np
from lookout.plans.fixtures import encode_png
import os
for split in ("in", "train/c0", "train/c1"):
    os.makedirs(f"{sys.argv[2]}/{split}")
    for i in range(5):
        px = np.random.default_rng(i).integers(0, 256, 8 * 8)
        open(f"{sys.argv[2]}/{split}/{i}.png", "wb").write(encode_png(px, 8, 8, 1))
from lookout.streaming.classify import read_live_table, start_image_classifier, start_live_class_counts
from lookout.operators import dataset, evaluation, scoring, views
w = sys.argv[2]
for fmt in ("parquet", "csv"):
    q = start_image_classifier(spark, f"{w}/in", f"{w}/{fmt}/predictions", f"{w}/{fmt}/metrics", f"{w}/{fmt}/checkpoint",
                               height=8, width=8, max_files_per_trigger=3, fmt=fmt)
    q.awaitTermination()
    page = views.page(spark, f"{w}/{fmt}/predictions", f"{w}/{fmt}/metrics", fmt=fmt)
    assert page["total_images"].first().total_images == 5, fmt
table = dataset.prepare_dataset(spark, f"{w}/train", f"{w}/features", 8, 8, factor=2)
assert table.count() == 10 + 2 * table.where("split = 'train' AND aug_index = 0").count()
m = scoring.LinearModel.rule(8 * 8 * 3)
scored = scoring.with_scores(table, "pixels", scoring.score_udf(m.make_predict_fn(), [8, 8, 3]))
report = evaluation.classification_report(scored.selectExpr("path AS vec_id", "label AS y_true", "y_pred", "scores"))
assert report.where("label = 'accuracy'").count() == 1
print("all", "well")
"""


def test_readme_usage_from_another_folder():
    work = tempfile.mkdtemp(prefix="lookout-elsewhere-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    done = subprocess.run(
        [sys.executable, "-c", RUN, ROOT, work], cwd=work, env=env, capture_output=True, text=True, timeout=600
    )
    assert "all well" in done.stdout, done.stderr[-3000:]
