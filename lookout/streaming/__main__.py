"""Run the classification stream (the consumer):

    python -m lookout.streaming --input DIR --output DIR [--metrics DIR]
        [--checkpoint DIR] [--size 64] [--model model.onnx]
        [--max-files-per-trigger N | --max-bytes-per-trigger SIZE]
        [--trigger-seconds S | --available-now] [--csv]
        [--archive DIR | --delete-read] [--newest-first] [--max-file-age AGE]

Without ``--model`` the rule-defined linear head scores the images. The
session comes from ``spark-submit`` / the cluster configuration.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from lookout.operators.scoring import onnx_predict_fn
from lookout.sources.images import StreamLimits
from lookout.streaming.classify import start_image_classifier


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="python -m lookout.streaming")
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--metrics")
    ap.add_argument("--rejects")
    ap.add_argument("--checkpoint")
    ap.add_argument("--size", type=int, default=64)
    ap.add_argument("--model")
    ap.add_argument("--max-files-per-trigger", type=int)
    ap.add_argument("--max-bytes-per-trigger", help="such as 512m")
    ap.add_argument("--archive", help="files of finished batches move below this folder")
    ap.add_argument("--delete-read", action="store_true", help="files of finished batches are deleted")
    ap.add_argument("--newest-first", action="store_true")
    ap.add_argument("--max-file-age", help="such as 7d: older files are left out")
    ap.add_argument("--trigger-seconds", type=float)
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--csv", action="store_true")
    ap.add_argument("--antialias", action="store_true", help="area-aware bilinear when downsizing")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName("lookout-consumer").getOrCreate()
    metrics = a.metrics or os.path.join(os.path.dirname(a.output.rstrip("/")), "metrics")
    checkpoint = a.checkpoint or os.path.join(os.path.dirname(a.output.rstrip("/")), "checkpoint")
    if a.model:
        spark.sparkContext.addFile(a.model)
    # Without a flag the consumer waits for new files for ever, each batch
    # following the one before it.
    trigger = {"availableNow": True} if a.available_now else {"processingTime": f"{a.trigger_seconds or 0} seconds"}
    q = start_image_classifier(
        spark,
        a.input,
        a.output,
        metrics,
        checkpoint,
        height=a.size,
        width=a.size,
        make_predict_fn=onnx_predict_fn(a.model) if a.model else None,
        max_files_per_trigger=a.max_files_per_trigger,
        trigger=trigger,
        fmt="csv" if a.csv else "parquet",
        antialias=a.antialias,
        rejects_dir=a.rejects,
        limits=StreamLimits(
            max_bytes=a.max_bytes_per_trigger,
            newest_first=a.newest_first,
            max_age=a.max_file_age,
            clean="archive" if a.archive else "delete" if a.delete_read else None,
            archive_dir=a.archive,
        ),
    )
    print(f"[lookout] streaming images from {a.input} -> {a.output}", flush=True)
    q.awaitTermination()


if __name__ == "__main__":
    main()
