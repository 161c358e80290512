"""Idempotent micro-batch sink.

Every micro-batch writes its predictions, its rejects and its timing row to
folders of their own and then commits them (:mod:`lookout.sources.commits`).
A batch replayed after a failure (the checkpoint commits after the sink)
replaces all that an earlier attempt wrote, whole: rows that are rejects in the
second attempt are no predictions any more. A *run* is the life of one
checkpoint: its id is written into the checkpoint's folder once, so a restart,
or a copy of the checkpoint, goes on in the same run, while a new checkpoint,
or a second consumer on the same folder, never touches what another one wrote.
Run ids sort by the time they began.

The row count comes from an ``Observation`` on the write itself, so the batch
is computed once -- no ``persist`` + ``count`` second pass. When the batch
carries an ``error`` column, rows with an error go to the rejects table (same
run and batch) and the narrow scored batch is persisted for those two writes,
so decoding and scoring still run once.
"""

from __future__ import annotations

import json
import time

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lookout.session import prepare
from lookout.sources.commits import EMPTY, Files, commit, csv_options, newest_batch, write_attempt, write_row

FIRST_RUN = "first"
RUN_FILE = "lookout_run"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """Run id of a checkpoint: when its metadata was first written, and the
    query id in it. It is kept in a file of the checkpoint's folder, as file
    times change when a folder is copied."""
    files = Files(spark, checkpoint)
    kept = f"{checkpoint}/{RUN_FILE}"
    if files.exists(kept):
        return files.read(kept)
    where = files.path(checkpoint, "metadata")
    began = files.fs.getFileStatus(where).getModificationTime()
    run = f"{began:015d}-{json.loads(files.read(f'{checkpoint}/metadata'))['id'][:8]}"
    files.write(f"{kept}.draft", run)
    files.rename(f"{kept}.draft", kept)
    return run


def write_partition(df: DataFrame, path: str, fmt: str = "parquet", header: bool = True, rebalance: bool = True) -> None:
    """Write ``df`` into ``<path>/[run_id=<run>/]batch_id=<id>/``, replacing
    only the partitions present (dynamic partition overwrite). With
    ``rebalance`` the rows are grouped by batch id first (AQE splits a large
    batch into files of the advisory size), so each batch gets a few files
    rather than one per input task."""
    if rebalance:
        df = df.hint("rebalance", "batch_id")
    parts = [c for c in ("run_id", "batch_id") if c in df.columns]
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
    writer.format(fmt).options(**csv_options(fmt, header)).save(path)


class BatchSink:
    """``foreachBatch`` callable: ``(batch_df, batch_id)``. ``checkpoint``
    names the run; without it all batches belong to ``run_id``."""

    def __init__(
        self,
        output_dir: str,
        metrics_dir: str | None = None,
        fmt: str = "parquet",
        rejects_dir: str | None = None,
        checkpoint: str | None = None,
        run_id: str = FIRST_RUN,
    ):
        self.output_dir = output_dir
        self.metrics_dir = metrics_dir
        self.fmt = fmt
        self.rejects_dir = rejects_dir
        self.checkpoint = checkpoint
        self._run = None if checkpoint else run_id
        self._newest: dict[str, int] = {}

    def run(self, spark: SparkSession) -> str:
        if self._run is None:
            self._run = run_of(spark, self.checkpoint)
        return self._run

    def commit(self, spark: SparkSession, path: str, batch_id: int, attempt: str) -> None:
        """A checkpoint has one writer, whose batches come in order: the log,
        which grows with them, is listed at the first one and for replays."""
        run = self.run(spark)
        if self.checkpoint and path not in self._newest:
            self._newest[path] = newest_batch(spark, path, run)
        new = bool(self.checkpoint) and batch_id > self._newest[path]
        commit(spark, path, run, batch_id, attempt, new)
        if new:
            self._newest[path] = batch_id

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prepare(spark)
        obs, seen = Observation(f"batch_{batch_id}"), Observation(f"batch_{batch_id}_seen")
        start = time.time()
        run = self.run(spark)
        split = "error" in batch.columns
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK) if split else batch
        rejected = EMPTY
        try:
            good = rows
            if split:
                good = rows.observe(seen, F.count("error").alias("bad")).where(F.col("error").isNull()).drop("error")
            # rebalance: AQE sizes the output files (a few per batch, not one
            # per input task) by shuffling the narrow result rows only
            # (the observation sits above the rebalance: below it, an empty
            # batch would lose its metrics)
            good = good.hint("rebalance").observe(obs, F.count(F.lit(1)).alias("n"))
            attempt = write_attempt(good, self.output_dir, run, batch_id, self.fmt)
            if split and self.rejects_dir:
                bad = rows.where(F.col("error").isNotNull()).drop("prediction")
                # Most batches have no rejects, and the write above has told so;
                # if nothing good was left for it, it may have told nothing.
                if seen.get.get("bad") != 0 and not bad.isEmpty():
                    rejected = write_attempt(bad.hint("rebalance"), self.rejects_dir, run, batch_id, self.fmt)
        finally:
            if split:
                rows.unpersist()
        n = int(obs.get.get("n", 0) or 0)
        duration_ms = int(round((time.time() - start) * 1000))
        timing = EMPTY
        if n and self.metrics_dir:  # P3: an empty batch leaves no metrics row
            per_image = duration_ms / n
            if self.fmt == "parquet":
                row = {"num_images": n, "duration_ms": duration_ms, "ms_per_image": per_image}
                timing = write_row(spark, pa.Table.from_pylist([row]), self.metrics_dir, run, batch_id)
            else:
                # One row from literals: a JVM-only plan of one task, no Python worker per batch.
                metrics = spark.range(0, 1, 1, 1).select(
                    F.lit(n).cast("bigint").alias("num_images"),
                    F.lit(duration_ms).cast("bigint").alias("duration_ms"),
                    F.lit(per_image).alias("ms_per_image"),
                )
                timing = write_attempt(metrics, self.metrics_dir, run, batch_id, self.fmt)
        # Each table changes at its commit, the predictions last. If the driver
        # is lost in between, Spark runs the batch again and all are replaced.
        if split and self.rejects_dir:
            self.commit(spark, self.rejects_dir, batch_id, rejected)
        if self.metrics_dir:
            self.commit(spark, self.metrics_dir, batch_id, timing)
        self.commit(spark, self.output_dir, batch_id, attempt if n else EMPTY)
