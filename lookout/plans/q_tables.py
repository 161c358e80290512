"""Registered queries: what long-running streams and their tables need --
commit log and compaction (T2, S9, S10), state that survives a restart (T3,
T4), file lifecycle and admission (S1, S13, S14), part files of several
layouts and their order (S7, S8, U1, W4), missing tables (S15, P3, P4)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookout.operators import views as V
from lookout.plans import sqlfrag as Q
from lookout.plans import standins as S
from lookout.plans.catalog import register
from lookout.plans.q_streaming import _as_predictions
from lookout.session import work_dir
from lookout.sources import commits as K
from lookout.sources import images as I
from lookout.sources.tables import (
    METRICS_SCHEMA,
    PREDICTION_SCHEMA,
    RUN_PREDICTION_SCHEMA,
    read_or_empty,
    read_part_csvs,
    table,
)
from lookout.streaming import classify as C
from lookout.streaming.sink import BatchSink

W = S.with_ctes
PARTS = 4


def _event_files(spark, sf, folder: str, part: int | None = None) -> None:
    """The prediction stand-in as ``PARTS`` Parquet files (or one of them)."""
    rows = _as_predictions(table(spark, sf, "events")).withColumn("_part", F.expr(f"pmod(xxhash64(image), {PARTS})"))
    if part is None:
        rows.repartitionById(PARTS, F.col("_part").cast("int")).drop("_part").write.mode("append").parquet(folder)
    else:
        rows.where(F.col("_part") == part).drop("_part").coalesce(1).write.mode("append").parquet(folder)


def _file_stream(spark, sf, folder: str):
    schema = _as_predictions(table(spark, sf, "events")).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


@register(
    "stream_replay_rejects",
    W(
        """SELECT 'prediction' AS kind, image FROM pred WHERE prediction <> '10'
UNION ALL SELECT 'reject', image FROM pred WHERE prediction = '10'""",
        S.PRED_SQL,
    ),
)
def stream_replay_rejects(spark, sf):
    """A batch whose rows are all scored at first and partly rejected
    when it is replayed: each row is in one table only afterwards."""
    base = work_dir(spark, "replay")
    sink = BatchSink(f"{base}/predictions", f"{base}/metrics", rejects_dir=f"{base}/rejects")
    rows = _as_predictions(table(spark, sf, "events"))
    none = F.lit(None).cast("string")
    sink(rows.withColumn("error", none), 0)
    sink(rows.withColumn("error", F.when(F.col("prediction") == "10", "unreadable")), 0)
    good = read_or_empty(spark, f"{base}/predictions", PREDICTION_SCHEMA)
    bad = read_or_empty(spark, f"{base}/rejects", T.StructType.fromDDL("image string, error string"))
    return good.select(F.lit("prediction").alias("kind"), "image").unionByName(
        bad.select(F.lit("reject").alias("kind"), "image")
    )


@register(
    "stream_compaction",
    W("SELECT image, prediction, CAST(1 AS BIGINT) AS copies, CAST(2 AS BIGINT) AS folders FROM pred", S.PRED_SQL),
)
def stream_compaction(spark, sf):
    """Batches of a stream rewritten into few files; then a batch
    comes, one from before is replayed, and both are compacted again. Every
    row is there once, in two compacted folders at last."""
    base = work_dir(spark, "compaction")
    src, out = f"{base}/source", f"{base}/predictions"
    _event_files(spark, sf, src)
    q = C.start_table_stream(_file_stream(spark, sf, src), out, None, f"{base}/checkpoint")
    q.awaitTermination()
    K.compact(spark, out, PREDICTION_SCHEMA)
    first = K.read_committed(spark, out, PREDICTION_SCHEMA).where("batch_id = 0")
    replayed = first.select("image", "prediction", "modification_time").checkpoint()
    sink = BatchSink(out, checkpoint=f"{base}/checkpoint")
    late = replayed.withColumn("image", F.concat("image", F.lit("?late")))
    sink(late, 100)
    sink(replayed, 0)
    K.compact(spark, out, PREDICTION_SCHEMA)
    K.vacuum(spark, out, 0)
    sink(late.limit(0), 100)  # the late batch once more, without its rows
    rows = K.read_committed(spark, out, PREDICTION_SCHEMA)
    folders = len(K.snapshot(spark, out).compacted)
    return rows.groupBy("image", "prediction").agg(F.count(F.lit(1)).alias("copies")).withColumn(
        "folders", F.lit(folders).cast("bigint")
    )


COUNTS_SQL = W(
    f"""SELECT TRY_CAST(prediction AS INTEGER) AS class_id,
       {Q.class_name('TRY_CAST(prediction AS INTEGER)')} AS class_name, CAST(count(*) AS BIGINT) AS n_images
FROM pred GROUP BY 1""",
    S.PRED_SQL,
)


@register("stream_state_restart", COUNTS_SQL)
def stream_state_restart(spark, sf):
    """Class counts as state of a query that is started anew for every
    file. Only the new file is there each time, so what came before is known
    from the state store alone."""
    base = work_dir(spark, "state")
    for part in range(PARTS):
        src = f"{base}/source"
        _event_files(spark, sf, src, part)
        C.start_live_class_counts(_file_stream(spark, sf, src), f"{base}/table", f"{base}/checkpoint").awaitTermination()
        K.Files(spark, src).delete(src)
    return C.read_live_table(spark, f"{base}/table")


# --- part files -------------------------------------------------------------------

ODD_NAME = "concat('a \"', event_id, '\", b.png')"
LAYOUTS_SQL = W(
    f"""SELECT CASE event_id % 3 WHEN 0 THEN image WHEN 1 THEN {ODD_NAME} ELSE image END AS image,
       CASE WHEN event_id % 3 = 2 THEN NULL ELSE prediction END AS prediction,
       CASE WHEN event_id % 3 = 1 THEN event_id * 0.5::DOUBLE END AS "ms per image",
       CASE WHEN event_id % 2 = 0 THEN 'run-a' ELSE 'run-b' END AS run_id, batch_id FROM pred""",
    S.PRED_SQL,
)


@register("csv_layouts", LAYOUTS_SQL)
def csv_layouts(spark, sf):
    """Two runs of CSV parts in three layouts (other column order
    and a header name with spaces; a column missing), with names that hold
    quotes and commas, read as one table by header name."""
    base = work_dir(spark, "layouts")
    rows = S.predictions(spark, sf).withColumn(
        "run_id", F.when(F.col("event_id") % 2 == 0, "run-a").otherwise("run-b")
    )
    layouts = [
        ["image", "prediction"],
        [F.expr("event_id * 0.5D").alias("ms per image"), "prediction", F.expr(ODD_NAME).alias("image")],
        ["image"],
    ]
    # Files are dealt to tasks by folder, as many as the session says: there
    # are far more files than a task should write, however few bytes they have.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for k, columns in enumerate(layouts):
        part = rows.where(F.col("event_id") % 3 == k).select(*columns, "run_id", "batch_id")
        writer = part.repartition(tasks, "run_id", "batch_id").write.mode("append").partitionBy("run_id", "batch_id")
        # Tasks put their files in place themselves, not the driver one by one.
        writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        writer.options(**K.csv_options("csv")).csv(base)
    schema = T.StructType([*RUN_PREDICTION_SCHEMA.fields, T.StructField("ms per image", T.DoubleType())])
    return read_part_csvs(spark, base, schema).select("image", "prediction", "ms per image", "run_id", "batch_id")


@register(
    "csv_page_newest_run",
    W(
        """SELECT image, prediction FROM pred WHERE event_id < 500 ORDER BY event_id DESC LIMIT 1""", S.PRED_SQL
    ),
)
def csv_page_newest_run(spark, sf):
    """W1 on a CSV page: the newest prediction is that of the newest run, not
    that of the highest batch id of an earlier one."""
    base = work_dir(spark, "csv-page")
    rows = S.predictions(spark, sf)
    for run, n in (("001-old", 3), ("002-new", 1)):
        sink = BatchSink(f"{base}/predictions", f"{base}/metrics", fmt="csv", run_id=run)
        for b in range(n):
            sink(rows.where(F.col("batch_id") == b).select("image", "prediction", "modification_time"), b)
    return V.page(spark, f"{base}/predictions", f"{base}/metrics", fmt="csv")["latest"].select("image", "prediction")


NEWEST = 20


@register(
    "csv_file_order",
    W(
        f"""SELECT CAST(row_number() OVER (ORDER BY part DESC, event_id DESC) AS INTEGER) AS rank, image FROM (
  SELECT *, event_id % {PARTS} AS part FROM pred) QUALIFY rank <= {NEWEST}""",
        S.PRED_SQL,
    ),
)
def csv_file_order(spark, sf):
    """Part files with equal modification times, as the page concatenates
    them: by file, and by line inside a file. The newest row is the last line
    of the last file."""
    folder = work_dir(spark, "file-order")
    rows = S.predictions(spark, sf)
    parts = rows.repartitionById(PARTS, F.expr(f"CAST(event_id % {PARTS} AS INT)")).sortWithinPartitions("event_id")
    parts.select("image", "prediction").write.options(**K.csv_options("csv")).csv(folder)
    files = K.Files(spark, folder)
    for name in files.names(folder):
        files.fs.setTimes(files.path(folder, name), 1_700_000_000_000, -1)
    found = V.newest_in_files(read_part_csvs(spark, folder, PREDICTION_SCHEMA, with_file_info=True), NEWEST)
    ranked = found.coalesce(1).withColumn("rank", (F.monotonically_increasing_id() + 1).cast("int"))
    return ranked.select("rank", "image")


# --- files of a stream ---------------------------------------------------------------


def _text_files(spark, sf, folder: str, n: int) -> list[int]:
    """``n`` files of event names in ``folder``, one second apart in time; a
    file's bytes follow its events. Returns the bytes."""
    ev = table(spark, sf, "events")
    lines = ev.select(F.concat(F.col("event_type"), F.lit(","), F.col("event_id").cast("string")).alias("value"), "event_id")
    files, sizes = K.Files(spark, folder), []
    for k in range(n):
        one = f"{folder}-{k}"
        lines.where(F.pmod("event_id", F.lit(n * (n + 1) // 2)).between(k * (k + 1) // 2, (k + 1) * (k + 2) // 2 - 1)).select(
            "value"
        ).coalesce(1).sortWithinPartitions("value").write.text(one)
        part = next(x for x in files.names(one) if x.startswith("part-"))
        files.fs.mkdirs(files.path(folder))
        target = f"{folder}/file{k:03d}.txt"
        files.rename(f"{one}/{part}", target)
        files.fs.setTimes(files.path(target), 1_700_000_000_000 + 1000 * k, -1)
        sizes.append(files.fs.getFileStatus(files.path(target)).getLen())
        files.delete(one)
    return sizes


FILES = 6


def _sizes_sql() -> str:
    span = FILES * (FILES + 1) // 2
    return f"""sizes AS (SELECT k, CAST(sum(strlen(event_type) + strlen(CAST(event_id AS VARCHAR)) + 2) AS BIGINT) AS bytes
  FROM events, (SELECT unnest(range({FILES})) AS k)
  WHERE event_id % {span} BETWEEN k * (k + 1) // 2 AND (k + 1) * (k + 2) // 2 - 1 GROUP BY k)"""


ADMISSION_SQL = f"""WITH RECURSIVE {_sizes_sql()},
lim AS (SELECT sum(bytes) // 3 AS most FROM sizes),
walk AS (SELECT 0 AS k, CAST(0 AS BIGINT) AS batch_id, bytes AS filled FROM sizes WHERE k = 0
  UNION ALL SELECT s.k, CASE WHEN w.filled + s.bytes > most THEN w.batch_id + 1 ELSE w.batch_id END,
    CASE WHEN w.filled + s.bytes > most THEN s.bytes ELSE w.filled + s.bytes END
  FROM walk w JOIN sizes s ON s.k = w.k + 1, lim)
SELECT printf('file%03d.txt', k) AS file_name, bytes AS length, batch_id FROM walk JOIN sizes USING (k)"""


@register("stream_admission_bytes", ADMISSION_SQL)
def stream_admission_bytes(spark, sf):
    """A ``binaryFile`` stream whose batches are bounded by bytes:
    oldest files first, and a batch ends before the file that would take it
    over the bound."""
    base = work_dir(spark, "admission")
    sizes = _text_files(spark, sf, f"{base}/in", FILES)
    limits = I.StreamLimits(max_bytes=sum(sizes) // 3)
    files = I.read_binary_stream(spark, f"{base}/in", glob="*.txt", limits=limits)
    out = f"{base}/out"
    C.start_table_stream(files.select("path", "length"), out, None, f"{base}/checkpoint").awaitTermination()
    rows = K.read_committed(spark, out)
    return rows.select(F.substring_index("path", "/", -1).alias("file_name"), "length", "batch_id")


@register(
    "stream_file_lifecycle",
    f"""WITH {_sizes_sql()} SELECT printf('file%03d.txt', k) AS file_name, bytes AS length, CAST(1 AS BIGINT) AS times_read,
  k = {FILES} - 1 AS in_input FROM sizes""",
)
def stream_file_lifecycle(spark, sf):
    """A stream that archives the files of finished batches. It is
    stopped and started again; at last the input holds only the file of the
    last batch (it is cleaned by the next one) and files in a folder below,
    which are not read, and no file was read twice or lost."""
    base = work_dir(spark, "lifecycle")
    src, arc = f"{base}/in", f"{base}/archive"
    _text_files(spark, sf, src, FILES)
    files = K.Files(spark, src)
    files.fs.mkdirs(files.path(f"{src}/later"))
    files.rename(f"{src}/file{FILES - 1:03d}.txt", f"{src}/later/file{FILES - 1:03d}.txt")
    limits = I.StreamLimits(max_files=1, clean="archive", archive_dir=arc)
    names: list[str] = []
    for half in range(2):
        stream = I.read_binary_stream(spark, src, glob="*.txt", limits=limits).select("path", "length")
        C.start_table_stream(stream, f"{base}/out", None, f"{base}/checkpoint").awaitTermination()
        if half == 0:  # the file that no run has seen comes down
            files.rename(f"{src}/later/file{FILES - 1:03d}.txt", f"{src}/file{FILES - 1:03d}.txt")
            files.fs.setTimes(files.path(f"{src}/file{FILES - 1:03d}.txt"), 1_700_000_900_000, -1)
    names = files.names(src)
    read = K.read_committed(spark, f"{base}/out").withColumn("file_name", F.substring_index("path", "/", -1))
    return read.groupBy("file_name", "length").agg(F.count(F.lit(1)).alias("times_read")).withColumn(
        "in_input", F.col("file_name").isin(names)
    )


@register(
    "stream_restart",
    W("SELECT image, prediction, CAST(1 AS BIGINT) AS copies FROM pred", S.PRED_SQL),
)
def stream_restart(spark, sf):
    """A stream stopped after each file and started again from its
    checkpoint, and once with nothing new: every row is there once, and an
    empty batch leaves no timing row."""
    base = work_dir(spark, "restart")
    out, met = f"{base}/predictions", f"{base}/metrics"
    for part in (*range(PARTS), None):
        if part is not None:
            _event_files(spark, sf, f"{base}/source", part)
        stream = _file_stream(spark, sf, f"{base}/source")
        C.start_table_stream(stream, out, met, f"{base}/checkpoint").awaitTermination()
    BatchSink(out, met, run_id="empty")(_as_predictions(table(spark, sf, "events")).limit(0), 0)
    timed = read_or_empty(spark, met, METRICS_SCHEMA).select("run_id", "batch_id").distinct()
    rows = read_or_empty(spark, out, PREDICTION_SCHEMA).join(timed, ["run_id", "batch_id"])
    return rows.groupBy("image", "prediction").agg(F.count(F.lit(1)).alias("copies"))


@register(
    "missing_tables",
    W(
        """SELECT * FROM (VALUES ('absent', false, CAST(0 AS BIGINT)), ('lacks a column', false, (SELECT count(*) FROM pred)),
  ('whole', true, (SELECT count(*) FROM pred))) t(kind, shown, n_rows)""",
        S.PRED_SQL,
    ),
)
def missing_tables(spark, sf):
    """A table that isn't there is an empty view; a view is shown only
    of a table that has the required columns and rows."""
    pred = S.predictions(spark, sf)
    tables = {
        "absent": read_or_empty(spark, work_dir(spark, "absent"), PREDICTION_SCHEMA),
        "lacks a column": pred.drop("prediction"),
        "whole": pred,
    }
    frames = [
        t.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(kind).alias("kind"), F.lit(V.has_required_columns(t)).alias("shown"), "n_rows"
        )
        for kind, t in tables.items()
    ]
    return V.union_parts(*frames)
