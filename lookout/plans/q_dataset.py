"""Registered queries: dataset preparation (ranks, splits, class
statistics, vector functions, feature-table persistence)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lookout.classes import NUM_CLASSES
from lookout.functions import arrays as A
from lookout.operators import dataset as D
from lookout.operators import ranking as R
from lookout.plans import sqlfrag as Q
from lookout.plans import standins as S
from lookout.plans.catalog import register
from lookout.session import work_dir
from lookout.sources.commits import Files
from lookout.sources.tables import table

W = S.with_ctes
KEY = "md5(concat('42:', CAST(vec_id AS VARCHAR)))"
BATCH_SIZE = 7


@register(
    "global_rank",
    f"SELECT vec_id, CAST(row_number() OVER (ORDER BY {KEY}, vec_id) AS BIGINT) AS rank FROM embeddings",
)
def global_rank(spark, sf):
    """W11 + W8: exact rank in seeded-shuffle order."""
    emb = table(spark, sf, "embeddings").select("vec_id")
    return R.rank_by_hash(emb, "vec_id", 42).select("vec_id", "rank")


@register(
    "batch_assignment",
    f"""SELECT doc_id, rank, (rank - 1) // {BATCH_SIZE} AS batch_no
FROM (SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) AS BIGINT) AS rank FROM documents)""",
)
def batch_assignment(spark, sf):
    """Ordered list cut into groups of 7."""
    docs = table(spark, sf, "documents").select("doc_id")
    return R.batch_assignment(docs, "doc_id", BATCH_SIZE).select("doc_id", "rank", "batch_no")


@register(
    "seeded_shuffle_head",
    f"SELECT vec_id, label, {KEY} AS shuffle_key FROM embeddings ORDER BY shuffle_key, vec_id LIMIT 3",
)
def seeded_shuffle_head(spark, sf):
    """W12 + W8: first 3 rows of the seeded shuffle."""
    emb = table(spark, sf, "embeddings").select("vec_id", "label")
    return R.seeded_shuffle_head(emb, "vec_id", 3, 42)


def _strat_sql(id_col: str, label_col: str, src: str) -> str:
    key = f"md5(concat('42:', CAST({id_col} AS VARCHAR)))"
    return f"""SELECT {id_col}, {label_col}, CASE WHEN 10 * rn <= 2 * n + 5 THEN 'val' ELSE 'train' END AS split
FROM (SELECT {id_col}, {label_col},
             row_number() OVER (PARTITION BY {label_col} ORDER BY {key}, {id_col}) AS rn,
             count(*) OVER (PARTITION BY {label_col}) AS n
      FROM {src})"""


@register("stratified_split", _strat_sql("vec_id", "label", "embeddings"))
def stratified_split(spark, sf):
    """Stratified 80/20 split by label."""
    return D.stratified_split(table(spark, sf, "embeddings"), "vec_id", "label")


@register("stratified_split_quality", _strat_sql("doc_id", "quality", "labels"))
def stratified_split_quality(spark, sf):
    """W9 over `labels`, stratified by quality."""
    return D.stratified_split(table(spark, sf, "labels"), "doc_id", "quality")


@register(
    "split_sizes",
    f"SELECT split, CAST(count(*) AS BIGINT) AS n_rows FROM ({_strat_sql('vec_id', 'label', 'embeddings')}) GROUP BY split",
)
def split_sizes(spark, sf):
    """Rows per split."""
    return D.split_sizes(D.stratified_split(table(spark, sf, "embeddings"), "vec_id", "label"))


@register(
    "plain_split",
    f"""SELECT vec_id, CASE WHEN rn <= (n * 8) // 10 THEN 'train' ELSE 'val' END AS split
FROM (SELECT vec_id, row_number() OVER (ORDER BY {KEY}, vec_id) AS rn, count(*) OVER () AS n FROM embeddings)""",
)
def plain_split(spark, sf):
    """First int(0.8 N) rows of the shuffle are train."""
    return D.plain_split(table(spark, sf, "embeddings"), "vec_id")


@register(
    "class_weights",
    """SELECT label, n_rows,
       round(CAST(sum(n_rows) OVER () AS DOUBLE) / CAST(count(*) OVER () * n_rows AS DOUBLE), 6) AS weight
FROM (SELECT label, CAST(count(*) AS BIGINT) AS n_rows FROM embeddings GROUP BY label)""",
)
def class_weights(spark, sf):
    """Balanced class weights."""
    w = D.class_weights(table(spark, sf, "embeddings"))
    return w.withColumn("weight", F.round("weight", 6))


@register("distinct_labels", "SELECT DISTINCT label FROM embeddings")
def distinct_labels(spark, sf):
    """Distinct labels."""
    return D.distinct_labels(table(spark, sf, "embeddings"))


@register(
    "class_distribution",
    W(
        """SELECT c.class_id, c.class_name, CAST(coalesce(t.n, 0) AS BIGINT) AS n_rows
FROM classes c LEFT JOIN (SELECT label, count(*) AS n FROM embeddings GROUP BY label) t ON c.class_id = t.label""",
        Q.classes_cte(),
    ),
)
def class_distribution(spark, sf):
    """A6 + J3: rows per class over the dimension."""
    return D.class_distribution(table(spark, sf, "embeddings"))


@register(
    "dataset_profile",
    """SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(min(len(embedding)) AS BIGINT) AS min_len,
       CAST(max(len(embedding)) AS BIGINT) AS max_len,
       CAST(min(list_min(embedding)) AS DOUBLE) AS min_value, CAST(max(list_max(embedding)) AS DOUBLE) AS max_value
FROM embeddings""",
)
def dataset_profile(spark, sf):
    """Rows, vector lengths, value range."""
    p = D.dataset_profile(table(spark, sf, "embeddings"), "embedding")
    return p.select("n_rows", F.col("min_len").cast("bigint"), F.col("max_len").cast("bigint"), "min_value", "max_value")


@register(
    "first_per_class",
    W(
        f"""SELECT c.class_id, c.class_name, f.vec_id
FROM classes c LEFT JOIN (SELECT label, arg_min(vec_id, {KEY}) AS vec_id FROM embeddings GROUP BY label) f
  ON c.class_id = f.label""",
        Q.classes_cte(),
    ),
)
def first_per_class(spark, sf):
    """W3 + P10: first sample per class."""
    return D.first_per_class(table(spark, sf, "embeddings"), "vec_id")


CLASS_OF_INTEREST = 3


@register("class_rows", f"SELECT vec_id, label FROM embeddings WHERE label = {CLASS_OF_INTEREST}")
def class_rows(spark, sf):
    """P10: rows of one class (the filter reaches the Parquet scan)."""
    return table(spark, sf, "embeddings").select("vec_id", "label").where(F.col("label") == CLASS_OF_INTEREST)


@register(
    "augmented_counts",
    f"""SELECT label, CAST(count(*) AS BIGINT) AS n_original, CAST(3 * count(*) AS BIGINT) AS n_whole_augmented,
       CAST(3 * count(*) FILTER (WHERE split = 'train') AS BIGINT) AS n_train_augmented,
       CAST(count(*) FILTER (WHERE split = 'val') AS BIGINT) AS n_val
FROM ({_strat_sql('vec_id', 'label', 'embeddings')}) GROUP BY label""",
)
def augmented_counts(spark, sf):
    """U2 + A6 (Q16): counts with whole-set vs train-only augmentation."""
    split = D.stratified_split(table(spark, sf, "embeddings"), "vec_id", "label")
    return D.augmented_counts(split, "label", factor=2)


# --- vector functions over the feature stand-in ---------------------------------

F_ = S.FEAT_SQL


@register(
    "unit_scale",
    W("SELECT vec_id, list_transform(pixels, lambda x: CAST(x AS DOUBLE) / 255.0) AS scaled FROM feat", F_),
)
def unit_scale(spark, sf):
    """pixels / 255."""
    return S.features(spark, sf).select("vec_id", A.unit_scale("pixels").alias("scaled"))


@register(
    "reshape_pad",
    W(
        """SELECT vec_id,
       list_transform(range(81), lambda i: coalesce(pixels[i + 1], 0)) AS padded,
       pixels[1:49] AS cut,
       list_transform(range(8), lambda r: list_transform(range(8), lambda c: pixels[r * 8 + c + 1 : r * 8 + c + 1])) AS tensor
FROM feat""",
        F_,
    ),
)
def reshape_pad(spark, sf):
    """pad, cut and reshape to a tensor."""
    return S.features(spark, sf).select(
        "vec_id",
        A.pad_or_cut("pixels", 81).alias("padded"),
        A.pad_or_cut("pixels", 49).alias("cut"),
        A.reshape("pixels", 8, 8, 1).alias("tensor"),
    )


@register(
    "one_hot",
    f"""SELECT vec_id, label,
       list_transform(range({NUM_CLASSES}), lambda i: CASE WHEN i = label THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS one_hot
FROM embeddings""",
)
def one_hot(spark, sf):
    """one-hot labels."""
    emb = table(spark, sf, "embeddings")
    return emb.select("vec_id", "label", A.one_hot("label", NUM_CLASSES).alias("one_hot"))


# --- feature table persistence ------------------------------------------------------


@register("parquet_label_scan", W("SELECT vec_id, label, pixels FROM feat", F_))
def parquet_label_scan(spark, sf):
    """S6 + P6: write the feature table with one folder per label, read it
    back with partition discovery and a column subset."""
    path = work_dir(spark, "features")
    D.save_features(S.features(spark, sf), path)
    return D.load_features(spark, path, columns=("vec_id", "label", "pixels"))


@register(
    "feature_roundtrip",
    W(
        """SELECT label, CAST(count(*) AS BIGINT) AS n_rows, CAST(min(len(pixels)) AS BIGINT) AS vec_len,
       min(list_min(list_transform(pixels, lambda x: CAST(x AS DOUBLE) / 255.0))) AS min_value,
       max(list_max(list_transform(pixels, lambda x: CAST(x AS DOUBLE) / 255.0))) AS max_value
FROM feat GROUP BY label""",
        F_,
    ),
)
def feature_roundtrip(spark, sf):
    """Save unit-scaled features, load them again, profile per label."""
    path = work_dir(spark, "features-scaled")
    feats = S.features(spark, sf).select("vec_id", "label", A.unit_scale("pixels").alias("pixels"))
    D.save_features(feats, path)
    back = D.load_features(spark, path)
    return back.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.size("pixels")).cast("bigint").alias("vec_len"),
        F.min(F.array_min("pixels")).alias("min_value"),
        F.max(F.array_max("pixels")).alias("max_value"),
    )


@register(
    "storage_report",
    "SELECT count(*) > 0 AS has_files, count(*) > 0 AS has_bytes, count(*) > 0 AS size_agrees FROM embeddings",
)
def storage_report(spark, sf):
    """Size of the saved feature table. Byte counts depend on the Parquet
    writer, so the check is that files and bytes are there and agree."""
    path = work_dir(spark, "features-size")
    D.save_features(S.features(spark, sf), path)
    return D.storage_report(spark, path).select(
        (F.col("n_files") > 0).alias("has_files"),
        (F.col("total_bytes") > 0).alias("has_bytes"),
        (F.abs(F.col("size_mb") * 1048576 - F.col("total_bytes")) <= 1).alias("size_agrees"),
    )


@register(
    "storage_sizes",
    "SELECT CAST(label AS INTEGER) AS label, true AS listed, true AS equal_bytes, true AS equal_size FROM embeddings GROUP BY label",
)
def storage_sizes(spark, sf):
    """The report of each label's folder against the lengths that the
    file system gives for it, file by file."""
    path = work_dir(spark, "features-sizes")
    D.save_features(S.features(spark, sf), path)
    report = D.storage_report(spark, path, by=r"label=([^/]+)/")
    files = Files(spark, path)
    rows = []
    for folder in files.names(path):
        if folder.startswith("label="):
            parts = [n for n in files.names(f"{path}/{folder}") if n.endswith(".parquet")]
            lengths = [files.fs.getFileStatus(files.path(path, folder, n)).getLen() for n in parts]
            rows.append((folder.split("=")[1], len(parts), sum(lengths)))
    told = spark.createDataFrame(rows, "folder string, files long, bytes long")
    return report.join(told, "folder", "full").select(
        F.col("folder").cast("int").alias("label"),
        (F.coalesce("n_files", F.lit(0)) == F.col("files")).alias("listed"),
        (F.coalesce("total_bytes", F.lit(0)) == F.col("bytes")).alias("equal_bytes"),
        (F.round(F.col("bytes") / 1048576.0, 6) == F.col("size_mb")).alias("equal_size"),
    )


# Keys that repeat: documents by length.
BATCH_TIES_SQL = f"""SELECT doc_id, rank, (rank - 1) // {BATCH_SIZE} AS batch_no FROM (
  SELECT doc_id, CAST(row_number() OVER (ORDER BY n_chars // 1000, md5(CAST(doc_id AS VARCHAR))) AS BIGINT) AS rank
  FROM documents)"""


@register("batch_assignment_ties", BATCH_TIES_SQL)
def batch_assignment_ties(spark, sf):
    """Groups of 7 of a list whose key repeats (documents by length);
    equal keys go by the md5 of their id."""
    docs = table(spark, sf, "documents").select("doc_id", F.expr("n_chars div 1000").alias("size"))
    return R.batch_assignment(docs, "size", BATCH_SIZE, tiebreak="doc_id").select("doc_id", "rank", "batch_no")
