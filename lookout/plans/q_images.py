"""Registered queries: the image path over image files that Spark writes
from the feature stand-in (one 8x8 grey PNG per ``embeddings`` row), so
the work grows with the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lookout.functions.arrays import unit_scale
from lookout.functions.images import EIGHT_BIT, KERAS_RECIPE, PREP_RECIPE, augment_udf
from lookout.operators import dataset as D
from lookout.plans import sqlfrag as Q
from lookout.plans import standins as S
from lookout.plans.catalog import register
from lookout.plans.fixtures import write_png_files
from lookout.session import work_dir
from lookout.sources import images as I

W = S.with_ctes
SIDE = 8  # the feature stand-in is an 8 x 8 x 1 tensor
RGB_LEN = SIDE * SIDE * 3
ID_FROM_PATH = r"img_(\d+)\.png$"


def export_features(spark, sf, folder_cols=(), frame=None) -> str:
    """Write the feature table as PNG files (an action) and return the root.
    The rows are dealt to all cores first, those of one file to one task: a
    table may come in one row group."""
    root = work_dir(spark, "images")
    frame = frame if frame is not None else S.features(spark, sf)
    frame = frame.repartition(spark.sparkContext.defaultParallelism, "vec_id")
    write_png_files(frame, root, "vec_id", "pixels", SIDE, SIDE, 1, folder_cols).count()
    return root


def _vec_id(col="path"):
    return F.regexp_extract(F.col(col), ID_FROM_PATH, 1).cast("bigint").alias("vec_id")


RGB_SQL = W(
    f"SELECT vec_id, list_transform(range({RGB_LEN}), lambda i: pixels[i // 3 + 1]) AS rgb FROM feat", S.FEAT_SQL
)


@register("image_features", RGB_SQL)
def image_features(spark, sf):
    """Scan the PNG folder with the image source (JVM decode),
    grey -> RGB, resize (identity here), flatten, scale; ``rgb`` is the
    vector scaled back to 0..255 for an exact check."""
    root = export_features(spark, sf)
    feats = I.image_features(I.read_images(spark, root), SIDE, SIDE)
    return feats.select(
        _vec_id(), F.transform("pixels", lambda x: F.round(x * 255).cast("int")).alias("rgb")
    )


UP = 2 * SIDE  # upsampled side for the resize check


def _resize_up_sql() -> str:
    """DuckDB twin of a 2x bilinear upsample with half-pixel centres: every
    weight is a multiple of 1/16, so values are exact and ``round_even``
    matches NumPy's half-to-even rounding."""

    def pos(o: str) -> str:
        return f"greatest(least(0.5 * ({o}) - 0.25, {SIDE - 1}), 0)"

    def lo(o: str) -> str:
        return f"CAST(floor({pos(o)}) AS INTEGER)"

    def hi(o: str) -> str:
        return f"least({lo(o)} + 1, {SIDE - 1})"

    def w(o: str) -> str:
        return f"({pos(o)} - floor({pos(o)}))"

    def px(y: str, x: str) -> str:
        return f"pixels[({y}) * {SIDE} + ({x}) + 1]"

    r, c = f"(i // {UP * 3})", f"((i // 3) % {UP})"
    top = f"((1 - {w(c)}) * {px(lo(r), lo(c))} + {w(c)} * {px(lo(r), hi(c))})"
    bottom = f"((1 - {w(c)}) * {px(hi(r), lo(c))} + {w(c)} * {px(hi(r), hi(c))})"
    value = f"(1 - {w(r)}) * {top} + {w(r)} * {bottom}"
    return W(
        f"SELECT vec_id, list_transform(range({UP * UP * 3}), lambda i: CAST(round_even({value}, 0) AS INTEGER)) AS rgb "
        "FROM feat",
        S.FEAT_SQL,
    )


@register("image_resize", _resize_up_sql())
def image_resize(spark, sf):
    """decoded images resized 8x8 -> 16x16 (bilinear, half-pixel
    centres), grey -> RGB, back to 0..255 for an exact check."""
    root = export_features(spark, sf)
    feats = I.image_features(I.read_images(spark, root), UP, UP)
    return feats.select(_vec_id(), F.transform("pixels", lambda x: F.round(x * 255).cast("int")).alias("rgb"))


LARGE = 64  # side of the images of the reduction check
# Pixel (y, x) of the large image of a feature row.
LARGE_PIXEL = "(pixels[y + 1] * 3 + pixels[x + 1] * 5 + pixels[(x * y) % 64 + 1]) // 9"


def _reduce_sql() -> str:
    """Two passes of a triangle filter eight times as wide, weights as whole
    2**-22, bytes in between."""
    scale = LARGE // SIDE
    return f"""WITH {S.FEAT_SQL},
taps AS (SELECT o, j, CAST(floor(w / sum(w) OVER (PARTITION BY o) * 4194304 + 0.5) AS BIGINT) AS w FROM (
  SELECT o, j, greatest(0.0, 1.0 - abs((j + 0.5 - (o + 0.5) * {scale}) / {scale}.0))::DOUBLE AS w
  FROM (SELECT unnest(range({SIDE})) AS o), (SELECT unnest(range({LARGE})) AS j))),
px AS (SELECT vec_id, y, x, {LARGE_PIXEL} AS v FROM feat, (SELECT unnest(range({LARGE})) AS y), (SELECT unnest(range({LARGE})) AS x)),
rows_done AS (SELECT vec_id, y, o AS x, CAST((sum(v * w) + 2097152)::BIGINT >> 22 AS BIGINT) AS v FROM px JOIN taps ON j = x GROUP BY vec_id, y, o),
done AS (SELECT vec_id, o AS y, x, CAST((sum(v * w) + 2097152)::BIGINT >> 22 AS INTEGER) AS v FROM rows_done JOIN taps ON j = y GROUP BY vec_id, o, x)
SELECT vec_id, list(v ORDER BY y, x) AS grey FROM done GROUP BY vec_id"""


@register("image_reduce", _reduce_sql())
def image_reduce(spark, sf):
    """decoded images reduced 64x64 -> 8x8 as the dataset job does it, in
    two passes over bytes."""
    side = F.sequence(F.lit(0), F.lit(LARGE - 1))
    at = lambda i: F.element_at("pixels", i.cast("int") + 1)
    pixel = lambda y, x: F.floor((at(y) * 3 + at(x) * 5 + at(F.pmod(x * y, F.lit(64)))) / 9).cast("int")
    large = F.flatten(F.transform(side, lambda y: F.transform(side, lambda x: pixel(y, x))))
    frame = S.features(spark, sf).select("vec_id", large.alias("pixels"))
    root = work_dir(spark, "large-images")
    write_png_files(frame, root, "vec_id", "pixels", LARGE, LARGE, 1, ()).count()
    feats = I.image_features(I.read_images(spark, root), SIDE, SIDE, EIGHT_BIT)
    every = F.sequence(F.lit(1), F.lit(RGB_LEN), F.lit(3))
    return feats.select(
        _vec_id(), F.transform(every, lambda i: F.round(F.element_at("pixels", i) * 255).cast("int")).alias("grey")
    )


@register(
    "label_folders",
    W(
        """SELECT c.class_id, c.class_name, CAST(coalesce(t.n, 0) AS BIGINT) AS n_images
FROM classes c LEFT JOIN (SELECT label, count(*) AS n FROM embeddings GROUP BY label) t ON c.class_id = t.label""",
        Q.classes_cte(),
    ),
)
def label_folders(spark, sf):
    """S4 + S3 + J3: class folders ``c0..c9`` -> (path, label) -> images per
    class over the whole dimension (zero for a missing class)."""
    frame = S.features(spark, sf).withColumn("folder", F.concat(F.lit("c"), F.col("label").cast("string")))
    root = export_features(spark, sf, ("folder",), frame)
    return D.class_distribution(I.labelled_folders(spark, root).rows, "label").withColumnRenamed("n_rows", "n_images")


# Where the images of the untidy folder lie: class 7 is missing, and some
# files are in folders that are no class folders.
UNTIDY = (
    "CASE WHEN vec_id % 11 = 0 THEN 'other' WHEN vec_id % 13 = 0 THEN 'c10' WHEN vec_id % 17 = 0 THEN 'c3/deeper' "
    "WHEN label = 7 THEN 'c' ELSE concat('c', CAST(label AS STRING)) END"
)


def _untidy(spark, sf) -> I.LabelledFolders:
    frame = S.features(spark, sf).withColumn("folder", F.expr(UNTIDY))
    return I.labelled_images(spark, export_features(spark, sf, ("folder",), frame), SIDE, SIDE)


@register(
    "image_rejects",
    f"""SELECT vec_id, 'outside_class_folders' AS reason FROM embeddings
WHERE NOT regexp_matches({UNTIDY.replace("STRING", "VARCHAR")}, '^c[0-9]$')""",
)
def image_rejects(spark, sf):
    """S4 + P8: what a labelled scan of an untidy folder leaves out, and why."""
    return _untidy(spark, sf).rejects.select(_vec_id(), "reason")


@register(
    "missing_classes",
    W(
        f"""SELECT class_id, class_name FROM classes WHERE concat('c', CAST(class_id AS VARCHAR)) NOT IN
(SELECT {UNTIDY.replace("STRING", "VARCHAR")} FROM embeddings)""",
        Q.classes_cte(),
    ),
)
def missing_classes(spark, sf):
    """The classes without any usable file."""
    return _untidy(spark, sf).missing.select("class_id", "class_name")

def _split_sql() -> str:
    # Rows per (label, split) depend only on the label sizes, not on which
    # rows the seeded keys pick, so any unique id gives the same counts.
    from lookout.plans.q_dataset import _strat_sql

    return _strat_sql("vec_id", "label", "embeddings")


def _strat_counts_sql() -> str:
    from lookout.plans.q_dataset import _strat_sql

    return (
        "SELECT split, CAST(label AS INTEGER) AS label, CAST(count(*) AS BIGINT) AS n_images "
        f"FROM ({_strat_sql('vec_id', 'label', 'embeddings')}) GROUP BY split, label"
    )


@register("split_folders", _strat_counts_sql())
def split_folders(spark, sf):
    """``<split>/<class>/`` folders -> (path, split, label); the label is
    the class folder's sorted index."""
    # The split is decided next to the pixel rows (no join back by id).
    frame = D.stratified_split(S.features(spark, sf), "vec_id", "label", keep_all=True).withColumn(
        "folder", F.concat(F.lit("c"), F.col("label").cast("string"))
    )
    root = export_features(spark, sf, ("split", "folder"), frame)
    rows = I.split_folders(spark, root)
    return rows.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n_images"))


def _draw_sql(name: str, low: float, high: float) -> str:
    digits = f"substr(md5(concat('42:', vec_id, ':', k, ':{name}')), 1, 8)"
    return f"({low} + CAST(concat('0x', {digits}) AS BIGINT) / 4294967296.0::DOUBLE * ({high} - {low}))"


def _copies_sql(steps: str, grey: str) -> str:
    """Originals as they are and copies as ``grey`` says, with the columns of
    the checks on shape and range."""
    return W(
        f"""SELECT vec_id, CAST(k AS INTEGER) AS aug_index, label, CAST({RGB_LEN} AS INTEGER) AS n_values, true AS in_range,
  CASE WHEN k = 0 THEN pixels ELSE {grey} END AS grey FROM ({steps})""",
        S.FEAT_SQL,
    )


def _prep_sql() -> str:
    """First recipe, in bytes: flip, nearest-neighbour rotation by whole
    65536ths, brightness and contrast in single precision, cut off."""
    low, high = (f"{s}{PREP_RECIPE['max_degrees']}" for s in ("-", ""))
    half = SIDE / 2.0
    x, y = f"(i % {SIDE})", f"(i // {SIDE})"
    fixed = lambda v: f"CAST(floor(({v}) * 65536.0 + 0.5) AS BIGINT)"
    sx, sy = f"((x0 + {x} * c - {y} * s) >> 16)", f"((y0 + {x} * s + {y} * c) >> 16)"
    inside = f"{sx} >= 0 AND {sx} < {SIDE} AND {sy} >= 0 AND {sy} < {SIDE}"
    flipped = f"list_transform(range({SIDE * SIDE}), lambda i: held[(i // {SIDE}) * {SIDE} + {SIDE} - i % {SIDE}])"
    cut = lambda v: f"CAST(floor(least(greatest({v}, 0::FLOAT), 255::FLOAT)) AS INTEGER)"
    steps = f"""SELECT *, CAST(floor(list_avg(lit) + 0.5) AS INTEGER) AS mean FROM (
 SELECT *, list_transform(turned, lambda p: {cut("bright * CAST(p AS FLOAT)")}) AS lit FROM (
  SELECT *, list_transform(range({SIDE * SIDE}), lambda i: CASE WHEN {inside} THEN faced[{sy} * {SIDE} + {sx} + 1] ELSE 0 END) AS turned FROM (
   SELECT *, {fixed("cos(t)")} AS c, {fixed("sin(t)")} AS s,
     {fixed(f"{half} - cos(t) * {half} + sin(t) * {half} + cos(t) * 0.5 - sin(t) * 0.5")} AS x0,
     {fixed(f"{half} - sin(t) * {half} - cos(t) * {half} + sin(t) * 0.5 + cos(t) * 0.5")} AS y0,
     CASE WHEN {_draw_sql("flip", 0.0, 1.0)} < {PREP_RECIPE["flip_p"]} THEN {flipped} ELSE held END AS faced FROM (
    SELECT vec_id, label, k, pixels, {_draw_sql("degrees", low, high)} * 0.017453292519943295 AS t,
      list_transform(pixels, lambda p: CAST(floor(CAST(p / 255.0::DOUBLE AS FLOAT) * 255::FLOAT) AS INTEGER)) AS held,
      CAST({_draw_sql("brightness", *PREP_RECIPE["brightness"])} AS FLOAT) AS bright,
      CAST({_draw_sql("contrast", *PREP_RECIPE["contrast"])} AS FLOAT) AS contrast
    FROM feat, unnest(range(3)) u(k)))))"""
    return _copies_sql(
        steps, f"list_transform(lit, lambda p: {cut('CAST(mean AS FLOAT) + contrast * (CAST(p AS FLOAT) - CAST(mean AS FLOAT))')})"
    )


def _keras_sql() -> str:
    """Second recipe: rotation and zoom about the centre, four taps with
    mirrored borders."""
    mid = (SIDE - 1) / 2.0
    dx, dy = f"((i % {SIDE} - {mid}) / zoom)", f"((i // {SIDE} - {mid}) / zoom)"
    sx, sy = f"(cos(t) * {dx} - sin(t) * {dy} + {mid})", f"(sin(t) * {dx} + cos(t) * {dy} + {mid})"

    def at(v: str, step: int) -> str:
        m = f"(((CAST(floor({v}) AS INTEGER) + {step}) % {2 * SIDE} + {2 * SIDE}) % {2 * SIDE})"
        return f"(CASE WHEN {m} >= {SIDE} THEN {2 * SIDE - 1} - {m} ELSE {m} END)"

    def tap(oy: int, ox: int) -> str:
        fy, fx = (f"({v} - floor({v}))" for v in (sy, sx))
        weight = f"({fy if oy else f'(1 - {fy})'} * {fx if ox else f'(1 - {fx})'})"
        return f"pixels[{at(sy, oy)} * {SIDE} + {at(sx, ox)} + 1] * {weight}"

    value = " + ".join(tap(oy, ox) for oy, ox in ((0, 0), (0, 1), (1, 0), (1, 1)))
    turn, zoom = KERAS_RECIPE["max_degrees"], KERAS_RECIPE["zoom"]
    steps = f"""SELECT vec_id, label, k, pixels, {_draw_sql("degrees", -turn, turn)} * 0.017453292519943295 AS t,
    1.0 + {_draw_sql("zoom", -zoom, zoom)} AS zoom FROM feat, unnest(range(3)) u(k)"""
    grey = f"list_transform(range({SIDE * SIDE}), lambda i: CAST(least(greatest(round_even({value}, 0), 0), 255) AS INTEGER))"
    return _copies_sql(steps, grey)


def _augment(spark, sf, recipe):
    feats = S.features(spark, sf)
    rgb = F.transform(F.sequence(F.lit(0), F.lit(RGB_LEN - 1)), lambda i: F.element_at("pixels", F.floor(i / 3).cast("int") + 1))
    base = feats.select("vec_id", "label", unit_scale(rgb).alias("pixels"))
    rows = D.augmented_rows(base, factor=2)
    aug = rows.withColumn(
        "aug", augment_udf(SIDE, SIDE, recipe)(F.col("pixels"), F.col("vec_id"), F.col("aug_index"))
    )
    return aug.select(
        "vec_id",
        F.col("aug_index").cast("int").alias("aug_index"),
        "label",
        F.size("aug").alias("n_values"),
        F.forall("aug", lambda x: (x >= 0) & (x <= 1)).alias("in_range"),
        F.transform(F.sequence(F.lit(1), F.lit(RGB_LEN), F.lit(3)), lambda i: F.round(F.element_at("aug", i) * 255).cast("int")).alias("grey"),
    )


@register("augment_images", _prep_sql())
def augment_images(spark, sf):
    """U2 + F14: originals plus two seeded augmented copies (flip, rotation,
    brightness, contrast), pixel by pixel: every parameter is drawn from the
    id, and every step is held in bytes."""
    return _augment(spark, sf, PREP_RECIPE)


# The first recipe without its rotation, and with real numbers between the steps.
FLAT_RECIPE = PREP_RECIPE | {"max_degrees": 0.0, "steps": None}


def _flat_sql() -> str:
    """The parameters from md5(seed:id:copy:name) and the steps in their order:
    flip, brightness, contrast about the rounded mean grey, rounding."""

    def draw(name: str, low: float, high: float) -> str:
        digits = f"substr(md5(concat('42:', vec_id, ':', k, ':{name}')), 1, 8)"
        return f"({low} + CAST(concat('0x', {digits}) AS BIGINT) / 4294967296.0::DOUBLE * ({high} - {low}))"

    bright, contrast = draw("brightness", *FLAT_RECIPE["brightness"]), draw("contrast", *FLAT_RECIPE["contrast"])
    flipped = f"list_transform(range({SIDE * SIDE}), lambda i: pixels[(i // {SIDE}) * {SIDE} + {SIDE} - i % {SIDE}])"
    return W(
        f"""SELECT vec_id, CAST(k AS INTEGER) AS aug_index, CASE WHEN k = 0 THEN pixels ELSE
       list_transform(lit, lambda x: CAST(round_even(least(greatest(mean + (x - mean) * contrast, 0), 255), 0) AS INTEGER))
       END AS grey
FROM (SELECT *, round_even(list_avg(lit), 0) AS mean
      FROM (SELECT *, list_transform(turned, lambda x: least(greatest(x * bright, 0), 255)) AS lit
            FROM (SELECT vec_id, k, pixels, CAST({bright} AS DOUBLE) AS bright, CAST({contrast} AS DOUBLE) AS contrast,
                         CASE WHEN {draw("flip", 0.0, 1.0)} < {FLAT_RECIPE["flip_p"]} THEN {flipped} ELSE pixels END AS turned
                  FROM feat, unnest(range(3)) t(k))))""",
        S.FEAT_SQL,
    )


@register("augment_flat", _flat_sql())
def augment_flat(spark, sf):
    """flip, brightness and contrast of the first recipe, value by value."""
    feats = S.features(spark, sf)
    rgb = F.transform(F.sequence(F.lit(0), F.lit(RGB_LEN - 1)), lambda i: F.element_at("pixels", F.floor(i / 3).cast("int") + 1))
    rows = D.augmented_rows(feats.select("vec_id", unit_scale(rgb).alias("pixels")), factor=2)
    aug = augment_udf(SIDE, SIDE, FLAT_RECIPE)(F.col("pixels"), F.col("vec_id"), F.col("aug_index"))
    every = F.sequence(F.lit(1), F.lit(RGB_LEN), F.lit(3))
    return rows.withColumn("aug", aug).select(
        "vec_id",
        F.col("aug_index").cast("int").alias("aug_index"),
        F.transform(every, lambda i: F.round(F.element_at("aug", i) * 255).cast("int")).alias("grey"),
    )


@register("augment_images_zoom", _keras_sql())
def augment_images_zoom(spark, sf):
    """U2 + F15: the second recipe (rotation within 5 % of a turn, zoom
    within 10 %, reflected borders), pixel by pixel."""
    return _augment(spark, sf, KERAS_RECIPE)


@register(
    "dataset_preparation",
    f"""SELECT label, split, CAST(count(*) * (CASE WHEN split = 'train' THEN 3 ELSE 1 END) AS BIGINT) AS n_rows,
       CAST({RGB_LEN} AS INTEGER) AS vec_len
FROM ({_split_sql()}) GROUP BY label, split""",
)
def dataset_preparation(spark, sf):
    """S4 -> F1-F3 -> W9 -> U2/F14 -> S11 as one job over class folders
    written from the feature table: rows per (label, split) after
    train-only augmentation."""
    frame = S.features(spark, sf).withColumn("folder", F.concat(F.lit("c"), F.col("label").cast("string")))
    root = export_features(spark, sf, ("folder",), frame)
    prepared = D.prepare_dataset(spark, root, work_dir(spark, "prepared"), SIDE, SIDE, factor=2)
    return prepared.groupBy("label", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(F.size("pixels")).alias("vec_len")
    )
