"""Class dimension: the ten driver-behaviour classes.

The labels are fixed values that must equal the reference's text exactly
(they appear in every view). Index i is class ``ci``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference): class names, in class order c0..c9.
CLASS_NAMES = [
    "c0: Conduite normale",
    "c1: SMS au volant (Droit)",
    "c2: Téléphone (Droit)",
    "c3: SMS au volant (Gauche)",
    "c4: Téléphone (Gauche)",
    "c5: Réglage Radio",
    "c6: En train de Boire",
    "c7: Se retourner derrière",
    "c8: Maquillage",
    "c9: Parler au passager",
]
# Fixed value: name shown for a class id outside the dimension.
UNKNOWN_NAME = "Inconnu"
NUM_CLASSES = len(CLASS_NAMES)

CLASS_SCHEMA = T.StructType(
    [
        T.StructField("class_id", T.IntegerType(), False),
        T.StructField("class_name", T.StringType(), False),
    ]
)


def class_dim(spark: SparkSession) -> DataFrame:
    """The 10-row class dimension (class_id INT, class_name STRING).

    Built from ``range`` and literals, so it is a JVM-only plan (no Python
    worker) with a known row count; its size is fixed by the model's output
    layer, so it is always safe to broadcast."""
    ids = spark.range(NUM_CLASSES).select(F.col("id").cast("int").alias("class_id"))
    return ids.select("class_id", class_name_of(F.col("class_id")).alias("class_name"))


def class_name_of(class_id: Column) -> Column:
    """Class id -> name, null when unknown (the history column's behaviour).

    An in-expression lookup: stays inside whole-stage codegen, no join."""
    names = F.array(*[F.lit(n) for n in CLASS_NAMES])
    return F.when(
        class_id.between(0, NUM_CLASSES - 1), F.element_at(names, (class_id + 1).cast("int"))
    )


def class_label_of(class_id: Column) -> Column:
    """Class id -> name, ``Inconnu`` when unknown (KPI / gallery behaviour)."""
    return F.coalesce(class_name_of(class_id), F.lit(UNKNOWN_NAME))


def short_label(name: Column) -> Column:
    """``"cN: text"`` -> ``text``; a name without ``": "`` (``Inconnu``) is kept."""
    return F.when(F.instr(name, ": ") > 0, F.split_part(name, F.lit(": "), F.lit(2))).otherwise(name)


def class_number(name: Column) -> Column:
    """``"cN: text"`` -> N as INT (sort key of the class axis)."""
    return F.regexp_extract(name, r"^c(\d+)", 1).cast("int")
