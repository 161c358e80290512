"""Documents to training tokens: five stages, each over all that the stage
before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of ``documents``.

1. ``quality``: the multiple-instance classifier is trained on ``labels`` and
   scores every document; those under one half go.
2. ``near_duplicates``: one document of each class of near-duplicates stays.
3. ``repeated_passages``: words inside repeated 35-word windows go; a text
   without any is left as it is, others keep their words joined by one space.
   A document of which nothing is left stays, with an empty text.
4. ``mixing``: documents are taken to the target weights of a domain,
   language, source tree, as many words as there are; a document taken in
   several epochs has as many rows.
5. ``tokens``: token ids of every row, and the hash of the text they decode to.

Null texts are empty; repeated rows and ids are handled as the operators say.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lookout.llm import bpe, mil_quality, mixing, probminhash, substring_dedup  # noqa: E402
from lookout.llm.frames import bound_batches, documents, remove_table, work_dir  # noqa: E402
from lookout.llm.queries import tokenizer_path, tree  # noqa: E402
from lookout.llm.samples import crc_of  # noqa: E402

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learnt_from = F.pmod(crc_of(F.col("doc_id")), F.lit(3)) != 1
    model = mil_quality.train(docs, labels, "doc_id", "text", "quality", learnt_from)
    return mil_quality.score(docs, "text", model).where("score >= 0.5").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return probminhash.keep_one(docs, "doc_id", "text").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    kept = substring_dedup.remove_repeated(docs, "doc_id", "text")
    return (
        kept.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")))
        .withColumn("n_chars", F.length("text").cast("long"))
        .select(*COLUMNS)
    )


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, "doc_id", mixing.word_count("text"), tree()).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return bpe.encode_decode(docs, "text", tokenizer_path()).select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mixed),
    ("tokens", tokens),
]

# The classifier and the sketches can't be written in SQL; tests/llm compares
# every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. The table of a stage is removed once the
    next one is written."""
    docs, before = documents(spark, sf_dir).select(*COLUMNS), None
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove_table(spark, before)
        before = path
    return docs
