"""whole texts go to the Python workers in batches of bounded bytes."""

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from lookout.llm import frames

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def _texts(spark):
    return spark.range(200, numPartitions=1).select(F.repeat(F.lit("word "), 20_000).alias("text"))


def test_batches_of_whole_texts_are_bounded(spark):
    def run(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows])], names=["rows"])

    @F.arrow_udf("long")
    def size(texts: pa.Array) -> pa.Array:
        return pa.array([len(texts)] * len(texts))

    spark.conf.unset(KEY)
    frames.bound_batches(spark)
    most = frames.BATCH_BYTES // 100_000 + 2
    told = _texts(spark).select(size("text").alias("rows")).agg(F.max("rows"), F.count("*")).first()
    assert told[1] == 200 and told[0] <= most
    spark.conf.unset(KEY)
    assert corpus_pipeline.STAGES[-1][0] == "tokens"
    corpus_pipeline.tokens(spark, _texts(spark).selectExpr("1L AS doc_id", "text", "'' AS lang", "'' AS source"), "")
    assert spark.conf.get(KEY) == str(frames.BATCH_BYTES)
    found = [r["rows"] for r in _texts(spark).mapInArrow(run, "rows long").collect()]
    assert sum(found) == 200 and max(found) <= most


def test_a_smaller_bound_of_the_session_holds(spark):
    spark.conf.set(KEY, "1m")
    try:
        frames.bound_batches(spark)
        assert spark.conf.get(KEY) in ("1m", str(1 << 20), f"{1 << 20}b")
    finally:
        spark.conf.unset(KEY)
