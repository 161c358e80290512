"""Every stage of the pipeline against a brute-force version on its own input."""

import collections
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from lookout.llm import mil_quality, queries
from lookout.llm.frames import work_dir
from tests.conftest import SF001
from tests.llm import test_probminhash, test_substring_dedup


@pytest.fixture(scope="module")
def stages(spark):
    """[(docs before, docs after)] of each stage, written and read again."""
    docs, out = spark.read.parquet(f"{SF001}/documents.parquet"), []
    for name, stage in C.STAGES:
        path = work_dir(spark, f"test-{name}")
        stage(spark, docs, SF001).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs, after))
        docs = after
    return out


def test_columns(stages):
    for _, after in stages[:-1]:
        assert after.columns == list(C.COLUMNS)


def test_quality(spark, stages):
    before, after = stages[0]
    learnt_from = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    model = mil_quality.train(before, labels, "doc_id", "text", "quality", learnt_from)
    scored = mil_quality.score(before, "text", model).collect()
    assert {r.doc_id for r in scored if r.score >= 0.5} == {r.doc_id for r in after.collect()}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    kept = {r.doc_id for r in after.collect()}
    assert len(good - kept) <= 0.03 * len(good)


def test_near_duplicates(stages):
    before, after = stages[1]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, c in test_probminhash.brute(rows)})
    assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in before.collect()}


def test_repeated_passages(stages):
    before, after = stages[2]
    texts = {r.doc_id: r.text for r in before.collect()}
    want = {
        d: kept if removed else texts[d]
        for d, _, removed, kept in test_substring_dedup.brute(list(texts.items()), 35)
    }
    assert {r.doc_id: r.text for r in after.collect()} == want
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_mixing(stages):
    before, after = stages[3]
    con = duckdb.connect()
    con.register("documents", before.toArrow())
    want = collections.Counter(r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.MIX_SQL})").fetchall())
    assert collections.Counter(r.doc_id for r in after.collect()) == want


def test_tokens(stages):
    before, after = stages[4]
    reference = Tokenizer.from_file(queries.tokenizer_path())
    want = collections.Counter()
    for r in before.collect():
        ids = reference.encode(r.text, add_special_tokens=False).ids
        sha = hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        want[r.doc_id, len(ids), tuple(ids), sha] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded_sha256) for r in after.collect()) == want


def test_run_gives_the_stages_result(spark, stages):
    key = ["doc_id", "n_tokens", "decoded_sha256"]
    got = collections.Counter(tuple(r) for r in C.run(spark, SF001).select(*key).collect())
    assert got == collections.Counter(tuple(r) for r in stages[-1][1].select(*key).collect())


def test_odd_rows_and_empty_tables(spark, make_docs, odd_rows, tmp_path):
    labels = spark.createDataFrame([(5, 1, 0), (7, 0, 1), (None, 1, 1), (4, None, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for rows in (odd_rows, []):
        docs = make_docs(rows, ("lang", "source", "score", "ids")).withColumn("n_chars", F.lit(1).cast("long"))
        for name, stage in C.STAGES:
            docs = stage(spark, docs, str(tmp_path)).checkpoint()
        assert docs.count() <= 4 * len(rows)
