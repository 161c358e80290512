"""The driver contract from other places: another working directory, and
without the llm subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

RUN = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", sys.argv[1] + "/__spark_entry__.py")
E = importlib.util.module_from_spec(spec)
spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
qs, sql = E.queries(), E.oracle_sql()
assert set(sql) <= set(qs)
assert any(k.startswith("op") for k in qs) == (sys.argv[2] == "with"), sorted(qs)
assert qs["augment_images"](spark, "/root/testdata/sf0.001").count() > 0  # a Python UDF of the package
print("rows", E.entry(spark).count())
"""


def _run(root, cwd, kind):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", RUN, root, kind], cwd=cwd, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 10" in out.stdout, out.stderr[-3000:]


def test_from_another_working_directory(tmp_path):
    kind = "with" if os.path.exists(f"{ROOT}/lookout/llm/__init__.py") else "without"
    _run(ROOT, tmp_path, kind)


def test_without_the_llm_folders(tmp_path):
    copy = tmp_path / "repo"
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    shutil.copytree(ROOT, copy, ignore=skip)
    _run(str(copy), tmp_path, "without")


def test_a_cluster_must_name_a_shared_folder(monkeypatch):
    from lookout import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext = Context()  # noqa: N815

        class conf:  # noqa: N801
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
