"""Arrow functions run where the workers cannot import the package by path."""

import os
import subprocess
import sys

CODE = """
import sys; sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {shared!r}).config("spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as e
print("ROWS", e.queries()["knn_topk"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_workers_get_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    env |= {"PYSPARK_PYTHON": sys.executable, "SPARK_SCALA_VERSION": "2.13"}
    code = CODE.format(repo=repo, shared=f"file://{tmp_path}/shared")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 5000" in out.stdout, out.stderr[-1500:]


BARE = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {missing!r}:
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Missing())
sys.path.insert(0, {repo!r})
import __spark_entry__ as e
names = e.queries()
print("QUERIES", len(names), sum(n.startswith("op") for n in names))
"""


def test_entry_without_what_the_optional_operators_need():
    """The other queries stay where a library of the optional ones, or their folder, is not there."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for missing in (["public_tokenizers"], ["xxhash"], ["corpus_pipeline"]):
        code = BARE.format(repo=repo, missing=missing)
        out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
        assert "QUERIES" in out.stdout, out.stderr[-1500:]
        n, optional = map(int, out.stdout.split("QUERIES")[1].split())
        assert n >= 70 and optional == 0
