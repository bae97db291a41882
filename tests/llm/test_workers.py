"""Operators on workers that cannot import the package, and what a worker keeps."""

import os
import subprocess
import sys
import types

from glossaflow.llm.common import worker_state

SCRIPT = """
import os, sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry_points
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local-cluster[1,2,1024]").config("spark.ui.enabled", "false")
         .config("spark.executor.memory", "1g").config("spark.sql.shuffle.partitions", "4")
         .config("spark.driver.host", "127.0.0.1").config("spark.checkpoint.dir", {folder!r}).getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def importable(rows):
    import importlib.util
    yield from [importlib.util.find_spec("glossaflow") is not None for _ in rows]

print("importable", any(spark.sparkContext.parallelize([1], 1).mapPartitions(importable).collect()))
for name, query in entry_points.queries().items():
    if name.startswith("op"):
        print(name.split("_")[0], query(spark, "/root/testdata/sf0.001").count() > 0, flush=True)
"""


def test_workers_without_the_package(tmp_path):
    """The script runs in a folder of its own, and the workers get no path to the package."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(root=root, folder=str(tmp_path / "shared"))
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    done = [line.split() for line in run.stdout.splitlines() if line.startswith(("op", "importable"))]
    assert ["importable", "False"] in done, run.stderr[-3000:]
    assert [name for name, found in done if found == "True" and name.startswith("op")] == [
        f"op{n}" for n in range(1, 14)], run.stderr[-3000:]


def test_a_worker_holds_the_state_of_one_operator(monkeypatch):
    monkeypatch.setitem(sys.modules, "_worker_state", types.ModuleType("_worker_state"))
    made = []
    build = lambda name: lambda: made.append(name) or name
    assert worker_state("a", 1, build("a1")) == "a1" and worker_state("a-more", 1, build("am")) == "am"
    assert worker_state("a", 1, build("a1 again")) == "a1" and made == ["a1", "am"]
    assert worker_state("b", 1, build("b1")) == "b1" and list(sys.modules["_worker_state"].held) == ["b"]
    assert worker_state("a", 1, build("a2")) == "a2" and worker_state("a", 2, build("a3")) == "a3"
    assert list(sys.modules["_worker_state"].held) == ["a"]
