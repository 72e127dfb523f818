"""Python-backed queries must run in a session started outside the repo folder
(Python workers then cannot import the package from their working directory)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.driver.host", "127.0.0.1").getOrCreate())
import __spark_entry__ as E
rows = E.queries()["partition_stats"](spark, "/root/testdata/sf0.001").collect()
rows += E.queries()["reduce_opaque"](spark, "/root/testdata/sf0.001").collect()
print("ROWS", len(rows))
"""


def test_python_workers_need_no_installed_package():
    cwd = tempfile.mkdtemp(prefix="pairflow-elsewhere-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS" in res.stdout, res.stderr[-2000:]
