"""Python workers must not need the package on their path: a query with
mapInPandas, run from another directory, still works (the package is
pickled by value)."""

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
         .getOrCreate())
import __spark_entry__ as E
print("ROWS", E.queries()["lead_summary"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_generation_runs_from_another_directory():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(),
                         capture_output=True, text=True, timeout=600, env=env)
    assert "ROWS 200" in out.stdout, out.stderr[-2000:]
