import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="quire-tests-")
    spark = (SparkSession.builder.master("local[4]").appName("quire-tests")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
             .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="quire-case-")


@pytest.fixture(scope="session")
def query_runs(spark):
    """Every registered query run once at sf0.001: name -> (columns, rows,
    final executed plan). Shared by the oracle and the plan tests."""
    from quire.plans.queries import QUERIES

    runs = {}
    for name, fn in QUERIES.items():
        df = fn(spark, SF0001)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        runs[name] = (df.columns, rows, plan.split("== Initial Plan ==")[0])
    return runs
