"""The registered queries run from any working directory with a bare
session, as the driver runs them: nothing the Python workers execute may need
the package on their path."""

import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
import __spark_entry__ as e
print("ROWS", e.queries()["stateful_trailing"](spark, {SF_SMALL!r}).count())
"""


def test_stream_query_from_elsewhere(tmp_dir):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_dir, env=env, capture_output=True, text=True, timeout=600
    )
    assert "ROWS 1000" in res.stdout, res.stderr[-2000:]
