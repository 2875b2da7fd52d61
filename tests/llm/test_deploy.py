"""Every operator's query and the pipeline run from any working directory: what the
Python workers execute needs no copy of the package on their path."""

import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as e
names = [n for n in e.queries() if n == "pipeline" or n.startswith("op")]
for name in names:
    e.queries()[name](spark, {SF_SMALL!r}).collect()
print("RAN", len(names))
"""


def test_operators_from_elsewhere(tmp_dir):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_dir, env=env, capture_output=True, text=True, timeout=900)
    assert "RAN 14" in res.stdout, res.stderr[-2000:]
