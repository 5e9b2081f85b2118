"""The driver imports __spark_entry__ from another working directory: every query,
including the one with a Python UDF, must run there too."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
import __spark_entry__ as E
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("ENTRY", E.entry(spark).count())
print("FUZZY", E.queries()["d05_fuzzy_gizom"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_queries_run_from_another_directory():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(prefix="sl-outside-"),
                         env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    lines = dict(line.split() for line in out.stdout.splitlines() if line.startswith(("ENTRY", "FUZZY")))
    assert int(lines["ENTRY"]) > 0 and int(lines["FUZZY"]) >= 0
