"""Queries whose work runs in Python workers must not depend on the working directory
(the driver imports the entry module from elsewhere)."""

import os
import subprocess
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as E
q = E.queries()
print("ROWS", q["login_fail_timer"](spark, {SF!r}).count(), q["stateful_apply"](spark, {SF!r}).count())
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_python_worker_queries_from_another_cwd():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(), env=env,
                         capture_output=True, text=True, timeout=600)
    rows = [l for l in out.stdout.splitlines() if l.startswith("ROWS")]
    assert rows, out.stderr[-2000:]
    _, timer, cap = rows[0].split()
    assert int(cap) > 0 and int(timer) >= 0
