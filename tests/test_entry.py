"""The registry can be read before any Spark session exists."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_registry_needs_no_session():
    code = "import __spark_entry__ as e; from pyspark import SparkContext; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q) and len(q) > 30 and SparkContext._active_spark_context is None"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
