"""The driver may import the entry module from another working directory:
Python workers must still find the package (shipped with addPyFile)."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as E
assert E.entry(spark).count() > 0
assert E.queries()["xlsx_roundtrip"](spark, "/root/testdata/sf0.001").count() > 0
print("OK")
"""


def test_entry_from_another_directory(tmp_path):
    r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=str(tmp_path), capture_output=True,
                       text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-3000:]
    assert "OK" in r.stdout
    assert not os.path.exists(os.path.join(str(tmp_path), "file:"))
