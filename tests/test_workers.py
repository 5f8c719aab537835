"""Python workers import the package wherever the driver was started."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
SCRIPT = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as driver
df = driver.queries()["mann_whitney"](spark, "/root/testdata/sf0.001")
print("DONE", len(df.collect()) >= 0)
"""


def test_p_values_from_an_empty_folder(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=600,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
    )
    assert "DONE True" in done.stdout, done.stderr[-2000:]
