import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from bidscope.operators.causal import _p_value
row = spark.range(1).selectExpr("2.0D AS t", "10.0D AS f").select(_p_value("t", "f").alias("p")).first()
print("p =", round(row["p"], 4))
"""


def test_executors_need_no_installed_package(tmp_path):
    """Python functions run in a session whose workers cannot import this package."""
    repo = str(Path(__file__).resolve().parents[1])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo)],
        cwd=tmp_path,
        env=env,
        capture_output=True,
        text=True,
        timeout=180,
    )
    assert "p = 0.0734" in done.stdout, done.stderr[-2000:]
