import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

PROGRAM = """
import importlib.util
from pyspark.sql import SparkSession
found = importlib.util.spec_from_file_location("entry_elsewhere", {path!r})
entry = importlib.util.module_from_spec(found)
found.loader.exec_module(entry)
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4").getOrCreate()
)
rows = entry.queries()["kmeans_step"](spark, "/root/testdata/sf0.001").collect()
assert len(rows) == 640, len(rows)
spark.stop()
print("all rows")
"""


def test_workers_get_the_package(tmp_path):
    """Started from another folder, without the package on the workers' path."""
    run = subprocess.run(
        [sys.executable, "-c", PROGRAM.format(path=str(ROOT / "__spark_entry__.py"))],
        cwd=tmp_path,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable},
        capture_output=True,
        text=True,
        timeout=240,
    )
    assert "all rows" in run.stdout, run.stderr[-2000:]
