"""The package reaches the workers from any working folder."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent

_JOB = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from casewise.session import tune

spark = tune(SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate())

def package(batches):
    import casewise.functions
    for batch in batches:
        yield batch

print("rows", spark.range(3).mapInArrow(package, "id BIGINT").count())
"""


def test_workers_import_the_package_from_any_folder(tmp_path):
    clean = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    script = tmp_path / "job.py"
    script.write_text(_JOB)
    done = subprocess.run(
        [sys.executable, str(script), str(REPO)], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300
    )
    assert "rows 3" in done.stdout, done.stderr[-2000:]
