"""The queries in sessions of their own, with Spark's settings as they come.

A plan may differ in a session that is warm or has other settings.
"""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
import __spark_entry__
from pyspark.sql import SparkSession

spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
for name in sys.argv[2:]:
    print(name, __spark_entry__.queries()[name](spark, sys.argv[1]).count())
"""


def rows_of(small_dir, *names):
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, small_dir, *names], cwd=ROOT, capture_output=True, text=True, timeout=900
    )
    assert done.returncode == 0, done.stderr[-3000:]
    return dict(line.split() for line in done.stdout.splitlines() if line.startswith(("op", "pipeline")))


@pytest.mark.parametrize("attempt", range(2))
def test_sharding_first_of_all(small_dir, small_docs, attempt):
    assert rows_of(small_dir, "op1_sharding") == {"op1_sharding": str(small_docs.count())}


def test_all_operators(small_dir):
    from tidemark.llm.catalog import QUERIES

    assert set(rows_of(small_dir, *QUERIES)) == set(QUERIES)
