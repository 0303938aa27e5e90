from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.llm.marked import maybe


@pytest.mark.parametrize("most_bytes", [1 << 24, 4096])
def test_no_marked_key_is_missed(spark, most_bytes):
    """Few false alarms while the filter has room, more when it is too small, never a miss."""
    keys = spark.range(20_000).select("id", F.xxhash64("id").alias("key"))
    known = maybe(keys.filter("id % 4 = 0").select("key"), most_bytes)
    told = keys.withColumn("known", known("key"))
    assert told.filter("id % 4 = 0 and not known").count() == 0
    alarms = told.filter("id % 4 <> 0 and known").count() / 15_000
    assert alarms < 0.05 if most_bytes > 4096 else alarms < 1


def test_nothing_is_marked(spark):
    keys = spark.range(100).select(F.xxhash64("id").alias("key"))
    assert keys.filter(maybe(keys.filter("false"))("key")).count() == 0
