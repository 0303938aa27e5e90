"""Writers: collections, message topics and fitted models."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, DataFrameWriter, functions as F


def append_collections(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append every row to its ``collection`` folder, all collections in one job.

    No shuffle: each task writes its own rows, so a collection that receives
    most of the data is written by all tasks. Empty collections get no folder.
    """
    rows.write.format(fmt).mode("append").partitionBy("collection").save(path)


def write_batch(rows: DataFrame, path: str, batch_id: str, fmt: str = "parquet") -> None:
    """Repeatable write: running a batch again replaces that batch only."""
    target = f"{path}/batch={batch_id}"
    rows.write.format(fmt).mode("overwrite").partitionBy("collection").save(target)


def append_each(
    rows: DataFrame, collections: Iterable[str], save: Callable[[DataFrameWriter, str], None]
) -> None:
    """Append to a store that takes one collection per write.

    ``save`` gets a writer in append mode and the collection name, for example
    ``lambda w, c: w.format("mongodb").option("collection", c).save()``. Pass
    landed or persisted rows: they are read once per collection, which is a
    list of configured names.
    """
    for name in collections:
        mine = rows.filter(F.col("collection") == name).drop("collection")
        save(mine.write.mode("append"), name)


def publish_kafka(messages: DataFrame, servers: str) -> None:
    """Send message rows to the topic each of them names."""
    sink = messages.select("key", "value", "topic").write.format("kafka")
    sink.option("kafka.bootstrap.servers", servers).save()


def publish_log(messages: DataFrame, path: str) -> None:
    """The same rows as an appended Parquet log, partitioned by topic."""
    messages.write.mode("append").partitionBy("topic").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
