"""The scoring job as a stream.

Offsets and output files are tracked in the checkpoint, so a restart neither
re-reads nor re-writes what is done: no copies in the collections.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.dates import event_time
from tidemark.plans.scoring import Scorer, score_messages
from tidemark.schemas import MESSAGE
from tidemark.session import land
from tidemark.sources.readers import kafka_options


BatchSave = Callable[[DataFrameWriter, str, int], None]


def kafka_stream(spark: SparkSession, servers: str, topics) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topics)).load()


def log_stream(spark: SparkSession, path: str) -> DataFrame:
    """A landed message log as a stream of its files."""
    return spark.readStream.schema(MESSAGE).parquet(path)


def post_key() -> Column:
    """The post's id; without one the message's place, or if that is unknown too a key of its own."""
    place = F.concat_ws("/", "topic", "partition", "offset")
    known = F.col("partition").isNotNull() & F.col("offset").isNotNull()
    # No id begins with a null character.
    return F.coalesce("tweet_id", F.concat(F.lit("\0"), F.when(known, place).otherwise(F.uuid())))


def start(
    messages: DataFrame,
    scorer: PipelineModel | Scorer,
    table: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: dict | None = None,
    within: str | None = None,
    post_time: bool = False,
) -> StreamingQuery:
    """Score what arrives; by default drain what is there and stop.

    See :func:`scored_stream` for ``within`` and ``post_time``.
    """
    scored = scored_stream(messages, scorer, table, within, post_time)
    writer = scored.writeStream.format(fmt).partitionBy("collection").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    return writer.start(path)


def scored_stream(
    messages: DataFrame, scorer: PipelineModel | Scorer, table: DataFrame, within: str | None = None, post_time: bool = False
) -> DataFrame:
    """The scored rows of a stream with their collection.

    With ``within``, for example ``1 hour``, copies of a post that arrive in a
    collection that much later are dropped; the watermark bounds the state, and
    rows that come later than it are dropped as well. Time is the message's,
    or with ``post_time`` the post's own (``event_time``), which falls back to
    the message's. Posts without an id are no copies of each other and all
    stay, as in a batch; only a message that is delivered again is dropped.
    """
    if not within:
        return score_messages(messages, scorer, table)
    place = ("timestamp", "topic", "partition", "offset")
    scored = score_messages(messages, scorer, table, keep=place)
    time = event_time("createdAt", "timestamp") if post_time else F.col("timestamp")
    scored = scored.withColumn("_time", time).withWatermark("_time", within)
    scored = scored.withColumn("_key", post_key()).dropDuplicatesWithinWatermark(["collection", "_key"])
    return scored.drop("_key", "_time", *place)


def start_each(
    messages: DataFrame,
    scorer: PipelineModel | Scorer,
    table: DataFrame,
    collections: Sequence[str],
    save: BatchSave,
    checkpoint: str,
    trigger: dict | None = None,
    within: str | None = None,
    post_time: bool = False,
) -> StreamingQuery:
    """Score what arrives into a store that takes one collection per write.

    ``save`` gets a writer, the collection's name and the batch's id, for
    example ``lambda w, c, b: w.mode("overwrite").parquet(f"{out}/{c}/batch={b}")``.
    After a failure Spark runs the batch again under the same id and with the
    same messages, so that a ``save`` which replaces what the batch has written
    leaves no copies. A batch is landed and read once per collection.
    """

    def write(rows: DataFrame, batch: int) -> None:
        landed = land(rows, "scored-batch")
        for name in collections:
            mine = landed.filter(F.col("collection") == name).drop("collection")
            save(mine.write, name, batch)

    writer = scored_stream(messages, scorer, table, within, post_time).writeStream.foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    return writer.start()
