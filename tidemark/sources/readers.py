"""Readers. Every schema is declared; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.schemas import LABELLED, MESSAGE
from tidemark.session import land


def read_labelled_csv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Headerless labelled posts by position.

    Permissive: a bad number is null, missing trailing fields are null, empty
    fields are null. One record per line, so large files stay splittable.
    """
    return spark.read.schema(LABELLED).csv(path, header=False, encoding=encoding)


CORRUPT = "_record"


def read_checked_csv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`read_labelled_csv`, and beside them the broken records as they stand in the file.

    A record is broken if it has too few or too many fields, or a text where a
    number belongs. Its row is among the rows all the same. ``broken`` has
    ``reason`` and ``record``. The parsed file is landed, so both are of one
    reading.
    """
    schema = StructType([*LABELLED.fields, StructField(CORRUPT, StringType())])
    options = {"header": False, "encoding": encoding, "columnNameOfCorruptRecord": CORRUPT}
    parsed = land(spark.read.schema(schema).csv(path, **options), "parsed-csv")
    # A number that cannot be read is the only field that is null and not empty in the record.
    number = F.col("target").isNull() & ~F.startswith(CORRUPT, F.lit(",")) & (F.trim(CORRUPT) != "")
    reason = F.when(number, "bad number").otherwise("number of fields")
    broken = parsed.filter(F.col(CORRUPT).isNotNull()).select(reason.alias("reason"), F.col(CORRUPT).alias("record"))
    return parsed.drop(CORRUPT), broken


def topic_list(topics: str | Sequence[str]) -> list[str]:
    """Topics from a comma list or a sequence."""
    parts = topics.split(",") if isinstance(topics, str) else topics
    return [t.strip() for t in parts if t.strip()]


def kafka_options(
    servers: str, topics: str | Sequence[str], starting: str = "earliest", ending: str | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topic_list(topics)),
        "startingOffsets": starting,
    }
    if ending:
        options["endingOffsets"] = ending
    return options


def read_kafka(spark: SparkSession, servers: str, topics: str | Sequence[str], **options) -> DataFrame:
    """Bounded scan of many topics, from earliest to the offsets of this moment."""
    return spark.read.format("kafka").options(**kafka_options(servers, topics, **options)).load()


def read_message_log(spark: SparkSession, path: str, topics: str | Sequence[str]) -> DataFrame:
    """The same rows from a landed Parquet log; the topic filter reaches the scan."""
    log = spark.read.schema(MESSAGE).parquet(path)
    return log.filter(F.col("topic").isin(topic_list(topics)))
