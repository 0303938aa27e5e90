"""Label index, label dictionary and rows that cannot be trained on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.labels import NEGATIVE, POSITIVE, display_name, sentiment_name


def distinct_labels(rows: DataFrame, column: str = "label") -> DataFrame:
    return rows.select(column).distinct().orderBy(column)


def label_index(rows: DataFrame, column: str = "target") -> DataFrame:
    """``(label, label_index, n)``: labels as text, ascending, numbered from 0.

    Null labels are skipped. The numbering window sees one row per distinct
    label, after the aggregation has combined them.
    """
    labels = (
        rows.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("label"))
        .agg(F.count("*").alias("n"))
    )
    position = F.row_number().over(Window.orderBy("label")) - 1
    return labels.select("label", position.cast("double").alias("label_index"), "n")


def describe_labels(index: DataFrame) -> DataFrame:
    """Add sentiment and display names to a label dictionary."""
    everything = Window.partitionBy()
    pair = (F.count("*").over(everything) == 2) & (
        F.count(F.when(F.col("label").isin(NEGATIVE, POSITIVE), 1)).over(everything) == 2
    )
    return index.select(
        "*",
        sentiment_name("label").alias("sentiment"),
        display_name(F.col("label"), F.col("label_index"), pair).alias("display"),
    ).orderBy("label_index")


def split_usable(rows: DataFrame, text: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a text and a label, and the quarantine of all others."""
    usable = F.col(text).isNotNull() & F.col(label).isNotNull()
    return rows.filter(usable), rows.filter(~usable)
