"""Confusion matrix and the four evaluation scores, from one pass.

Both start from :func:`confusion_counts`, which has one row per pair of classes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def confusion_counts(scored: DataFrame) -> DataFrame:
    """``(label, prediction, n)``: the only step that reads the scored rows."""
    return scored.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def confusion_matrix(counts: DataFrame, labels: DataFrame | None = None, most_classes: int = 1000) -> DataFrame:
    """Every (label, prediction) pair of the label set, zeros included.

    ``labels`` has one column ``label``; without it the labels that occur are
    used. The matrix has a cell for each pair, so a column with more than
    ``most_classes`` distinct values is refused: it is no class label.
    """
    known = (labels if labels is not None else counts).select("label").distinct()
    classes = known.count()
    if classes > most_classes:
        raise ValueError(f"{classes} distinct labels are more than most_classes = {most_classes}")
    axes = known.agg(F.sort_array(F.collect_set("label")).alias("axis"))
    grid = axes.select("axis", F.explode("axis").alias("label")).select(
        "label", F.explode("axis").alias("prediction")
    )
    return (
        grid.join(counts, ["label", "prediction"], "left")
        .select("label", "prediction", F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("label", "prediction")
    )


def eval_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy and label-weighted precision, recall and F1 in one row.

    A class that is never predicted has precision 0.
    """
    sides = F.inline(
        F.array(
            F.struct(
                F.col("label").alias("cls"),
                F.col("n").alias("actual"),
                F.lit(0).cast("bigint").alias("predicted"),
                F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"),
            ),
            F.struct(
                F.col("prediction").alias("cls"),
                F.lit(0).cast("bigint").alias("actual"),
                F.col("n").alias("predicted"),
                F.lit(0).cast("bigint").alias("hit"),
            ),
        )
    )
    per_class = (
        counts.select(sides)
        .groupBy("cls")
        .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit"))
        .withColumn("p", F.when(F.col("predicted") > 0, F.col("hit") / F.col("predicted")).otherwise(0.0))
        .withColumn("r", F.when(F.col("actual") > 0, F.col("hit") / F.col("actual")).otherwise(0.0))
        .withColumn(
            "f",
            F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0),
        )
    )
    total = F.sum("actual")
    weighted = lambda c: F.sum(F.col("actual") * F.col(c)) / total
    return per_class.agg(
        (F.sum("hit") / total).alias("accuracy"),
        weighted("p").alias("weighted_precision"),
        weighted("r").alias("weighted_recall"),
        weighted("f").alias("f1"),
    )
