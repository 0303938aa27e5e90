"""Chi-squared test of every feature against the label, and top-k selection.

Each distinct value of a feature is a category. Only the cells that occur are
counted, one row each, for any number of labels; the category of absent
features follows from the label totals, so zeros are never materialised.

Over the labels of one category, the sum of (o - e)^2 / e with e = r * c / N is
N / r * sum(o^2 / c) - r, where o is a cell, r the category's and c the label's
rows, and N all rows: labels that do not occur in it add nothing to the sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.special import chi2_tail
from tidemark.session import land

_EXACT = "decimal(38,16)"
# Engines differ in the last places of a p-value; ranks must not.
P_PLACES = 12


def label_totals(rows: DataFrame, label: str = "label") -> DataFrame:
    """``(label, label_rows)``, one row per label."""
    return rows.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("label_rows"))


def _category(squares: Column, size: Column, n: Column) -> Column:
    """The part of one category, from the sum of o^2 / c over its labels."""
    return n.cast("double") / size * squares.cast("double") - size


def chi2_stats(found: DataFrame, totals: DataFrame, feature: str = "feature", label: str = "label") -> DataFrame:
    """``(feature, statistic, dof, p_value)`` from rows ``(feature, tf, label)``.

    Cells are counted first, map-side combined and keyed by feature, value and
    label; the later aggregations see one row per cell. Squares are summed as
    decimals: the statistic does not depend on the order of rows, and features
    with equal tables get equal statistics.
    """
    totals = land(totals, "label-totals")
    corpus = totals.agg(F.sum("label_rows").alias("n"), F.count("*").alias("labels")).first()
    n, labels = F.lit(corpus.n or 0), corpus.labels

    def square(o: str) -> Column:
        return (F.col(o).cast("double") * F.col(o) / F.col("label_rows")).cast(_EXACT)

    cells = found.groupBy(feature, "tf", F.col(label).alias("label")).agg(F.count("*").alias("o"))
    cells = land(cells.join(totals, "label"), "chi2-cells")
    by_value = cells.groupBy(feature, "tf").agg(F.sum("o").alias("size"), F.sum(square("o")).alias("squares"))
    seen = by_value.groupBy(feature).agg(
        F.sum(_category(F.col("squares"), F.col("size"), n).cast(_EXACT)).alias("seen"),
        F.count("*").alias("values"),
        F.sum("size").alias("with"),
    )
    # Rows without the feature, per label; a label that never has it adds all its rows.
    absent = cells.groupBy(feature, "label", "label_rows").agg(F.sum("o").alias("o"))
    absent = absent.withColumn("gap", F.col("label_rows") - F.col("o"))
    missing = absent.groupBy(feature).agg(
        (F.sum(square("gap")) + (n - F.sum("label_rows")).cast(_EXACT)).alias("squares")
    )
    rest = n - F.col("with")
    zero_part = F.when(rest > 0, _category(F.col("squares"), rest, n)).otherwise(0.0)
    dof = (F.col("values") + (rest > 0).cast("int") - 1) * (labels - 1)
    statistic = F.when(dof > 0, F.greatest(F.col("seen").cast("double") + zero_part, F.lit(0.0))).otherwise(0.0)
    tested = seen.join(missing, feature).select(feature, statistic.alias("statistic"), dof.alias("dof"))
    return tested.withColumn("p_value", chi2_tail("statistic", "dof"))


def chi2_select(stats: DataFrame, vocab: DataFrame, size: int, feature: str = "feature") -> DataFrame:
    """The ``size`` features with the lowest p-values, lower feature on ties.

    A feature with idf 0 has one value everywhere and gets p = 1. ``vocab``
    lists every feature, so the result is whole even where no row has a term.
    p-values tie when they agree to ``P_PLACES`` places.
    """
    joined = vocab.join(stats, feature, "left")
    constant = (F.col("idf") == 0) | F.col("statistic").isNull()
    ranked = joined.select(
        *vocab.columns,
        F.when(constant, 0.0).otherwise(F.col("statistic")).alias("statistic"),
        F.when(constant, 0).otherwise(F.col("dof")).alias("dof"),
        F.when(constant, 1.0).otherwise(F.col("p_value")).alias("p_value"),
    )
    return ranked.orderBy(F.round("p_value", P_PLACES), feature).limit(size)
