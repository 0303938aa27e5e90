"""Names of label values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The two label values that have a name.
NEGATIVE, POSITIVE = "0", "4"


def sentiment_name(label: str | Column) -> Column:
    label = F.col(label) if isinstance(label, str) else label
    return (
        F.when(label == POSITIVE, "Positive").when(label == NEGATIVE, "Negative").otherwise("Unknown")
    )


def display_name(label: Column, index: Column, is_sentiment_pair: Column) -> Column:
    """``Negative (0)`` for the two-label task, ``label (index)`` otherwise."""
    named = F.concat(sentiment_name(label), F.lit(" ("), label, F.lit(")"))
    plain = F.concat(label, F.lit(" ("), index.cast("string"), F.lit(")"))
    return F.when(is_sentiment_pair, named).otherwise(plain)
