"""Row counts per stage and topic in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidemark.operators.messages import decode, has_text, is_object, parse_json


def funnel_counts(messages: DataFrame, stored: DataFrame) -> DataFrame:
    """Counts per topic, and in total in the row where ``is_total`` is true.

    ``n_malformed`` counts values that are no JSON object, ``n_valid`` posts
    with a text; only that field is parsed. ``stored`` has a ``topic`` for each
    row that was written, so ``n_written`` is what is there, not what should be.
    """
    read = decode(messages).withColumn("malformed", ~is_object("value_str"))
    text = parse_json(read, "value_str", "text string", keep=("topic", "malformed"))
    counts = text.groupBy("topic").agg(
        F.count("*").alias("n_raw"),
        F.count_if("malformed").alias("n_malformed"),
        F.count_if(has_text("text")).alias("n_valid"),
    )
    written = stored.groupBy(F.col("topic").alias("_to")).agg(F.count("*").alias("_n"))
    both = counts.join(written, F.col("topic").eqNullSafe(F.col("_to")), "left")
    both = both.withColumn("n_written", F.coalesce("_n", F.lit(0)))
    sums = [F.sum(c).alias(c) for c in ("n_raw", "n_malformed", "n_valid", "n_written")]
    return both.rollup("topic").agg((F.grouping("topic") == 1).alias("is_total"), *sums)


def figures(observation: Observation) -> dict:
    """What an observation saw; nothing where Spark found that there are no rows and left its place out."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


class Tally:
    """Counts per topic that a job takes of its own rows while it writes, without another pass.

    ``watch`` adds a count to the plan at the place of the rows; after the
    write, ``report`` has the figures. Topics are a given list, as a job's
    subscriptions are; others count in the total only. A stage that runs again
    after executors were lost counts its rows again: where that must not be,
    count what was stored (:func:`funnel_counts`).
    """

    def __init__(self, topics: Sequence[str]):
        self.topics = list(dict.fromkeys(topics))
        self.watched: dict[str, Observation] = {}

    def watch(self, rows: DataFrame, name: str, where: Column | None = None) -> DataFrame:
        """The rows, which have a ``topic``; those ``where`` holds count as ``name``."""
        counted = F.lit(True) if where is None else where
        observation = self.watched[name] = Observation()
        sums = [F.count_if(counted & (F.col("topic") == t)).alias(str(i)) for i, t in enumerate(self.topics)]
        return rows.observe(observation, F.count_if(counted).alias("all"), *sums)

    def report(self, spark: SparkSession) -> DataFrame:
        """``topic, is_total`` and a column per name: a row per topic that any count saw, and the total."""
        found = {name: figures(observation) for name, observation in self.watched.items()}
        seen = [i for i in range(len(self.topics)) if any(f.get(str(i)) for f in found.values())]
        rows = [(self.topics[i], False, *[int(f.get(str(i)) or 0) for f in found.values()]) for i in seen]
        rows.append((None, True, *[int(f.get("all") or 0) for f in found.values()]))
        schema = "topic string, is_total boolean" + "".join(f", {name} bigint" for name in found)
        return spark.createDataFrame(rows, schema)


def topic_report(parsed: DataFrame, table: DataFrame) -> DataFrame:
    """One row per route: what arrived, what is usable, whether it is written.

    A topic without rows, or without usable rows, is reported and writes
    nothing.
    """
    counts = parsed.groupBy("topic").agg(
        F.count("*").alias("n_raw"), F.count_if(has_text("text")).alias("n_valid")
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return (
        table.join(counts, "topic", "left")
        .select("topic", "collection", zero("n_raw"), zero("n_valid"))
        .withColumn("written", F.col("n_valid") > 0)
    )
