"""A corpus from raw documents to packed sequences, in five stages.

1. ``quality``      documents whose lines are mostly bad go
2. ``exact_dedup``  of equal texts the largest doc_id stays
3. ``near_dedup``   of each SimHash group (three-word shingles, two bits) the smallest
                    doc_id stays
4. ``mixing``       sources come to their target weights, some documents twice
5. ``packing``      all that is left, as pieces of sequences of 4096 tokens

Each stage works on all that its predecessor kept. Between stages the documents
are written as Parquet to the shared folder and read again, so a lost executor
costs no more than a part of one stage. All stages but the last return the
columns of the documents; a table with more columns keeps them.

An empty table passes all stages and gives no pieces. Null texts have no line:
they are kept or rejected by the share of good documents, and if kept count as
empty. Rows that repeat doc_id and text become one in the second stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import documents, table
from tidemark.llm.dedup import distinct_rows
from tidemark.llm.mixing import mixed
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality import accepted
from tidemark.llm.simhash import one_per_group
from tidemark.session import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Documents that Spark hands to Python at once. Its default of 10,000 rows is
# meant for narrow rows; whole texts make that tens of MB, several times over.
BATCH_DOCS = 1000


def small_batches(stage: Stage) -> Stage:
    """The stage, with BATCH_DOCS set in the session: it is read when the stage's result is written."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_DOCS))
        return stage(spark, docs, sf_dir)

    return run_stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return distinct_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Less memory than by default: the workers have served other stages already.
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(docs, path, run_tokens=500_000, most_words=100_000)


STAGES: list[tuple[str, Stage]] = [
    ("quality", small_batches(quality)),
    ("exact_dedup", small_batches(exact_dedup)),
    ("near_dedup", small_batches(near_dedup)),
    ("mixing", small_batches(mixing)),
    ("packing", small_batches(packing)),
]

# The classifier, the tokenizer and XXH64 are not SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
