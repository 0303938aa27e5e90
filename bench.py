"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query
runs once untimed, so that compilation is not measured, and then
``BENCH_REPEATS`` times; the median counts. Results go to the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import build_session, cleanup  # noqa: E402

HEADLINE = (
    "text_clean",
    "tokenize",
    "ngram_3",
    "term_counts",
    "doc_freq",
    "vocabulary_1",
    "vocabulary_2",
    "vocabulary_3",
    "idf_weights",
    "tfidf",
    "feature_long",
    "linear_score",
    "chi2_stats",
    "chi2_select",
    "train_score",
    "eval_metrics",
    "load_labelled",
    "message_scan",
    "post_parse",
    "score_output",
    "route_write",
    "funnel_counts",
    "stream_write",
    "search_plan",
    "phrase_search",
    "page_explode",
    "page_quota",
    "failure_cutoff",
    "publish_json",
    "publish_counts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = build_session(
        "tidemark-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.tidemark.inputTasks": cpus,
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        laps = []
        for lap in range(repeats + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if lap:
                laps.append(time.perf_counter() - began)
        times[name] = round(statistics.median(laps), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of median run times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    cleanup(spark)
    spark.stop()


if __name__ == "__main__":
    main()
