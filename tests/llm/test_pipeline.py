from __future__ import annotations

import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm.dedup import deduplicate
from tidemark.llm.mixing import mix_report
from tidemark.llm.quality import score_documents
from tidemark.llm.simhash import simhash_groups
from tidemark.session import fresh_path

ROOT = Path(corpus_pipeline.__file__).resolve().parent


def rows(df):
    return Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_every_stage_takes_effect(spark, small_dir, small_docs):
    """Each stage keeps what its operator, which other tests hold against brute force, says of its own input."""
    docs, stages = small_docs, dict(corpus_pipeline.STAGES)
    columns = docs.columns

    def after(name):
        path = fresh_path(spark, name)
        stages[name](spark, docs, small_dir).write.parquet(path)
        return spark.read.parquet(path)

    labels = spark.read.parquet(f"{small_dir}/labels.parquet")
    good = score_documents(docs, labels).filter("predicted = 1").select("doc_id")
    kept = after("quality")
    assert rows(kept) == rows(docs.join(good, "doc_id")) and 0 < kept.count() < docs.count()
    docs = kept

    stay = deduplicate(docs).filter("kept").select("doc_id")
    kept = after("exact_dedup")
    assert rows(kept) == rows(docs.join(stay, "doc_id"))
    docs = kept

    stay = simhash_groups(docs).filter("doc_id = component_id").select("doc_id")
    kept = after("near_dedup")
    assert rows(kept) == rows(docs.join(stay, "doc_id"))
    docs = kept

    copies = {r.doc_id: r.copies for r in mix_report(docs).collect()}
    kept = after("mixing")
    assert kept.columns == columns
    assert {k: n for (k, _), n in rows(kept).items()} == {k: n for k, n in copies.items() if n}
    docs = kept

    pieces = after("packing")
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = Counter()
    for (key, text), n in rows(docs).items():
        wanted[key] += n * (len(plain.encode(text, add_special_tokens=False).ids) + 1)
    got = Counter()
    for r in pieces.collect():
        got[r.doc_id] += r.length
    assert got == wanted


def test_odd_rows_pass(spark, tmp_path, edge_docs):
    """Nulls, empty and repeated rows, extra columns: all stages run, and keep the columns."""
    edge_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (15, 0), (16, 1)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == edge_docs.columns, name
        path = fresh_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_empty_table(spark, tmp_path, no_docs):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_runs_from_another_folder(tmp_path):
    """Workers need no path to this repository."""
    script = (
        f"import sys; sys.path.insert(0, {str(ROOT)!r});"
        "import __spark_entry__ as entry; from tidemark.session import build_session;"
        "s = build_session(master='local[2]', **{'spark.ui.enabled': 'false', 'spark.sql.shuffle.partitions': '2',"
        "'spark.sql.adaptive.coalescePartitions.initialPartitionNum': '2'});"
        "names = ['op2_exact_dedup', 'op5_lm_scoring', 'op7_line_quality', 'op8_simhash'];"
        "print('rows', *[entry.queries()[n](s, '/root/testdata/sf0.001').count() for n in names])"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "rows 200 200 200 200" in done.stdout, done.stderr[-2000:]
