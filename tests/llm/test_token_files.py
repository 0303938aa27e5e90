from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm.token_files import (
    load_dictionary,
    op10_token_files,
    opened,
    read_frame,
    read_token_files,
    write_token_files,
)

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [1]


def test_round_trip_of_edge_rows(spark, edge_docs, edge_rows, tmp_path):
    out = write_token_files(edge_docs, str(tmp_path / "files"), PATH, docs_per_segment=3, chunk_bytes=64)
    rows = sorted(read_token_files(spark, out).collect(), key=lambda r: r.start)
    order = sorted(edge_rows, key=lambda r: (r[0] is not None, r[0]))
    assert [r.doc_id for r in rows] == [k for k, _, _ in order]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in rows] == [plain(t) for _, t, _ in order]
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()


def test_empty_table(spark, no_docs, tmp_path):
    out = write_token_files(no_docs, str(tmp_path / "files"), PATH)
    assert read_token_files(spark, out).collect() == []


def test_one_document_is_read_alone(spark, small_docs, tmp_path):
    out = write_token_files(small_docs, str(tmp_path / "files"), PATH)
    _, dictionary = load_dictionary(spark, out)
    assert dictionary
    chunk = spark.read.parquet(f"{out}/segments").orderBy("segment", "chunk").first()
    keys = opened(bytes(chunk["index"]))[0][0]
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    last = len(keys) - 1
    for position in {0, last // 2, last}:
        ids = read_frame(dictionary, bytes(chunk["frames"]), bytes(chunk["index"]), position)
        assert ids.tolist() == plain(texts[keys[position]])


def test_other_dictionary_is_refused(spark, small_docs, tmp_path):
    out = write_token_files(small_docs.limit(20), str(tmp_path / "files"), PATH)
    wrong = spark.read.parquet(f"{out}/dictionary").selectExpr("dictionary_hash", "cast('x' as binary) as dictionary")
    wrong.write.parquet(str(tmp_path / "wrong/dictionary"))
    with pytest.raises(ValueError, match="does not match"):
        load_dictionary(spark, str(tmp_path / "wrong"))


def test_query(spark, small_dir, small_docs):
    rows = sorted(op10_token_files(spark, small_dir).collect())
    at = 0
    for row, doc in zip(rows, small_docs.orderBy("doc_id").collect(), strict=True):
        ids = plain(doc.text)
        assert tuple(row) == (doc.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
