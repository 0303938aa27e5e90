from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings, strategies as st

from compare import connect, duck_rows, spark_rows
from tidemark.llm import infill
from tidemark.llm.infill import OP13_SQL, Layout, Units, chunks, digests, op13_infill, output_pieces, output_texts, split_marks

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(key, text):
    """The rule, read from its statement: n, form, prefix_chars, middle_chars, output."""
    text = text or ""
    units = UNIT.findall(text)
    drawn = sha(f"1:{'' if key is None else key}")
    h1, h2, h3, h4 = (int(drawn[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def expected(rows):
    out = []
    for key, text in rows:
        n, form, p, m, output = brute(key, text)
        out.append((key, n, form, p, m, sha(output), sha(text or "")))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_edge_rows(edge_docs, edge_rows):
    rows = [(k, t) for k, t, _ in edge_rows]
    for chunk in (7, infill.CHUNK):
        assert got(digests(output_pieces(edge_docs, chunk=chunk))) == expected(rows)


def test_outputs_are_whole_texts(spark):
    odd = ["<P>", "a<S>b", "<<P", "S><", "<S", "<M", "a" * 9000, "é" * 9000, "<P " * 4000, "one two<", ">x<<M", None, ""]
    rows = [(i, odd[i % len(odd)]) for i in range(200)]
    pieces = output_pieces(spark.createDataFrame(rows, "doc_id bigint, text string"), chunk=64)
    assert got(digests(pieces)) == expected(rows)
    assert got(output_texts(pieces)) == sorted(((k, *brute(k, t)) for k, t in rows), key=str)


def test_documents(spark, small_dir, small_docs):
    df = op13_infill(spark, small_dir)
    assert got(df) == expected([(r.doc_id, r.text) for r in small_docs.collect()])
    assert spark_rows(df) == duck_rows(connect(small_dir), OP13_SQL)
    forms = {r.form: r["count"] for r in df.groupBy("form").count().collect()}
    assert set(forms) == {"plain", "psm", "spm"}


def test_repeated_rows_and_hot_key(spark):
    rows = [(7, "the same id") if i % 3 else (i, f"text {i}") for i in range(300)]
    assert got(digests(output_pieces(spark.createDataFrame(rows, "doc_id bigint, text string")))) == expected(rows)


def test_empty_table(no_docs):
    df = digests(output_pieces(no_docs))
    assert df.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert df.collect() == [] and output_texts(output_pieces(no_docs)).collect() == []


def test_shares_and_seed_are_parameters(spark):
    docs = spark.range(300).selectExpr("id as doc_id", "concat('some text of ', id) as text")
    forms = [r.form for r in digests(output_pieces(docs, Layout(seed=2, plain_percent=0, spm_percent=100))).collect()]
    assert set(forms) == {"spm"}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ<>PSM é\n你", max_size=60), st.integers(0, 10_000), st.integers(1, 9))
def test_pieces_and_their_split(text, key, most):
    raw = text.encode()
    (n, form, p, m), pieces = Layout().pieces(key, raw, most)
    assert (n, form, p, m, b"".join(pieces).decode()) == brute(key, text)
    parts = ["", "", ""]
    for part, data in split_marks(pieces, form):
        parts[part] += data.decode("latin-1")
    assert "".join(parts).encode("latin-1") == raw


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abé <你", max_size=80), st.integers(1, 5))
def test_units_over_small_blocks(text, block):
    size, infill.BLOCK = infill.BLOCK, block
    try:
        raw = text.encode()
        units, words = Units(raw), UNIT.findall(text)
        assert units.total == len(words)
        assert [units.place(i) for i in range(len(words) + 1)] == [len("".join(words[:i]).encode()) for i in range(len(words) + 1)]
        spans = list(chunks(units.data, 0, len(raw), block))
        assert b"".join(raw[a:b] for a, b in spans) == raw
        assert all(a in {units.place(i) for i in range(len(words) + 1)} for a, _ in spans)
    finally:
        infill.BLOCK = size
