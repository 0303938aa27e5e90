from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemark.llm.packing import balanced, op6_packing, pack_documents
from tidemark.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def check(df, texts):
    pieces = [r.asDict() for r in df.collect()]
    left = defaultdict(list)
    for p in pieces:
        left[p["doc_id"]].append(p)
    wanted = defaultdict(list)
    for key, text in texts:
        wanted[key].append(plain(text) + [2])
    assert set(left) == set(wanted)
    for key, copies in wanted.items():
        if len(copies) > 1:  # copies cannot be told apart: count their ids
            assert sum(p["length"] for p in left[key]) == sum(map(len, copies))
            continue
        at = 0
        for p in sorted(left[key], key=lambda p: p["start"]):
            ids = np.array(copies[0][at : at + p["length"]], "<u4")
            assert (p["start"], p["doc_tokens"]) == (at, len(copies[0]))
            assert p["ids_crc32"] == zlib.crc32(ids.tobytes()) and p["length"] == len(ids) > 0
            at += p["length"]
        assert at == len(copies[0])
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert 0 < at <= 4096 and at & (at - 1) == 0


def test_edge_rows(edge_docs, edge_rows):
    check(pack_documents(edge_docs, PATH), [(k, t) for k, t, _ in edge_rows])


def test_empty_table(no_docs):
    assert pack_documents(no_docs, PATH).collect() == []


def test_whole_table(spark, small_dir, small_docs):
    check(op6_packing(spark, small_dir), [(r.doc_id, r.text) for r in small_docs.collect()])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 700), max_size=60))
def test_every_token_once_and_no_padding(lengths):
    out = balanced(lengths, 128, 1.0, 1 / 128)
    seen = sorted((doc, at, n) for sequence in out for doc, at, n in sequence)
    for doc, n in enumerate(lengths):
        at = 0
        for _, start, length in (p for p in seen if p[0] == doc):
            assert start == at
            at += length
        assert at == n
    sizes = [sum(n for _, _, n in s) for s in out]
    assert all(n & (n - 1) == 0 and n <= 128 for n in sizes)
    assert len([n for n in sizes if n < 128]) <= 7


def test_costs_are_balanced():
    """Full sequences of short documents cost less unequal amounts than packing in order."""
    rng = random.Random(5)
    lengths = [min(int(rng.expovariate(1 / 300)) + 1, 4000) for _ in range(2000)]

    def spread(sequences):
        costs = [sum(n + n * n / 4096 for _, _, n in s) for s in sequences if sum(n for _, _, n in s) == 4096]
        return np.std(costs) / np.mean(costs)

    in_order, open_piece = [], []
    for doc, n in enumerate(lengths):
        while n:
            take = min(n, 4096 - sum(x[2] for x in open_piece))
            open_piece.append((doc, 0, take))
            n -= take
            if sum(x[2] for x in open_piece) == 4096:
                in_order, open_piece = in_order + [open_piece], []
    assert spread(balanced(lengths, 4096, 1.0, 1 / 4096)) < spread(in_order)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abEH'’.,*!?|<>§é̱́İßstlrvemd019 \n\t\x1c\xa0　你😀"), max_size=40), max_size=4))
def test_encoder_equals_the_library(texts):
    encoder = WordEncoder(PATH, most_words=20, words_at_once=3)
    for _ in range(2):
        got = encoder.texts([t.encode() for t in texts])
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [plain(t) for t in texts]


def test_ids_of_latin_letters_beside_punctuation():
    """Every letter whose pieces are looked up apart, and the first beyond, before and after punctuation."""
    letters = [chr(c) for c in range(0xA0, 0x290)]
    texts = [f"{a}{c}{b}" for c in letters for a, b in (("", "_#"), ("see ", "! now"), ("x.", "y"), ("(", ")"), ("-", "1"))]
    got = WordEncoder(PATH).texts([t.encode() for t in texts])
    wrong = [t for t, x in zip(texts, got) if np.frombuffer(x, "<u4").tolist() != plain(t)]
    assert wrong == []
