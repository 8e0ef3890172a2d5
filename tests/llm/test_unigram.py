from __future__ import annotations

import random
import struct

import numpy as np
import pytest
import sentencepiece
from helpers import SF, documents, edge_docs, edge_texts, empty_docs

from demandspark.llm import queries, unigram

PATH = queries.TOKENIZER


@pytest.fixture(scope="module")
def model():
    return unigram.load(PATH)


def _field(number, kind, value):
    def number_of(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    head = number_of(number << 3 | kind)
    return head + (number_of(len(value)) + value if kind == 2 else number_of(value) if kind == 0 else value)


def library(model):
    """The library's own unigram segmenter over the same pieces and scores."""
    kinds = {0: 1, 1: 6, 2: 2, 3: 3}
    proto = b""
    for piece, score, kind in zip(model.pieces, model.scores.tolist(), model.kinds.tolist(), strict=True):
        body = _field(1, 2, piece.encode()) + _field(2, 5, struct.pack("<f", score if kind == 0 else 0)) + _field(3, 0, kinds[kind])
        proto += _field(1, 2, body)
    fallback = int((model.byte_ids >= 0).all())
    proto += _field(2, 2, _field(3, 0, 1) + _field(35, 0, fallback) + _field(4, 0, len(model.pieces)))
    proto += _field(3, 2, _field(1, 2, b"identity") + _field(3, 0, 1) + _field(4, 0, 0) + _field(5, 0, 1))
    return sentencepiece.SentencePieceProcessor(model_proto=proto)


def same(model, texts):
    tool, lib = unigram.Codec(model), library(model)
    ids, at = tool.encode(texts)
    for i, want in enumerate(lib.encode(texts)):
        got = ids[at[i] : at[i + 1]].tolist()
        if got != want:  # the library adds scores in 32 bits and may pick another of two nearly equal paths
            score = lambda x: sum(model.scores[j] for j in x if model.kinds[j] == 0)
            assert score(got) >= score(want) - 1e-3 and abs(score(got) - score(want)) < 1e-2
    back = tool.decode(ids, at)
    assert [b for b, t in zip(back, texts, strict=True) if unigram.MARK not in t] == [t for t in texts if unigram.MARK not in t]


def test_against_the_library(spark, model):
    texts = [r.text for r in documents(spark).collect() if r.text is not None]
    odd = [t for t in edge_texts() if t is not None and len(t) < 100_000] + ["  two  spaces ", "\n\n x\n\n", "▁x ▁", "\t\ttab", "ñ" * 50, "\x00"]
    same(model, texts + odd)


def test_random_small_vocabularies():
    rng = random.Random(3)
    for _ in range(30):
        pieces = {"".join(rng.choice("ab▁ñ") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(2, 14))}
        pieces = ["<unk>", *sorted(pieces | set("ab▁ñ"))]
        kinds = np.array([2] + [0] * (len(pieces) - 1))
        scores = np.array([0.0] + [rng.uniform(-9, -1) for _ in pieces[1:]])
        model = unigram.Model(pieces, scores, kinds)
        texts = ["".join(rng.choice("ab ñc\n") for _ in range(rng.randint(0, 30))) for _ in range(20)]
        tool, lib = unigram.Codec(model), library(model)
        ids, at = tool.encode(texts)
        for i, want in enumerate(lib.encode(texts)):
            # two orders of the same pieces score the same, but for rounding
            assert sorted(ids[at[i] : at[i + 1]].tolist()) == sorted(want)


def test_trie_holds_its_words():
    rng = random.Random(5)
    words = {bytes(rng.choice(b"\x00\x01az\xff") for _ in range(rng.randint(1, 6))): i for i in range(2000)}
    trie = unigram.DoubleArray(words)

    def get(word):
        s = 0
        for b in word:
            t = int(trie.base[s]) + b + 1
            if t >= len(trie.check) or trie.check[t] != s:
                return -1
            s = t
        return int(trie.value[s])

    assert all(get(w) == i for w, i in words.items())
    assert all(get(w + b"q") == -1 for w in words)


def test_memory_of_stretches_is_bounded(model, monkeypatch):
    monkeypatch.setattr(unigram, "MEMO", 10)
    tool = unigram.Codec(model)
    first, at = tool.encode(["some words in a row"])
    for i in range(5):
        tool.encode([f"other{i} words{i} that{i} fill{i} it{i}"])
    again, _ = tool.encode(["some words in a row"])
    assert first.tolist() == again.tolist() and len(tool.memo) <= 20


def test_query_and_round_trip(spark, model):
    rows = queries.op8_sentencepiece(spark, SF)
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    back = {r.doc_id: r.text for r in unigram.decode(rows.select("doc_id", "ids"), model).collect()}
    assert back == texts
    assert rows.where("not exact or n_ids <> size(ids)").count() == 0


def test_edges(spark, model):
    docs = edge_docs(spark)
    rows = unigram.encode(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id == 0:
            assert r.ids is None and r.n_ids == 0 and r.exact is None
        elif r.doc_id == 1:
            assert r.ids == [] and r.exact
        else:
            assert r.exact
    assert unigram.encode(empty_docs(spark), model).count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, -5, 10**6])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in unigram.decode(odd, model).collect()} == {1: None, 2: "", 3: ""}
