from __future__ import annotations

import random
from collections import Counter

import numpy as np
import zstandard
from helpers import documents, edge_docs, empty_docs, words

from demandspark.llm import quality


def plain(text):
    w = words(text)
    windows = list(zip(*(w[i:] for i in range(5)), strict=False))
    count = Counter(windows)
    covered = set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def check(docs):
    texts = Counter((r.doc_id, r.text) for r in docs.collect())
    by_id = {i: t for i, t in texts}
    rows = quality.judge(docs).collect()
    assert len(rows) == sum(texts.values())
    for r in rows:
        got = r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words
        assert got == plain(by_id[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (r.reason is None) and not (r.base_failed and r.kept)
        raw = (by_id[r.doc_id] or "").encode()
        if raw:
            assert r.ratio == len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(raw)) / len(raw)
        else:
            assert r.ratio is None and not r.kept
    return {r.doc_id: r for r in rows}


def test_against_plain_version(spark):
    check(documents(spark))


def test_edges(spark):
    found = check(edge_docs(spark))
    assert found[11].n_repeat_words == 20_000
    assert quality.judge(empty_docs(spark)).count() == 0


def test_bands():
    limits = quality.Limits()
    assert quality.verdict(1000, 0.2, 0.2, 0.2, limits) == "repetitive"
    assert quality.verdict(1000, 0.9, 0.9, 0.9, limits) == "incompressible"
    assert quality.verdict(60_000, 0.42, 0.1, 0.5, limits) == "repetitive chunk"
    assert quality.verdict(60_000, 0.42, 0.4, 0.8, limits) == "incompressible chunk"
    assert quality.verdict(60_000, 0.42, 0.4, 0.5, limits) is None
    assert quality.verdict(100, 1.0, 1.0, 1.0, limits) is None and quality.verdict(5000, 1.0, 1.0, 1.0, limits)


def test_chunks_cover_every_byte():
    press = zstandard.ZstdCompressor(level=3, write_content_size=False)
    raw = bytes(range(256)) * 40
    whole, low, high = quality.ratios(raw, press, 4096)
    assert low <= high and whole < 1
    assert quality.ratios(raw[:5000], press, 4096)[1:] == (quality.ratios(raw[:5000], press, 4096)[0],) * 2


def test_learned_limits_reject_by_chunks(spark):
    rng = random.Random(2)
    pool = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
    prose = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    rows = [(i, prose(900)) for i in range(60)]
    noise = " ".join("".join(chr(rng.randrange(33, 126)) for _ in range(9)) for _ in range(120))
    dull = " ".join(f"item {i} is the same as item {i + 1}" for i in range(30))
    rows += [(100, f"{prose(450)} {noise} {prose(350)}"), (101, f"{prose(450)} {dull} {prose(350)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(60)] + [(100, 0), (101, 0)], "doc_id long, quality int")
    plain_reasons = {r.doc_id: r.reason for r in quality.judge(docs).collect()}
    assert not any(plain_reasons.values())
    learned = quality.learn(docs, labels, quality.Sample(edges=(2048, float("inf"))))
    assert learned.bands[0][1:] == quality.Limits().bands[4][1:]  # nothing that short is labelled
    reasons = {r.doc_id: r.reason for r in quality.judge(docs, learned).collect()}
    assert not any(reasons[i] for i in range(60))
    assert reasons[100] in ("incompressible", "incompressible chunk") and reasons[101] in ("repetitive", "repetitive chunk")
    assert quality.learn(docs, labels.where("quality = 0")) == quality.Limits()
    assert quality.learn(empty_docs(spark), labels) == quality.Limits()


def test_a_wrong_label_moves_no_limit_and_clashing_columns_are_ignored(spark):
    rng = random.Random(6)
    pool = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(200)), "x", 1.0) for i in range(200)]
    bad = (999, " ".join(["same", "old", "words"] * 400)[:1200] + " " + " ".join(pool[:8]), "x", 1.0)
    schema = "doc_id long, text string, id string, `a.b` double"
    labels = [(i, 1) for i in range(200)]
    learned = []
    for more in ([], [bad]):
        docs = spark.createDataFrame(rows + more, schema)
        marks = spark.createDataFrame(labels + [(r[0], 1) for r in more], "doc_id long, quality int")
        limits = quality.learn(docs, marks, quality.Sample(least_rows=30), quality.Limits(repeat_percent=100))
        learned.append([b for b in limits.bands if b[0] in (1536, 2048)])
        assert all(r.kept for r in quality.judge(spark.createDataFrame(rows, schema), limits).collect())
    for (_, low, high), (_, low2, high2) in zip(*learned, strict=True):
        assert abs(low - low2) < 0.02 and abs(high - high2) < 0.02


def test_limits_come_from_all_good_documents(spark):
    """No sample: every good document's ratio counts, and the quantiles are those of all of them."""
    rng = random.Random(3)
    pool = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(20))) for i in range(4500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1) for i, _ in rows], "doc_id long, quality int")
    learned = quality.learn(docs, marks, quality.Sample(edges=(100_000, float("inf"))))
    seen = [r.ratio for r in quality.judge(docs).where("not base_failed").collect()]
    low, middle, high = np.quantile(seen, [0.05, 0.5, 0.95])
    assert np.allclose(learned.bands[0][1:], (2 * low - middle - 0.005, 2 * high - middle + 0.005), rtol=1e-12)
