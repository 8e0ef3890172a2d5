from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from helpers import SF, documents, edge_docs, empty_docs, words

from demandspark.llm import queries, substring_dedup


def plain(rows, width):
    """What is left of every row, from all windows of all rows."""
    first = {}
    for i, text in rows:
        if i is None:
            continue
        w = words(text)
        for p in range(len(w) - width + 1):
            key = tuple(w[p : p + width])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        w = words(text)
        gone = set()
        for p in range(len(w) - width + 1):
            if i is not None and first[tuple(w[p : p + width])] < i:
                gone.update(range(p, p + width))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    want = plain(rows, 50)
    assert result(queries.op4_substring_dedup(spark, SF)) == want
    assert sum(r[2] for r in want) > 0


@pytest.mark.parametrize("width", [3, 20, 50])
def test_random_texts(spark, width):
    rng = random.Random(width)
    pool = [f"w{i}" for i in range(400)]
    passage = rng.choices(pool, k=width + 30)
    rows = []
    for i in range(60):
        w = rng.choices(pool, k=rng.randint(0, 3 * width))
        for _ in range(rng.randint(0, 2)):
            a = rng.randint(0, 20)
            at = rng.randint(0, len(w))
            w[at:at] = passage[a : a + width + rng.randint(-2, 10)]
        rows.append((rng.randint(0, 40), rng.choice([" ", "\n", " \t "]).join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert result(substring_dedup.dedupe(docs, width)) == plain(rows, width)


def test_kept_text_and_intervals(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"a b {passage} c"), (2, f"x {passage}  y\nz"), (3, passage)], "doc_id long, text string")
    found = {r.doc_id: r for r in substring_dedup.dedupe(docs, with_text=True).collect()}
    assert found[2].kept == "x y z" and [(s.start, s.stop) for s in found[2].removed] == [(1, 61)]
    assert found[3].kept == "" and found[3].n_removed == 60
    assert found[1].n_removed == 0 and found[1].removed == []


def test_edges(spark):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(substring_dedup.dedupe(docs)) == plain(rows, 50)
    assert substring_dedup.dedupe(empty_docs(spark)).count() == 0


def test_smallest():
    values = np.random.default_rng(1).integers(0, 1000, 200)
    for width in (1, 2, 3, 7, 35):
        want = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert substring_dedup.smallest(values, width).tolist() == want
