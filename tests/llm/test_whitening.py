from __future__ import annotations

import math

import numpy as np
import pytest
from helpers import SF

from demandspark.llm import queries, whitening


def plain(rows, by_count=True, most=32):
    """Whitening of a list of vectors by numpy, without grouping."""
    fine = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in fine])
    fit = x if by_count else np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    z = fit - total / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1], vectors.T[::-1]
    keep = [k for k in range(len(values)) if values[k] > 1e-9 * values[0]][:most]
    w = (x - total / n) @ (vectors[keep] / np.sqrt(values[keep])[:, None]).T
    off = [sum((n * int(c) - int(t)) ** 2 for c, t in zip(r, total, strict=True)) for r in x]
    return [i for i, _ in fine], n, off, w, values[keep] / values.sum()


def check(df, rows, **how):
    ids, n, off, w, share = plain(rows, **how)
    got = {}
    for r in df.collect():
        got.setdefault(r.vec_id, []).append(r)
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained - share[r.component - 1]) < 1e-9
    assert sorted(got, key=repr) == sorted(set(ids), key=repr)
    mine = {}
    for i, line, deviation in zip(ids, w, off, strict=True):
        mine.setdefault(i, []).append((deviation, line))
    signs = np.zeros(len(share))
    for i, lines in mine.items():
        have = {}
        for r in sorted(got[i], key=lambda r: r.component):
            have.setdefault(r.deviation, {}).setdefault(r.component, []).append(r.whitened)
        for deviation, line in lines:
            found = np.array([have[deviation][k + 1][0] for k in range(len(line))])
            assert np.allclose(np.abs(found), np.abs(line), atol=1e-6)
            big = np.abs(line) > 1e-3
            sign = np.sign(found * line)
            assert ((signs == sign) | (signs == 0) | ~big).all()
            signs = np.where(big, sign, signs)
        assert len(got[i]) == len(lines) * len(share)


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(queries.op13_embedding_whitening(spark, SF), rows)


def vectors(spark, rows):
    """Extra columns have the names that the operator uses inside."""
    data = [(i, v, "x", 1, 2.0, "y") for i, v in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, key string, rows int, `a.b` double, x string")


@pytest.mark.parametrize("by_count", [True, False])
@pytest.mark.parametrize("hot_keys", [1, 8, 4096])
def test_repeated_vectors(spark, by_count, hot_keys):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 6)).astype(np.float32).tolist()
    rows = [(i, base[i]) for i in range(40)] + [(100 + i, base[0]) for i in range(50)] + [(7, base[7]), (7, base[9]), (None, base[3])]
    settings = whitening.Settings(by_count=by_count, hot_keys=hot_keys, components=4, block_values=30)
    check(whitening.whiten(vectors(spark, rows).repartition(5), settings), rows, by_count=by_count, most=4)


def test_edges(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(9)]
    bad = [(20, None), (21, []), (22, [None, 1.0, 2.0]), (23, [float("nan"), 1.0, 2.0]), (24, [1.0, float("-inf"), 2.0]), (25, [3e38, 0.0, 0.0])]
    check(whitening.whiten(vectors(spark, rows + bad)), rows)
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, bad)).count() == 0
    assert whitening.whiten(vectors(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0  # no variance
    flat = [(i, [float(i), 1.0, 2.0 * i]) for i in range(5)]  # one direction has it all
    check(whitening.whiten(vectors(spark, flat)), flat)
    lengths = whitening.whiten(vectors(spark, rows + [(50 + i, [float(i), float(i * i)]) for i in range(4)]))
    assert {(r.n, r.component) for r in lengths.collect()} == {(9, 1), (9, 2), (9, 3), (4, 1), (4, 2)}


def test_deviation_is_exact_beyond_doubles():
    x = np.array([[1_000_000, 999_983], [1_000_411, 1_000_001]])
    n, total = 3_000_000, [3_000_000_000_001, 2_999_949_000_017]
    want = [sum((n * int(c) - t) ** 2 for c, t in zip(r, total, strict=True)) for r in x]
    assert whitening.deviations(x, n, total) == [w if w < 2**63 else None for w in want]
    far = np.array([[1 << 60]])
    assert whitening.deviations(far, 5, [0]) == [None]
