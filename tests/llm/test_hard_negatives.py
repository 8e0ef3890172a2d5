from __future__ import annotations

import math

import numpy as np
import pytest
from helpers import SF

from demandspark.llm import hard_negatives as H
from demandspark.llm import queries


def plain(rows, every=100, k=5, percent=80):
    """All pairs by hand. ``rows`` are vec_id, vector, label; equal rows count once."""
    fine = {
        (i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v))
        for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for i, label, a in fine:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), j, other) for j, other, b in fine if j != i and len(a) == len(b))
        for p, pid, other in [s for s in scored if s[2] == label][:k]:
            good = [(s, j) for s, j, o in scored if o != label and percent * -p <= 100 * -s <= 100 * -p][:k]
            out += [(i, pid, n + 1, j, -p, -s) for n, (s, j) in enumerate(good)]
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.collect()))


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = result(queries.op11_hard_negatives(spark, SF))
    assert got == plain(rows) and got


def vectors(spark, rows):
    data = [(i, v, label, 1, 2, "x", 0) for i, v, label in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, part int, dim int, `a.b` string, anchor int")


def mined(spark, rows, every=10, **settings):
    return H.mine(H.swapped_labels(H.whole_vectors(vectors(spark, rows))), f"vec_id % {every} = 0", H.Settings(**settings))


@pytest.mark.parametrize("small", [{}, {"shard_rows": 40, "page_shards": 3, "salt_anchors": 7, "leaf": 4, "fan": 2, "sample_rows": 50}])
def test_clusters_ties_and_many_shards(spark, small):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(6, 8)) + 1
    rows = [(i, (centers[i % 6] + 0.2 * rng.normal(size=8)).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(400)]
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(150)]  # one vector many times
    rows += [rows[10], rows[10], (20, rows[3][1], 1), (20, rows[4][1], 1)]  # repeated rows; one id, several vectors
    assert result(mined(spark, rows, **small)) == plain(rows, 10)


def test_edges(spark):
    rows = [
        (100, [1.0, 2.0], 1), (1, [1.0, 1.9], 1), (2, [1.0, 1.8], 2), (3, [-1.0, -2.0], 1), (10, [0.0, 0.0], 3), (11, [0.5, 0.1], 3),
        (12, [0.1, 0.2], 4), (20, [5.0], 1), (23, [4.9], 1), (22, [4.5], 2), (30, None, 1), (40, [], 1), (50, [float("nan"), 1.0], 1),
        (60, [float("inf"), 1.0], 1), (110, [None, 1.0], 1), (80, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (90, [-3.0, 1.0], 9),
    ]
    got = result(mined(spark, rows))
    assert got == plain(rows, 10) and {r[0] for r in got} >= {100, 10, 20}
    assert mined(spark, []).count() == 0
    assert mined(spark, [(0, [1.0], 1)]).count() == 0


def tree(n=600, leaf=8, fan=4, dim=3, seed=1):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.normal(size=(n, dim)) * 256)
    labels = rng.integers(0, 5, n)
    return H.Tree(np.arange(n), labels, x, x, labels, H.Settings(leaf=leaf, fan=fan)), x, labels


def test_tree_covers_its_rows():
    t, x, labels = tree()
    assert sorted(t.ids) == list(range(len(x))) and (t.rows == x[t.ids]).all()

    def rows(node):
        if node < t.pages:
            return list(range(t.first[node], t.last[node]))
        return [r for c in range(t.first[node], t.last[node]) for r in rows(c)]

    assert sorted(rows(t.root)) == list(range(len(x)))
    for node in range(len(t.first)):
        inside = t.rows[rows(node)]
        assert (t.low[node] == inside.min(axis=0)).all() and (t.high[node] == inside.max(axis=0)).all()
        assert t.least[node] == t.labels[rows(node)].min() and t.most[node] == t.labels[rows(node)].max()
    q = np.array([[3.0, -2.0, 7.0]])
    low, high = t.bounds(q)
    for node in range(len(t.first)):
        scores = t.rows[rows(node)] @ q[0]
        assert low[0, node] <= scores.min() and scores.max() <= high[0, node]


def test_str_order_tiles_the_plane():
    rng = np.random.default_rng(0)
    keys = rng.random((256, 2))
    order = H.str_order(keys, 16)
    pages = keys[order].reshape(16, 16, 2)
    widths = pages.max(axis=1) - pages.min(axis=1)
    assert sorted(order) == list(range(256)) and widths.mean() < 0.35  # four slabs by four


def test_most_pages_stay_closed():
    t, x, labels = tree(n=4000, leaf=16, fan=8)
    q = x[0]
    low, high = t.bounds(q[None])
    best = H.Best(5, -np.inf, np.inf)
    opened = H.walk(t, q, low[0], high[0], lambda a, b: False, lambda ids, ls: ids >= 0, [best])
    want = sorted(zip((-(x @ q)).tolist(), range(len(x)), strict=True))[:5]
    assert best.kept == want
    assert opened < t.pages / 5


def test_shards_that_cannot_matter_get_no_anchor(spark):
    """Three far clusters: most anchors meet only the shards of their own."""
    rng = np.random.default_rng(6)
    rows = [(i, (np.eye(3)[i % 3] * 20 + 0.1 * rng.normal(size=3)).tolist(), (i // 3) % 2) for i in range(900)]
    settings = H.Settings(shard_rows=30)
    sharded = H.shards(H.whole_vectors(vectors(spark, rows)), settings)
    anchors = sharded.where("vec_id % 10 = 0").withColumn("anchor", H.F.col("vec_id")).withColumn("bounds", H.F.array(H.F.lit(400 * 65536).cast("long")))
    near = lambda least, most, label, bounds, low, high: 100 * high >= 80 * bounds[0]
    visits = H.routed(H.directory(sharded), anchors.select("anchor", "vec_id", "label", "dim", "vec", "bounds"), near, settings)
    n = sharded.select("part").distinct().count()
    assert n >= 20
    assert visits.count() < 0.65 * n * anchors.count()  # five ninths, and shards on a border
