from __future__ import annotations

import math

import numpy as np
from helpers import SF

from demandspark.llm import queries, topk


def plain(rows, every, k=5):
    """Scores of all pairs, by hand."""
    ok = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in {x[0]: x for x in ok if x[0] % every == 0}.values():
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in ok if i != q and len(a) == len(b))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def result(df):
    return sorted(map(tuple, df.collect()))


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert result(queries.op9_exact_topk(spark, SF)) == plain(rows, 50)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], "vec_id long, embedding array<float>, shard int, dim int, score string")


def test_shards_blocks_ties_and_clusters(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(6, 8))
    rows = [(i, (centers[i % 6] + 0.01 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # equal vectors: the smallest ids win
    df = topk.staged_vectors(vectors(spark, rows))
    settings = topk.Settings(shard_rows=100, leaf=8, pivots=20, page_shards=3, salt_queries=16)
    assert result(topk.search(df.where("vec_id % 10 = 0"), df, settings)) == plain(rows, 10)


def test_repeated_queries_and_one_id_with_two_vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(60)]
    want = plain(rows, 10)
    df = topk.staged_vectors(vectors(spark, rows))
    asked = df.where("vec_id % 10 = 0")
    assert result(topk.search(asked.unionByName(asked).unionByName(asked.where("vec_id = 20")), df)) == want
    other = rng.normal(size=4).astype(np.float32).tolist()
    two = topk.whole_vectors(vectors(spark, [(20, other)]))
    got = result(topk.search(asked.where("vec_id = 20").unionByName(two), df))
    second = [r for r in plain([*[r for r in rows if r[0] != 20], (20, other)], 20) if r[0] == 20]
    assert got == sorted([r for r in want if r[0] == 20] + second)


def test_edges(spark):
    rows = [
        (0, [1.0, 2.0]), (2, None), (4, []), (6, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (10, [None, 1.0]),
        (12, [-1.0, 0.004]), (14, [5.0]), (None, [1.0, 1.0]), (16, [0.0, 0.0]),
    ]
    df = topk.whole_vectors(vectors(spark, rows))
    got = result(topk.search(df.where("vec_id % 2 = 0"), df))
    assert got == plain(rows, 2) and {r[0] for r in got} == {0, 12, 16}
    assert topk.search(df.where("false"), df).count() == 0
    assert topk.search(df, df.where("false")).count() == 0
    none = topk.whole_vectors(vectors(spark, []))
    assert topk.search(none, none).count() == 0


def test_cover_tree():
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(size=(500, 3)), np.zeros((100, 3)), rng.normal(size=(200, 3)) * 1e-3 + 5])
    order, root = topk.cover_tree(points, 16)
    assert sorted(order) == list(range(len(points)))

    def check(node):
        inside = points[order[node.low : node.high]]
        assert np.sqrt(((inside - node.center) ** 2).sum(axis=1)).max() <= node.radius + 1e-12
        if node.children:
            assert [c.low for c in node.children] == [node.low, *[c.high for c in node.children[:-1]]]
            assert node.children[-1].high == node.high
            reach = 2.0 ** np.ceil(np.log2(node.radius)) / 2
            assert all(c.radius <= reach for c in node.children)
            centers = np.array([c.center for c in node.children])
            gaps = np.sqrt(((centers[:, None] - centers[None]) ** 2).sum(axis=2))
            assert (gaps[~np.eye(len(centers), dtype=bool)] > reach).all()
        for c in node.children:
            check(c)

    check(root)
    assert root.children


def test_pruning_leaves_pairs_out():
    rng = np.random.default_rng(6)
    far = np.concatenate([rng.normal(size=(2000, 4)) * 0.1 + c for c in ([50, 0, 0, 0], [-50, 0, 0, 0], [0, -50, 0, 0])]).round(3) * 256
    order, root = topk.cover_tree(far, 64)
    shard = topk.Shard(np.arange(len(far))[order], far[order], root)
    task = topk.Search(np.arange(10) + 10**6, far[:10], shard, np.full(10, -np.inf), topk.Settings())
    seen = []
    inner = task.compare
    task.compare = lambda a, b: (seen.append(b.high - b.low), inner(a, b))
    task.run()
    assert sum(seen) < len(far) / 2


def test_queries_go_to_the_shards_that_can_matter_only(spark):
    rng = np.random.default_rng(6)
    centers = np.array([[50, 0, 0, 0], [-50, 0, 0, 0], [0, -50, 0, 0], [0, 0, 50, 0], [0, 0, 0, 50]])
    rows = [(i, (centers[i % 5] + 0.1 * rng.normal(size=4)).astype(np.float32).tolist()) for i in range(1000)]
    df = topk.staged_vectors(vectors(spark, rows))
    settings = topk.Settings(shard_rows=100, leaf=8, pivots=10)
    queries, sharded, balls, pivots = topk.dealt(df.where("vec_id % 10 = 0"), df, settings)
    n = sharded.select("part").distinct().count()
    assert n >= 10 and len(pivots) == 10
    start = queries.withColumns({"floor": topk.F.lit(2000.0 * 65536), "home": topk.F.lit(-1).cast("long")})
    sent = topk.routed(balls, start, pivots, False, settings).count()
    assert sent < queries.count() * n / 2
    assert result(topk.search(df.where("vec_id % 10 = 0"), df, settings)) == plain(rows, 10)


def test_balls_hold_their_rows_and_pivots_cover_the_sample(spark):
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(500, 6)) * 256)
    pivots = topk.cover_pivots(x, 20)
    gaps = topk._distances(pivots, pivots)[~np.eye(20, dtype=bool)]
    assert topk._distances(x, pivots).min(axis=1).max() <= gaps.min() + 1e-6
    df = topk.staged_vectors(vectors(spark, [(i, (v / 256).tolist()) for i, v in enumerate(x)]))
    _, sharded, balls, pivots = topk.dealt(df, df, topk.Settings(shard_rows=100, pivots=20))
    radius = {(r.part, r.cell): r.radius for r in balls.collect()}
    for r in sharded.collect():
        assert np.linalg.norm(np.array(r.vec) - pivots[r.cell]) <= radius[r.part, r.cell] + 1e-6
