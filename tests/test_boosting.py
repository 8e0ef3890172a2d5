from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from demandspark.operators import boosting as G


def data(spark, n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.random((n, 3)) * 20)
    y = 3 * (x[:, 0] > 9) * (x[:, 1] > 4) + 0.1 * x[:, 2] + 0.05 * rng.normal(size=n)
    rows = [(*map(float, r), float(t)) for r, t in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double").repartition(3)
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df), x, y


def plain(x, y, rounds, depth, rate, reg, least, gamma=0.0):
    """Trees grown by trying every value of every column, row lists in hand."""

    def leaf(g):
        return -g.sum() / (len(g) + reg)

    def grow(rows, left_levels):
        g = margin[rows] - y[rows]
        best = (0.0, None)
        if left_levels:
            for f in range(x.shape[1]):
                for t in np.unique(x[rows, f])[:-1]:
                    low = x[rows, f] <= t
                    a, b = g[low], g[~low]
                    if min(len(a), len(b)) < least:
                        continue
                    gain = (a.sum() ** 2 / (len(a) + reg) + b.sum() ** 2 / (len(b) + reg) - g.sum() ** 2 / (len(g) + reg)) / 2 - gamma
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, t, low))
        if best[1] is None:
            step[rows] = rate * leaf(g)
            return
        f, t, low = best[1]
        grow(rows[low], left_levels - 1)
        grow(rows[~low], left_levels - 1)

    margin = np.full(len(y), y.mean())
    for _ in range(rounds):
        step = np.zeros(len(y))
        grow(np.arange(len(y)), depth)
        margin = margin + step
    return margin


@pytest.mark.parametrize(("reg", "least", "gamma"), [(1.0, 1.0, 0.0), (50.0, 20.0, 0.5)])
def test_trees_equal_an_exhaustive_search(spark, reg, least, gamma):
    df, x, y = data(spark)
    settings = {"maxIter": 4, "maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 1.0, "columnRate": 1.0, "maxBins": 64}
    model = G.BoostedTrees(labelCol="y", regLambda=reg, minChildWeight=least, gamma=gamma, **settings).fit(df)
    want = plain(x, y, 4, 3, 0.3, reg, least, gamma)
    assert np.allclose(G.predict_rows(model.model(), x), want, atol=1e-8)
    scored = {(r.a, r.b, r.c): r.prediction for r in model.transform(df).collect()}
    assert np.allclose([scored[tuple(r)] for r in x], want, atol=1e-8)


def test_rows_and_columns_are_sampled_per_tree_and_a_rerun_agrees(spark):
    df, x, y = data(spark)
    settings = {"maxIter": 30, "maxDepth": 2, "columnRate": 0.5, "subsamplingRate": 0.5, "stepSize": 0.2}
    one, two = (G.BoostedTrees(labelCol="y", **settings).fit(d).model() for d in (df, df.repartition(5)))
    assert np.allclose(G.predict_rows(one, x), G.predict_rows(two, x))
    used = [{f for f, t in zip(tree["feature"], tree["threshold"], strict=True) if t < np.inf} for tree in one["trees"]]
    assert all(len(u) <= 1 for u in used) and len(set.union(*used)) == 3  # one of three columns a tree
    assert np.abs(G.predict_rows(one, x) - y).mean() < 0.5 * np.abs(y - y.mean()).mean()


def test_poisson_uses_the_hessian(spark):
    df, x, y = data(spark)
    model = G.BoostedTrees(labelCol="y", objective="poisson", maxIter=1, maxDepth=1, stepSize=1.0, regLambda=2.0, subsamplingRate=1.0, columnRate=1.0)
    found = model.fit(df.withColumn("y", F.abs("y"))).model()
    y = np.abs(y)
    tree, mean = found["trees"][0], y.mean()
    low = x[:, tree["feature"][0]] <= tree["threshold"][0]
    for side, value in zip((low, ~low), tree["value"], strict=True):
        assert np.isclose(value, -(mean - y[side]).sum() / (mean * side.sum() + 2.0))
    assert np.isclose(found["start"], np.log(mean)) and (G.predict_rows(found, x) > 0).all()


def test_saved_with_a_pipeline(spark, tmp_path):
    df, x, _ = data(spark)
    model = Pipeline(stages=[G.BoostedTrees(labelCol="y", predictionCol="raw", maxIter=3, maxDepth=2)]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    one, two = (sorted((r.a, r.b, r.c, r.raw) for r in m.transform(df).collect()) for m in (model, again))
    assert one == two


def test_one_value_no_split_and_bad_settings(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 5, "a double, y double")
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    model = G.BoostedTrees(labelCol="y", maxIter=2).fit(df)
    assert {r.prediction for r in model.transform(df).collect()} == {2.0}
    with pytest.raises(ValueError, match="unknown settings"):
        G.BoostedTrees(numTrees=3)
    with pytest.raises(ValueError, match="maxBins"):
        G.BoostedTrees(maxBins=1000)


def test_a_rare_value_of_a_flag_has_a_bin(spark):
    """Quantiles alone would put both values of a flag into one bin if one of them is rarer than a bin."""
    flag = [0.0] * 5 + [1.0] * 995
    y = [50.0 if f == 0 else 1.0 for f in flag]
    df = spark.createDataFrame([(f, float(i), t) for i, (f, t) in enumerate(zip(flag, y, strict=True))], "a double, b double, y double")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df.repartition(3))
    settings = {"maxIter": 1, "maxDepth": 1, "stepSize": 1.0, "regLambda": 0.0, "subsamplingRate": 1.0, "columnRate": 1.0}
    model = G.BoostedTrees(labelCol="y", **settings).fit(df)
    scored = {(r.a, round(r.prediction, 9)) for r in model.transform(df).collect()}
    assert scored == {(0.0, 50.0), (1.0, 1.0)}


def test_few_rows_are_added_up_in_few_tasks(spark, monkeypatch):
    """900 levels of a model are 900 jobs, and each task of a job costs more than adding up some thousand rows."""
    df, _, _ = data(spark)
    made, blocks_of = [], G.blocks_of
    monkeypatch.setattr(G, "blocks_of", lambda *given: made.append(blocks_of(*given)) or made[-1])
    settings = {"maxIter": 2, "maxDepth": 2}
    G.BoostedTrees(labelCol="y", **settings).fit(df)
    monkeypatch.setattr(G, "TASK_ROWS", 300)
    G.BoostedTrees(labelCol="y", **settings).fit(df)
    cores = spark.sparkContext.defaultParallelism
    assert [b.getNumPartitions() for b in made] == [1, min(2, cores)]
