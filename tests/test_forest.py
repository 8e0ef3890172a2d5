from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from demandspark import schemas
from demandspark.operators import boosting as G
from demandspark.operators import forecast
from demandspark.operators import forest as T


def data(spark, n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.random((n, 3)) * 20)
    y = 3 * (x[:, 0] > 9) * (x[:, 1] > 4) + 0.1 * x[:, 2] + 0.05 * rng.normal(size=n)
    rows = [(*map(float, r), float(t)) for r, t in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, f"a double, b double, c double, {schemas.TARGET} double").repartition(3)
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df), x, y


def plain(x, y, depth):
    """A tree grown by trying every value of every column, row lists in hand."""
    out = np.zeros(len(y))

    def grow(rows, levels):
        best = (1e-9, None)
        for f in range(x.shape[1]) if levels else ():
            for t in np.unique(x[rows, f])[:-1]:
                low = x[rows, f] <= t
                gain = ((y[rows] - y[rows].mean()) ** 2).sum() - sum(((y[r] - y[r].mean()) ** 2).sum() for r in (rows[low], rows[~low]))
                if gain > best[0] + 1e-9:
                    best = (gain, low)
        if best[1] is None:
            out[rows] = y[rows].mean()
            return
        grow(rows[best[1]], levels - 1)
        grow(rows[~best[1]], levels - 1)

    grow(np.arange(len(y)), depth)
    return out


@pytest.mark.parametrize("handed", [5, 100, 1 << 14])
def test_a_tree_equals_an_exhaustive_search(spark, monkeypatch, handed):
    """Wherever nodes are handed over: nearly none, some, all below the first split."""
    monkeypatch.setattr(T, "HANDED_ROWS", handed)
    df, x, y = data(spark)
    model = forecast.regressor(schemas.FOREST, numTrees=1, maxDepth=4, bootstrap=False).fit(df)
    want = plain(x, y, 4)
    assert np.allclose(T.forest_rows(model.forest(), x), want, atol=1e-8)
    scored = {(r.a, r.b, r.c): r.raw_prediction for r in model.transform(df).collect()}
    assert np.allclose([scored[tuple(r)] for r in x], want, atol=1e-8)


def test_a_rerun_agrees_however_the_rows_are_dealt(spark):
    df, x, y = data(spark)
    one, two = (
        forecast.regressor(schemas.FOREST, numTrees=10, maxDepth=5).fit(d).transform(df).select("a", "b", "c", "raw_prediction")
        for d in (df, df.repartition(5))
    )
    one, two = (np.array(sorted(map(tuple, d.collect()))) for d in (one, two))
    assert np.allclose(one, two, atol=1e-9)


def test_trees_differ_and_their_mean_is_better(spark):
    df, x, y = data(spark)
    found = forecast.regressor(schemas.FOREST, numTrees=30, maxDepth=6).fit(df).forest()
    truth = 3 * (x[:, 0] > 9) * (x[:, 1] > 4) + 0.1 * x[:, 2]
    single = [T.forest_rows({k: v[i : i + 1] for k, v in found.items()}, x) for i in range(30)]
    assert len({tuple(s) for s in single}) == 30
    errors = [((s - truth) ** 2).mean() for s in single]
    assert ((T.forest_rows(found, x) - truth) ** 2).mean() < 0.7 * np.mean(errors)


def test_rows_are_drawn_with_replacement():
    n = 100_000
    block = G.Block(np.zeros((1, n), np.uint8), np.zeros(n), np.zeros(n), np.arange(n, dtype=np.uint64) * np.uint64(G._ODD))
    drawn = [T.draws(block, seed) for seed in (42, 43)]
    for d in drawn:
        shares = np.bincount(d, minlength=4)[:4] / n
        assert np.allclose(shares, [0.3679, 0.3679, 0.1839, 0.0613], atol=0.006)
    assert abs(np.corrcoef(*drawn)[0, 1]) < 0.02 and (T.draws(block, None) == 1).all()


def test_sums_of_many_nodes_are_taken_in_parts(spark, monkeypatch):
    df, x, _ = data(spark)
    forest = forecast.regressor(schemas.FOREST, numTrees=6, maxDepth=5)
    whole = forest.fit(df).forest()
    for name, value in (("HANDED_ROWS", 20), ("_SUMS", 100), ("_TASK_ROWS", 50)):
        monkeypatch.setattr(T, name, value)
    assert np.allclose(T.forest_rows(forest.fit(df).forest(), x), T.forest_rows(whole, x), atol=1e-9)


def test_saved_with_a_pipeline(spark, tmp_path):
    df, x, _ = data(spark)
    model = Pipeline(stages=[forecast.regressor(schemas.FOREST, numTrees=3, maxDepth=3)]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    one, two = (sorted((r.a, r.b, r.c, r.raw_prediction) for r in m.transform(df).collect()) for m in (model, again))
    assert one == two


def test_one_value_no_split_and_bad_settings(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 5, "a double, y double")
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    model = T.Forest(labelCol="y", numTrees=2, bootstrap=False).fit(df)
    assert {r.prediction for r in model.transform(df).collect()} == {2.0}
    with pytest.raises(ValueError, match="unknown settings"):
        T.Forest(maxIter=3)
    with pytest.raises(ValueError, match="maxBins"):
        T.Forest(maxBins=1)
    assert df.transform(model.transform).where(F.col("prediction").isNull()).count() == 0
