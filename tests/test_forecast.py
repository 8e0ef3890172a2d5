from __future__ import annotations

import math
import random
import sys
import threading
from datetime import date, timedelta

import pytest
import samples
from pyspark.sql import functions as F

from demandspark import schemas
from demandspark.operators import evaluate as E
from demandspark.operators import features, forecast
from demandspark.operators.side_by_side import side_by_side
from demandspark.plans import jobs
from demandspark.registry import queries as Q
from demandspark.sources.models import load_forecaster


def test_chronological_split(spark):
    train, test, split = forecast.chronological_split(samples.series(spark), 0.25)
    row = split.first()
    assert (row.distinct_dates, row.split_date) == (40, date(2025, 1, 31))
    assert (train.count(), test.count()) == (30, 10)
    assert train.agg(F.max("Date")).first()[0] < test.agg(F.min("Date")).first()[0]
    parts = {r.part: r.row_count for r in forecast.split_summary(samples.series(spark), 0.25).collect()}
    assert parts == {"train": 30, "test": 10}


def test_baselines_fall_back(spark):
    full = spark.createDataFrame([(-1.0, 4.0), (3.0, None)], "Lag_1 double, Rolling_Mean_7 double")
    assert [r.yhat for r in forecast.naive_forecast(full).collect()] == [0.0, 3.0]
    assert [r.yhat for r in forecast.moving_average_forecast(full).collect()] == [4.0, None]
    lag = full.select("Lag_1")
    assert [r.yhat for r in forecast.moving_average_forecast(lag).collect()] == [0.0, 3.0]
    bare = spark.range(2)
    assert [r.yhat for r in forecast.naive_forecast(bare).collect()] == [0.0, 0.0]


def test_metrics_and_leaderboard(spark):
    y, a = (100, 150, 200, 250), (110, 140, 210, 240)
    rows = [("A", float(t), float(p)) for t, p in zip(y, a)] + [("B", float(t), p + 20.0) for t, p in zip(y, a)]
    metrics = E.evaluate(spark.createDataFrame(rows, "model string, y double, yhat double"))
    board = E.leaderboard(metrics).collect()
    assert [tuple(r) for r in board] == [("A", 10.0, 10.0, 6.42), ("B", 20.0, 22.36, 13.92)]
    best = E.best_model(metrics).first()
    assert best.model == "A" and "(MAE: 10.0)" in best.rationale and "MAPE of 6.42%" in best.rationale
    zero = spark.createDataFrame([("Z", 0.0, 3.0)], "model string, y double, yhat double")
    assert E.evaluate(zero).first().mape == 300.0


def _market(spark, days=150):
    """Demand with weekly, promotional and per-product structure, as in a real shop."""
    rng = random.Random(7)
    rows = []
    for store, factor, region in [("S01", 1.2, "North"), ("S02", 0.8, "South")]:
        for product, base, price in [("P101", 45, 120.0), ("P102", 90, 22.0), ("P103", 25, 150.0)]:
            for i in range(days):
                d = date(2025, 1, 1) + timedelta(days=i)
                promo = rng.random() < 0.2
                mean = base * factor * (1.35 if d.weekday() >= 5 else 1) * (1.5 if promo else 1)
                rows.append((d, store, product, "Electronics" if price > 100 else "Groceries",
                             max(0, round(rng.gauss(mean, 0.08 * mean))), price, 20.0 if promo else 0.0,
                             int(promo), 0, 200, region))
    return spark.createDataFrame(rows, samples.PANEL)


def test_train_rank_save_and_score(spark, tmp_path):
    market = _market(spark)
    path = str(tmp_path / "best")
    params = {schemas.FOREST: {"numTrees": 10, "maxDepth": 6}, schemas.BOOSTED: {"maxIter": 15, "maxDepth": 4, "stepSize": 0.3}}
    models, predictions, board = jobs.train_and_rank(
        market, params=params, model_path=path, board_path=str(tmp_path / "board")
    )
    ranks = {r.model: r for r in board.collect()}
    assert len(ranks) == 5
    assert all(ranks[m].mae < ranks[schemas.NAIVE].mae for m in forecast.LEARNED)
    assert all(ranks[m].rmse >= ranks[m].mae for m in ranks)
    counts = {r["count"] for r in predictions.groupBy("model").count().collect()}
    assert len(counts) == 1
    assert predictions.filter("yhat < 0 OR yhat IS NULL").count() == 0

    saved = load_forecaster(spark, path)
    assert saved.name in forecast.LEARNED and saved.categorical == schemas.CATEGORICAL_FEATURES
    table = features.build_features(market).orderBy("Date", "Store_ID", "Product_ID").limit(20)
    one = [r.yhat for r in forecast.predict(models[saved.name], table).collect()]
    two = [r.yhat for r in forecast.predict(saved.model, table).collect()]
    assert one == pytest.approx(two)

    # A store and region the model has not seen still gets a forecast.
    requests = spark.createDataFrame(
        [
            ("P101", "S01", date(2025, 6, 1), None, None, None, None, None, None),
            ("P101", "S77", date(2025, 6, 1), 99.0, 10.0, 1, 0, 50.0, 50.0),
            ("P101", "S01", date(2025, 6, 1), -1.0, None, None, None, None, None),
            ("P999", "S01", date(2025, 6, 1), None, None, None, None, None, None),
        ],
        schemas.SCORE_REQUESTS,
    )
    regions = spark.createDataFrame([("S01", "North")], "store_id string, region string")
    catalog = samples.products(spark, "P101")
    stock = spark.createDataFrame([("P101", "S01", 10)], "product_id string, store_id string, inventory_level int")
    decisions, rejects = jobs.decide_and_record(
        saved.model, requests, market, catalog, regions, stock, saved.name,
        str(tmp_path / "forecasts"), str(tmp_path / "risks"), lead=2,
    )
    assert {tuple(r.reasons) for r in rejects.collect()} == {("unit_price",), ("unknown product",)}
    written = spark.read.parquet(str(tmp_path / "forecasts"))
    assert written.count() == 2 and written.filter("created_at IS NULL OR predicted_demand < 0").count() == 0
    risks = {r.store_id: r for r in spark.read.parquet(str(tmp_path / "risks")).collect()}
    assert risks["S01"].current_inventory == 10 and risks["S77"].current_inventory == 150
    assert {r.store_id: r.risk_level for r in decisions.collect()} == {s: r.risk_level for s, r in risks.items()}


def test_a_model_that_fails_does_not_stop_the_others(spark):
    train, _, _ = forecast.chronological_split(features.build_features(_market(spark, 60)), 0.25)
    bad = {schemas.FOREST: {"maxBins": 1}}
    with pytest.warns(UserWarning, match="Random Forest"):
        models = forecast.fit_models(train, [schemas.LINEAR, schemas.FOREST], bad)
    assert list(models) == [schemas.LINEAR]
    with pytest.raises(ExceptionGroup):
        forecast.fit_models(train, [schemas.FOREST], bad)


def test_ranking_needs_every_model(spark, tmp_path):
    market, path, board = _market(spark, 60), tmp_path / "best", tmp_path / "board"
    kinds, bad = [schemas.LINEAR, schemas.FOREST], {schemas.FOREST: {"maxBins": 1}}
    with pytest.raises(ExceptionGroup, match="Random Forest") as told:
        jobs.train_and_rank(market, kinds=kinds, params=bad, model_path=str(path), board_path=str(board))
    assert ["maxBins" in str(e) for e in told.value.exceptions] == [True]
    assert not path.exists() and not board.exists()
    with pytest.warns(UserWarning, match="Random Forest"):
        models, _, ranks = jobs.train_and_rank(market, kinds=kinds, params=bad, leave_out=True)
    assert list(models) == [schemas.LINEAR]
    assert {r.model for r in ranks.collect()} == {schemas.LINEAR, schemas.NAIVE, schemas.MOVING_AVERAGE}


def test_queries_about_five_models_tell_of_a_failure(spark, monkeypatch):
    small, regressor = {schemas.FOREST: {"numTrees": 2}, schemas.BOOSTED: {"maxIter": 2}}, forecast.regressor
    broken, market = {schemas.BOOSTED}, _market(spark, 60)

    def fails(name, **params):
        if name in broken:
            raise MemoryError(name)
        return regressor(name, **small.get(name, {}), **params)

    monkeypatch.setattr(forecast, "regressor", fails)
    monkeypatch.setattr(Q, "stored_panel", lambda spark, sf_dir: market)
    for query in (Q.best_of_five, Q.leaderboard_five, Q.prediction_pivot_five):
        with pytest.raises(ExceptionGroup, match=schemas.BOOSTED):
            query(spark, "broken")
    broken.clear()  # a failure is not remembered
    assert Q.leaderboard_five(spark, "broken").count() == 5 and Q.best_of_five(spark, "broken").count() == 1


def test_a_thread_that_just_ends_is_a_failure(spark):
    tasks = {"good": lambda: 5, "exit": lambda: sys.exit(3), 7: lambda: 5}  # a pool cannot be named by a number
    results, failures = side_by_side(spark, tasks)
    assert results == {"good": 5} and list(failures) == ["exit", 7]
    assert all(isinstance(e, Exception) for e in failures.values()) and isinstance(failures["exit"].__cause__, SystemExit)


def test_jobs_run_side_by_side_in_their_own_pools(spark):
    seen, meet = {}, threading.Barrier(2, timeout=60)

    def task(name):
        meet.wait()  # both are running now
        context = spark.sparkContext
        seen[name] = (context.getLocalProperty("spark.scheduler.pool"), context.getLocalProperty("spark.jobGroup.id"))
        if name == "bad":
            raise ValueError(name)
        return spark.range(5).count()

    results, failures = side_by_side(spark, {n: lambda n=n: task(n) for n in ("good", "bad")})
    assert results == {"good": 5} and str(failures["bad"]) == "bad"
    assert seen == {"good": ("good", "good"), "bad": ("bad", "bad")}


def test_unknown_category_encodes_to_zeros(spark):
    from pyspark.ml import Pipeline

    table = features.build_features(samples.series(spark))
    prepared = Pipeline(stages=forecast.preprocessor_stages()).fit(table)
    strange = table.withColumn("Store_ID", F.lit("S99"))
    row = prepared.transform(strange).first()
    assert row.Store_ID_hot.toArray().sum() == 0 and row.Product_ID_hot.toArray().sum() == 1
    scaled = prepared.transform(table).select("scaled").collect()
    means = [sum(r.scaled[i] for r in scaled) / len(scaled) for i in range(len(schemas.NUMERICAL_FEATURES))]
    assert all(math.isclose(m, 0, abs_tol=1e-9) for m in means)


def test_forecast_for_products_without_one(spark):
    from demandspark.operators import lookup

    catalog = samples.products(spark, "P101", "P102")
    known = spark.createDataFrame([("P101",)], "product_id string")
    requests = forecast.requests_for_missing(lookup.missing_forecasts(catalog, known), "S01", "2025-02-10")
    scored, rejects = forecast.score_requests(
        None, requests, samples.series(spark), catalog, lookup.default_regions(spark), "mean"
    )
    row = scored.first()
    assert (row.product_id, row.predicted_demand) == ("P102", 50) and rejects.count() == 0
