"""Every query against its SQL twin over the driver's smallest tables."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as driver
from demandspark import schemas
from demandspark.operators import forecast
from demandspark.registry.oracle import ORACLE
from demandspark.registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_twin_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) == []


@pytest.fixture(scope="module")
def naive_error(spark):
    return {r.model: r.mae for r in QUERIES["leaderboard_baselines"](spark, SF_DIR).collect()}[schemas.NAIVE]


@pytest.mark.parametrize("name", ["linear_forecast", "forest_forecast", "boosted_forecast"])
def test_learned_query_beats_naive(spark, name, naive_error):
    rows = QUERIES[name](spark, SF_DIR).collect()
    keys = QUERIES["naive_forecast"](spark, SF_DIR).select(*schemas.PANEL_KEYS).collect()
    assert sorted((r.Store_ID, r.Product_ID, r.Date) for r in rows) == sorted(map(tuple, keys))
    assert all(r.yhat >= 0 for r in rows) and len({r.yhat for r in rows}) > 10
    assert sum(abs(r.y - r.yhat) for r in rows) / len(rows) < naive_error


def test_five_models_at_full_settings(spark):
    board = QUERIES["leaderboard_five"](spark, SF_DIR).collect()
    assert [r["rank"] for r in board] == [1, 2, 3, 4, 5] and [r.mae for r in board] == sorted(r.mae for r in board)
    by_model = {r.model: r for r in board}
    for r in QUERIES["leaderboard_baselines"](spark, SF_DIR).collect():  # the rows that SQL confirms
        assert tuple(by_model[r.model][c] for c in ("mae", "rmse", "mape")) == (r.mae, r.rmse, r.mape)
    naive = by_model[schemas.NAIVE]
    assert all(r.beats_naive == (r.mae < naive.mae) for r in board)
    assert all(by_model[m].beats_naive for m in forecast.LEARNED) and not naive.beats_naive
    best = QUERIES["best_of_five"](spark, SF_DIR).first()
    assert best.model == board[0].model and best.model in forecast.LEARNED and f"(MAE: {best.mae})" in best.rationale

    wide = QUERIES["prediction_pivot_five"](spark, SF_DIR).collect()
    baselines = {(r.Date, r.Store_ID, r.Product_ID): r for r in QUERIES["prediction_pivot"](spark, SF_DIR).collect()}
    assert len(wide) == len(baselines)
    for r in wide:
        other = baselines[r.Date, r.Store_ID, r.Product_ID]
        assert (r.actual, r.naive, r.moving_average) == (other.actual, other.naive, other.moving_average)
    for name, model in (("linear", schemas.LINEAR), ("forest", schemas.FOREST), ("boosted", schemas.BOOSTED)):
        error = sum(abs(r.actual - r[name]) for r in wide) / len(wide)
        assert abs(error - by_model[model].mae) < 0.006


def test_batch_scoring_has_the_accepted_requests(spark):
    rows = QUERIES["batch_scoring"](spark, SF_DIR).collect()
    baseline = QUERIES["batch_scoring_baseline"](spark, SF_DIR).collect()
    assert sorted(r.request_id for r in rows) == sorted(r.request_id for r in baseline)
    assert all(r.predicted_demand >= 0 for r in rows) and len({r.predicted_demand for r in rows}) > 3


def test_entry(spark):
    board = driver.entry(spark)
    assert board.columns == ["model", "mae", "rmse", "mape"]
    assert [r.model for r in board.collect()] == ["Moving Average (7-Day)", "Naive Forecast (Lag-1)"]
