"""End-to-end jobs: train and rank forecasters, decide stock for everything on sale."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from demandspark.operators import evaluate as E
from demandspark.operators import features, forecast
from demandspark.operators.inventory import risk_job
from demandspark.operators.lookup import missing_forecasts
from demandspark.sources.models import save_forecaster
from demandspark.sources.staging import stage
from demandspark.sources.tables import append_forecasts, append_risks, save_leaderboard


def baseline_leaderboard(panel: DataFrame, ratio: float = 0.20) -> DataFrame:
    """Both baselines on the chronological test set. The panel is read several times; pass a
    stored table."""
    _, test, _ = forecast.chronological_split(features.add_history(panel), ratio, calendar=panel)
    return E.leaderboard(E.evaluate(forecast.baseline_predictions(test)))


def train_and_rank(
    panel: DataFrame,
    ratio: float = 0.20,
    kinds: Iterable[str] = forecast.LEARNED,
    params: Mapping[str, dict] | None = None,
    model_path: str | None = None,
    board_path: str | None = None,
    leave_out: bool = False,
):
    """Features, split, five forecasters, leaderboard; saves the best learned model. If a learned model cannot be
    fitted, an error is raised and nothing is ranked or saved; with ``leave_out`` it is left out with a warning.

    The feature table is written once to the shared folder, since fitting reads it many times.
    Returns (models, predictions, leaderboard).
    """
    table = stage(features.build_features(panel), "features")
    start = forecast.split_date(table, ratio).first().split_date
    train, test = table.filter(table.Date < start), table.filter(table.Date >= start)
    models, predictions = forecast.train_all(train, test, kinds, params, leave_out)
    predictions = stage(predictions, "predictions")  # scoring is not repeated by whoever reads them
    board = stage(E.evaluate(predictions), "metrics")
    if board_path:
        save_leaderboard(E.leaderboard(board), board_path)
    if model_path:
        best = E.leaderboard(board.filter(board.model.isin(list(models)))).first().model
        save_forecaster(best, models[best], model_path)
    return models, predictions, E.leaderboard(board)


def decide_and_record(
    model, requests, history, catalog, regions, inventory, model_name: str,
    forecast_path: str, risk_path: str, lead: int = 1, run: str | None = None,
):
    """Score requests, append the forecasts, decide stock from them, append the decisions.

    Scores are written before they are used again, so forecasts and decisions agree. A job
    repeated under the same ``run`` replaces what it wrote before.
    Returns (decisions, rejects).
    """
    forecasts, rejects = forecast.score_requests(
        model, requests, history, catalog, regions, model_name
    )
    forecasts = stage(forecasts, "forecasts")
    append_forecasts(forecasts, forecast_path, run)
    decisions = stage(risk_job(forecasts, inventory, lead), "decisions")
    append_risks(decisions, risk_path, run)
    return decisions, rejects


def forecast_missing(
    model, catalog, forecasts, history, regions, model_name: str, store: str, day: str,
    forecast_path: str | None = None, run: str | None = None,
) -> DataFrame:
    """Forecasts for the products of the catalog that have none yet, for one store and day;
    appended to the table of forecasts if a path is given."""
    missing = missing_forecasts(catalog, forecasts)
    requests = forecast.requests_for_missing(missing, store, day)
    made, _ = forecast.score_requests(model, requests, history, catalog, regions, model_name)
    made = stage(made, "forecasts")
    if forecast_path:
        append_forecasts(made, forecast_path, run)
    return made
