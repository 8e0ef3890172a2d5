from __future__ import annotations

import pytest

from demandspark.operators import inventory

OUT, NORMAL, OVER = "Stock-Out Risk", "Normal Stock", "Overstock Risk"
# stock, demand, safety in, lead -> safety, required, reorder, risk
CASES = [
    (30, 100.0, 20.0, 1, 20.0, 120.0, 90, OUT),
    (150, 100.0, 20.0, 1, 20.0, 120.0, 0, NORMAL),
    (350, 100.0, 20.0, 1, 20.0, 120.0, 0, OVER),
    (20, 120.0, None, 1, 24.0, 144.0, 124, OUT),
    (140, 100.0, None, 1, 20.0, 120.0, 0, NORMAL),
    (600, 80.0, None, 1, 16.0, 96.0, 0, OVER),
    (30, 78.0, None, 2, 15.6, 171.6, 142, OUT),
    (100, 100.0, None, 1, 20.0, 120.0, 20, NORMAL),
    (4, 5.0, None, 1, 5.0, 10.0, 6, OUT),
    (10, 0.0, None, 0, 5.0, 5.0, 0, NORMAL),
]
SCHEMA = "product_id string, current_inventory int, forecast_demand double, safety_stock double, lead_time_days int"


def _table(spark, cases):
    return spark.createDataFrame([(f"P{i}", *c[:4]) for i, c in enumerate(cases)], SCHEMA)


def test_decisions(spark):
    decisions, rejects = inventory.decide_inventory(_table(spark, CASES))
    rows = {r.product_id: r for r in decisions.collect()}
    assert rejects.count() == 0
    for i, case in enumerate(CASES):
        r = rows[f"P{i}"]
        assert (r.safety_stock, r.required_stock, r.reorder_quantity, r.risk_level) == case[4:], case
        assert r.store_id == "N/A" and r.lead_time_days == max(1, case[3])


def test_advice(spark):
    rows = {r.product_id: r.recommendation for r in inventory.decide_inventory(_table(spark, CASES))[0].collect()}
    assert rows["P0"] == (
        "High stock-out hazard! Current stock (30) is insufficient for anticipated demand (100). "
        "Urgent reorder of 90 units advised."
    )
    assert rows["P2"] == (
        "Excess inventory detected! Current stock (350) exceeds 2x required buffer (120). "
        "Suspend replenishment to reduce holding costs."
    )
    assert rows["P7"].startswith("Inventory is operating within healthy parameters. Routine top-up of 20 units")
    assert rows["P1"] == "Stock levels are fully sufficient to satisfy target demand cycle."


def test_rejects_and_strict(spark):
    bad = [(-10, 50.0, None, 1), (50, -20.0, None, 1), (50, 20.0, None, 1)]
    decisions, rejects = inventory.decide_inventory(_table(spark, bad))
    assert decisions.count() == 1
    assert {r.reason for r in rejects.collect()} == {
        "current inventory must not be negative", "forecast demand must not be negative",
    }
    with pytest.raises(Exception, match="must not be negative"):
        inventory.decide_inventory(_table(spark, bad), strict=True)[0].collect()


def test_safety_stock(spark):
    df = spark.createDataFrame(
        [(100.0, None), (10.0, None), (100.0, 35.0), (100.0, -1.0)], "forecast_demand double, safety_stock double"
    )
    assert [r.safety_stock for r in inventory.safety_stock(df).collect()] == [20.0, 5.0, 35.0, 20.0]


def test_risk_job_defaults(spark):
    forecasts = spark.createDataFrame(
        [("P1", "S01", 100.0), ("P2", "S01", 100.0)], "product_id string, store_id string, predicted_demand double"
    )
    stock = spark.createDataFrame([("P1", "S01", 30)], "product_id string, store_id string, inventory_level int")
    risks = inventory.risk_job(forecasts, stock)
    rows = {r.product_id: r for r in risks.collect()}
    assert rows["P1"].current_inventory == 30 and rows["P1"].risk_level == OUT
    assert rows["P2"].current_inventory == 150 and rows["P2"].risk_level == NORMAL
    counts = {r.risk_level: r.row_count for r in inventory.risk_breakdown(risks).collect()}
    assert counts == {OUT: 1, NORMAL: 1, OVER: 0}
    for lead in (0, 31):
        with pytest.raises(ValueError):
            inventory.risk_job(forecasts, stock, lead=lead)


def test_category_risk_and_reorder(spark):
    rows = [(25, 100.0), (50, 100.0), (300, 100.0), (200, 100.0), (100, 100.0), (125, 100.0)]
    df = spark.createDataFrame(
        [(s, d, "Electronics") for s, d in rows] + [(1, 1.0, "Unknown")],
        "inventory_level int, forecast_demand double, category string",
    )
    result = inventory.category_risk(df).collect()
    assert [r.risk_level for r in result] == ["HIGH", "MEDIUM", "OVERSTOCK", "LOW", "LOW", "LOW", None]
    assert [r.reorder_quantity for r in result[2:6]] == [0, 0, 50, 20]


def test_category_forecast(spark):
    products = spark.createDataFrame([("P1", "Groceries"), ("P2", "Apparel")], "product_id string, category string")
    pairs = spark.createDataFrame(
        [(p, s) for p in ("P1", "P2") for s in ("S01", "S02")], "product_id string, store_id string"
    )
    rows = {(r.product_id, r.store_id): r.predicted_demand for r in inventory.category_forecast(products, pairs).collect()}
    assert len(rows) == 4 and rows["P1", "S01"] == 1125.0 and rows["P2", "S02"] == 450.0
