"""Named row rules as SQL conditions."""

from __future__ import annotations

# Request rules: a request is accepted when every condition is true; null is not true.
SALE_RULES = {
    "date": "date IS NOT NULL",
    "store_id": "store_id IS NOT NULL",
    "product_id": "product_id IS NOT NULL",
    "units_sold": "units_sold >= 0",
    "discount": "discount IS NULL OR discount BETWEEN 0 AND 100",
    "promotion": "promotion IS NULL OR promotion IN (0, 1)",
}

SCORE_RULES = {
    "product_id": "product_id IS NOT NULL",
    "store_id": "store_id IS NOT NULL",
    "forecast_date": "forecast_date IS NOT NULL",
    "unit_price": "unit_price IS NULL OR (unit_price > 0 AND NOT isnan(unit_price))",
    "discount": "discount IS NULL OR discount BETWEEN 0 AND 100",
    "promotion": "promotion IS NULL OR promotion IN (0, 1)",
    "holiday": "holiday IS NULL OR holiday IN (0, 1)",
    "lag_1": "lag_1 IS NULL OR (lag_1 >= 0 AND NOT isnan(lag_1))",
    "rolling_mean_7": "rolling_mean_7 IS NULL OR (rolling_mean_7 >= 0 AND NOT isnan(rolling_mean_7))",
}

REORDER_RULES = {
    "product_id": "product_id IS NOT NULL",
    "store_id": "store_id IS NOT NULL",
    "reorder_quantity": "reorder_quantity > 0",
}

# Table constraints, as a database reads them: a CHECK is violated when it is false, so a
# null only violates NOT NULL.
TABLE_NOT_NULL = {
    "products": ["product_id", "product_name", "category", "unit_price"],
    "sales": ["date", "store_id", "product_id", "units_sold", "revenue"],
    "inventory": ["product_id", "store_id", "inventory_level"],
    "forecasts": ["product_id", "store_id", "forecast_date", "predicted_demand", "model_name"],
    "inventory_risk": [
        "product_id", "current_inventory", "forecast_demand", "risk_level", "reorder_quantity",
    ],
}

TABLE_CHECKS = {
    "products": ["unit_price > 0"],
    "sales": [
        "units_sold >= 0",
        "discount BETWEEN 0 AND 100",
        "promotion IN (0, 1)",
        "revenue >= 0",
    ],
    "inventory": ["inventory_level >= 0"],
    "forecasts": ["predicted_demand >= 0"],
    "inventory_risk": [
        "current_inventory >= 0",
        "forecast_demand >= 0",
        "risk_level IN ('Stock-Out Risk', 'Normal Stock', 'Overstock Risk')",
        "reorder_quantity >= 0",
    ],
}

TABLE_KEYS = {
    "products": ["product_id"],
    "inventory": ["product_id", "store_id"],
}
