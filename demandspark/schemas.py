"""Table schemas, key lists and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

SERIES_KEYS = ["Store_ID", "Product_ID"]
PANEL_KEYS = SERIES_KEYS + ["Date"]

RAW_SALES = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        T.StructField("Store_ID", T.StringType()),
        T.StructField("Product_ID", T.StringType()),
        T.StructField("Product_Category", T.StringType()),
        T.StructField("Units_Sold", T.LongType()),
        T.StructField("Unit_Price", T.DoubleType()),
        T.StructField("Discount", T.DoubleType()),
        T.StructField("Promotion", T.IntegerType()),
        T.StructField("Holiday", T.IntegerType()),
        T.StructField("Inventory_Level", T.DoubleType()),
        T.StructField("Region", T.StringType()),
    ]
)

# A line of a CSV feed that does not fit the columns, as it stands in the file.
RAW_LINE = "raw_line"

PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType(), False),
        T.StructField("product_name", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("unit_price", T.DecimalType(10, 2), False),
    ]
)

SALES = T.StructType(
    [
        T.StructField("date", T.DateType(), False),
        T.StructField("store_id", T.StringType(), False),
        T.StructField("product_id", T.StringType(), False),
        T.StructField("units_sold", T.LongType(), False),
        T.StructField("discount", T.DecimalType(5, 2)),
        T.StructField("promotion", T.IntegerType()),
        T.StructField("revenue", T.DecimalType(12, 2), False),
    ]
)

INVENTORY = T.StructType(
    [
        T.StructField("product_id", T.StringType(), False),
        T.StructField("store_id", T.StringType(), False),
        T.StructField("inventory_level", T.LongType(), False),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

FORECASTS = T.StructType(
    [
        T.StructField("product_id", T.StringType(), False),
        T.StructField("store_id", T.StringType(), False),
        T.StructField("forecast_date", T.DateType(), False),
        T.StructField("predicted_demand", T.DecimalType(10, 2), False),
        T.StructField("model_name", T.StringType(), False),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# The risk table carries the store as well: risk is decided per store and product.
INVENTORY_RISK = T.StructType(
    [
        T.StructField("product_id", T.StringType(), False),
        T.StructField("store_id", T.StringType(), False),
        T.StructField("current_inventory", T.LongType(), False),
        T.StructField("forecast_demand", T.DoubleType(), False),
        T.StructField("risk_level", T.StringType(), False),
        T.StructField("reorder_quantity", T.LongType(), False),
        T.StructField("created_at", T.TimestampType()),
    ]
)

TABLES = {
    "products": PRODUCTS,
    "sales": SALES,
    "inventory": INVENTORY,
    "forecasts": FORECASTS,
    "inventory_risk": INVENTORY_RISK,
}

SALE_REQUESTS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("units_sold", T.LongType()),
        T.StructField("discount", T.DoubleType()),
        T.StructField("promotion", T.IntegerType()),
    ]
)

SCORE_REQUESTS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("forecast_date", T.DateType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("discount", T.DoubleType()),
        T.StructField("promotion", T.IntegerType()),
        T.StructField("holiday", T.IntegerType()),
        T.StructField("lag_1", T.DoubleType()),
        T.StructField("rolling_mean_7", T.DoubleType()),
    ]
)

REORDER_REQUESTS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("reorder_quantity", T.LongType()),
        T.StructField("supplier_notes", T.StringType()),
    ]
)

# ---------------------------------------------------------------------------
# Results only agree with the published ones if these are equal.
# ---------------------------------------------------------------------------
STORE_ID_PATTERN = "^S[0-9]{2,}$"
PRODUCT_ID_PATTERN = "^P[0-9]{2,}$"
DATE_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"

STORE_REGIONS = {"S01": "North", "S02": "South", "S03": "East", "S04": "West", "S05": "Central"}
DEFAULT_REGION = "North"

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

CATEGORICAL_FEATURES = ["Store_ID", "Product_ID", "Product_Category", "Region"]
CALENDAR_FEATURES = ["Day", "Month", "Year", "Week", "Quarter", "Day_of_Week", "Is_Weekend"]
HISTORY_FEATURES = ["Lag_1", "Lag_7", "Lag_30", "Rolling_Mean_7", "Rolling_Mean_30"]
NUMERICAL_FEATURES = (
    ["Unit_Price", "Discount", "Promotion", "Holiday"] + CALENDAR_FEATURES + HISTORY_FEATURES
)
FEATURES = CATEGORICAL_FEATURES + NUMERICAL_FEATURES
TARGET = "Units_Sold"
CORRELATED = [
    "Units_Sold", "Unit_Price", "Discount", "Promotion", "Holiday", "Day_of_Week", "Is_Weekend",
    "Lag_1", "Lag_7", "Rolling_Mean_7", "Rolling_Mean_30",
]

NAIVE = "Naive Forecast (Lag-1)"
MOVING_AVERAGE = "Moving Average (7-Day)"
LINEAR = "Linear Regression"
FOREST = "Random Forest Regressor"
BOOSTED = "Gradient-Boosted Trees Regressor"

STOCK_OUT, NORMAL, OVERSTOCK = "Stock-Out Risk", "Normal Stock", "Overstock Risk"
RISK_LABELS = [STOCK_OUT, NORMAL, OVERSTOCK]
CATEGORY_RISK_LABELS = ["HIGH", "MEDIUM", "LOW", "OVERSTOCK"]

DEFAULT_LAG = 50.0
DEFAULT_STOCK_FOR_RISK = 150
DEFAULT_STOCK_FOR_REORDER = 0

# category -> (lowest, highest) units a day and store
CATEGORY_DEMAND = {
    "Electronics": (2, 12),
    "Groceries": (15, 60),
    "Apparel": (5, 25),
    "Home & Kitchen": (3, 18),
    "Health & Beauty": (8, 35),
}
# category -> (stock at or below which risk is MEDIUM, stock at or below which it is HIGH)
RISK_THRESHOLDS = {
    "Electronics": (50, 25),
    "Groceries": (120, 60),
    "Apparel": (80, 40),
    "Home & Kitchen": (60, 30),
    "Health & Beauty": (90, 45),
}

# Sentences; %d stands for a whole number, %s for text
ADVICE_STOCK_OUT = (
    "High stock-out hazard! Current stock (%d) is insufficient for anticipated demand (%d). "
    "Urgent reorder of %d units advised."
)
ADVICE_OVERSTOCK = (
    "Excess inventory detected! Current stock (%d) exceeds 2x required buffer (%d). "
    "Suspend replenishment to reduce holding costs."
)
ADVICE_TOP_UP = (
    "Inventory is operating within healthy parameters. Routine top-up of %d units recommended "
    "to sustain target safety buffer."
)
ADVICE_ENOUGH = "Stock levels are fully sufficient to satisfy target demand cycle."
RECEIPT_STATUS = "CONFIRMED"
RECEIPT_MESSAGE = (
    "Successfully reordered %d units. Inventory balance updated from %d to %d."
)
RATIONALE = (
    "The '%s' model was selected as the optimal production forecaster because it achieved the "
    "lowest Mean Absolute Error (MAE: %s) and Root Mean Squared Error (RMSE: %s) alongside a "
    "highly competitive MAPE of %s%%. It effectively captures non-linear promotion, holiday, "
    "store-regional interactions, and temporal lag dynamics without exhibiting volatility or "
    "lookahead leakage."
)
HEALTH_URGENT = "URGENT: Stock-Out Hazard"
HEALTH_OVERSTOCK = "WARNING: Overstock Capital Trapped"
HEALTH_OPTIMAL = "OPTIMAL: Balanced Stock"
