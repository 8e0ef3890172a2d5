"""Stock decisions: safety stock, reorder quantity, risk class and advice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark import schemas
from demandspark.functions import columns as C


# Amounts and days from these on do not fit the decimals of a decision; such rows are rejects.
AMOUNT_LIMIT = 1_000_000_000
LEAD_LIMIT = 1_000_000


def _amount(value: Column) -> Column:
    return value.cast("decimal(20,4)")


def _optional(df: DataFrame, name: str, data_type: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(data_type))


def safety_stock_of(demand: Column, override: Column, ratio: float = 0.20, floor: float = 5.0) -> Column:
    """The override if it is given and not negative, else a share of the demand with a floor."""
    share = F.bround(_amount(demand) * F.lit(str(ratio)).cast("decimal(8,4)"), 2)
    computed = F.greatest(F.lit(str(floor)).cast("decimal(20,4)"), share.cast("decimal(20,4)"))
    return F.when(override >= 0, _amount(override)).otherwise(computed)


def safety_stock(df: DataFrame, ratio: float = 0.20, floor: float = 5.0) -> DataFrame:
    """Adds safety_stock from forecast_demand; an existing safety_stock is an override."""
    df = _optional(df, "safety_stock", "double")
    value = safety_stock_of(F.col("forecast_demand"), F.col("safety_stock"), ratio, floor)
    return df.withColumn("safety_stock", value.cast("double"))


def advice(risk: Column, stock: Column, demand: Column, required: Column, reorder: Column) -> Column:
    """The advice sentence of a decision."""
    return (
        F.when(
            risk == schemas.STOCK_OUT,
            F.format_string(schemas.ADVICE_STOCK_OUT, stock, C.whole(demand), reorder),
        )
        .when(
            risk == schemas.OVERSTOCK,
            F.format_string(schemas.ADVICE_OVERSTOCK, stock, C.whole(required)),
        )
        .when(reorder > 0, F.format_string(schemas.ADVICE_TOP_UP, reorder))
        .otherwise(schemas.ADVICE_ENOUGH)
    )


def decide_inventory(
    df: DataFrame,
    lead: int = 1,
    ratio: float = 0.20,
    stockout: float = 0.75,
    overstock: float = 2.0,
    strict: bool = False,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Decide stock per row of (product_id, current_inventory, forecast_demand), optionally with
    store_id, safety_stock and lead_time_days; ``keep`` names columns to pass on. Returns
    (decisions, rejects).

    Rows with negative or missing stock or demand are rejects, as are amounts from a billion and
    lead times from a million days; ``strict`` makes them an error. NaN counts as missing.
    Amounts are decimals until the end, so rounding up and comparing are exact.
    """
    df = _optional(df, "store_id", "string")
    df = _optional(df, "safety_stock", "double")
    df = _optional(df, "lead_time_days", "int")
    amounts = ["current_inventory", "forecast_demand", "safety_stock"]
    floats = [name for name, kind in df.dtypes if name in amounts and kind in ("double", "float")]
    df = df.withColumns({name: C.nan_to_null(F.col(name)) for name in floats})
    stock, demand = F.col("current_inventory"), F.col("forecast_demand")
    problem = (
        F.when(stock.isNull() | (stock < 0), F.lit("current inventory must not be negative"))
        .when(demand.isNull() | (demand < 0), F.lit("forecast demand must not be negative"))
        .when(
            F.greatest(*amounts) >= AMOUNT_LIMIT, F.lit("amounts must be below a billion")
        )
        .when(F.col("lead_time_days") >= LEAD_LIMIT, F.lit("lead time must be below a million days"))
    )
    judged = df.withColumn("reason", problem)
    rejects = judged.filter(F.col("reason").isNotNull())
    if strict:
        accepted = judged.withColumn(
            "forecast_demand",
            F.when(F.col("reason").isNull(), demand).otherwise(F.raise_error(F.col("reason")).cast("double")),
        )
    else:
        accepted = judged.filter(F.col("reason").isNull())

    required = F.col("required")
    risk = (
        F.when(
            (_amount(stock) < _amount(demand) * F.lit(str(stockout)).cast("decimal(8,4)"))
            | (_amount(stock) < F.col("safety")),
            schemas.STOCK_OUT,
        )
        .when(_amount(stock) > required * F.lit(str(overstock)).cast("decimal(8,4)"), schemas.OVERSTOCK)
        .otherwise(schemas.NORMAL)
    )
    decisions = (
        accepted.withColumn("lead", F.greatest(F.lit(1), F.coalesce("lead_time_days", F.lit(lead))))
        .withColumn("safety", safety_stock_of(demand, F.col("safety_stock"), ratio))
        .withColumn(
            "required",
            F.bround(
                F.bround(_amount(demand) * F.col("lead").cast("decimal(6,0)"), 2) + F.col("safety"), 2
            ).cast("decimal(20,4)"),
        )
        .withColumn(
            "reorder",
            F.greatest(F.lit(0).cast("long"), F.ceil(F.col("required") - _amount(stock)).cast("long")),
        )
        .withColumn("risk", risk)
        .select(
            *keep,
            "product_id",
            F.coalesce("store_id", F.lit("N/A")).alias("store_id"),
            stock.cast("long").alias("current_inventory"),
            C.half_even(demand).alias("forecast_demand"),
            F.bround("safety", 2).cast("double").alias("safety_stock"),
            F.col("lead").alias("lead_time_days"),
            required.cast("double").alias("required_stock"),
            F.col("reorder").alias("reorder_quantity"),
            F.col("risk").alias("risk_level"),
            advice(F.col("risk"), stock.cast("long"), demand, required, F.col("reorder")).alias("recommendation"),
        )
    )
    return decisions, rejects


def risk_job(
    forecasts: DataFrame,
    inventory: DataFrame,
    lead: int = 1,
    default_stock: int = schemas.DEFAULT_STOCK_FOR_RISK,
    keep: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Decide stock for every forecast row (product_id, store_id, predicted_demand); a product
    without stock on record in the store counts as ``default_stock``. ``lead`` is 1 to 30 days."""
    if not 1 <= lead <= 30:
        raise ValueError(f"lead time must be 1 to 30 days: {lead}")
    keys = ["product_id", "store_id"]
    joined = forecasts.select(*keys, "predicted_demand", *keep).join(
        inventory.select(*keys, "inventory_level"), keys, "left"
    )
    decisions, _ = decide_inventory(
        joined.select(
            *keys,
            *keep,
            F.coalesce(F.col("inventory_level").cast("long"), F.lit(default_stock).cast("long")).alias(
                "current_inventory"
            ),
            F.col("predicted_demand").cast("double").alias("forecast_demand"),
        ),
        lead=lead,
        keep=keep,
        **options,
    )
    return decisions


def risk_breakdown(df: DataFrame, labels=tuple(schemas.RISK_LABELS)) -> DataFrame:
    """Rows per risk label; labels without rows count zero."""
    listed = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in labels])).alias("risk_level"))
    counts = df.groupBy("risk_level").agg(F.count("*").alias("row_count"))
    return listed.join(counts, "risk_level", "left").fillna({"row_count": 0})


def _by_category(category: Column, values: Mapping[str, tuple[float, float]], index: int) -> Column:
    pairs = [F.lit(x) for name, pair in values.items() for x in (name, float(pair[index]))]
    return F.try_element_at(F.create_map(*pairs), category)


def category_risk(
    df: DataFrame, thresholds: Mapping[str, tuple[float, float]] = schemas.RISK_THRESHOLDS
) -> DataFrame:
    """Adds risk_level and reorder_quantity from thresholds per category.

    Needs inventory_level, forecast_demand and category. A category without thresholds gets null.
    """
    stock, demand, category = F.col("inventory_level"), F.col("forecast_demand"), F.col("category")
    low, medium = _by_category(category, thresholds, 0), _by_category(category, thresholds, 1)
    level = (
        F.when(low.isNull(), F.lit(None))
        .when(stock <= medium, "HIGH")
        .when(stock <= low, "MEDIUM")
        .when(_amount(stock) > _amount(demand) * F.lit("2.5").cast("decimal(3,1)"), "OVERSTOCK")
        .otherwise("LOW")
    )
    return df.withColumn("risk_level", level).withColumn("reorder_quantity", reorder_to_tens(stock, demand))


def reorder_to_tens(stock: Column, demand: Column) -> Column:
    """What is missing to one and a half times the demand, half-even to tens."""
    missing = _amount(demand) * F.lit("1.5").cast("decimal(3,1)") - _amount(stock)
    return F.bround(F.greatest(F.lit(0).cast("decimal(24,5)"), missing.cast("decimal(24,5)")), -1).cast("long")


def category_forecast(
    products: DataFrame,
    pairs: DataFrame,
    bounds: Mapping[str, tuple[float, float]] = schemas.CATEGORY_DEMAND,
    days: int = 30,
) -> DataFrame:
    """Demand over ``days`` from the category's daily range, for each (product_id, store_id)."""
    category = F.col("category")
    daily = (_by_category(category, bounds, 0) + _by_category(category, bounds, 1)) / 2
    return pairs.join(products, "product_id").select(
        "product_id", "store_id", "category", F.bround(daily * days, 2).alias("predicted_demand")
    )
