"""The five business reports.

Sales are aggregated per product (and store or month) before they meet the catalog, so the
join sees aggregates and a product that makes up much of the table is no hot join key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark import schemas
from demandspark.functions import columns as C


def monthly_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Units, revenue and mean discount by month and category; newest month first."""
    by_product = sales.groupBy(C.year_month(F.col("date")).alias("sales_month"), "product_id").agg(
        F.sum("units_sold").alias("units"),
        F.sum("revenue").alias("revenue"),
        F.sum("discount").alias("discount"),
        F.count("discount").alias("discounts"),
    )
    revenue = F.sum("revenue")
    return (
        by_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("sales_month", "category")
        .agg(
            F.sum("units").alias("total_units_sold"),
            F.round(revenue, 2).cast("double").alias("total_revenue"),
            F.round(F.sum("discount").cast("double") / F.sum("discounts"), 2).alias("avg_discount_pct"),
        )
        .orderBy(F.desc_nulls_first("sales_month"), F.desc_nulls_first("total_revenue"), "category")
    )


def top_n_per_store(sales: DataFrame, products: DataFrame, n: int = 3) -> DataFrame:
    """Per store the products with the n highest revenues; equal revenues share a rank."""
    revenue = sales.groupBy("store_id", "product_id").agg(F.sum("revenue").alias("store_revenue"))
    by_revenue = W.partitionBy("store_id").orderBy(F.desc_nulls_first("store_revenue"))
    return (
        revenue.join(products.select("product_id", "product_name", "category"), "product_id")
        .withColumn("rank_in_store", F.dense_rank().over(by_revenue))
        .filter(F.col("rank_in_store") <= n)
        .select(
            "store_id",
            "rank_in_store",
            "product_id",
            "product_name",
            "category",
            F.round("store_revenue", 2).cast("double").alias("total_revenue"),
        )
        .orderBy("store_id", "rank_in_store", "product_id")
    )


def recent_velocity(sales: DataFrame, days: int = 7) -> DataFrame:
    """Mean units per sales row in the last days, counted back from the newest date; both ends
    belong to the range."""
    newest = sales.agg(F.max("date").alias("newest")).scalar()
    return (
        sales.filter(F.col("date") >= F.date_sub(newest, days))
        .groupBy("store_id", "product_id")
        .agg(F.round(F.avg("units_sold"), 2).alias("velocity"))
    )


def health_status(stock: Column, rate: Column) -> Column:
    return (
        F.when(stock < rate * 3, schemas.HEALTH_URGENT)
        .when(stock > rate * 14, schemas.HEALTH_OVERSTOCK)
        .otherwise(schemas.HEALTH_OPTIMAL)
    )


def stockout_report(inventory: DataFrame, products: DataFrame, sales: DataFrame, days: int = 7) -> DataFrame:
    """Stock against its recent velocity; the shortest cover first, products without sales last."""
    rate = F.coalesce("velocity", F.lit(0.0))
    return (
        inventory.join(products.select("product_id", "product_name"), "product_id")
        .join(recent_velocity(sales, days), ["store_id", "product_id"], "left")
        .select(
            "store_id",
            "product_id",
            "product_name",
            F.col("inventory_level").alias("current_inventory"),
            rate.alias("daily_run_rate"),
            F.round(C.ratio(F.col("inventory_level"), F.col("velocity")), 1).alias("estimated_days_of_stock"),
            health_status(F.col("inventory_level"), rate).alias("inventory_health_status"),
        )
        .orderBy(F.asc_nulls_last("estimated_days_of_stock"), "store_id", "product_id")
    )


def promo_elasticity(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Mean units with and without promotion by category, and the lift between them."""

    def part(flag: int) -> Column:
        return F.when(F.col("promotion") == flag, F.col("units_sold"))

    by_product = sales.groupBy("product_id").agg(
        F.sum(part(1)).alias("units_1"),
        F.count(part(1)).alias("rows_1"),
        F.sum(part(0)).alias("units_0"),
        F.count(part(0)).alias("rows_0"),
    )
    on = C.ratio(F.sum("units_1"), F.sum("rows_1").cast("double"))
    off = C.ratio(F.sum("units_0"), F.sum("rows_0").cast("double"))
    return (
        by_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(on.alias("on"), off.alias("off"))
        .select(
            "category",
            F.round("on", 2).alias("avg_units_on_promo"),
            F.round("off", 2).alias("avg_units_no_promo"),
            F.round(C.ratio(F.col("on") - F.col("off"), F.col("off")) * 100, 2).alias(
                "promotion_sales_lift_pct"
            ),
        )
        .orderBy(F.desc_nulls_first("promotion_sales_lift_pct"), "category")
    )


def forecast_errors(forecasts: DataFrame, sales: DataFrame) -> DataFrame:
    """Every forecast with the sales of its product, store and day, and its error. A day with
    several sales rows gives several rows."""
    error = F.abs(F.col("predicted_demand").cast("double") - F.col("units_sold"))
    actual = sales.select("product_id", "store_id", F.col("date").alias("forecast_date"), "units_sold")
    return forecasts.join(actual, ["product_id", "store_id", "forecast_date"]).select(
        "product_id",
        "store_id",
        "forecast_date",
        "model_name",
        F.col("predicted_demand").cast("double").alias("predicted_demand"),
        F.col("units_sold").alias("actual_units_sold"),
        F.round(error, 2).alias("absolute_error"),
        F.round(C.ratio(error * 100, F.col("units_sold").cast("double")), 2).alias("error_percentage"),
    )


def forecast_accuracy(forecasts: DataFrame, sales: DataFrame, limit: int = 50) -> DataFrame:
    """The newest forecasts against what was sold."""
    return forecast_errors(forecasts, sales).orderBy(
        F.desc_nulls_first("forecast_date"), "store_id", "product_id", "model_name"
    ).limit(limit)
