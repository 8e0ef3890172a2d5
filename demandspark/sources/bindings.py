"""The driver's star schema seen as a sales panel, its relational tables and its requests.

Dimensions are joined without broadcast hints: Spark broadcasts a side only while its size
stays below the session's threshold and sort-merges it otherwise, splitting skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark import schemas
from demandspark.functions import columns as C
from demandspark.operators.features import add_past
from demandspark.streaming.ingest import read_requests


# The columns used here, with the types the files have; naming them saves reading the footers
# once more for every query.
_COLUMNS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_discount double, l_shipdate timestamp_ntz"
    ),
    "part": "p_partkey bigint, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, user_id bigint",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table's file as a stream."""
    schema = table(spark, sf_dir, name).schema
    return read_requests(spark, sf_dir, schema, pathGlobFilter=f"{name}.parquet")


def _product_number(part_type: Column, bucket: Column) -> Column:
    rank = (
        F.when(part_type == "ECONOMY", 0)
        .when(part_type == "LARGE", 1)
        .when(part_type == "MEDIUM", 2)
        .when(part_type == "PROMO", 3)
        .when(part_type == "SMALL", 4)
        .otherwise(5)
    )
    return F.lit(100) + 10 * rank + bucket


def _product_id(number: Column) -> Column:
    return F.concat(F.lit("P"), number.cast("string"))


def _store_id(number: Column) -> Column:
    return F.concat(F.lit("S"), F.lpad(number.cast("string"), 2, "0"))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey",
        _store_id(F.col("n_nationkey") + 1).alias("Store_ID"),
        F.col("r_name").alias("Region"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store -> region; a store is a nation."""
    return _places(spark, sf_dir).select(
        F.col("Store_ID").alias("store_id"), F.col("Region").alias("region")
    )


def _lines(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Order lines with day, nation, part type and bucket, units, discount and price.

    One dimension at a time: each right side is a plain table whose size Spark knows, so it
    is broadcast only if it is small.
    """
    line = lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier")
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_type",
        (F.col("p_size") % 5).alias("bucket"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )
    return (
        line.join(part, line.l_partkey == part.p_partkey)
        .join(supplier, line.l_suppkey == supplier.s_suppkey)
        .select(
            F.col("l_shipdate").cast("date").alias("Date"),
            "s_nationkey",
            "p_type",
            "bucket",
            F.col("l_quantity").cast("long").alias("units"),
            F.rint(F.col("l_discount") * 100).cast("int").alias("disc"),
            "price",
            "l_orderkey",
            "l_linenumber",
        )
    )


def _named(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds store, region, product and category to rows with nation, part type and bucket."""
    place = _places(spark, sf_dir)
    return df.join(place, df.s_nationkey == place.n_nationkey).withColumns(
        {
            "Product_ID": _product_id(_product_number(F.col("p_type"), F.col("bucket"))),
            "Product_Category": F.col("p_type"),
        }
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily panel; (Store_ID, Product_ID, Date) is unique.

    Lines are added up by narrow keys first; names are looked up for the sums.
    """
    day = F.col("Date")
    month, dom = F.month(day), F.dayofmonth(day)
    holiday = (
        ((month == 12) & dom.isin(24, 25, 31))
        | ((month == 1) & (dom == 1))
        | ((month == 7) & (dom == 4))
        | ((month == 2) & (dom == 14))
    )
    sums = (
        _lines(spark, sf_dir)
        .groupBy("Date", "s_nationkey", "p_type", "bucket")
        .agg(
            F.sum("units").alias("Units_Sold"),
            F.max("price").alias("price"),
            F.max("disc").alias("disc"),
            F.sum(F.col("l_orderkey") % 97).alias("stock"),
        )
    )
    return _named(sums, spark, sf_dir).select(
        "Date",
        "Store_ID",
        "Product_ID",
        "Product_Category",
        "Units_Sold",
        F.col("price").cast("double").alias("Unit_Price"),
        F.col("disc").cast("double").alias("Discount"),
        (F.col("disc") >= 8).cast("int").alias("Promotion"),
        holiday.cast("int").alias("Holiday"),
        (F.col("stock") + 10).alias("Inventory_Level"),
        "Region",
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spoil(panel(spark, sf_dir))


def spoil(daily: DataFrame) -> DataFrame:
    """A panel as a raw feed: text dates, gaps, bad values and copied rows."""
    h = (
        F.col("Units_Sold") * 7
        + F.col("Inventory_Level") * 13
        + F.substring("Product_ID", 2, 3).cast("int") * 17
        + F.dayofmonth("Date")
    )
    marked = daily.withColumn("h", h)
    spoiled = marked.select(
        F.when(F.col("h") % 1009 == 1, "not-a-date").otherwise(F.col("Date").cast("string")).alias("Date"),
        F.when(F.col("h") % 911 == 2, "INVALID").otherwise(F.col("Store_ID")).alias("Store_ID"),
        "Product_ID",
        "Product_Category",
        F.when(F.col("h") % 809 == 3, F.lit(-5).cast("long")).otherwise(F.col("Units_Sold")).alias("Units_Sold"),
        F.when(F.col("h") % 701 == 4, F.lit(-10.0))
        .when(F.col("h") % 601 != 5, F.col("Unit_Price"))
        .alias("Unit_Price"),
        F.when(F.col("h") % 503 != 6, F.col("Discount")).alias("Discount"),
        "Promotion",
        "Holiday",
        F.when(F.col("h") % 401 != 7, F.col("Inventory_Level").cast("double")).alias("Inventory_Level"),
        "Region",
        F.when(F.col("h") % 499 == 0, 2).otherwise(1).alias("copies"),
    )
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return spoiled.withColumn("copy", copies).select(*schemas.RAW_SALES.names)


def products(daily: DataFrame) -> DataFrame:
    """The catalog of a panel: its products with the highest price each has had."""
    name = F.concat("Product_Category", F.lit(" item "), "Product_ID")
    return daily.groupBy(
        F.col("Product_ID").alias("product_id"),
        name.alias("product_name"),
        F.col("Product_Category").alias("category"),
    ).agg(F.max("Unit_Price").cast("decimal(10,2)").alias("unit_price"))


def sales(daily: DataFrame) -> DataFrame:
    """The sales table of a panel."""
    revenue = C.net_revenue(F.col("Units_Sold"), F.col("Unit_Price"), F.col("Discount"))
    return daily.select(
        F.col("Date").alias("date"),
        F.col("Store_ID").alias("store_id"),
        F.col("Product_ID").alias("product_id"),
        F.col("Units_Sold").alias("units_sold"),
        F.col("Discount").cast("decimal(5,2)").alias("discount"),
        F.col("Promotion").alias("promotion"),
        F.bround(revenue, 2).cast("decimal(12,2)").alias("revenue"),
    )


def inventory(daily: DataFrame) -> DataFrame:
    """The last known level of each series of a panel."""
    series = [F.col("Product_ID").alias("product_id"), F.col("Store_ID").alias("store_id")]
    return daily.groupBy(*series).agg(F.max_by("Inventory_Level", "Date").alias("inventory_level"))


def sale_requests(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Each order line as a request to record a sale; some are out of range, some name a
    product that the catalog lacks. ``lineitem`` may be a stream."""
    line = _named(_lines(spark, sf_dir, lineitem), spark, sf_dir)
    key = F.col("l_orderkey")
    return line.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("Date").alias("date"),
        F.col("Store_ID").alias("store_id"),
        F.when(key % 53 == 0, F.lit("P9999")).otherwise(F.col("Product_ID")).alias("product_id"),
        F.when(key % 41 == 0, -F.col("units")).otherwise(F.col("units")).alias("units_sold"),
        F.when(key % 61 != 0, F.when(key % 67 == 0, F.lit(120.0)).otherwise(F.col("disc").cast("double"))).alias("discount"),
        F.when(key % 71 == 0, F.lit(2)).otherwise((F.col("disc") >= 8).cast("int")).alias("promotion"),
    )


def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a request to forecast a product in a store on a day. Some bring their
    own lags, prices or flags, some leave them out, a few break the rules; store S26 and S27
    have no history."""
    event = table(spark, sf_dir, "events")
    i, user = F.col("event_id"), F.col("user_id")
    return event.select(
        F.col("event_id").alias("request_id"),
        F.when(i % 97 == 0, F.lit("P9999"))
        .otherwise(F.concat(F.lit("P"), (F.lit(100) + 10 * (user % 6) + i % 5).cast("string")))
        .alias("product_id"),
        F.concat(F.lit("S"), F.lpad((i % 27 + 1).cast("string"), 2, "0")).alias("store_id"),
        F.date_add(F.lit("2001-11-05").cast("date"), (i % 60).cast("int")).alias("forecast_date"),
        F.when(i % 3 == 0, (i % 89).cast("double")).alias("unit_price"),
        F.when(i % 4 != 0, (i % 11).cast("double")).alias("discount"),
        F.when(i % 5 != 0, (i % 2).cast("int")).alias("promotion"),
        F.when(i % 6 != 0, (i % 13 == 0).cast("int")).alias("holiday"),
        F.when(i % 7 == 0, (user % 60).cast("double")).when(i % 83 == 0, F.lit(-1.0)).alias("lag_1"),
        F.when(i % 14 == 0, (user % 50).cast("double")).alias("rolling_mean_7"),
    )


def reorder_requests(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Each order as a request to restock; some quantities are not positive, some products
    or stores have no stock on record. ``orders`` may be a stream."""
    order = orders if orders is not None else table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return order.select(
        F.col("o_orderkey").alias("request_id"),
        F.when(key % 59 == 0, F.lit("P9999"))
        .otherwise(F.concat(F.lit("P"), (F.lit(100) + 10 * (cust % 6) + key % 5).cast("string")))
        .alias("product_id"),
        F.concat(F.lit("S"), F.lpad((cust % 27 + 1).cast("string"), 2, "0")).alias("store_id"),
        (key % 90 - 2).alias("reorder_quantity"),
        F.col("o_orderpriority").alias("supplier_notes"),
    )


def forecasts(daily: DataFrame) -> DataFrame:
    """Naive predictions for all days of a panel that have a day before, as rows of the forecast
    table. They are written up to six days ahead, so that the last written is not the last day."""
    return (
        add_past(daily, lags=(1,), windows=())
        .filter(F.col("Lag_1").isNotNull())
        .select(
            F.col("Product_ID").alias("product_id"),
            F.col("Store_ID").alias("store_id"),
            F.col("Date").alias("forecast_date"),
            F.col("Lag_1").cast("decimal(10,2)").alias("predicted_demand"),
            F.lit(schemas.NAIVE).alias("model_name"),
            F.date_sub("Date", F.dayofmonth("Date") % 7).cast("timestamp_ntz").alias("created_at"),
        )
    )
