"""Every operator as a query over the driver's tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark import schemas
from demandspark.functions import columns as C
from demandspark.functions import rules as R
from demandspark.operators import evaluate as E
from demandspark.operators import explore, features, forecast, history_store, inventory, lookup, quality, replenish
from demandspark.plans import jobs, reports, sql_reports
from demandspark.sources import bindings as B
from demandspark.sources import keyed, tables
from demandspark.sources.staging import new_folder, stage
from demandspark.streaming import ingest, restock

Query = Callable[[SparkSession, str], DataFrame]
KEYS = schemas.PANEL_KEYS


def stored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as a stored table, for queries that read it more than once: joining and adding
    up the order lines then happens once, and each use reads its own columns only."""
    return stage(B.panel(spark, sf_dir), "panel")


# The driver's part types stand for the categories of the fixed tables; STANDARD has no counterpart.
CATEGORIES = dict(zip(["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"], schemas.RISK_THRESHOLDS, strict=True))


def _by_part_type(values):
    return {part_type: values[category] for part_type, category in CATEGORIES.items()}


# --- profiling and cleaning -------------------------------------------------------------------


def audit_columns(spark, sf_dir):
    return quality.audit_columns(B.dirty(spark, sf_dir))


def numeric_profile(spark, sf_dir):
    columns = ["Units_Sold", "Unit_Price", "Discount", "Promotion", "Holiday", "Inventory_Level"]
    return quality.numeric_profile(B.dirty(spark, sf_dir), columns)


def duplicate_count(spark, sf_dir):
    return quality.duplicate_count(B.dirty(spark, sf_dir))


def distinct_rows(spark, sf_dir):
    return B.dirty(spark, sf_dir).dropDuplicates()


def outliers_iqr(spark, sf_dir):
    return quality.outliers_iqr(B.panel(spark, sf_dir), "Units_Sold")


def clean_table(spark, sf_dir):
    return quality.clean_sales(B.dirty(spark, sf_dir)).clean


def clean_rejects(spark, sf_dir):
    return quality.clean_sales(B.dirty(spark, sf_dir)).rejects


def clean_waterfall(spark, sf_dir):
    return quality.clean_sales(B.dirty(spark, sf_dir)).waterfall


def malformed_lines(spark, sf_dir):
    """Lines of a CSV feed that are too short, too long or hold a word for a number, as the cleaning rejects them."""
    raw = B.dirty(spark, sf_dir)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in raw.columns]
    fields[4] = F.when(F.col("Units_Sold") % 97 == 7, F.lit("many")).otherwise(fields[4])
    line = F.concat_ws(",", *fields)
    line = F.when(F.col("Units_Sold") % 97 == 3, F.concat_ws(",", *fields[:9])).when(F.col("Units_Sold") % 97 == 5, F.concat(line, F.lit(",more"))).otherwise(line)
    folder = new_folder(spark, "csv-feed")
    raw.select(line.alias("value")).write.text(folder)
    rejects = quality.clean_sales(tables.read_sales(spark, folder, keep_bad_lines=True, header=False)).rejects
    return rejects.filter(F.col("reason") == quality.BAD_LINES).select(schemas.RAW_LINE, "reason")


def quality_gate(spark, sf_dir):
    return quality.quality_gate(quality.clean_sales(B.dirty(spark, sf_dir)).clean)


def _with_gaps(spark, sf_dir):
    raw = B.dirty(spark, sf_dir).dropDuplicates()
    return stage(raw.withColumn("Date", C.parse_day(F.col("Date"))), "with-gaps")


def impute_price(spark, sf_dir):
    filled = quality.impute(_with_gaps(spark, sf_dir))
    return filled.select(*KEYS, "Units_Sold", C.half_even(F.col("Unit_Price")).alias("Unit_Price"), "Discount")


def impute_inventory(spark, sf_dir):
    return quality.impute(_with_gaps(spark, sf_dir)).select(*KEYS, "Units_Sold", "Inventory_Level")


# --- features ---------------------------------------------------------------------------------


def revenue(spark, sf_dir):
    return features.add_revenue(B.panel(spark, sf_dir)).select(*KEYS, "Revenue")


def features_calendar(spark, sf_dir):
    table = features.add_calendar(B.panel(spark, sf_dir))
    return table.select(
        *KEYS,
        *schemas.CALENDAR_FEATURES,
        C.year_month(F.col("Date")).alias("Year_Month"),
        C.weekday_name(F.col("Date")).alias("Weekday_Name"),
    )


def features_lags(spark, sf_dir):
    past = features.add_past(stored_panel(spark, sf_dir))
    return past.select(*KEYS, *schemas.HISTORY_FEATURES)


def features_history(spark, sf_dir):
    return features.add_history(stored_panel(spark, sf_dir)).select(*KEYS, *schemas.HISTORY_FEATURES)


def _history_by_batches(spark, sf_dir) -> tuple[str, str]:
    """The panel's days in four batches, one after the other; folders of the features and of the store."""
    daily = stored_panel(spark, sf_dir)
    root, out = new_folder(spark, "history-store"), new_folder(spark, "history")
    history_store.create_store(spark, root, buckets=8)
    first, last = daily.agg(F.min("Date"), F.max("Date")).first()
    step = (last - first) // 4 + timedelta(days=1)
    for i in range(4):
        days = daily.filter(F.col("Date").between(first + i * step, first + (i + 1) * step - timedelta(days=1)))
        history_store.add_days(days, root, out)
    return out, root


def features_in_batches(spark, sf_dir):
    out, root = _history_by_batches(spark, sf_dir)
    return history_store.filled(spark.read.parquet(out), root).select(*KEYS, *schemas.HISTORY_FEATURES)


def series_tails(spark, sf_dir):
    """What serving needs of each series, from the store that the batches have kept up."""
    return history_store.tail_features(spark, _history_by_batches(spark, sf_dir)[1])


def features_full(spark, sf_dir):
    return features.build_features(stored_panel(spark, sf_dir))


def feature_columns(spark, sf_dir):
    return features.feature_columns(features.build_features(stored_panel(spark, sf_dir)))


def serving_features(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    return features.serving_features(
        B.score_requests(spark, sf_dir), daily, B.products(daily), B.stores(spark, sf_dir)
    )


def dense_panel(spark, sf_dir):
    """Per series and month: days on the spine, days with sales, units with gaps as zero."""
    dense = features.dense_panel(stored_panel(spark, sf_dir))
    return dense.groupBy(
        F.col("Store_ID").alias("store_id"),
        F.col("Product_ID").alias("product_id"),
        C.year_month(F.col("Date")).alias("year_month"),
    ).agg(
        F.count("*").alias("days"),
        F.sum("present").cast("long").alias("days_present"),
        F.sum(F.coalesce("Units_Sold", F.lit(0))).alias("units"),
    )


# --- exploration ------------------------------------------------------------------------------


def _on_panel(operator, *args) -> Query:
    return lambda spark, sf_dir: operator(B.panel(spark, sf_dir), *args)


def correlation_long(spark, sf_dir):
    return explore.correlation_long(features.build_features(stored_panel(spark, sf_dir)))


def box_stats(spark, sf_dir):
    table = stored_panel(spark, sf_dir)
    return explore.box_stats(table, "Promotion").unionByName(explore.box_stats(table, "Holiday"))


# --- reports ----------------------------------------------------------------------------------


def r1_monthly_category(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    return reports.monthly_category(B.sales(daily), B.products(daily))


def r2_top3_per_store(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    return reports.top_n_per_store(B.sales(daily), B.products(daily))


def r3_stockout(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    return reports.stockout_report(B.inventory(daily), B.products(daily), B.sales(daily))


def r4_promo_elasticity(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    return reports.promo_elasticity(B.sales(daily), B.products(daily))


def r5_forecast_accuracy(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    return reports.forecast_accuracy(B.forecasts(daily), B.sales(daily))


def _colocated(spark, sf_dir) -> dict[str, DataFrame]:
    daily = stored_panel(spark, sf_dir)
    named = {"products": B.products(daily), "sales": B.sales(daily), "inventory": B.inventory(daily), "forecasts": B.forecasts(daily)}
    return tables.register_colocated(spark, named, new_folder(spark, "colocated"), buckets=8, prefix="colocated_")


def colocated_stockout(spark, sf_dir):
    t = _colocated(spark, sf_dir)
    return reports.stockout_report(t["inventory"], t["products"], t["sales"])


def colocated_forecast_accuracy(spark, sf_dir):
    t = _colocated(spark, sf_dir)
    return reports.forecast_accuracy(t["forecasts"], t["sales"])


def colocated_risk_job(spark, sf_dir):
    t = _colocated(spark, sf_dir)
    newest = lookup.latest_per_key(t["forecasts"], ["product_id", "store_id"], ["forecast_date", "model_name"])
    return inventory.risk_job(newest, t["inventory"], lead=3)


def _sql_report(call: str) -> Query:
    """A report as SQL callers get it: a table function over the registered tables."""

    def query(spark, sf_dir):
        daily = stored_panel(spark, sf_dir)
        named = {"products": B.products(daily), "sales": B.sales(daily), "inventory": B.inventory(daily), "forecasts": B.forecasts(daily)}
        tables.register_catalog(spark, named)
        sql_reports.register(spark)
        return spark.sql(f"SELECT * FROM {call}")

    return query


def forecast_errors(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    return reports.forecast_errors(B.forecasts(daily), B.sales(daily))


# --- lookups and audits -----------------------------------------------------------------------


def sales_page(spark, sf_dir):
    return _plain_sales(lookup.sales_page(B.sales(B.panel(spark, sf_dir)), limit=50, offset=20))


def sales_page_of_store(spark, sf_dir):
    page = lookup.sales_page(B.sales(B.panel(spark, sf_dir)), store="S03", product="P112", limit=50, offset=5)
    return _plain_sales(page)


def sales_page_after(spark, sf_dir):
    """The page after a sale far back, from sales stored by month."""
    root = new_folder(spark, "sales-by-month")
    tables.save_by_month(B.sales(B.panel(spark, sf_dir)), root)
    cursor = (date(1996, 7, 15), "S10", "P120")
    return _plain_sales(lookup.sales_page_after(spark, root, cursor, limit=50))


def inventory_listing(spark, sf_dir):
    return lookup.only(B.inventory(B.panel(spark, sf_dir)))


def inventory_of_store(spark, sf_dir):
    return lookup.only(B.inventory(B.panel(spark, sf_dir)), store="S05")


def inventory_of_product(spark, sf_dir):
    return lookup.only(B.inventory(B.panel(spark, sf_dir)), product="P120")


def product_by_id(spark, sf_dir):
    catalog = lookup.only(B.products(B.panel(spark, sf_dir)), product="P131")
    return catalog.withColumn("unit_price", F.col("unit_price").cast("double"))


def product_listing(spark, sf_dir):
    catalog = lookup.only(B.products(B.panel(spark, sf_dir)))
    return catalog.withColumn("unit_price", F.col("unit_price").cast("double"))


def stock_lookup(spark, sf_dir):
    requests = B.reorder_requests(spark, sf_dir).select("request_id", "product_id", "store_id")
    return lookup.with_defaults(
        requests,
        B.inventory(B.panel(spark, sf_dir)),
        stock_for_risk=schemas.DEFAULT_STOCK_FOR_RISK,
        stock_for_reorder=schemas.DEFAULT_STOCK_FOR_REORDER,
    )


def stock_for_keys(spark, sf_dir):
    wanted = B.reorder_requests(spark, sf_dir).select("request_id", "product_id", "store_id")
    return wanted.join(B.inventory(B.panel(spark, sf_dir)), ["product_id", "store_id"])


def region_lookup(spark, sf_dir):
    requests = B.score_requests(spark, sf_dir).select("request_id", "store_id")
    return lookup.with_region(requests, B.stores(spark, sf_dir))


def region_lookup_known(spark, sf_dir):
    requests = B.score_requests(spark, sf_dir).select("request_id", "store_id")
    return lookup.with_region(requests, lookup.default_regions(spark))


def _risk_history(daily):
    return inventory.risk_job(B.forecasts(daily), B.inventory(daily), keep=["forecast_date"])


def latest_risk(spark, sf_dir):
    risks = _risk_history(stored_panel(spark, sf_dir)).withColumnRenamed("forecast_date", "created_on")
    return lookup.latest_per_key(risks, ["product_id"], ["created_on", "store_id"])


def recent_forecasts(spark, sf_dir):
    return lookup.recent_forecasts(B.forecasts(stored_panel(spark, sf_dir)))


def recent_store_forecasts(spark, sf_dir):
    return lookup.recent_forecasts(B.forecasts(stored_panel(spark, sf_dir)), n=3, store="S07")


def missing_forecasts(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    return lookup.missing_forecasts(_catalog_after_import(spark, sf_dir, daily), B.forecasts(daily)).select("product_id", "product_name")


def forecast_missing(spark, sf_dir):
    """Products that came with an import and have no forecast get one."""
    daily = stored_panel(spark, sf_dir)
    catalog = _catalog_after_import(spark, sf_dir, daily)
    forecasts, regions = B.forecasts(daily), B.stores(spark, sf_dir)
    return jobs.forecast_missing(
        None, catalog, forecasts, daily, regions, schemas.MOVING_AVERAGE, "S03", "2002-01-07"
    )


def existence_rejects(spark, sf_dir):
    requests = B.sale_requests(spark, sf_dir)
    _, rejects = lookup.check_exists(requests, B.products(B.panel(spark, sf_dir)))
    return rejects.select("order_key", "line_number", "date", "store_id", "product_id", "units_sold")


def request_rejects(spark, sf_dir):
    _, rejects = lookup.validate_requests(B.sale_requests(spark, sf_dir), R.SALE_RULES)
    return rejects.withColumn("reasons", F.concat_ws(",", "reasons"))


def sale_intake(spark, sf_dir):
    accepted, _ = lookup.admit_sales(B.sale_requests(spark, sf_dir), B.products(B.panel(spark, sf_dir)))
    return _plain_sales(lookup.price_sales(accepted))


def _plain_sales(sales: DataFrame) -> DataFrame:
    return sales.withColumn("discount", F.col("discount").cast("double")).withColumn(
        "revenue", F.col("revenue").cast("double")
    )


def constraint_audit(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    raw = stage(B.spoil(daily), "raw-feed")
    unclean_sales = raw.select(
        C.parse_day(F.col("Date")).alias("date"),
        F.col("Store_ID").alias("store_id"),
        F.col("Product_ID").alias("product_id"),
        F.col("Units_Sold").alias("units_sold"),
        F.col("Discount").alias("discount"),
        F.col("Promotion").alias("promotion"),
        C.net_revenue(F.col("Units_Sold"), F.col("Unit_Price"), F.col("Discount")).alias("revenue"),
    )
    unclean_stock = raw.select(
        F.col("Product_ID").alias("product_id"),
        F.col("Store_ID").alias("store_id"),
        F.col("Inventory_Level").alias("inventory_level"),
    )
    return lookup.constraint_audit(
        {
            "products": B.products(daily),
            "sales": unclean_sales,
            "inventory": unclean_stock,
            "forecasts": B.forecasts(daily),
            "inventory_risk": _risk_history(daily),
        }
    )


def orphan_audit(spark, sf_dir):
    children = {
        "sale_requests": B.sale_requests(spark, sf_dir),
        "score_requests": B.score_requests(spark, sf_dir),
        "reorder_requests": B.reorder_requests(spark, sf_dir),
    }
    return lookup.orphan_audit(children, B.products(B.panel(spark, sf_dir)))


def table_counts(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    return tables.table_counts(
        {
            "products": B.products(daily),
            "sales": B.sales(daily),
            "inventory": B.inventory(daily),
            "forecasts": B.forecasts(daily),
        }
    )


# --- forecasting ------------------------------------------------------------------------------


def split_dates(spark, sf_dir):
    return forecast.split_summary(B.panel(spark, sf_dir))


def leaderboard_baselines(spark, sf_dir):
    return jobs.baseline_leaderboard(stored_panel(spark, sf_dir))


def _test_rows(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    _, test, _ = forecast.chronological_split(features.add_history(daily), calendar=daily)
    return test


def _test_predictions(spark, sf_dir):
    return forecast.baseline_predictions(_test_rows(spark, sf_dir))


def naive_forecast(spark, sf_dir):
    return forecast.naive_forecast(_test_rows(spark, sf_dir)).select(*KEYS, "yhat")


def moving_average_forecast(spark, sf_dir):
    return forecast.moving_average_forecast(_test_rows(spark, sf_dir)).select(*KEYS, "yhat")


def best_baseline(spark, sf_dir):
    return E.best_model(E.evaluate(_test_predictions(spark, sf_dir)))


def prediction_pivot(spark, sf_dir):
    columns = {schemas.NAIVE: "naive", schemas.MOVING_AVERAGE: "moving_average"}
    return E.wide_predictions(_test_predictions(spark, sf_dir), columns, n=None)


def _train_and_test(daily):
    table = stage(features.build_features(daily), "features")
    start = forecast.split_date(table).first().split_date
    return table.filter(F.col("Date") < start), table.filter(F.col("Date") >= start)


def _learned(kind) -> Query:
    def query(spark, sf_dir):
        train, test = _train_and_test(stored_panel(spark, sf_dir))
        return forecast.model_predictions(forecast.fit_models(train, [kind]), test)

    return query


_TRAINED: dict[tuple[str, str], DataFrame] = {}


def _five_predictions(spark, sf_dir) -> DataFrame:
    """Predictions of all five models at their full settings over the test days. The queries about all five share
    one training per application; the predictions are a stored table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        _, _TRAINED[key], _ = jobs.train_and_rank(stored_panel(spark, sf_dir))
    return _TRAINED[key]


def leaderboard_five(spark, sf_dir):
    return E.against_naive(E.evaluate(_five_predictions(spark, sf_dir)))


def best_of_five(spark, sf_dir):
    return E.best_model(E.evaluate(_five_predictions(spark, sf_dir)))


def prediction_pivot_five(spark, sf_dir):
    """Actual and predicted units of all models side by side, for all test rows."""
    names = ["naive", "moving_average", "linear", "forest", "boosted"]
    columns = dict(zip([schemas.NAIVE, schemas.MOVING_AVERAGE, *forecast.LEARNED], names, strict=True))
    return E.wide_predictions(_five_predictions(spark, sf_dir), columns, n=None)


def linear_on_lag(spark, sf_dir):
    """Slope and intercept of the linear model on one column."""
    table = features.add_history(stored_panel(spark, sf_dir))
    vectors = VectorAssembler(inputCols=["Lag_1"], outputCol="features").transform(table)
    model = forecast.regressor(schemas.LINEAR).fit(vectors.withColumn(schemas.TARGET, F.col(schemas.TARGET).cast("double")))
    rows = [(round(float(model.coefficients[0]), 6), round(float(model.intercept), 4))]
    return spark.createDataFrame(rows, "slope double, intercept double")


def stump_on_promotion(spark, sf_dir):
    """A forest of one tree with one split on a flag predicts the mean of each side."""
    daily = stored_panel(spark, sf_dir)
    vectors = VectorAssembler(inputCols=["Promotion"], outputCol="features").transform(daily)
    vectors = vectors.withColumn(schemas.TARGET, F.col(schemas.TARGET).cast("double"))
    stump = forecast.regressor(schemas.FOREST, numTrees=1, maxDepth=1, bootstrap=False).fit(vectors)
    flags = daily.select("Promotion").distinct()
    scored = stump.transform(VectorAssembler(inputCols=["Promotion"], outputCol="features").transform(flags))
    return scored.select("Promotion", F.bround("raw_prediction", 6).alias("mean_units"))


def boosted_two_rounds(spark, sf_dir):
    """Two regularised trees of one split each over two flags and the month, on all rows of the panel."""
    daily = stored_panel(spark, sf_dir).withColumn("Late", (F.dayofmonth("Date") > 20).cast("int"))
    inputs = ["Promotion", "Holiday", "Late"]
    vectors = VectorAssembler(inputCols=inputs, outputCol="features")
    model = forecast.regressor(
        schemas.BOOSTED, maxIter=2, maxDepth=1, stepSize=0.5, regLambda=100.0, subsamplingRate=1.0, columnRate=1.0
    ).fit(vectors.transform(daily))
    scored = model.transform(vectors.transform(daily.select(*inputs).distinct()))
    return scored.select(*inputs, F.bround("raw_prediction", 6).alias("yhat"))


def encoded_totals(spark, sf_dir):
    """What one-hot encoding and scaling give: a count per store, and mean and deviation per number."""
    table = features.build_features(stored_panel(spark, sf_dir))
    fitted = Pipeline(stages=forecast.preprocessor_stages()).fit(table)
    indexer, scaler = fitted.stages[0], fitted.stages[3]
    hot = vector_to_array(F.col("Store_ID_hot"))
    encoded = fitted.transform(table).select(F.posexplode(hot).alias("i", "one")).groupBy("i").agg(F.sum("one").alias("value"))
    names = F.array(*[F.lit(x) for x in indexer.labelsArray[0]])
    counts = encoded.select(F.concat(F.lit("rows "), F.get(names, F.col("i"))).alias("name"), "value")
    rows = [
        (f"{what} {name}", round(float(x), 4))
        for what, vector in (("mean", scaler.mean), ("deviation", scaler.std))
        for name, x in zip(schemas.NUMERICAL_FEATURES, vector, strict=True)
    ]
    return counts.unionByName(spark.createDataFrame(rows, "name string, value double"))


def batch_scoring(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    models = forecast.fit_models(_train_and_test(daily)[0], [schemas.LINEAR])
    forecasts, _ = forecast.score_requests(
        models[schemas.LINEAR],
        B.score_requests(spark, sf_dir),
        daily,
        B.products(daily),
        B.stores(spark, sf_dir),
        schemas.LINEAR,
    )
    return forecasts


def batch_scoring_baseline(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    forecasts, _ = forecast.score_requests(
        None,
        B.score_requests(spark, sf_dir),
        daily,
        B.products(daily),
        B.stores(spark, sf_dir),
        schemas.MOVING_AVERAGE,
    )
    return forecasts


def scoring_rejects(spark, sf_dir):
    catalog = B.products(B.panel(spark, sf_dir))
    _, rejects = lookup.admit(B.score_requests(spark, sf_dir), R.SCORE_RULES, catalog)
    return rejects.select("request_id", "product_id", F.concat_ws(",", "reasons").alias("reasons"))


# --- stock ------------------------------------------------------------------------------------


def _latest_forecasts(daily):
    return lookup.latest_per_key(
        B.forecasts(daily), ["product_id", "store_id"], ["forecast_date", "model_name"]
    )


def _stock_and_demand(spark, sf_dir):
    panel = B.panel(spark, sf_dir)
    return panel.select(
        "Date",
        F.col("Product_ID").alias("product_id"),
        F.col("Store_ID").alias("store_id"),
        F.col("Inventory_Level").alias("current_inventory"),
        (F.col("Units_Sold") + F.col("Discount") / 4).alias("forecast_demand"),
        F.when(F.col("Promotion") == 1, F.col("Discount") - 9).alias("safety_stock"),
        F.when(F.dayofmonth("Date") > 20, F.dayofmonth("Date") - 22).alias("lead_time_days"),
    )


def safety_stock(spark, sf_dir):
    table = inventory.safety_stock(_stock_and_demand(spark, sf_dir))
    return table.select("Date", "product_id", "store_id", "forecast_demand", "safety_stock")


def inventory_decision(spark, sf_dir):
    decisions, _ = inventory.decide_inventory(_stock_and_demand(spark, sf_dir), keep=["Date"])
    return decisions


def inventory_rejects(spark, sf_dir):
    table = _stock_and_demand(spark, sf_dir).withColumn(
        "current_inventory", F.col("current_inventory") - 40
    )
    _, rejects = inventory.decide_inventory(table, keep=["Date"])
    return rejects.select("Date", "product_id", "store_id", "current_inventory", "forecast_demand", "reason")


def risk_job(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    return inventory.risk_job(_latest_forecasts(daily), B.inventory(daily), lead=3)


def risk_breakdown(spark, sf_dir):
    return inventory.risk_breakdown(_risk_history(stored_panel(spark, sf_dir)))


def category_risk(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    demand = _latest_forecasts(daily).select(
        "product_id", "store_id", (F.col("predicted_demand").cast("double") * 3).alias("forecast_demand")
    )
    table = (
        B.inventory(daily)
        .join(demand, ["product_id", "store_id"])
        .join(B.products(daily).select("product_id", "category"), "product_id")
    )
    return inventory.category_risk(table, _by_part_type(schemas.RISK_THRESHOLDS))


def category_forecast(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    pairs = B.inventory(daily).select("product_id", "store_id")
    catalog = B.products(daily).select("product_id", "category")
    return inventory.category_forecast(catalog, pairs, _by_part_type(schemas.CATEGORY_DEMAND))


# --- changing tables --------------------------------------------------------------------------


def _stock_and_reorders(spark, sf_dir):
    daily = stored_panel(spark, sf_dir)
    accepted, _ = lookup.admit(B.reorder_requests(spark, sf_dir), R.REORDER_RULES, B.products(daily))
    return B.inventory(daily), accepted


def reorder_receipts(spark, sf_dir):
    _, receipts = replenish.apply_reorders(*_stock_and_reorders(spark, sf_dir))
    return receipts


def reorder_ledger(spark, sf_dir):
    """A receipt per request, with the balance before and after it."""
    return replenish.reorder_ledger(*_stock_and_reorders(spark, sf_dir), order="request_id")


def _keyed(df, keys, buckets=8) -> str:
    """``df`` as a table that changes by key; returns its folder."""
    root = new_folder(df.sparkSession, "keyed")
    keyed.create(df, root, keys, buckets)
    return root


def reorder_inventory(spark, sf_dir):
    stock, accepted = _stock_and_reorders(spark, sf_dir)
    root = _keyed(stock, ["product_id", "store_id"])
    keyed.restock(accepted, root, lambda receipts: receipts.write.mode("overwrite").parquet(f"{root}/receipts"))
    return keyed.read(spark, root)


def stamped_stock(spark, sf_dir):
    """The stock after the reorders; only pairs that changed carry the new time."""
    stock, accepted = _stock_and_reorders(spark, sf_dir)
    stock = stock.withColumn("updated_at", F.lit("2001-01-01").cast("timestamp_ntz"))
    stamp = F.lit("2002-02-02").cast("timestamp_ntz")
    after, _ = replenish.apply_reorders(stock, accepted, stamp)
    return after


def inventory_upsert(spark, sf_dir):
    changes = B.reorder_requests(spark, sf_dir).withColumnRenamed("reorder_quantity", "inventory_level")
    root = _keyed(B.inventory(B.panel(spark, sf_dir)), ["product_id", "store_id"])
    keyed.change_by_key(changes.select("request_id", "product_id", "store_id", "inventory_level"), root, order=["request_id"])
    return keyed.read(spark, root)


def _catalog_after_import(spark, sf_dir, daily):
    changes = (
        B.score_requests(spark, sf_dir)
        .filter(F.col("unit_price") > 0)
        .select(
            "request_id",
            "product_id",
            F.concat(F.lit("Imported "), "product_id").alias("product_name"),
            F.lit("IMPORT").alias("category"),
            F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        )
    )
    root = _keyed(B.products(daily), ["product_id"])
    keyed.change_by_key(changes, root, order=["request_id"])
    return keyed.read(spark, root)


def catalog_upsert(spark, sf_dir):
    catalog = _catalog_after_import(spark, sf_dir, B.panel(spark, sf_dir))
    return catalog.withColumn("unit_price", F.col("unit_price").cast("double"))


# --- streams ----------------------------------------------------------------------------------


def stream_sales(spark, sf_dir):
    out = new_folder(spark, "stream-sales")
    catalog = stage(B.products(B.panel(spark, sf_dir)), "catalog")
    requests = B.sale_requests(spark, sf_dir, B.table_stream(spark, sf_dir, "lineitem"))
    ingest.start_sales_stream(requests, catalog, out, f"{out}/checkpoint").awaitTermination()
    return _plain_sales(spark.read.parquet(f"{out}/sales").drop("batch"))


def stream_sales_rejects(spark, sf_dir):
    out = new_folder(spark, "stream-sales")
    catalog = stage(B.products(B.panel(spark, sf_dir)), "catalog")
    requests = B.sale_requests(spark, sf_dir, B.table_stream(spark, sf_dir, "lineitem"))
    ingest.start_sales_stream(requests, catalog, out, f"{out}/checkpoint").awaitTermination()
    rejects = spark.read.parquet(f"{out}/rejects").drop("batch")
    return rejects.withColumn("reasons", F.concat_ws(",", "reasons"))


def stream_sales_once(spark, sf_dir):
    """The sales of a stream whose every file is delivered twice."""
    out = new_folder(spark, "stream-sales-once")
    catalog = stage(B.products(B.panel(spark, sf_dir)), "catalog")
    requests = B.sale_requests(spark, sf_dir).withColumn("requested_at", F.col("date").cast("timestamp"))
    requests = stage(requests.withColumn("request_id", F.monotonically_increasing_id()), "requests")
    for _ in range(2):
        requests.write.mode("append").parquet(f"{out}/in")
    stream = ingest.read_requests(spark, f"{out}/in", requests.schema)
    for query in ingest.start_once_only_stream(stream, catalog, out, f"{out}/checkpoint", ["request_id"], "requested_at", "3700 days"):
        query.awaitTermination()
    return _plain_sales(spark.read.parquet(f"{out}/sales").drop("batch", "requested_at", "request_id"))


def _restocked(spark, sf_dir) -> str:
    """Runs the stream of reorders to its end; returns its folder."""
    out = new_folder(spark, "stream-reorders")
    daily = stored_panel(spark, sf_dir)
    catalog = stage(B.products(daily), "catalog")
    requests = B.reorder_requests(spark, sf_dir, B.table_stream(spark, sf_dir, "orders"))
    for query in restock.start_restocking(requests, catalog, stage(B.inventory(daily), "stock"), out, f"{out}/checkpoint"):
        query.awaitTermination()
    return out


def stream_reorders(spark, sf_dir):
    return restock.current_stock(spark, f"{_restocked(spark, sf_dir)}/checkpoint")


def stream_reorder_receipts(spark, sf_dir):
    return spark.read.parquet(f"{_restocked(spark, sf_dir)}/receipts")


QUERIES: dict[str, Query] = {
    "leaderboard_baselines": leaderboard_baselines,
    "audit_columns": audit_columns,
    "numeric_profile": numeric_profile,
    "duplicate_count": duplicate_count,
    "distinct_rows": distinct_rows,
    "outliers_iqr": outliers_iqr,
    "clean_table": clean_table,
    "clean_rejects": clean_rejects,
    "clean_waterfall": clean_waterfall,
    "malformed_lines": malformed_lines,
    "quality_gate": quality_gate,
    "impute_price": impute_price,
    "impute_inventory": impute_inventory,
    "revenue": revenue,
    "features_calendar": features_calendar,
    "features_lags": features_lags,
    "features_history": features_history,
    "features_in_batches": features_in_batches,
    "series_tails": series_tails,
    "features_full": features_full,
    "feature_columns": feature_columns,
    "serving_features": serving_features,
    "dense_panel": dense_panel,
    "daily_units": _on_panel(explore.daily_units),
    "monthly_units": _on_panel(explore.monthly_units),
    "yearly_units": _on_panel(explore.yearly_units),
    "weekday_means": _on_panel(explore.weekday_means),
    "category_sales": _on_panel(explore.category_sales),
    "store_region_sales": _on_panel(explore.store_region_sales),
    "region_share": _on_panel(explore.region_share),
    "promo_split": _on_panel(explore.flag_split, "Promotion", "No Promotion", "Active Promotion"),
    "holiday_split": _on_panel(explore.flag_split, "Holiday", "Non-Holiday", "Holiday"),
    "lift_pct": _on_panel(explore.flag_lift),
    "box_stats": box_stats,
    "product_sales": _on_panel(explore.product_sales),
    "top_products": _on_panel(explore.top_products),
    "low_products": _on_panel(explore.low_products),
    "correlation_long": correlation_long,
    "r1_monthly_category": r1_monthly_category,
    "r2_top3_per_store": r2_top3_per_store,
    "r3_stockout": r3_stockout,
    "r4_promo_elasticity": r4_promo_elasticity,
    "r5_forecast_accuracy": r5_forecast_accuracy,
    "colocated_stockout": colocated_stockout,
    "colocated_forecast_accuracy": colocated_forecast_accuracy,
    "colocated_risk_job": colocated_risk_job,
    "sql_monthly_category": _sql_report("monthly_category_report()"),
    "sql_top_products": _sql_report("top_products_report(3)"),
    "sql_stockout": _sql_report("stockout_report(7)"),
    "sql_promo_elasticity": _sql_report("promo_elasticity_report()"),
    "sql_forecast_accuracy": _sql_report("forecast_accuracy_report(50)"),
    "forecast_errors": forecast_errors,
    "sales_page": sales_page,
    "sales_page_of_store": sales_page_of_store,
    "sales_page_after": sales_page_after,
    "inventory_listing": inventory_listing,
    "inventory_of_store": inventory_of_store,
    "inventory_of_product": inventory_of_product,
    "product_by_id": product_by_id,
    "product_listing": product_listing,
    "stock_lookup": stock_lookup,
    "stock_for_keys": stock_for_keys,
    "region_lookup": region_lookup,
    "region_lookup_known": region_lookup_known,
    "latest_risk": latest_risk,
    "recent_forecasts": recent_forecasts,
    "recent_store_forecasts": recent_store_forecasts,
    "missing_forecasts": missing_forecasts,
    "forecast_missing": forecast_missing,
    "existence_rejects": existence_rejects,
    "request_rejects": request_rejects,
    "sale_intake": sale_intake,
    "constraint_audit": constraint_audit,
    "orphan_audit": orphan_audit,
    "table_counts": table_counts,
    "split_dates": split_dates,
    "naive_forecast": naive_forecast,
    "moving_average_forecast": moving_average_forecast,
    "best_baseline": best_baseline,
    "prediction_pivot": prediction_pivot,
    "linear_forecast": _learned(schemas.LINEAR),
    "forest_forecast": _learned(schemas.FOREST),
    "boosted_forecast": _learned(schemas.BOOSTED),
    "leaderboard_five": leaderboard_five,
    "best_of_five": best_of_five,
    "prediction_pivot_five": prediction_pivot_five,
    "linear_on_lag": linear_on_lag,
    "stump_on_promotion": stump_on_promotion,
    "boosted_two_rounds": boosted_two_rounds,
    "encoded_totals": encoded_totals,
    "batch_scoring": batch_scoring,
    "batch_scoring_baseline": batch_scoring_baseline,
    "scoring_rejects": scoring_rejects,
    "safety_stock": safety_stock,
    "inventory_decision": inventory_decision,
    "inventory_rejects": inventory_rejects,
    "risk_job": risk_job,
    "risk_breakdown": risk_breakdown,
    "category_risk": category_risk,
    "category_forecast": category_forecast,
    "reorder_receipts": reorder_receipts,
    "reorder_ledger": reorder_ledger,
    "reorder_inventory": reorder_inventory,
    "stamped_stock": stamped_stock,
    "inventory_upsert": inventory_upsert,
    "catalog_upsert": catalog_upsert,
    "stream_sales": stream_sales,
    "stream_sales_rejects": stream_sales_rejects,
    "stream_sales_once": stream_sales_once,
    "stream_reorders": stream_reorders,
    "stream_reorder_receipts": stream_reorder_receipts,
}
