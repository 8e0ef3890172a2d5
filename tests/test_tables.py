from __future__ import annotations

from datetime import date, timedelta

import pytest
import samples
from pyspark.sql import functions as F

from demandspark import schemas
from demandspark.functions import rules as R
from demandspark.operators import explore, lookup, replenish
from demandspark.plans import reports
from demandspark.sources import staging, tables


def test_csv_feed_and_missing_path(spark, tmp_path):
    path = str(tmp_path / "feed")
    tables.write_table(samples.dirty(spark), path, file_format="csv")
    back = tables.read_sales(spark, path)
    assert back.schema == schemas.RAW_SALES and back.count() == 8
    assert back.filter("Unit_Price IS NULL").count() == 1
    with pytest.raises(FileNotFoundError):
        tables.read_sales(spark, str(tmp_path / "nowhere"))


def test_nan_is_a_gap(spark, tmp_path):
    path = str(tmp_path / "feed")
    feed = samples.dirty(spark).withColumn("Unit_Price", F.lit(float("nan")))
    tables.write_table(feed, path)
    assert tables.read_sales(spark, path, "parquet").filter("Unit_Price IS NOT NULL").count() == 0


def test_partitioned_snapshot(spark, tmp_path):
    path = str(tmp_path / "clean")
    tables.save_cleaned(samples.series(spark), path)
    back = spark.read.parquet(path)
    assert back.count() == 40
    assert back.filter("Year = 2025 AND Month = 2").count() == 9


def test_empty_leaderboard_is_an_error(spark, tmp_path):
    empty = spark.createDataFrame([], "model string, mae double")
    with pytest.raises(ValueError):
        tables.save_leaderboard(empty, str(tmp_path / "board"))


def test_catalog_counts_and_versions(spark, tmp_path):
    tables.register_catalog(spark, {"products": samples.products(spark, "P101", "P102")})
    counts = {r.table_name: r.row_count for r in tables.table_counts({t: spark.table(t) for t in schemas.TABLES}).collect()}
    assert counts == {"products": 2, "sales": 0, "inventory": 0, "forecasts": 0, "inventory_risk": 0}
    root = str(tmp_path / "stock")
    for version, rows in enumerate(([1], [1, 2], [7])):
        tables.write_version(spark.createDataFrame([(x,) for x in rows], "x int"), root, version)
    assert [r.x for r in tables.read_version(spark, root).collect()] == [7]
    assert sorted(r.x for r in tables.read_version(spark, root, 1).collect()) == [1, 2]


def _sales(spark, rows):
    return spark.createDataFrame(
        rows, "date date, store_id string, product_id string, units_sold bigint, discount double, promotion int"
    )


def test_sales_page(spark):
    rows = [(date(2025, 1, d), s, "P101", d, 0.0, 0) for d in range(1, 6) for s in ("S01", "S02")]
    sales = _sales(spark, rows)
    page = lookup.sales_page(sales, limit=3, offset=1).collect()
    assert [(r.date.day, r.store_id) for r in page] == [(5, "S02"), (4, "S01"), (4, "S02")]
    assert {r.store_id for r in lookup.sales_page(sales, store="S02").collect()} == {"S02"}
    assert lookup.sales_page(sales, product="P9").count() == 0
    for bad in ({"limit": 0}, {"limit": 501}, {"offset": -1}):
        with pytest.raises(ValueError):
            lookup.sales_page(sales, **bad)


def test_request_rules_and_catalog(spark):
    rows = [
        (date(2026, 10, 1), "S01", "P101", 45, 10.0, 1),
        (date(2026, 10, 1), "S01", "P9999", 10, 0.0, 0),
        (date(2026, 10, 1), "S01", "P101", -25, 0.0, 0),
        (date(2026, 10, 1), "S01", "P101", 5, 120.0, 2),
        (None, "S01", "P101", None, None, None),
    ]
    requests, catalog = _sales(spark, rows), samples.products(spark, "P101")
    accepted, rejects = lookup.admit(requests, R.SALE_RULES, catalog)
    sale = lookup.price_sales(accepted).first()
    assert accepted.count() == 1 and float(sale.revenue) == 4860.0
    assert sorted(tuple(r.reasons) for r in rejects.collect()) == [
        ("date", "units_sold"), ("discount", "promotion"), ("units_sold",), ("unknown product",),
    ]
    good, bad = lookup.validate_requests(requests, R.SALE_RULES)
    assert (good.count(), bad.count()) == (2, 3)
    known, unknown = lookup.check_exists(requests, catalog)
    assert (known.count(), unknown.count()) == (4, 1)


def test_sales_and_forecasts_are_appended(spark, tmp_path):
    sales, forecasts = str(tmp_path / "sales"), str(tmp_path / "forecasts")
    requests = _sales(spark, [(date(2026, 10, 1), "S01", "P101", 45, None, None)])
    accepted, _ = lookup.admit(requests, R.SALE_RULES, samples.products(spark, "P101"))
    predicted = spark.createDataFrame(
        [("P101", "S01", date(2026, 10, 1), 7, "m")],
        "product_id string, store_id string, forecast_date date, predicted_demand long, model_name string",
    )
    for _ in range(2):
        tables.append_sales(lookup.price_sales(accepted), sales)
        tables.append_forecasts(predicted, forecasts)
    stored = spark.read.parquet(sales).collect()
    assert [(float(r.revenue), float(r.discount), r.promotion) for r in stored] == [(5400.0, 0.0, 0)] * 2
    back = spark.read.parquet(forecasts)
    assert back.count() == 2 and back.filter("created_at IS NULL").count() == 0
    assert [f.dataType for f in back.schema] == [f.dataType for f in schemas.FORECASTS]


def test_latest_and_last_n(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, None)], "k string, t int, v string")
    latest = {r.k: r.v for r in lookup.latest_per_key(df, ["k"], ["t"]).collect()}
    assert latest == {"a": "y", "b": None}
    newest = lookup.last_n_per_key(df, ["k"], [F.desc("t")], 2)
    assert sorted((r.k, r.t, r["rank"]) for r in newest.collect()) == [("a", 2, 2), ("a", 3, 1), ("b", 1, 1)]


def test_upsert(spark):
    stock = spark.createDataFrame([("P1", "S01", 5), ("P2", "S01", 6)], "product_id string, store_id string, inventory_level int")
    changes = spark.createDataFrame(
        [("P2", "S01", 7, 1), ("P2", "S01", 8, 2), ("P3", "S01", 9, 1)],
        "product_id string, store_id string, inventory_level int, n int",
    )
    after = replenish.upsert(stock, changes, ["product_id", "store_id"], order=["n"])
    assert sorted((r.product_id, r.inventory_level) for r in after.collect()) == [("P1", 5), ("P2", 8), ("P3", 9)]
    assert after.columns == stock.columns


def test_reorders(spark):
    stock = spark.createDataFrame([("P1", "S01", 5), ("P2", "S01", 6)], "product_id string, store_id string, inventory_level long")
    requests = spark.createDataFrame(
        [("P1", "S01", 75), ("P1", "S01", 5), ("P9", "S02", 3)], "product_id string, store_id string, reorder_quantity long"
    )
    after, receipts = replenish.apply_reorders(stock, requests)
    assert sorted((r.product_id, r.inventory_level) for r in after.collect()) == [("P1", 85), ("P2", 6), ("P9", 3)]
    first = {r.product_id: r for r in receipts.collect()}["P1"]
    assert (first.previous_inventory, first.new_inventory, first.request_count, first.status) == (5, 85, 2, "CONFIRMED")
    assert first.message == "Successfully reordered 80 units. Inventory balance updated from 5 to 85."


def test_constraint_and_orphan_audit(spark):
    stock = spark.createDataFrame(
        [("P1", "S01", 5), ("P1", "S01", -2), (None, "S01", None)], "product_id string, store_id string, inventory_level int"
    )
    found = {r.constraint_name: r.violations for r in lookup.constraint_audit({"inventory": stock}).collect()}
    assert found == {
        "product_id NOT NULL": 1, "store_id NOT NULL": 0, "inventory_level NOT NULL": 1,
        "inventory_level >= 0": 1, "product_id, store_id UNIQUE": 1,
    }
    orphans = lookup.orphan_audit({"inventory": stock}, samples.products(spark, "P7")).first()
    assert (orphans.orphan_rows, orphans.orphan_products) == (2, 1)


def test_forecast_join_fans_out(spark):
    forecasts = spark.createDataFrame(
        [("P1", "S01", date(2025, 1, 1), 10.0, "m")],
        "product_id string, store_id string, forecast_date date, predicted_demand double, model_name string",
    )
    sales = _sales(spark, [(date(2025, 1, 1), "S01", "P1", 8, 0.0, 0), (date(2025, 1, 1), "S01", "P1", 0, 0.0, 0)])
    rows = sorted(reports.forecast_errors(forecasts, sales).collect(), key=lambda r: r.actual_units_sold)
    assert [(r.absolute_error, r.error_percentage) for r in rows] == [(10.0, None), (2.0, 25.0)]


def test_stock_report_covers_eight_dates(spark):
    sales = _sales(spark, [(date(2025, 1, d), "S01", "P1", d, 0.0, 0) for d in (1, 2, 9)])
    velocity = reports.recent_velocity(sales).first().velocity
    assert velocity == 5.5  # the 2nd and the 9th are both in
    stock = spark.createDataFrame([("P1", "S01", 10), ("P2", "S01", 10)], "product_id string, store_id string, inventory_level int")
    rows = reports.stockout_report(stock, samples.products(spark, "P1", "P2"), sales).collect()
    assert [r.product_id for r in rows] == ["P1", "P2"]
    assert rows[0].inventory_health_status == schemas.HEALTH_URGENT and rows[0].estimated_days_of_stock == 1.8
    assert rows[1].estimated_days_of_stock is None and rows[1].inventory_health_status == schemas.HEALTH_OVERSTOCK


def test_absent_weekday_flag_and_single_row(spark):
    one = samples.panel(spark, [("S01", "P101", date(2025, 1, 1), 4)])
    means = {r.weekday: r.mean_units for r in explore.weekday_means(one).collect()}
    assert len(means) == 7 and means["Wednesday"] == 4.0 and means["Sunday"] is None
    assert {r.lift_pct for r in explore.flag_lift(one).collect()} == {None}
    split = explore.flag_split(one, "Promotion", "off", "on").first()
    assert (split.label, split.std_units, split.row_count) == ("off", None, 1)


def test_box_stats(spark):
    rows = [("S01", "P101", date(2025, 1, d), u) for d, u in enumerate([1, 2, 3, 4, 100], 1)]
    box = explore.box_stats(samples.panel(spark, rows), "Promotion").first()
    assert (box.q25, box.q50, box.q75) == (2.0, 3.0, 4.0)
    assert (box.whisker_low, box.whisker_high, box.outliers) == (1.0, 4.0, 1)


def test_pages_by_seeking_equal_pages_by_offset(spark, tmp_path):
    rows = [(date(2024, 11, 1) + timedelta(days=d), f"S0{s}", f"P{p}", d, 0.0, 0) for d in range(0, 200, 3) for s in (1, 2) for p in (101, 102)]
    sales, path = _sales(spark, rows), str(tmp_path / "sales")
    tables.save_by_month(sales, path)
    for store, product in ((None, None), ("S02", None), ("S01", "P102")):
        cursor, offset = None, 0
        while True:
            page = lookup.sales_page_after(spark, path, cursor, store, product, limit=17)
            want = lookup.sales_page(sales, store, product, limit=17, offset=offset).collect()
            got = page.collect()
            assert [tuple(r) for r in got] == [tuple(r) for r in want]
            if not got:
                break
            cursor, offset = (got[-1].date, got[-1].store_id, got[-1].product_id), offset + len(got)
    deep = lookup.sales_page_after(spark, path, (date(2024, 12, 10), "S01", "P101"), limit=5)
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [(" in plan or "PartitionFilters: [" in plan
    scanned = deep._jdf.queryExecution().optimizedPlan().toString()
    assert "24300" in scanned  # December 2024 only: 2024 * 12 + 12
    empty = str(tmp_path / "none")
    tables.save_by_month(sales.limit(0), empty)
    with pytest.raises(ValueError):
        lookup.sales_page_after(spark, path, None, limit=0)


def test_scratch_tables_go_and_others_stay(spark):
    keep = staging.new_folder(spark, "kept")
    with staging.scratch(spark, "work"):
        part = staging.stage(spark.range(5), "part")
        assert part.count() == 5
        part.write.parquet(keep)
        inside = part.inputFiles()[0].rsplit("/", 2)[0]
    assert spark.read.parquet(keep).count() == 5
    assert not any("work-" in name for name in staging.folders(spark, staging.work_folder(spark))) and "work-" in inside
    assert staging.stage(spark.range(2), "part").count() == 2
