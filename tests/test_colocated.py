from __future__ import annotations

import pytest

from demandspark.operators import inventory, lookup
from demandspark.plans import reports
from demandspark.registry.queries import stored_panel
from demandspark.sources import bindings as B
from demandspark.sources import tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    daily = stored_panel(spark, SF_DIR)
    named = {"products": B.products(daily), "sales": B.sales(daily), "inventory": B.inventory(daily), "forecasts": B.forecasts(daily)}
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForCoPartition")}
    found = tables.register_colocated(spark, named, str(tmp_path_factory.mktemp("colocated")), 4, "test_")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as if all tables were large
    yield found, named
    for name in found:
        spark.sql(f"DROP TABLE test_{name}")
    for k, v in before.items():
        spark.conf.set(k, v)


def shuffles(df):
    return [line.strip() for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


def rows(df):
    return sorted(map(str, df.collect()))


def newest(forecasts):
    return lookup.latest_per_key(forecasts, ["product_id", "store_id"], ["forecast_date", "model_name"])


def test_joins_by_product_and_store_move_no_row(spark, stored):
    t, plain = stored
    assert shuffles(inventory.risk_job(newest(t["forecasts"]), t["inventory"])) == []
    assert shuffles(reports.forecast_errors(t["forecasts"], t["sales"])) == []
    velocity = t["inventory"].join(reports.recent_velocity(t["sales"]), ["store_id", "product_id"], "left")
    assert shuffles(velocity) == []
    # the catalog is the one table that has no store; it meets the stock by product
    whole = shuffles(reports.stockout_report(t["inventory"], t["products"], t["sales"]))
    assert all("sales" not in line for line in whole) and len(whole) <= 2
    assert len(shuffles(inventory.risk_job(newest(plain["forecasts"]), plain["inventory"]))) > 0


def test_rows_are_those_of_plain_tables(stored):
    t, plain = stored
    for x in (t, plain):
        x["risk"] = inventory.risk_job(newest(x["forecasts"]), x["inventory"])
        x["errors"] = reports.forecast_errors(x["forecasts"], x["sales"])
        x["stockout"] = reports.stockout_report(x["inventory"], x["products"], x["sales"])
    for name in ("risk", "errors", "stockout"):
        assert rows(t.pop(name)) == rows(plain.pop(name))


def test_a_bucket_is_one_file(spark, stored):
    t, _ = stored
    assert len(t["sales"].inputFiles()) == 4 and spark.table("test_sales").count() == t["sales"].count()
