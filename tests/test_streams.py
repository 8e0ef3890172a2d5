from __future__ import annotations

from datetime import date, datetime

import pandas as pd
import samples

from demandspark import schemas
from demandspark.functions import rules as R
from demandspark.operators import lookup, replenish
from demandspark.streaming import ingest, restock


def _rows(df):
    return sorted(str(r.asDict()) for r in df.collect())


def test_sales_stream_equals_batch_over_several_batches(spark, tmp_path):
    folder = str(tmp_path / "in")
    days = range(1, 7)
    rows = [(date(2025, 1, d), "S01", p, u, 5.0, 0) for d in days for p, u in (("P101", d), ("P101", -d), ("P9", d))]
    requests = spark.createDataFrame(rows, schemas.SALE_REQUESTS)
    requests.repartition(3).write.parquet(folder)
    catalog, out = samples.products(spark, "P101"), str(tmp_path / "out")

    def run():
        stream = ingest.read_requests(spark, folder, schemas.SALE_REQUESTS, files_per_batch=1)
        ingest.start_sales_stream(stream, catalog, out, str(tmp_path / "checkpoint")).awaitTermination()

    run()
    accepted, rejects = lookup.admit(requests, R.SALE_RULES, catalog)
    written = spark.read.parquet(f"{out}/sales")
    assert written.select("batch").distinct().count() > 1
    assert _rows(written.drop("batch")) == _rows(lookup.price_sales(accepted))
    assert _rows(spark.read.parquet(f"{out}/rejects").drop("batch")) == _rows(rejects)

    # Going on after a stop records new files only.
    more = spark.createDataFrame([(date(2025, 2, 1), "S01", "P101", 3, None, None)], schemas.SALE_REQUESTS)
    more.coalesce(1).write.mode("append").parquet(folder)
    run()
    assert spark.read.parquet(f"{out}/sales").count() == 7


def test_repeated_requests_are_recorded_once_and_late_ones_told(spark, tmp_path):
    schema = "request_id long, at timestamp, date date, store_id string, product_id string, units_sold long, discount double, promotion int"
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    catalog = samples.products(spark, "P101")

    def deliver(*requests):
        rows = [(i, datetime(2025, 1, day), date(2025, 1, day), "S01", product, 2, None, None) for i, day, product in requests]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = ingest.read_requests(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)
        for query in ingest.start_once_only_stream(stream, catalog, out, f"{out}/checkpoint", ["request_id"], "at", "5 days"):
            query.awaitTermination()

    first = [(1, 2, "P101"), (2, 3, "P101"), (3, 3, "P9"), (2, 3, "P101")]
    deliver(*first)
    deliver(*first)  # the file comes twice
    deliver((4, 20, "P101"))
    deliver((4, 20, "P101"), (5, 18, "P101"), (6, 4, "P101"))  # 6 is older than 5 days before the newest
    deliver((7, 21, "P101"), (1, 2, "P101"))
    assert sorted(r.request_id for r in spark.read.parquet(f"{out}/sales").collect()) == [1, 2, 4, 5, 7]
    assert [r.request_id for r in spark.read.parquet(f"{out}/rejects").collect()] == [3]
    assert [(r.request_id, r.reasons) for r in ingest.late_requests(spark, out, ["request_id"]).collect()] == [(6, ["too late"])]


def test_requests_remembered_lie_in_rocksdb(spark, tmp_path):
    schema = "request_id long, at timestamp, date date, store_id string, product_id string, units_sold long, discount double, promotion int"
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, datetime(2025, 1, 1), date(2025, 1, 1), "S01", "P101", 2, None, None)] * 2, schema).write.parquet(folder)
    stream = ingest.read_requests(spark, folder, spark.createDataFrame([], schema).schema)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    queries = ingest.start_once_only_stream(stream, samples.products(spark, "P101"), out, f"{out}/checkpoint", ["request_id"], "at", "5 days")
    for query in queries:
        query.awaitTermination()
    states = [dict(s.customMetrics) for p in queries[0].recentProgress for s in p.stateOperators]
    assert sum(s.get("rocksdbPutCount", 0) for s in states) == 1
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


STOCK = "product_id string, store_id string, inventory_level long"


def _restock(spark, folder, catalog, stock, out):
    stream = ingest.read_requests(spark, folder, schemas.REORDER_REQUESTS, files_per_batch=1)
    queries = restock.start_restocking(stream, catalog, stock, out, f"{out}/checkpoint")
    for query in queries:
        query.awaitTermination()
    return queries


def test_reorder_stream_keeps_balances_over_batches_and_restarts(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    stock = spark.createDataFrame([("P101", "S01", 5), ("P102", "S01", 6)], STOCK)
    catalog = samples.products(spark, "P101", "P102")
    first = [("P101", "S01", q, None) for q in (1, 2, 3, -4)] + [("P102", "S02", 7, "rush"), ("P9", "S01", 8, None), (None, "S01", 1, None)]
    requests = spark.createDataFrame(first, schemas.REORDER_REQUESTS)
    requests.repartition(2).write.parquet(folder)
    _restock(spark, folder, catalog, stock, out)

    accepted, rejects = lookup.admit(requests, R.REORDER_RULES, catalog)
    after, _ = replenish.apply_reorders(stock, accepted)
    assert _rows(restock.current_stock(spark, f"{out}/checkpoint")) == _rows(after)
    assert _rows(spark.read.parquet(f"{out}/rejects")) == _rows(rejects)

    # a restart goes on from the balances it left: the opening stock given now is not read
    more = spark.createDataFrame([("P102", "S01", 9, None), ("P101", "S01", 1, None)], schemas.REORDER_REQUESTS)
    more.coalesce(1).write.mode("append").parquet(folder)
    queries = _restock(spark, folder, catalog, spark.createDataFrame([("P102", "S01", 1000)], STOCK), out)
    levels = {(r.product_id, r.store_id): r.inventory_level for r in restock.current_stock(spark, f"{out}/checkpoint").collect()}
    assert levels == {("P101", "S01"): 12, ("P102", "S01"): 15, ("P102", "S02"): 7}

    # each batch emits the pairs it names and no other, and a pair's receipts follow each other
    receipts = spark.read.parquet(f"{out}/receipts").collect()
    assert sorted((r.product_id, r.store_id, r.new_inventory) for r in receipts)[-2:] == [("P102", "S01", 15), ("P102", "S02", 7)]
    chain = sorted((r.previous_inventory, r.new_inventory) for r in receipts if r.product_id == "P101")
    assert chain[0][0] == 5 and chain[-1][1] == 12 and all(a[1] == b[0] for a, b in zip(chain, chain[1:], strict=False))
    assert sum(r.request_count for r in receipts) == 6
    assert queries[0].lastProgress["stateOperators"][0]["numRowsTotal"] >= 3

    # earlier balances stay readable
    early = {(r.product_id, r.store_id): r.inventory_level for r in restock.current_stock(spark, f"{out}/checkpoint", 1).collect()}
    assert early[("P102", "S01")] == 6 and early[("P101", "S01")] == 11


def test_requests_of_a_crowded_pair_are_added_up_before_the_shuffle():
    batch = pd.DataFrame({"product_id": ["P1"] * 5000 + ["P2"], "store_id": ["S1"] * 5001, "reorder_quantity": [2] * 5001})
    (part,) = restock._added_up(iter([batch]))
    assert part.to_dict("records") == [
        {"product_id": "P1", "store_id": "S1", "request_count": 5000, "reorder_quantity": 10000},
        {"product_id": "P2", "store_id": "S1", "request_count": 1, "reorder_quantity": 2},
    ]
