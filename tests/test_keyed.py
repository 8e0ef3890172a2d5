from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from demandspark.operators import replenish
from demandspark.sources import keyed
from demandspark.sources.staging import files, folders

STOCK = "product_id string, store_id string, inventory_level long"
KEYS = ["product_id", "store_id"]


def stock(spark, n=40):
    return spark.createDataFrame([(f"P{i}", f"S{i % 5}", i) for i in range(n)], STOCK)


def rows(df):
    return sorted(map(tuple, df.select(*STOCK.replace(" string", "").replace(" long", "").split(", ")).collect()))


def bucket_files(spark, root):
    return {
        f"{c}/{b}": sorted(files(spark, f"{root}/{c}/{b}"))
        for c in folders(spark, root)
        if c.startswith("change=")
        for b in folders(spark, f"{root}/{c}")
    }


def test_one_changed_key_rewrites_one_bucket(spark, tmp_path):
    root = str(tmp_path / "stock")
    keyed.create(stock(spark), root, KEYS, 8)
    before = bucket_files(spark, root)
    assert len(before) == 8 and all(sum(f.endswith(".parquet") for f in names) == 1 for names in before.values())
    changes = spark.createDataFrame([("P3", "S3", 300)], STOCK)
    assert keyed.change_by_key(changes, root) == 1
    after = bucket_files(spark, root)
    new = set(after) - set(before)
    assert len(new) == 1 and {k: after[k] for k in before} == before  # old files are untouched
    want = rows(replenish.upsert(stock(spark), changes, KEYS))
    assert rows(keyed.read(spark, root)) == want
    assert rows(keyed.read(spark, root, 0)) == rows(stock(spark))


def test_plan_reads_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path / "stock")
    keyed.create(stock(spark), root, KEYS, 8)
    changes = spark.createDataFrame([("P3", "S3", 300)], STOCK)
    seen = []

    def how(present, new):
        seen.append((len(present.inputFiles()), present.count()))
        return replenish.upsert(present, new, KEYS)

    keyed.change(changes, root, how)
    assert seen[0][0] == 1 and seen[0][1] < 40


def test_many_changes_equal_one_upsert_each(spark, tmp_path):
    root = str(tmp_path / "stock")
    keyed.create(stock(spark, 6), root, KEYS, 4)
    plain = stock(spark, 6)
    for i in range(4):
        changes = spark.createDataFrame([(f"P{i}", f"S{i}", 1000 + i), (f"N{i}", "S9", i), (f"P{i + 1}", f"S{i + 1}", -i)], STOCK)
        keyed.change_by_key(changes, root)
        plain = replenish.upsert(plain, changes, KEYS)
    assert rows(keyed.read(spark, root)) == rows(plain)
    assert keyed.change_by_key(spark.createDataFrame([], STOCK), root) == 4  # nothing to do
    keyed.drop_old(spark, root, keep=1)
    assert rows(keyed.read(spark, root)) == rows(plain)
    assert files(spark, f"{root}/pointers") == ["000000000004.json"]
    used = {c for c in folders(spark, root) if c.startswith("change=")}
    assert all(not c.startswith(("change=0-", "change=1-")) or any(f.startswith(c) for f in bucket_files(spark, root)) for c in used)


def test_reader_sees_old_or_new_and_a_failed_change_nothing(spark, tmp_path):
    root = str(tmp_path / "stock")
    keyed.create(stock(spark), root, KEYS, 4)
    changes = spark.createDataFrame([("P1", "S1", 7)], STOCK)
    started, go, result = threading.Event(), threading.Event(), []

    def slow(present, new):
        started.set()
        go.wait(30)
        return replenish.upsert(present, new, KEYS)

    worker = threading.Thread(target=lambda: result.append(keyed.change(changes, root, slow)))
    worker.start()
    assert started.wait(60)
    assert rows(keyed.read(spark, root)) == rows(stock(spark))
    go.set()
    worker.join()
    assert result == [1] and ("P1", "S1", 7) in rows(keyed.read(spark, root))

    def broken(present, new):
        return present.withColumn("inventory_level", F.raise_error(F.lit("stop")).cast("long"))

    now = rows(keyed.read(spark, root))
    with pytest.raises(Exception, match="stop"):
        keyed.change(changes, root, broken)
    assert rows(keyed.read(spark, root)) == now


def test_second_of_two_changes_made_at_once_is_refused(spark, tmp_path):
    root = str(tmp_path / "stock")
    keyed.create(stock(spark), root, KEYS, 4)
    mine, other = (spark.createDataFrame([("P1", "S1", x)], STOCK) for x in (1, 2))

    def how(present, new):
        if new is mine:
            keyed.change_by_key(other, root)
        return replenish.upsert(present, new, KEYS)

    with pytest.raises(keyed.ConcurrentChange):
        keyed.change(mine, root, how)
    assert ("P1", "S1", 2) in rows(keyed.read(spark, root))
    keyed.change_by_key(mine, root)  # made again it succeeds
    assert ("P1", "S1", 1) in rows(keyed.read(spark, root))
    with pytest.raises(ValueError, match="other keys"):
        keyed.change(mine, root, lambda present, new: stock(spark))


def test_restock_changes_touched_pairs_and_tells_receipts(spark, tmp_path):
    root, out = str(tmp_path / "stock"), str(tmp_path / "receipts")
    keyed.create(stock(spark), root, KEYS, 8)
    requests = spark.createDataFrame([("P1", "S1", 5), ("P1", "S1", 6), ("NEW", "S0", 2)], "product_id string, store_id string, reorder_quantity long")
    keyed.restock(requests, root, lambda receipts: receipts.write.mode("overwrite").parquet(out))
    after, receipts = replenish.apply_reorders(stock(spark), requests)
    assert rows(keyed.read(spark, root)) == rows(after)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, receipts.collect()))
