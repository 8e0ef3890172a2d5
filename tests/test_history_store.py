from __future__ import annotations

from datetime import date, timedelta

import pytest
import samples
from pyspark.sql import functions as F

from demandspark import schemas
from demandspark.operators import features, history_store
from demandspark.sources import keyed

COLUMNS = ["Lag_1", "Lag_7", "Lag_30", "Rolling_Mean_7", "Rolling_Mean_30"]


def panel(spark):
    """Three series; one starts late, one has days missing, one ends early."""
    rows = []
    for s, (store, product) in enumerate([("S01", "P101"), ("S01", "P102"), ("S02", "P101")]):
        for i in range(90):
            if (s == 1 and i < 50) or (s == 2 and (i % 3 == 0 or i > 70)):
                continue
            rows.append((date(2025, 1, 1) + timedelta(days=i), store, product, "Electronics", (i * 7 + s * 13) % 41, 5.0, 0.0, 0, 0, 10, "North"))
    return spark.createDataFrame(rows, samples.PANEL)


def rows(df, columns):
    return sorted(tuple(r) for r in df.select(*schemas.PANEL_KEYS, *columns).collect())


def batches(days, cuts):
    edges = [date(2025, 1, 1) + timedelta(days=c) for c in (0, *cuts, 100)]
    return [days.filter((F.col("Date") >= a) & (F.col("Date") < b)) for a, b in zip(edges, edges[1:], strict=False)]


@pytest.mark.parametrize("cuts", [(), (45,), (1, 2, 31, 60, 61)])
def test_features_by_batches_equal_those_of_all_days(spark, tmp_path, cuts):
    root, out = str(tmp_path / "store"), str(tmp_path / "out")
    history_store.create_store(spark, root, buckets=4)
    days = panel(spark)
    for batch in batches(days, cuts):
        _, late = history_store.add_days(batch, root, out)
        assert late.count() == 0
    made = spark.read.parquet(out)
    assert rows(made, [*COLUMNS, "series_first"]) == rows(features.add_past(days), [*COLUMNS, "series_first"])
    assert rows(history_store.filled(made, root), COLUMNS) == rows(features.add_history(days), COLUMNS)
    tails = {tuple(r) for r in features.series_tail(days).collect()}
    assert {tuple(r) for r in history_store.tail_features(spark, root).collect()} == tails
    assert {r.rows for r in keyed.read(spark, root).collect()} == {90, 40, 47}


def test_a_batch_reads_no_older_day(spark, tmp_path):
    root, out, stored = (str(tmp_path / n) for n in ("store", "out", "days"))
    history_store.create_store(spark, root, buckets=4)
    old, new = batches(panel(spark), (80,))
    old.write.parquet(f"{stored}/old")
    new.filter("Store_ID = 'S01'").write.parquet(f"{stored}/new")
    history_store.add_days(spark.read.parquet(f"{stored}/old"), root, out)
    before = {r.Store_ID: r.rows for r in keyed.read(spark, root).filter("Store_ID = 'S02'").collect()}
    table, _ = history_store.add_days(spark.read.parquet(f"{stored}/new"), root, out)
    assert table.count() == 20
    assert all("/batch=2/" in f for f in table.inputFiles())
    assert {r.Store_ID: r.rows for r in keyed.read(spark, root).filter("Store_ID = 'S02'").collect()} == before


def test_plan_of_a_batch_scans_the_batch_and_the_store(spark, tmp_path):
    root, out = str(tmp_path / "store"), str(tmp_path / "out")
    history_store.create_store(spark, root, buckets=2)
    old, new = batches(panel(spark), (80,))
    for name, df in (("old", old), ("new", new)):
        df.write.parquet(str(tmp_path / name))
    history_store.add_days(spark.read.parquet(str(tmp_path / "old")), root, out)
    read = []
    plain = history_store._with_past

    def seen(good, *rest):
        read.extend(good.inputFiles())
        return plain(good, *rest)

    history_store._with_past = seen
    try:
        history_store.add_days(spark.read.parquet(str(tmp_path / "new")), root, out)
    finally:
        history_store._with_past = plain
    assert read and not any("/old/" in f or "/out/" in f for f in read)


def test_late_days_and_repeated_batches_are_refused(spark, tmp_path):
    root, out = str(tmp_path / "store"), str(tmp_path / "out")
    history_store.create_store(spark, root)
    first, second = batches(panel(spark), (60,))
    history_store.add_days(second, root, out)
    now = sorted(map(str, keyed.read(spark, root).collect()))
    table, late = history_store.add_days(first, root, out)
    assert table.count() == 0 and late.count() == first.count()
    table, late = history_store.add_days(second, root, out)  # the same batch again
    assert late.count() == second.count()
    assert sorted(map(str, keyed.read(spark, root).collect())) == now
    empty, none = history_store.add_days(first.limit(0), root, out)
    assert empty.count() == 0 and none.count() == 0
