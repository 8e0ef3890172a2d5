from __future__ import annotations

import random
from datetime import date, timedelta

import pandas as pd
import pytest
import samples

from demandspark import schemas
from demandspark.operators import features

HISTORY = schemas.HISTORY_FEATURES


def _by_index(df):
    return [[r[c] for c in HISTORY] for r in df.orderBy("Date").collect()]


@pytest.mark.parametrize("slice_days", [1461, 9, 1])
def test_forty_day_series(spark, slice_days):
    rows = _by_index(features.add_history(samples.series(spark), slice_days=slice_days))
    assert rows[0] == [51, 51, 51, 51, 51]
    assert rows[1] == [51, 51, 51, 51, 51]
    assert rows[4] == [54, 51, 51, 52.5, 52.5]
    assert rows[5] == [55, 51, 51, 53, 53]
    assert rows[8] == [58, 52, 51, 55, 54.5]
    assert rows[29] == [59, 53, 51, 56, 54.66]
    assert rows[30] == [50, 54, 51, 55.57, 54.5]
    assert rows[39] == [58, 52, 50, 55, 54.23]


def _expected(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["s", "p", "d"]).reset_index(drop=True)
    units = frame.groupby(["s", "p"])["u"]
    for k in (1, 7, 30):
        frame[f"Lag_{k}"] = units.shift(k)
    for n in (7, 30):
        frame[f"Rolling_Mean_{n}"] = units.transform(lambda x, n=n: x.shift(1).rolling(n, min_periods=1).mean())
    for c in HISTORY:
        frame[c] = frame.groupby(["s", "p"])[c].bfill().fillna(frame["u"].median()).round(2)
    return frame


@pytest.mark.parametrize("slice_days", [1461, 40, 3])
def test_history_equals_pandas_with_gaps_and_short_series(spark, slice_days):
    rng = random.Random(slice_days)
    rows = []
    for s, p, days in [("S01", "P101", 160), ("S01", "P102", 31), ("S02", "P101", 8), ("S02", "P102", 1)]:
        chosen = sorted(rng.sample(range(days * 3), days))
        rows += [(s, p, date(2024, 1, 1) + timedelta(days=d), rng.randrange(200)) for d in chosen]
    got = features.add_history(samples.panel(spark, rows), slice_days=slice_days)
    got = got.orderBy("Store_ID", "Product_ID", "Date").toPandas()
    expected = _expected(pd.DataFrame(rows, columns=["s", "p", "d", "u"]))
    for c in HISTORY:
        assert got[c].to_list() == pytest.approx(expected[c].to_list(), abs=1e-9), c


def test_no_leakage_beyond_the_first_row(spark):
    past = features.add_past(samples.series(spark)).orderBy("Date").collect()
    assert past[0].Lag_1 is None and past[0].Rolling_Mean_7 is None
    assert all(row.Lag_1 == before.Units_Sold for before, row in zip(past, past[1:]))


def test_median_fill(spark):
    filled = features.add_history(samples.series(spark), fill="median", median=7.0).orderBy("Date").collect()
    assert filled[0].Lag_1 == 7.0 and filled[6].Lag_7 == 7.0 and filled[7].Lag_7 == 51
    with pytest.raises(ValueError):
        features.add_history(samples.series(spark), fill="zero")


def test_revenue_and_calendar(spark):
    table = features.build_features(samples.series(spark))
    assert len(table.columns) == 24
    first = table.orderBy("Date").first()
    assert first.Revenue == 5100.0
    assert (first.Day, first.Month, first.Year, first.Week, first.Quarter) == (1, 1, 2025, 1, 1)
    assert (first.Day_of_Week, first.Is_Weekend) == (2, 0)
    assert features.feature_columns(table).columns == [*schemas.FEATURES, "Units_Sold"]
    from pyspark.sql import functions as F

    kept = features.add_revenue(samples.series(spark).withColumn("Revenue", F.lit(1.5)))
    assert {r.Revenue for r in kept.collect()} == {1.5}


def _requests(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.SCORE_REQUESTS)


def _regions(spark):
    return spark.createDataFrame([("S01", "North"), ("S02", "South")], "store_id string, region string")


def test_serving_tail(spark):
    requests = _requests(
        spark,
        ("P101", "S01", date(2025, 2, 10), None, None, None, None, None, None),
        ("P101", "S02", date(2025, 2, 10), 0.0, 5.0, 1, 0, 12.0, None),
        ("P101", "S09", date(2026, 10, 15), 85.0, 15.0, 1, 0, 55.0, 52.0),
        ("P999", "S01", date(2025, 2, 10), None, None, None, None, None, None),
    )
    served = features.serving_features(
        requests, samples.series(spark), samples.products(spark, "P101"), _regions(spark)
    )
    rows = {r.Store_ID: r for r in served.collect()}
    assert set(rows) == {"S01", "S02", "S09"}
    known = rows["S01"]
    assert (known.Lag_1, known.Lag_7, known.Lag_30, known.Rolling_Mean_7) == (59, 53, 51, 56)
    assert known.Rolling_Mean_30 == pytest.approx(54.533333)
    assert (known.Unit_Price, known.Discount, known.Promotion, known.Holiday) == (120.0, 0.0, 0, 0)
    # no history: the constant, even over a supplied lag_1, since rolling_mean_7 is missing
    assert [rows["S02"][c] for c in HISTORY] == [50.0] * 5
    assert rows["S02"].Unit_Price == 120.0 and rows["S02"].Region == "South"
    given = rows["S09"]
    assert [given[c] for c in HISTORY] == [55, 55, 55, 52, 55]
    assert (given.Day, given.Month, given.Year, given.Week, given.Quarter) == (15, 10, 2026, 42, 4)
    assert (given.Day_of_Week, given.Is_Weekend, given.Region) == (3, 0, "North")


def test_serving_few_requests_gives_the_same(spark):
    requests = _requests(
        spark,
        ("P101", "S01", date(2025, 2, 10), None, None, None, None, None, None),
        ("P101", "S05", date(2025, 2, 10), None, None, None, None, None, None),
    )
    given = (requests, samples.series(spark), samples.products(spark, "P101"), _regions(spark))
    all_series = features.serving_features(*given).orderBy("Store_ID").collect()
    assert features.serving_features(*given, few_requests=True).orderBy("Store_ID").collect() == all_series


def test_rows_sharing_a_day_follow_their_units(spark):
    day = date(2025, 1, 1)
    rows = [("S01", "P101", day + timedelta(days=d), u) for d in range(12) for u in (d, 30 - d, d)]
    results = []
    for options in ({}, {"slice_days": 4}, {"slice_days": 1}):
        got = features.add_past(samples.panel(spark, rows), **options)
        results.append(sorted(map(str, got.select("Date", "Units_Sold", *HISTORY).collect())))
    assert all(r == results[0] for r in results)


def test_slices_do_not_change_a_crowded_series(spark):
    rows = [("S01", "P101", date(2025, 1, 1) + timedelta(days=i % 50), i) for i in range(400)]
    rows += [("S01", "P102", date(2025, 1, 1) + timedelta(days=i), i) for i in range(20)]
    results = []
    for slice_days in (1000, 7, 1):
        got = features.add_past(samples.panel(spark, rows), slice_days=slice_days)
        results.append(sorted(map(str, got.select("Product_ID", "Date", "Units_Sold", *HISTORY).collect())))
    assert results[0] == results[1] == results[2]


def test_history_plan_has_no_broadcast(spark, tmp_path):
    rows = [("S01", "P101", date(2025, 1, 1) + timedelta(days=i), i) for i in range(40)]
    samples.panel(spark, rows).write.parquet(str(tmp_path / "panel"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        past = features.add_past(spark.read.parquet(str(tmp_path / "panel")))
        plan = past._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastExchange" not in plan and plan.count("FileScan") == 2


def test_serving_as_of_and_short_series(spark):
    requests = _requests(spark, ("P101", "S01", date(2025, 2, 10), None, None, None, None, None, None))
    served = features.serving_features(
        requests, samples.series(spark), samples.products(spark, "P101"), _regions(spark), as_of="2025-01-04"
    ).first()
    assert [served[c] for c in HISTORY] == [53.0] * 5


def test_dense_panel(spark):
    rows = [
        ("S01", "P101", date(2025, 1, 1), 5),
        ("S01", "P101", date(2025, 1, 4), 6),
        ("S02", "P101", date(2025, 1, 2), 7),
    ]
    df = samples.panel(spark, rows)
    dense = features.dense_panel(df)
    assert dense.count() == 8 and dense.filter("present = 1").count() == 3
    assert features.dense_panel(df, "series").count() == 5
