from __future__ import annotations

from datetime import date

import pytest
import samples
from pyspark.sql import functions as F

from demandspark import schemas
from demandspark.operators import quality
from demandspark.sources import tables


def test_audit_of_dirty_rows(spark):
    audit = {r.column_name: r for r in quality.audit_columns(samples.dirty(spark)).collect()}
    assert len(audit) == 11
    assert {r.row_count for r in audit.values()} == {8}
    assert {r.duplicate_rows for r in audit.values()} == {1}
    assert {c: r.missing for c, r in audit.items() if r.missing} == {"Discount": 1, "Unit_Price": 1}
    assert audit["Units_Sold"].data_type == "bigint"


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "a")], "a int, b string")
    assert quality.duplicate_count(df).first().duplicate_rows == 2


def test_profile(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "x double")
    row = quality.numeric_profile(df, ["x"]).first()
    assert (row.value_count, row.minimum, row.q50, row.maximum) == (3, 1.0, 2.0, 4.0)
    assert row.mean == 2.333333 and row.std == 1.527525


def test_clean_dirty_rows(spark):
    result = quality.clean_sales(samples.dirty(spark))
    rows = {r.Date: r for r in result.clean.collect()}
    assert sorted(rows) == [date(2025, 1, d) for d in (1, 2, 3, 4)]
    assert rows[date(2025, 1, 3)].Discount == 0.0
    assert rows[date(2025, 1, 4)].Unit_Price == 120.0
    assert {r.reason for r in result.rejects.collect()} == {
        "negative_sales_dropped", "negative_prices_dropped", "invalid_ids_dropped",
    }
    counters = {r.metric: r.value for r in result.waterfall.collect()}
    assert counters["initial_rows"] == 8 and counters["final_rows"] == 4 and counters["rows_removed"] == 4
    assert counters["duplicates_removed"] == 1
    assert counters["missing_Discount"] == 1 and counters["missing_Unit_Price"] == 1
    assert counters["outlier_upper_bound_3iqr"] == 78.75 and counters["extreme_outliers_detected"] == 0
    gate = quality.quality_gate(result.clean).agg(F.sum("violations").alias("n")).first()
    assert gate.n == 0


def test_staging_makes_no_difference(spark):
    raw = samples.dirty(spark)
    one, two = quality.clean_sales(raw, staged=True), quality.clean_sales(raw, staged=False)
    for name in ("clean", "rejects", "waterfall"):
        assert sorted(map(str, getattr(one, name).collect())) == sorted(map(str, getattr(two, name).collect()))


def test_counters_add_up(spark):
    extra = [
        ("2025-1-4", "S01", "P101", "E", 1, 1.0, 0.0, 0, 0, 1.0, "N"),
        ("2025-02-30", "S01", "P101", "E", 1, 1.0, 0.0, 0, 0, 1.0, "N"),
        (None, "S01", "P101", "E", 1, 1.0, 0.0, 0, 0, 1.0, "N"),
        ("2025-01-09", None, "P101", "E", 1, 1.0, 0.0, 0, 0, 1.0, "N"),
        ("2025-01-09", "S1", "P101", "E", 1, 1.0, 0.0, 0, 0, 1.0, "N"),
        ("2025-01-09", "S01", "P101", "E", None, 1.0, 0.0, 0, 0, 1.0, "N"),
        ("2025-01-10", "S01", "P101", "E", 1, 0.0, 0.0, 0, 0, 1.0, "N"),
        ("2025-01-11", "S01", "P101", "E", 1, 1.0, 0.0, None, 0, 1.0, "N"),
        ("2025-01-12", "S01", "P101", "E", 0, 1.0, 0.0, 0, 0, -4.7, "N"),
    ]
    raw = samples.dirty(spark).unionByName(spark.createDataFrame(extra, schemas.RAW_SALES))
    result = quality.clean_sales(raw)
    c = {r.metric: int(r.value) for r in result.waterfall.collect()}
    assert [c[s] for s in quality.STEPS] == [3, 3, 1, 1, 2, 1]
    assert c["initial_rows"] == c["duplicates_removed"] + sum(c[s] for s in quality.STEPS) + c["final_rows"]
    assert result.rejects.count() == sum(c[s] for s in quality.STEPS)
    assert result.clean.count() == c["final_rows"]
    negative = result.clean.filter("Date = '2025-01-12'").first()
    assert negative.Inventory_Level == 0


def test_stock_falls_back_to_global_median(spark):
    rows = [
        ("2025-01-01", "S01", "P101", "E", 1, 1.0, 0.0, 0, 0, 10.0, "N"),
        ("2025-01-02", "S01", "P101", "E", 1, 1.0, 0.0, 0, 0, None, "N"),
        ("2025-01-03", "S01", "P101", "E", 1, 1.0, 0.0, 0, 0, 21.0, "N"),
        ("2025-01-01", "S02", "P101", "E", 1, 1.0, 0.0, 0, 0, None, "N"),
    ]
    clean = quality.clean_sales(spark.createDataFrame(rows, schemas.RAW_SALES)).clean
    stock = {(r.Store_ID, r.Date.day): r.Inventory_Level for r in clean.collect()}
    # series median 15.5; then the median of 10, 15.5, 21 is 15.5; both are cut to 15
    assert stock == {("S01", 1): 10, ("S01", 2): 15, ("S01", 3): 21, ("S02", 1): 15}


def test_malformed_lines_are_rejects(spark, tmp_path):
    good = "2025-01-01,S01,P101,Electronics,50,120.0,0.0,0,0,300.0,North"
    bad = [good.rsplit(",", 1)[0], good + ",more", good.replace(",50,", ",fifty,")]
    (tmp_path / "feed.csv").write_text("\n".join([",".join(schemas.RAW_SALES.names), good, *bad, bad[1], good.replace("01-01", "01-02")]) + "\n")
    raw = tables.read_sales(spark, str(tmp_path / "feed.csv"), keep_bad_lines=True)
    for staged in (True, False):
        result = quality.clean_sales(raw, staged)
        assert result.clean.count() == 2
        rejects = result.rejects.collect()
        assert sorted(r.raw_line for r in rejects) == sorted(bad) and {r.reason for r in rejects} == {quality.BAD_LINES}
        counts = {r.metric: int(r.value) for r in result.waterfall.orderBy("step").collect()}
        assert list(counts)[2] == quality.BAD_LINES
        assert (counts["initial_rows"], counts["duplicates_removed"], counts[quality.BAD_LINES], counts["final_rows"]) == (6, 1, 3, 2)
    plain = tables.read_sales(spark, str(tmp_path / "feed.csv"))
    assert plain.columns == schemas.RAW_SALES.names and plain.count() == 6
    with pytest.raises(ValueError, match="CSV"):
        tables.read_sales(spark, str(tmp_path), "parquet", keep_bad_lines=True)


def test_counters_are_taken_while_the_rows_are_written(spark, tmp_path):
    samples.dirty(spark).write.parquet(str(tmp_path / "feed"))
    raw = spark.read.parquet(str(tmp_path / "feed"))
    result = quality.clean_sales(raw)
    plan = result.waterfall._jdf.queryExecution().optimizedPlan().toString()
    assert "[1,initial_rows,8.0],[2,duplicates_removed,1.0]" in plan  # constants: the rows are not read for them
    assert all("/feed" not in f for df in (result.clean, result.rejects, result.waterfall) for f in df.inputFiles())
    read_again = quality.cleaning_waterfall(result.judged)
    assert sorted(map(tuple, result.waterfall.collect())) == sorted(map(tuple, read_again.collect()))
    empty = quality.clean_sales(samples.dirty(spark).limit(0))
    assert {r.value for r in empty.waterfall.filter("metric like '%rows%'").collect()} == {0.0}
