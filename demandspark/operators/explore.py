"""Aggregates that describe the panel: trends, splits, lifts, shares, boxes, correlation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark import schemas
from demandspark.functions import columns as C
from demandspark.operators.quantiles import grouped_quantiles

MERGE_TASKS = 8  # tasks that merge what the others have added up


def _revenue(df: DataFrame) -> Column:
    """Unrounded revenue summed exactly; an existing Revenue column is taken as it is."""
    if "Revenue" in df.columns:
        return F.sum("Revenue")
    exact = C.net_revenue(F.col("Units_Sold"), F.col("Unit_Price"), F.col("Discount"))
    return F.sum(exact).cast("double")


def daily_units(df: DataFrame) -> DataFrame:
    return df.groupBy("Date").agg(F.sum("Units_Sold").alias("units"))


def monthly_units(df: DataFrame) -> DataFrame:
    return df.groupBy(C.year_month(F.col("Date")).alias("year_month")).agg(F.sum("Units_Sold").alias("units"))


def yearly_units(df: DataFrame) -> DataFrame:
    """Units per year, with the number of days that have sales in the year."""
    # Days first: the distinct days are few, so no row-level distinct is needed.
    by_day = df.groupBy("Date").agg(F.sum("Units_Sold").alias("units"))
    return by_day.groupBy(F.year("Date").alias("year")).agg(
        F.sum("units").alias("units"), F.count("*").alias("days")
    )


def weekday_means(df: DataFrame) -> DataFrame:
    """Mean units per row by weekday, Monday to Sunday; a weekday without rows has null."""
    spark = df.sparkSession
    names = F.array(*[F.lit(day) for day in schemas.WEEKDAYS])
    week = spark.range(7).select(
        F.col("id").cast("int").alias("day_of_week"), F.get(names, F.col("id").cast("int")).alias("weekday")
    )
    means = df.groupBy(F.weekday("Date").alias("day_of_week")).agg(F.avg("Units_Sold").alias("mean_units"))
    return week.join(means, "day_of_week", "left").orderBy("day_of_week")


def category_sales(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.col("Product_Category").alias("category"))
        .agg(F.sum("Units_Sold").alias("units"), _revenue(df).alias("revenue"))
        .orderBy(F.desc("units"), "category")
    )


def store_region_sales(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.col("Store_ID").alias("store_id"), F.col("Region").alias("region"))
        .agg(
            F.sum("Units_Sold").alias("units"),
            F.avg("Units_Sold").alias("mean_units"),
            _revenue(df).alias("revenue"),
        )
        .orderBy(F.desc("units"), "store_id")
    )


def region_share(df: DataFrame) -> DataFrame:
    """Units per region and their share of the total in percent, one decimal."""
    regions = df.groupBy(F.col("Region").alias("region")).agg(F.sum("Units_Sold").alias("units"))
    # One row with all regions, which are few, so that the panel is added up once.
    wide = regions.agg(F.sum("units").alias("total"), F.collect_list(F.struct("region", "units")).alias("rows"))
    share = C.ratio(F.col("units") * F.lit(100.0), F.col("total").cast("double"))
    return wide.select("total", F.inline("rows")).select("region", "units", F.round(share, 1).alias("share_pct"))


def flag_split(df: DataFrame, flag: str, off: str, on: str, digits: int = 6) -> DataFrame:
    """Mean, sample deviation and count of units for both values of a flag."""
    return df.groupBy(C.flag_label(F.col(flag), off, on).alias("label")).agg(
        F.avg("Units_Sold").alias("mean_units"),
        F.bround(F.stddev_samp("Units_Sold"), digits).alias("std_units"),
        F.count("Units_Sold").alias("row_count"),
    )


def flag_lift(df: DataFrame, flags: Sequence[str] = ("Promotion", "Holiday")) -> DataFrame:
    """How far mean units with the flag lie above those without, in percent; null if one of
    the two is absent."""
    wide = df.agg(
        *[
            F.avg(F.when(F.col(flag) == on, F.col("Units_Sold"))).alias(f"{flag}_{on}")
            for flag in flags
            for on in (0, 1)
        ]
    )
    return C.unfold(
        wide,
        [
            F.struct(
                F.lit(flag).alias("flag"),
                F.bround(
                    C.ratio(F.col(f"{flag}_1") - F.col(f"{flag}_0"), F.col(f"{flag}_0")) * 100, 2
                ).alias("lift_pct"),
            )
            for flag in flags
        ],
    )


def box_stats(df: DataFrame, flag: str, column: str = schemas.TARGET, whisker: float = 1.5) -> DataFrame:
    """What a box plot shows per flag value: quartiles, whisker ends, outliers. Each flag value may be a large part of
    the table: quartiles come from ``grouped_quantiles``, the rest from one aggregate."""
    values = df.select(F.col(flag).alias("flag_value"), F.col(column).alias("v"))
    boxes = grouped_quantiles(values, ["flag_value"], "v", [0.25, 0.5, 0.75]).drop("total")
    q25, q75, v = F.col("q")[0], F.col("q")[2], F.col("v")
    reach = whisker * (q75 - q25)
    inside = v.between(q25 - reach, q75 + reach)
    return (
        values.join(boxes, "flag_value")
        .groupBy("flag_value")
        .agg(
            F.first("q").alias("q"),
            F.min(F.when(inside, v)).cast("double").alias("whisker_low"),
            F.max(F.when(inside, v)).cast("double").alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
        .select(
            F.lit(flag).alias("flag"),
            "flag_value",
            F.col("q")[0].alias("q25"),
            F.col("q")[1].alias("q50"),
            F.col("q")[2].alias("q75"),
            "whisker_low",
            "whisker_high",
            "outliers",
        )
    )


def product_sales(df: DataFrame) -> DataFrame:
    return df.groupBy(
        F.col("Product_ID").alias("product_id"), F.col("Product_Category").alias("category")
    ).agg(
        F.sum("Units_Sold").alias("units"),
        (F.sum(F.col("Unit_Price").cast("decimal(12,2)")).cast("double") / F.count("Unit_Price")).alias("mean_price"),
        _revenue(df).alias("revenue"),
    )


def top_products(df: DataFrame, n: int = 5) -> DataFrame:
    return product_sales(df).orderBy(F.desc("units"), "product_id").limit(n)


def low_products(df: DataFrame, n: int = 5) -> DataFrame:
    """The n products with the fewest units, still in descending order."""
    lowest = product_sales(df).orderBy("units", F.desc("product_id")).limit(n)
    return lowest.orderBy(F.desc("units"), "product_id")


def correlation_long(
    df: DataFrame, columns: Sequence[str] = tuple(schemas.CORRELATED), digits: int = 6
) -> DataFrame:
    """Pearson correlation of every pair of columns, one row per pair, in one pass.

    Each task adds up one small matrix of its rows, centred on their own mean; the matrices are merged in a few tasks
    and the driver gets one for each of these. Rows with a missing value in one of the columns are left out; a column
    without spread gives null. Runs when called.
    """
    numbers = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("x")).filter(
        F.forall("x", lambda v: v.isNotNull())
    )
    size = len(columns)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Moments.none(size)
        for batch in batches:
            total = total + _Moments.of(batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size))
        yield total.batch()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Moments.none(size)
        for batch in batches:
            for part in _Moments.read(pa.Table.from_batches([batch]), size):
                total = total + part
        yield total.batch()

    schema = "n long, mean array<double>, products array<double>"
    parts = numbers.mapInArrow(gather, schema).repartition(MERGE_TASKS).mapInArrow(merge, schema).toArrow()
    total = sum(_Moments.read(parts, size), _Moments.none(size))
    spread = np.sqrt(np.diag(total.products))
    with np.errstate(divide="ignore", invalid="ignore"):
        matrix = total.products / np.outer(spread, spread)
    rows = [
        (a, b, float(matrix[i, j]) if spread[i] > 0 and spread[j] > 0 else None)
        for (i, a), (j, b) in combinations(enumerate(columns), 2)
    ]
    table = df.sparkSession.createDataFrame(rows, "left_column string, right_column string, r double")
    return table.select("left_column", "right_column", F.bround("r", digits).alias("correlation"))


@dataclass(frozen=True)
class _Moments:
    """Number, means and centred sums of products of some rows."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def none(cls, size: int) -> _Moments:
        return cls(0, np.zeros(size), np.zeros((size, size)))

    @classmethod
    def of(cls, x: np.ndarray) -> _Moments:
        if not len(x):
            return cls.none(x.shape[1])
        mean = x.mean(axis=0)
        return cls(len(x), mean, (x - mean).T @ (x - mean))

    @classmethod
    def read(cls, table: pa.Table, size: int) -> list[_Moments]:
        lines = zip(*(table.column(c).to_pylist() for c in ("n", "mean", "products")), strict=True)
        return [cls(n, np.array(m), np.array(p).reshape(size, size)) for n, m, p in lines]

    def batch(self) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array([self.n], pa.int64()), pa.array([self.mean.tolist()]), pa.array([self.products.ravel().tolist()])],
            names=["n", "mean", "products"],
        )

    def __add__(self, other: _Moments) -> _Moments:
        n = self.n + other.n
        if not n:
            return self
        step = other.mean - self.mean
        products = self.products + other.products + np.outer(step, step) * (self.n * other.n / n)
        return _Moments(n, self.mean + step * (other.n / n), products)
