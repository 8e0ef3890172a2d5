"""Sums over all earlier rows of a key, without a task that holds a key."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.sources.staging import stage

ROWS_PER_RANGE = 500_000


def running_sum(df: DataFrame, keys: list[str], order: list[Column], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same keys that come before in ``order``.

    The rows are dealt into ranges of (keys, order), so a hot key spans many ranges. Each range adds up
    its rows, a running sum over the ranges of a key gives where each range starts, and a window inside
    the range does the rest. A range holds about ``ROWS_PER_RANGE`` rows whatever the keys are; only rows
    that agree in keys and order stay together. Keys must not be null; column names with a leading
    underscore are the function's own. The dealt rows are staged, which fixes the ranges.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(df.count() / ROWS_PER_RANGE))
    dealt = stage(df.repartitionByRange(n, *keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sums = dealt.groupBy(*keys, "_range").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = local.join(starts, [*keys, "_range"])
    return joined.withColumn(out, F.col("_start") + F.col("_local")).drop("_range", "_start", "_local")
