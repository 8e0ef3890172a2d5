"""History features kept up day by day: a stored tail per series is all that a batch of new days needs of the past.

The store is a table that changes by key (``sources/keyed``), one row per store and product: the series' last units,
newest last, its first units and its length. A batch of new days reads and rewrites the buckets of the series it
names; no older day is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark import schemas
from demandspark.operators.features import LAGS, WINDOWS, fill_gaps
from demandspark.operators.quantiles import exact_median
from demandspark.sources import keyed
from demandspark.sources.staging import stage
from demandspark.sources.tables import write_table

KEYS = schemas.SERIES_KEYS
_SCHEMA = "Store_ID string, Product_ID string, tail array<bigint>, first_units bigint, rows bigint, last_day date"


def create_store(spark: SparkSession, root: str, buckets: int = 64) -> None:
    """An empty store."""
    keyed.create(spark.createDataFrame([], _SCHEMA), root, KEYS, buckets)


def _tails(days: DataFrame, reach: int) -> DataFrame:
    """Per series what a batch adds: its last ``reach`` units in order of day, first units, rows, last day.

    Each task keeps its newest rows of a series and shuffles those; the rest are sums.
    """
    units = F.col(schemas.TARGET).cast("long")
    newest = W.partitionBy(*KEYS).orderBy(F.desc("Date"), F.desc("u"))
    kept = days.select(*KEYS, "Date", units.alias("u")).withColumn("place", F.row_number().over(newest)).filter(F.col("place") <= reach)
    tails = kept.groupBy(*KEYS).agg(F.transform(F.sort_array(F.collect_list(F.struct("Date", "u"))), lambda x: x["u"]).alias("new_tail"))
    sums = days.groupBy(*KEYS).agg(
        F.min(F.struct("Date", units.alias("u")))["u"].alias("new_first"),
        F.count(F.lit(1)).alias("new_rows"),
        F.min("Date").alias("from_day"),
        F.max("Date").alias("new_day"),
    )
    return tails.join(sums, KEYS)


def _merged(present: DataFrame, new: DataFrame, reach: int) -> DataFrame:
    """The store's rows after a batch."""
    both = present.join(new, KEYS, "full_outer")
    nothing = F.array().cast("array<bigint>")
    tail = F.concat(F.coalesce("tail", nothing), F.coalesce("new_tail", nothing))
    return both.select(
        *KEYS,
        F.slice(tail, F.greatest(F.lit(1), F.size(tail) - reach + 1), reach).alias("tail"),
        F.coalesce("first_units", "new_first").alias("first_units"),
        (F.coalesce("rows", F.lit(0)) + F.coalesce("new_rows", F.lit(0))).alias("rows"),
        F.greatest("last_day", "new_day").alias("last_day"),
    )


def add_days(
    days: DataFrame, root: str, out: str, lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS
) -> tuple[DataFrame, DataFrame]:
    """Features of a batch of new days, and the days that come too late. Updates the store.

    The features are written to ``<out>/batch=<n>``, n being the number of the store's next change, before the store
    changes: a batch that fails before that overwrites its folder when it is made again.

    Returns ``days`` with ``Lag_k``, ``Rolling_Mean_n``, ``series_first`` and ``series_rows`` as ``add_past`` gives
    them (``series_rows`` counts the rows so far), and the rows of series whose store is already at or beyond the
    batch's first day of that series: a history cannot change behind its end, so such a series' rows are all
    refused. A day of a series must be in one batch only.
    """
    reach = max([*lags, *windows])
    new = stage(_tails(days, reach), "tails")
    spark = days.sparkSession
    ends = keyed.read_touched(spark, root, new).select(*KEYS, "tail", "first_units", "rows", "last_day")
    known = stage(new.select(*KEYS, "from_day").join(ends, KEYS, "left"), "known-tails")
    late = known.filter(F.col("last_day") >= F.col("from_day")).select(*KEYS)
    good = days.join(known.drop("from_day").filter(F.col("last_day").isNull() | (F.col("from_day") > F.col("last_day"))), KEYS)
    folder = f"{out}/batch={keyed.last_change(spark, root) + 1}"
    write_table(_with_past(good, days.columns, lags, windows, reach), folder)
    table = spark.read.parquet(folder)
    rejects = days.join(late, KEYS, "left_semi")
    accepted = new.join(late, KEYS, "left_anti")
    keyed.change(accepted, root, lambda present, changes: _merged(present, changes, reach))
    return table, rejects


def _with_past(rows: DataFrame, columns: list[str], lags: Sequence[int], windows: Sequence[int], reach: int) -> DataFrame:
    """Rows of a batch with what comes before them, in the batch or in the tail of their series.

    A batch is a few days, so a series' rows of one batch are one window group.
    """
    value = schemas.TARGET
    in_order = W.partitionBy(*KEYS).orderBy("Date", value)
    nothing = F.array().cast("array<bigint>")
    before = F.collect_list(F.col(value).cast("long")).over(in_order.rowsBetween(-reach, -1))
    held = F.coalesce("tail", nothing)
    past = F.concat(held, before)
    wide = rows.withColumns(
        {
            "past": F.slice(past, F.greatest(F.lit(1), F.size(past) - reach + 1), reach),
            "series_first": F.coalesce("first_units", F.first(value).over(in_order.rowsBetween(W.unboundedPreceding, 0)).cast("long")),
            "series_rows": F.coalesce("rows", F.lit(0)) + F.row_number().over(in_order),
        }
    )
    size = F.size("past")

    def lag(k: int) -> Column:
        return F.when(size >= k, F.get("past", size - k)).cast("double")

    def mean(n: int) -> Column:
        last = F.slice("past", F.greatest(F.lit(1), size - n + 1), n)
        return F.when(size > 0, F.aggregate(last, F.lit(0).cast("bigint"), lambda a, x: a + x) / F.least(size, F.lit(n)))

    return wide.select(
        *columns,
        *[lag(k).alias(f"Lag_{k}") for k in lags],
        *[mean(n).alias(f"Rolling_Mean_{n}") for n in windows],
        "series_first",
        "series_rows",
    )


def filled(
    table: DataFrame, root: str, median: float | None = None, lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """Features that ``add_days`` has written, of any batches, without gaps as ``add_history`` fills them: a series
    that has grown since then fills the gaps of its first days. ``median`` defaults to that of ``table``."""
    lengths = keyed.read(table.sparkSession, root).select(*KEYS, F.col("rows").alias("series_rows"))
    middle = exact_median(table, schemas.TARGET).scalar() if median is None else F.lit(float(median))
    return fill_gaps(table.drop("series_rows").join(lengths, KEYS), middle, lags, windows).drop("batch")


def tail_features(spark: SparkSession, root: str) -> DataFrame:
    """``series_tail`` of all days so far, from the store alone: what serving needs of the history."""
    store = keyed.read(spark, root)
    units, n = F.col("tail"), F.size("tail")
    newest = F.get(units, n - 1).cast("double")

    def at(k: int) -> Column:
        return F.when(n >= k, F.get(units, n - k).cast("double")).otherwise(newest)

    def mean(k: int) -> Column:
        total = F.aggregate(F.slice(units, F.greatest(F.lit(1), n - k + 1), k), F.lit(0).cast("bigint"), lambda a, x: a + x)
        return F.when(n >= k, total / F.lit(float(k))).otherwise(newest)

    return store.select(
        *KEYS,
        newest.alias("tail_1"),
        at(7).alias("tail_7"),
        at(30).alias("tail_30"),
        mean(7).alias("tail_mean_7"),
        mean(30).alias("tail_mean_30"),
    )
