"""Revenue, calendar and history features, serving features and the dense panel.

History columns look at rows, not days: Lag_7 is the seventh row before this one. The panel
should hold one row per (Store_ID, Product_ID, Date), without null Units_Sold. Rows that share
a day are taken in the order of their units, so the result does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark import schemas
from demandspark.functions import columns as C
from demandspark.operators.quantiles import exact_median

SLICE_DAYS = 1461
LAGS = (1, 7, 30)
WINDOWS = (7, 30)


def add_revenue(df: DataFrame, round_to: int | None = 2) -> DataFrame:
    """Net revenue; a Revenue column that is already there is kept as it is."""
    if "Revenue" in df.columns:
        return df
    exact = C.net_revenue(F.col("Units_Sold"), F.col("Unit_Price"), F.col("Discount"))
    value = exact if round_to is None else F.bround(exact, round_to)
    return df.withColumn("Revenue", value.cast("double"))


def add_calendar(df: DataFrame, day: str = "Date") -> DataFrame:
    return df.withColumns(C.calendar(F.col(day)))


def add_past(
    df: DataFrame,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    value: str = schemas.TARGET,
    slice_days: int = SLICE_DAYS,
) -> DataFrame:
    """Lag_k and Rolling_Mean_n over earlier rows only; null where there is no past.

    Adds ``series_first`` (first value of the series, known on the rows that need it) and
    ``series_rows`` (its length, exact up to one more than the longest reach).

    A series is cut into slices of ``slice_days`` days, so a long one is shared by many tasks and
    no window group grows with the series. A panel has one row per series and day; rows that
    share a day stay together. Each slice gets the last rows before it from a table
    with a few rows per slice; Spark limits those rows before the shuffle (WindowGroupLimit),
    and the join reuses the partitioning and order the window has made. Besides the wide table
    only keys, days and values are read again; pass a stored table.
    """
    reach = max([*lags, *windows])
    keys = schemas.SERIES_KEYS
    slice_keys = keys + ["slice"]
    sliced = df.withColumn("slice", F.floor(F.unix_date("Date") / slice_days))

    newest_first = W.partitionBy(*slice_keys).orderBy(F.desc("Date"), F.desc("v"))
    tails = (
        sliced.select(*slice_keys, "Date", F.col(value).alias("v"))
        .withColumn("rank", F.row_number().over(newest_first))
        .filter(F.col("rank") <= reach + 1)
        .groupBy(*slice_keys)
        .agg(F.sort_array(F.collect_list(F.struct("Date", "v"))).alias("rows"))
        .select(*slice_keys, F.col("rows.v").alias("tail"))
    )
    by_slice = W.partitionBy(*keys).orderBy("slice")
    all_slices = by_slice.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    earlier = F.flatten(F.collect_list("tail").over(by_slice.rowsBetween(-reach, -1)))
    carried = (
        tails.select(
            *slice_keys,
            F.sum(F.size("tail")).over(all_slices).alias("series_rows"),
            earlier.alias("earlier"),
        )
        .withColumn(
            "earlier",
            F.slice("earlier", F.greatest(F.lit(1), F.size("earlier") - reach + 1), reach),
        )
        # sums of the last 0, 1, 2, ... earlier values
        .withColumn(
            "earlier_sums",
            F.aggregate(
                F.reverse("earlier"),
                F.array(F.lit(0).cast(df.schema[value].dataType)),
                lambda sums, v: F.concat(sums, F.array(F.element_at(sums, -1) + v)),
            ),
        )
    )

    in_slice = W.partitionBy(*slice_keys).orderBy("Date", value)
    row = F.row_number().over(in_slice)
    local = sliced.withColumns(
        {
            "row": row,
            "slice_first": F.first(value).over(in_slice.rowsBetween(W.unboundedPreceding, 0)),
            **{f"Lag_{k}": F.lag(value, k).over(in_slice) for k in lags},
            **{f"sum_{n}": F.sum(value).over(in_slice.rowsBetween(-n, -1)) for n in windows},
        }
    )

    held = F.coalesce(F.size("earlier"), F.lit(0))
    columns: dict[str, Column] = {}
    for k in lags:
        position = F.when(F.col("row") + F.col("held") > k, F.col("held") + F.col("row") - k)
        columns[f"Lag_{k}"] = (
            F.when(F.col("row") > k, F.col(f"Lag_{k}"))
            .otherwise(F.get("earlier", position - 1))
            .cast("double")
        )
    for n in windows:
        local_rows = F.least(F.col("row") - 1, F.lit(n))
        taken = F.least(F.lit(n) - local_rows, F.col("held"))
        total = F.coalesce(F.col(f"sum_{n}"), F.lit(0)) + F.when(
            taken > 0, F.get("earlier_sums", taken)
        ).otherwise(0)
        columns[f"Rolling_Mean_{n}"] = F.when(local_rows + taken > 0, total / (local_rows + taken))
    columns["series_first"] = F.when(F.col("held") == 0, F.col("slice_first")).otherwise(
        F.get("earlier", F.lit(0))
    )
    return (
        local.join(carried, slice_keys, "left")
        .withColumn("held", held)
        .withColumns(columns)
        .select(*df.columns, *columns, "series_rows")
    )


def add_history(
    df: DataFrame,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    fill: str = "bfill",
    median: float | None = None,
    slice_days: int = SLICE_DAYS,
) -> DataFrame:
    """Lags and rolling means without gaps.

    ``fill="bfill"`` takes the next known value of the series. Since every value is known from
    row k on, that is always the first Units_Sold of the series, if it has more than k rows.
    What stays empty gets the median of all Units_Sold (or ``median``, such as one of the
    training days only); ``fill="median"`` uses only that.
    """
    if fill not in ("bfill", "median"):
        raise ValueError(f"unknown fill: {fill}")
    past = add_past(df, lags, windows, slice_days=slice_days)
    if median is None:
        middle = exact_median(df, schemas.TARGET).scalar()
    else:
        middle = F.lit(float(median))
    return fill_gaps(past, middle, lags, windows, fill)


def fill_gaps(
    past: DataFrame, middle: Column, lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS, fill: str = "bfill"
) -> DataFrame:
    """The columns of ``add_past`` without gaps, see ``add_history``; ``middle`` is the median of all units."""
    past = past.withColumn("middle", middle)
    filled = {}
    for name, first_row in [(f"Lag_{k}", k) for k in lags] + [(f"Rolling_Mean_{n}", 1) for n in windows]:
        value = F.col(name)
        if fill == "bfill":
            known = F.col("series_rows") > first_row
            value = F.coalesce(value, F.when(known, F.col("series_first").cast("double")))
        filled[name] = F.bround(F.coalesce(value, F.col("middle")), 2)
    return past.withColumns(filled).drop("series_first", "series_rows", "middle")


def build_features(df: DataFrame, **history_options) -> DataFrame:
    """The whole feature table: panel, revenue, calendar and history."""
    return add_history(add_calendar(add_revenue(df)), **history_options)


def feature_columns(df: DataFrame) -> DataFrame:
    """The model's inputs in their fixed order, then the target."""
    return df.select(*schemas.FEATURES, schemas.TARGET)


def series_tail(history: DataFrame, as_of: str | None = None) -> DataFrame:
    """Per series: the newest value, the 7th and 30th newest, and the means of the newest 7 and
    30. A series too short for one of them repeats its newest value.

    Each task keeps its newest 30 rows per series and shuffles only those.
    """
    if as_of is not None:
        history = history.filter(F.col("Date") < F.lit(as_of).cast("date"))
    newest_first = W.partitionBy(*schemas.SERIES_KEYS).orderBy(F.desc("Date"), F.desc(schemas.TARGET))
    units, rank = F.col(schemas.TARGET).cast("double"), F.col("rank")
    newest = F.max(F.when(rank == 1, units))
    rows = F.count("*")

    def at(k: int) -> Column:
        return F.when(rows >= k, F.max(F.when(rank == k, units))).otherwise(newest)

    def mean(n: int) -> Column:
        return F.when(rows >= n, F.avg(F.when(rank <= n, units))).otherwise(newest)

    return (
        history.select(*schemas.PANEL_KEYS, schemas.TARGET)
        .withColumn("rank", F.row_number().over(newest_first))
        .filter(rank <= 30)
        .groupBy(*schemas.SERIES_KEYS)
        .agg(
            newest.alias("tail_1"),
            at(7).alias("tail_7"),
            at(30).alias("tail_30"),
            mean(7).alias("tail_mean_7"),
            mean(30).alias("tail_mean_30"),
        )
    )


def serving_features(
    requests: DataFrame,
    history: DataFrame,
    catalog: DataFrame | None,
    regions: DataFrame,
    as_of: str | None = None,
    few_requests: bool = False,
) -> DataFrame:
    """One feature row per request whose product is in the catalog. Requests that ``admit`` has
    joined with the catalog come with ``catalog=None``.

    If a request lacks lag_1 or rolling_mean_7, all its history inputs come from the series'
    tail, and from a constant for a series without history. Otherwise inputs it lacks repeat
    its lag_1.

    ``few_requests`` looks up only the series that are asked for. That pays while their keys
    are small enough to be broadcast; without it the tails of all series are found.
    """
    optional = ["lag_7", "lag_30", "rolling_mean_30"]
    for name in optional:
        if name not in requests.columns:
            requests = requests.withColumn(name, F.lit(None).cast("double"))
    replaced = {
        "product_id", "store_id", "unit_price", "discount", "promotion", "holiday",
        "lag_1", "rolling_mean_7", *optional,
    }
    if catalog is None:
        requests = requests.withColumnsRenamed({"catalog_category": "category", "catalog_unit_price": "catalog_price"})
    else:
        found = catalog.select("product_id", "category", F.col("unit_price").alias("catalog_price"))
        requests = requests.join(found, "product_id")
    from_catalog = {"category", "catalog_price"}
    kept = [
        name for name in requests.columns
        if name not in replaced | from_catalog and not name.startswith("catalog_")
    ]
    r = requests.alias("r")
    if few_requests:
        asked = requests.select(
            F.col("store_id").alias("Store_ID"), F.col("product_id").alias("Product_ID")
        ).distinct()
        history = history.join(asked, schemas.SERIES_KEYS, "left_semi")
    tail = series_tail(history, as_of).withColumnsRenamed(
        {"Store_ID": "tail_store", "Product_ID": "tail_product"}
    )
    joined = (
        r.join(regions.select(F.col("store_id").alias("region_store"), "region"),
              F.col("r.store_id") == F.col("region_store"), "left")
        .join(tail, (F.col("r.store_id") == F.col("tail_store"))
              & (F.col("r.product_id") == F.col("tail_product")), "left")
    )
    from_tail = F.col("r.lag_1").isNull() | F.col("r.rolling_mean_7").isNull()

    def pick(own: str, tail_column: str) -> Column:
        return (
            F.when(from_tail, F.coalesce(tail_column, F.lit(schemas.DEFAULT_LAG)))
            .otherwise(F.coalesce(F.col(f"r.{own}"), F.col("r.lag_1")))
        )

    price = C.effective_price(F.col("r.unit_price"), F.col("catalog_price").cast("double"))
    return joined.select(
        *[F.col(f"r.{name}") for name in kept],
        F.col("r.store_id").alias("Store_ID"),
        F.col("r.product_id").alias("Product_ID"),
        F.col("category").alias("Product_Category"),
        F.coalesce("region", F.lit(schemas.DEFAULT_REGION)).alias("Region"),
        price.alias("Unit_Price"),
        F.coalesce("r.discount", F.lit(0.0)).alias("Discount"),
        F.coalesce("r.promotion", F.lit(0)).alias("Promotion"),
        F.coalesce("r.holiday", F.lit(0)).alias("Holiday"),
        *[c.alias(name) for name, c in C.calendar(F.col("r.forecast_date")).items()],
        pick("lag_1", "tail_1").alias("Lag_1"),
        pick("lag_7", "tail_7").alias("Lag_7"),
        pick("lag_30", "tail_30").alias("Lag_30"),
        pick("rolling_mean_7", "tail_mean_7").alias("Rolling_Mean_7"),
        pick("rolling_mean_30", "tail_mean_30").alias("Rolling_Mean_30"),
    )


def dense_panel(df: DataFrame, scope: str = "global") -> DataFrame:
    """One row per series and calendar day, with ``present`` telling whether the panel has it.

    ``scope="global"`` spans the first to the last day of the panel, ``"series"`` those of each
    series. The days are generated per series from its key, so nothing is crossed.
    """
    if scope not in ("global", "series"):
        raise ValueError(f"unknown scope: {scope}")
    spans = df.groupBy(*schemas.SERIES_KEYS).agg(F.min("Date").alias("start"), F.max("Date").alias("end"))
    if scope == "global":
        spans = spans.withColumns(
            {
                "start": df.agg(F.min("Date").alias("start")).scalar(),
                "end": df.agg(F.max("Date").alias("end")).scalar(),
            }
        )
    spine = spans.select(*schemas.SERIES_KEYS, F.explode(F.sequence("start", "end")).alias("Date"))
    return spine.join(df.withColumn("present", F.lit(1)), schemas.PANEL_KEYS, "left").fillna({"present": 0})
