"""Auditing and cleaning the raw sales feed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from demandspark import schemas
from demandspark.functions import columns as C
from demandspark.operators.quantiles import exact_quantiles, grouped_quantiles
from demandspark.sources.staging import stage

# Cleaning steps in order; a row is charged to the first step it fails. A feed with raw lines has one step before.
BAD_LINES = "malformed_lines_dropped"
STEPS = [
    "invalid_dates_dropped",
    "invalid_ids_dropped",
    "negative_sales_dropped",
    "null_sales_dropped",
    "negative_prices_dropped",
    "null_flags_dropped",
]


def _copies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows with the number of their copies; copies are counted before the shuffle."""
    return df.groupBy(*columns).agg(F.count("*").alias("copies"))


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How many rows repeat an earlier row."""
    copies = _copies(df, columns or df.columns)
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))


def audit_columns(df: DataFrame) -> DataFrame:
    """One row per column: position, type, nulls; with the table's row and duplicate counts."""
    copies = _copies(df, df.columns)
    nulls = [
        F.coalesce(F.sum(F.when(F.col(name).isNull(), F.col("copies"))), F.lit(0)).alias(f"nulls_{i}")
        for i, name in enumerate(df.columns)
    ]
    wide = copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
        *nulls,
    )
    return C.unfold(
        wide,
        [
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col(f"nulls_{i}").alias("missing"),
                F.col("row_count"),
                F.col("duplicate_rows"),
            )
            for i, field in enumerate(df.schema.fields)
        ],
    )


def numeric_profile(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Count, mean, deviation, exact quartiles and range per column.

    The columns are read once for the moments and three times for the quartiles, so they are written out first.
    """
    df = stage(df.select(*columns), "profiled")
    wide = df.agg(
        *[
            F.struct(
                F.count(name).alias("n"),
                F.avg(name).alias("mean"),
                F.stddev_samp(name).alias("std"),
                F.min(name).cast("double").alias("min"),
                F.max(name).cast("double").alias("max"),
            ).alias(name)
            for name in columns
        ]
    )
    moments = C.unfold(
        wide,
        [
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(name)["n"].alias("value_count"),
                F.bround(F.col(name)["mean"].cast("double"), digits).alias("mean"),
                F.bround(F.col(name)["std"], digits).alias("std"),
                F.col(name)["min"].alias("minimum"),
                F.col(name)["max"].alias("maximum"),
            )
            for name in columns
        ],
    )
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    rounded = [F.bround(F.get("q", F.lit(i)), digits).alias(name) for i, name in enumerate(("q25", "q50", "q75"))]
    return moments.join(quartiles, "column_name", "left").select(
        "column_name", "value_count", "mean", "std", "minimum", *rounded, "maximum"
    )


def outliers_iqr(df: DataFrame, column: str, k: float = 3.0, weight: str | None = None) -> DataFrame:
    """Quartiles, upper bound q75 + k * IQR and the number of values above it.

    ``weight`` names a column with the number of rows each row stands for. The quartiles are scalars of the plan;
    the table is then read once more to count.
    """
    quartiles = grouped_quantiles(df, [], column, [0.25, 0.75], weight).agg(F.max("q").alias("q"))
    q25, q75 = F.get("q", F.lit(0)), F.get("q", F.lit(1))
    quartiles = quartiles.select(q25.alias("q25"), q75.alias("q75"), (q75 + k * (q75 - q25)).alias("upper_bound"))
    count = F.lit(1) if weight is None else F.col(weight)
    bound = quartiles.select("upper_bound").scalar()
    above = df.agg(F.coalesce(F.sum(F.when(F.col(column) > bound, count)), F.lit(0)).alias("outliers"))
    return quartiles.join(above).select(F.lit(column).alias("column_name"), "q25", "q75", "upper_bound", "outliers")


def _first_failure() -> Column:
    """Index into STEPS of the first step the row fails; null if it passes all."""
    ids = C.matches(F.col("Store_ID"), schemas.STORE_ID_PATTERN) & C.matches(
        F.col("Product_ID"), schemas.PRODUCT_ID_PATTERN
    )
    units, price = F.col("Units_Sold"), F.col("Unit_Price")
    return (
        F.when(C.parse_day(F.col("Date")).isNull(), 0)
        .when(~ids, 1)
        .when(units < 0, 2)
        .when(units.isNull(), 3)
        .when(price <= 0, 4)
        .when(F.col("Promotion").isNull() | F.col("Holiday").isNull(), 5)
    )


def steps_of(df: DataFrame) -> list[str]:
    """The cleaning steps that apply to a feed."""
    return [*STEPS, BAD_LINES] if schemas.RAW_LINE in df.columns else STEPS


def judge_rows(raw: DataFrame) -> DataFrame:
    """The distinct rows of the feed with their ``copies`` and the step they ``failed``; NaN
    counts as missing. A line that could not be read fails before all else."""
    floats = [name for name, kind in raw.dtypes if kind in ("double", "float")]
    raw = raw.withColumns({name: C.nan_to_null(F.col(name)) for name in floats})
    names, failed = list(schemas.RAW_SALES.names), _first_failure()
    if schemas.RAW_LINE in raw.columns:
        names.append(schemas.RAW_LINE)
        failed = F.when(F.col(schemas.RAW_LINE).isNotNull(), len(STEPS)).otherwise(failed)
    return _copies(raw, names).withColumn("failed", failed)


def _counters(judged: DataFrame) -> dict[str, Column]:
    """The counts of the waterfall as aggregates over judged rows, in order."""
    kept, steps = F.col("failed").isNull(), steps_of(judged)
    order = [*range(len(STEPS), len(steps)), *range(len(STEPS))]
    return {
        "initial_rows": F.sum("copies"),
        "duplicates_removed": F.sum(F.col("copies") - 1),
        **{steps[i]: F.count_if(F.col("failed") == i) for i in order},
        "final_rows": F.count_if(kept),
        **{f"missing_{c}": F.count_if(kept & F.col(c).isNull()) for c in schemas.RAW_SALES.names},
    }


def store_judged(judged: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """The judged rows as a stored table and the counts of the waterfall, taken while it is written."""
    observed = Observation("waterfall")
    stored = stage(judged.observe(observed, *[c.alias(m) for m, c in _counters(judged).items()]), "judged-sales")
    return stored, {name: value or 0 for name, value in observed.get.items()}


def cleaning_waterfall(judged: DataFrame, outlier_k: float = 3.0, counts: dict[str, int] | None = None) -> DataFrame:
    """The cleaning counters as (step, metric, value) rows, from the result of judge_rows. ``counts`` are those that
    ``store_judged`` has taken; without them the rows are read for it."""
    counters = _counters(judged)
    names = list(counters)
    if counts is None:
        wide = judged.agg(*[c.alias(m) for m, c in counters.items()])
    else:
        wide = judged.sparkSession.range(1).select(*[F.lit(counts[m]).cast("long").alias(m) for m in names])
    cut = names.index("final_rows") + 1
    metrics = [*names[:cut], "rows_removed", *names[cut:]]
    wide = wide.withColumn("rows_removed", F.col("initial_rows") - F.col("final_rows"))
    kept = F.col("failed").isNull()
    counters = C.unfold(
        wide,
        [
            F.struct(
                F.lit(i + 1).alias("step"),
                F.lit(m).alias("metric"),
                F.coalesce(F.col(m), F.lit(0)).cast("double").alias("value"),
            )
            for i, m in enumerate(metrics)
        ],
    )
    outliers = outliers_iqr(judged.filter(kept), "Units_Sold", outlier_k)
    report = C.unfold(
        outliers,
        [
            F.struct(
                F.lit(len(metrics) + 1 + i).alias("step"),
                F.lit(m).alias("metric"),
                F.col(c).cast("double").alias("value"),
            )
            for i, (m, c) in enumerate(
                [("extreme_outliers_detected", "outliers"), ("outlier_upper_bound_3iqr", "upper_bound")]
            )
        ],
    )
    return counters.unionByName(report)


def _median(df: DataFrame, keys: Sequence[str], column: str, name: str, weight: str | None = None) -> DataFrame:
    found = grouped_quantiles(df, keys, column, [0.5], weight)
    return found.select(*keys, F.get("q", F.lit(0)).alias(name))


def impute(kept: DataFrame) -> DataFrame:
    """Fill the gaps: discount by 0, price by the product's median, stock by the median of the
    series and then by the median of the stock as filled so far.

    Only rows with a gap meet the medians; all others go straight through, so the table itself
    is not shuffled for it.
    """
    kept = kept.fillna({"Discount": 0.0})
    gap = F.col("Unit_Price").isNull() | F.col("Inventory_Level").isNull()
    whole, gappy = kept.filter(~gap), kept.filter(gap)
    price = _median(kept, ["Product_ID"], "Unit_Price", "median_price")
    stock = _median(kept, schemas.SERIES_KEYS, "Inventory_Level", "median_stock")
    series_filled = (
        gappy.join(price, "Product_ID", "left")
        .join(stock, schemas.SERIES_KEYS, "left")
        .withColumns(
            {
                "Unit_Price": F.coalesce("Unit_Price", "median_price"),
                "Inventory_Level": F.coalesce("Inventory_Level", "median_stock"),
            }
        )
        .select(*kept.columns)
    )
    # The median over the filled column, from counts per level.
    levels = (
        whole.select("Inventory_Level")
        .unionByName(series_filled.select("Inventory_Level"))
        .groupBy("Inventory_Level")
        .agg(F.count("*").alias("n"))
    )
    middle = _median(levels, [], "Inventory_Level", "middle", "n").agg(F.max("middle")).scalar()
    filled = series_filled.withColumn("Inventory_Level", F.coalesce("Inventory_Level", middle))
    return whole.unionByName(filled)


def enforce_types(df: DataFrame) -> DataFrame:
    """Whole units and stock (stock clipped at zero, then cut), money with two decimals."""
    return df.withColumns(
        {
            "Units_Sold": F.col("Units_Sold").cast("long"),
            "Unit_Price": C.half_even(F.col("Unit_Price")),
            "Discount": C.half_even(F.col("Discount")),
            "Promotion": F.col("Promotion").cast("int"),
            "Holiday": F.col("Holiday").cast("int"),
            "Inventory_Level": C.at_least_zero(F.col("Inventory_Level")).try_cast("long"),
        }
    )


@dataclass
class CleanResult:
    """``clean`` is the panel with dates and enforced types, ``rejects`` the distinct rows that were dropped with the
    ``reason``, ``waterfall`` the counters. Each is planned when it is asked for."""

    judged: DataFrame
    counts: dict[str, int] | None = None

    @cached_property
    def clean(self) -> DataFrame:
        kept = self.judged.filter(F.col("failed").isNull()).select(*schemas.RAW_SALES.names)
        return enforce_types(impute(kept.withColumn("Date", C.parse_day(F.col("Date")))))

    @cached_property
    def rejects(self) -> DataFrame:
        reason = F.get(F.array(*[F.lit(step) for step in steps_of(self.judged)]), F.col("failed"))
        dropped = self.judged.filter(F.col("failed").isNotNull())
        return dropped.select(*[c for c in dropped.columns if c not in ("copies", "failed")], reason.alias("reason"))

    @cached_property
    def waterfall(self) -> DataFrame:
        return cleaning_waterfall(self.judged, counts=self.counts)


def clean_sales(raw: DataFrame, staged: bool = True) -> CleanResult:
    """Clean the raw feed.

    The distinct rows are the one thing that needs the whole feed shuffled, and all three
    results start from them. They are therefore written once to the shared folder, and the
    counters are taken from the rows as they are written; medians then read only their columns. With ``staged=False``
    nothing is written, and each result that is used repeats the shuffle.
    """
    judged = judge_rows(raw)
    return CleanResult(*store_judged(judged)) if staged else CleanResult(judged)


def quality_gate(clean: DataFrame) -> DataFrame:
    """Nulls per column and values out of domain; a clean table has zeros only."""
    wide = clean.agg(
        *[F.count_if(F.col(name).isNull()).alias(f"null {name}") for name in clean.columns],
        F.count_if(F.col("Units_Sold") < 0).alias("negative Units_Sold"),
        F.count_if(F.col("Unit_Price") <= 0).alias("non-positive Unit_Price"),
        F.count_if(F.col("Inventory_Level") < 0).alias("negative Inventory_Level"),
    )
    return C.unfold(
        wide,
        [F.struct(F.lit(m).alias("check_name"), F.col(f"`{m}`").alias("violations")) for m in wide.columns],
    )
