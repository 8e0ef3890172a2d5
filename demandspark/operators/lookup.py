"""Filtered pages, latest rows per key, lookups, request checks and table audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark import schemas
from demandspark.functions import columns as C
from demandspark.functions import rules as R
from demandspark.sources.tables import months


def only(df: DataFrame, store: str | None = None, product: str | None = None) -> DataFrame:
    """Rows of a store and/or a product; without either the whole table."""
    if store:
        df = df.filter(F.col("store_id") == store)
    if product:
        df = df.filter(F.col("product_id") == product)
    return df


def sales_page(
    sales: DataFrame,
    store: str | None = None,
    product: str | None = None,
    limit: int = 50,
    offset: int = 0,
) -> DataFrame:
    """A page of sales, newest first; store and product break ties."""
    if not 1 <= limit <= 500:
        raise ValueError(f"limit must be 1 to 500: {limit}")
    if offset < 0:
        raise ValueError(f"offset must not be negative: {offset}")
    ordered = only(sales, store, product).orderBy(F.desc("date"), "store_id", "product_id")
    return ordered.offset(offset).limit(limit)


def sales_page_after(
    spark: SparkSession,
    path: str,
    cursor: tuple[date, str, str] | None = None,
    store: str | None = None,
    product: str | None = None,
    limit: int = 50,
) -> DataFrame:
    """The page of sales that follows ``cursor`` (date, store and product of the last sale seen), newest first; the
    first page without one.

    The table at ``path`` is one of ``tables.save_by_month``. From the cursor's month on back only as many months are
    read as the page needs, however deep it lies: 1, 2, 4, ... are counted until they hold a page. The last row of a
    page is the next cursor; sales that agree in all three columns must lie on one page.
    """
    if not 1 <= limit <= 500:
        raise ValueError(f"limit must be 1 to 500: {limit}")
    behind = [m for m in months(spark, path) if cursor is None or m <= (cursor[0].year, cursor[0].month)]
    sales = only(spark.read.parquet(path), store, product)
    if cursor is not None:
        day, last_store, last_product = (F.lit(x) for x in cursor)
        later = (F.col("store_id") > last_store) | ((F.col("store_id") == last_store) & (F.col("product_id") > last_product))
        sales = sales.filter((F.col("date") < day) | ((F.col("date") == day) & later))
    number = F.col("Year") * 12 + F.col("Month")
    taken = 1
    while True:
        first, last = (behind[min(taken, len(behind)) - 1], behind[0]) if behind else ((0, 1), (0, 0))
        part = sales.filter(number.between(first[0] * 12 + first[1], last[0] * 12 + last[1]))
        if taken >= len(behind) or part.count() >= limit:
            break
        taken *= 2
    return part.drop("Year", "Month").orderBy(F.desc("date"), "store_id", "product_id").limit(limit)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    Each task keeps one row per key before the shuffle (WindowGroupLimit), however many a key has.
    """
    others = [c for c in df.columns if c not in keys]
    newest = last_n_per_key(df, keys, [F.desc(c) for c in order], 1)
    return newest.select(*keys, *others)


def last_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    """The first n rows per key in the given order; tasks drop other rows before the shuffle."""
    ranked = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= n)


def recent_forecasts(forecasts: DataFrame, n: int = 5, store: str | None = None) -> DataFrame:
    """The n forecasts per product that were written last, of one store or of all; demand as
    whole units. Of those written together, or without a time of writing, later days come first."""
    written = [F.desc("created_at")] if "created_at" in forecasts.columns else []
    newest = [*written, F.desc("forecast_date"), F.asc("store_id"), F.asc("model_name")]
    return last_n_per_key(only(forecasts, store), ["product_id"], newest, n).withColumn(
        "predicted_demand", C.demand_units(F.col("predicted_demand"))
    )


def with_default(
    df: DataFrame, inventory: DataFrame, default: int, name: str = "current_inventory"
) -> DataFrame:
    """Adds the stock on record for (product_id, store_id), or ``default``."""
    return with_defaults(df, inventory, **{name: default})


def with_defaults(df: DataFrame, inventory: DataFrame, **defaults: int) -> DataFrame:
    """Adds the stock on record under each name, with that name's default where there is none."""
    keys = ["product_id", "store_id"]
    level = F.col("inventory_level").cast("long")
    joined = df.join(inventory.select(*keys, "inventory_level"), keys, "left")
    filled = {name: F.coalesce(level, F.lit(n).cast("long")) for name, n in defaults.items()}
    return joined.withColumns(filled).drop("inventory_level")


def with_region(df: DataFrame, regions: DataFrame) -> DataFrame:
    """Adds the store's region; unknown stores get the default region."""
    return df.join(regions, "store_id", "left").fillna({"region": schemas.DEFAULT_REGION})


def default_regions(spark) -> DataFrame:
    """The five known stores and their regions."""
    pairs = [F.struct(F.lit(s).alias("store_id"), F.lit(r).alias("region")) for s, r in schemas.STORE_REGIONS.items()]
    return spark.range(1).select(F.inline(F.array(*pairs)))


def check_exists(df: DataFrame, catalog: DataFrame, key: str = "product_id") -> tuple[DataFrame, DataFrame]:
    """Rows whose key the catalog has, and rows whose key it lacks."""
    known = catalog.select(key)
    return df.join(known, key, "left_semi"), df.join(known, key, "left_anti")


def _failed(rules: Mapping[str, str]) -> Column:
    tests = [F.when(~F.coalesce(F.expr(test), F.lit(False)), F.lit(name)) for name, test in rules.items()]
    return F.array_compact(F.array(*tests))


def validate_requests(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Requests that keep every rule, and the others with the ``reasons`` they failed for."""
    judged = df.withColumn("reasons", _failed(rules))
    return judged.filter(F.size("reasons") == 0).drop("reasons"), judged.filter(F.size("reasons") > 0)


def judge(
    df: DataFrame, rules: Mapping[str, str], catalog: DataFrame, more: Mapping[str, Column] | None = None
) -> DataFrame:
    """Requests with the catalog's columns as ``catalog_*`` and the ``reasons`` to refuse them, none for a good one.

    ``more`` names conditions over requests and catalog columns, for rows that pass the rest.
    """
    found = catalog.select(
        F.col("product_id").alias("catalog_id"),
        *[F.col(c).alias(f"catalog_{c}") for c in catalog.columns if c != "product_id"],
    )
    judged = df.join(found, df.product_id == found.catalog_id, "left").withColumn(
        "reasons",
        F.array_compact(
            F.concat(
                _failed(rules),
                F.array(F.when(F.col("catalog_id").isNull(), F.lit("unknown product"))),
            )
        ),
    )
    for name, test in (more or {}).items():
        failed = (F.size("reasons") == 0) & ~F.coalesce(test, F.lit(False))
        judged = judged.withColumn("reasons", F.when(failed, F.array(F.lit(name))).otherwise(F.col("reasons")))
    return judged.drop("catalog_id")


def parted(judged: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Accepted requests with the catalog's columns, and rejects with ``columns`` and their reasons."""
    accepted = judged.filter(F.size("reasons") == 0).drop("reasons")
    return accepted, judged.filter(F.size("reasons") > 0).select(*columns, "reasons")


def admit(
    df: DataFrame, rules: Mapping[str, str], catalog: DataFrame, more: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rules and catalog in one go: accepted requests with the catalog's columns as
    ``catalog_*``, and rejects with reasons; accepted and rejects add up to the input."""
    return parted(judge(df, rules, catalog, more), df.columns)


def _sale_revenue() -> Column:
    discount = F.coalesce(F.col("discount"), F.lit(0.0))
    return F.bround(C.net_revenue(F.col("units_sold"), F.col("catalog_unit_price"), discount), 2)


def judge_sales(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """``judge`` by the rules for sales; a revenue that the sales table cannot hold is a reason too.

    Only amounts near that limit are worked out in decimals for it.
    """
    share = 1 - F.coalesce(F.col("discount"), F.lit(0.0)) / 100
    rough = F.abs(F.col("units_sold").cast("double") * F.col("catalog_unit_price").cast("double") * share)
    exact = _sale_revenue().try_cast("decimal(12,2)").isNotNull()
    return judge(df, R.SALE_RULES, catalog, {"revenue": F.when(rough < 9e9, F.lit(True)).otherwise(exact)})


def admit_sales(df: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    return parted(judge_sales(df, catalog), df.columns)


def price_sales(accepted: DataFrame) -> DataFrame:
    """Accepted sale requests as rows of the sales table, revenue from the catalog price."""
    kept = [c for c in accepted.columns if not c.startswith("catalog_")]
    return accepted.select(
        *[c for c in kept if c not in ("discount", "promotion")],
        F.coalesce("discount", F.lit(0.0)).cast("decimal(5,2)").alias("discount"),
        F.coalesce("promotion", F.lit(0)).alias("promotion"),
        _sale_revenue().cast("decimal(12,2)").alias("revenue"),
    )


def constraint_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Violations per table and constraint: NOT NULL and CHECK in one pass per table, keys by
    counting rows per key."""
    audits = []
    for table, df in tables.items():
        tests = {f"{c} NOT NULL": F.col(c).isNull() for c in R.TABLE_NOT_NULL[table]}
        tests |= {check: ~F.expr(check) for check in R.TABLE_CHECKS[table]}
        wide = df.agg(*[F.count_if(test).alias(f"t{i}") for i, test in enumerate(tests.values())])
        rows = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(name).alias("constraint_name"),
                F.col(f"t{i}").alias("violations"),
            )
            for i, name in enumerate(tests)
        ]
        audits.append(C.unfold(wide, rows))
        if table in R.TABLE_KEYS:
            keys = R.TABLE_KEYS[table]
            audits.append(
                df.dropna(subset=keys)
                .groupBy(*keys)
                .agg(F.count("*").alias("n"))
                .agg(F.count_if(F.col("n") > 1).alias("violations"))
                .select(
                    F.lit(table).alias("table_name"),
                    F.lit(f"{', '.join(keys)} UNIQUE").alias("constraint_name"),
                    "violations",
                )
            )
    result = audits[0]
    for audit in audits[1:]:
        result = result.unionByName(audit)
    return result


def orphan_audit(children: Mapping[str, DataFrame], catalog: DataFrame) -> DataFrame:
    """Rows per child table whose product the catalog lacks, and how many products that are."""
    audits = []
    for table, df in children.items():
        # Count per product first: the join then sees products, not rows.
        counts = df.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(F.count("*").alias("n"))
        audits.append(
            counts.join(catalog.select("product_id"), "product_id", "left_anti").agg(
                F.lit(table).alias("table_name"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
                F.count("*").alias("orphan_products"),
            )
        )
    result = audits[0]
    for audit in audits[1:]:
        result = result.unionByName(audit)
    return result


def missing_forecasts(catalog: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Products without any forecast. Distinct products meet the catalog, not forecast rows."""
    return catalog.join(forecasts.select("product_id").distinct(), "product_id", "left_anti")
