"""Readers, writers, the five-table catalog and versioned tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from demandspark import schemas
from demandspark.functions import columns as C
from demandspark.sources.staging import folders, remove


def read_sales(spark: SparkSession, path: str, file_format: str = "csv", keep_bad_lines: bool = False, **options) -> DataFrame:
    """The raw sales feed with its fixed schema; NaN becomes null at the door.

    With ``keep_bad_lines`` a line of a CSV feed that has too few or too many fields, or a field that is no number, is
    kept as it stands in the column ``raw_line`` (null for good lines); ``clean_sales`` then rejects and counts it.
    Without, such a line becomes a row with nulls.
    """
    schema = schemas.RAW_SALES
    if keep_bad_lines:
        if file_format != "csv":
            raise ValueError("only CSV feeds have lines")
        schema = StructType([*schema.fields, StructField(schemas.RAW_LINE, StringType())])
        options["columnNameOfCorruptRecord"] = schemas.RAW_LINE
    if file_format == "csv":
        options = {"header": True, **options}
    reader = spark.read.schema(schema).options(**options)
    try:
        feed = reader.format(file_format).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no sales feed at {path}") from error
        raise
    doubles = ["Unit_Price", "Discount", "Inventory_Level"]
    return feed.withColumns({name: C.nan_to_null(F.col(name)) for name in doubles})


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    file_format: str = "parquet",
    sort_by: Sequence[str] = (),
) -> None:
    """Write a table.

    With ``partition_by`` rows are first gathered by partition value, so that a partition
    is a few files and not one per task; AQE splits partitions that come out too large.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode).format(file_format)
    if file_format == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def save_cleaned(clean: DataFrame, path: str) -> None:
    """The cleaned panel by month, series and days adjacent within each file."""
    dated = clean.withColumns({"Year": F.year("Date"), "Month": F.month("Date")})
    write_table(dated, path, partition_by=["Year", "Month"], sort_by=schemas.PANEL_KEYS)


def save_by_month(sales: DataFrame, path: str) -> None:
    """Sales by month, newest first within each file, for ``lookup.sales_page_after``."""
    dated = sales.withColumns({"Year": F.year("date"), "Month": F.month("date")})
    write_table(dated, path, partition_by=["Year", "Month"], sort_by=["date", "store_id", "product_id"])


def months(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """Year and month of every month a table by month holds, newest first, from the names of its folders."""
    found = []
    for year in folders(spark, path):
        if year.startswith("Year="):
            names = folders(spark, f"{path}/{year}")
            found += [(int(year[5:]), int(month[6:])) for month in names if month.startswith("Month=")]
    return sorted(found, reverse=True)


def save_leaderboard(board: DataFrame, path: str) -> None:
    if board.isEmpty():
        raise ValueError("the leaderboard has no rows; evaluate models first")
    write_table(board, path, file_format="csv")


def register_catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Register the given tables as views; tables not given become empty views."""
    for name, schema in schemas.TABLES.items():
        table = tables.get(name)
        if table is None:
            table = spark.createDataFrame([], schema)
        table.createOrReplaceTempView(name)


def register_colocated(
    spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, buckets: int, prefix: str = ""
) -> dict[str, DataFrame]:
    """Store tables below ``folder`` in hash buckets of product and store, and name them in the catalog.

    Joins and sums by product and store over such tables move no row: equal keys lie in buckets of one number. So that
    this holds for joins on further columns (a day) as well, the session is told that some of the join's keys may
    decide where rows meet. A bucket is one file, written by one task; choose ``buckets`` so that the largest table has
    some hundred megabytes a bucket, and the same number for all tables.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", False)
    keys = ["product_id", "store_id"]
    found = {}
    for name, table in tables.items():
        own = [k for k in keys if k in table.columns]
        rows = table.repartition(buckets, *own).write.mode("overwrite").format("parquet").bucketBy(buckets, *own).sortBy(*own)
        rows.option("path", f"{folder}/{prefix}{name}").saveAsTable(f"{prefix}{name}")
        found[name] = spark.table(f"{prefix}{name}")
    return found


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in order and type; columns the data lacks become null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _append_run(df: DataFrame, schema: StructType, path: str, run: str | None) -> None:
    """Append stamped rows. With ``run`` they go to a folder of that name, which the same run
    overwrites when it is repeated; do not mix both ways in one table."""
    stamped = conform(df.withColumn("created_at", F.current_timestamp()), schema)
    if run is None:
        write_table(stamped, path, mode="append")
    else:
        write_table(stamped, f"{path}/run={run}")


def append_forecasts(forecasts: DataFrame, path: str, run: str | None = None) -> None:
    """Append a batch of forecasts, stamped with the time of writing."""
    _append_run(forecasts, schemas.FORECASTS, path, run)


def append_risks(decisions: DataFrame, path: str, run: str | None = None) -> None:
    """Append a batch of risk decisions, stamped with the time of writing."""
    _append_run(decisions, schemas.INVENTORY_RISK, path, run)


def append_sales(sales: DataFrame, path: str) -> None:
    write_table(conform(sales, schemas.SALES), path, mode="append")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


# A table that is rewritten as a whole keeps each state in its own version folder: the state
# being read is never overwritten, and writing a version again after a failure gives the same
# folder.


def write_version(df: DataFrame, root: str, version: int) -> None:
    write_table(df, f"{root}/version={version}")


def _versions(spark: SparkSession, root: str) -> list[int]:
    """The versions there are, from the names of their folders."""
    names = [name.split("=") for name in folders(spark, root)]
    return sorted(int(parts[1]) for parts in names if len(parts) == 2 and parts[0] == "version")


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The given version, or the newest one."""
    if version is None:
        version = _versions(spark, root)[-1]
    return spark.read.parquet(f"{root}/version={version}")


def drop_versions(spark: SparkSession, root: str, keep: int) -> None:
    """Remove all but the newest ``keep`` versions, two at least."""
    for version in _versions(spark, root)[: -max(2, keep)]:
        remove(spark, f"{root}/version={version}")
