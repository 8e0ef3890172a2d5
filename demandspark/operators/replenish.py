"""Changing tables: upserts and restocking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandspark import schemas
from demandspark.operators.lookup import latest_per_key


def upsert(
    current: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    stamp: Column | None = None,
) -> DataFrame:
    """``current`` with the values of ``changes`` where a key has a change, and new keys added.

    ``order`` names columns of ``changes`` that tell which of several changes of a key is last;
    without it the one with the greatest values is taken, so a key never comes twice.
    ``stamp`` becomes the ``updated_at`` of the keys with a change.
    The result is a new table; write it beside the old one (``write_version``).
    """
    values = [c for c in current.columns if c not in keys]
    changes = latest_per_key(changes, keys, order or [c for c in values if c in changes.columns])
    if stamp is not None:
        changes = changes.withColumn("updated_at", stamp)
    renamed = changes.select(
        *keys, F.lit(True).alias("changed"), *[F.col(c).alias(f"new_{c}") for c in values if c in changes.columns]
    )
    return current.join(renamed, list(keys), "full_outer").select(
        *keys,
        *[
            F.when(F.col("changed"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
            if c in changes.columns
            else F.col(c)
            for c in values
        ],
    ).select(*current.columns)


def apply_reorders(
    inventory: DataFrame, requests: DataFrame, stamp: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Add reordered quantities to the stock. Returns (inventory, receipts).

    Requests of one product and store are summed before they meet the stock, so each pair gets
    one receipt (``reorder_ledger`` gives one per request); a pair without stock starts from
    zero. ``stamp``, or else the present time, becomes the ``updated_at`` of restocked pairs if
    the stock has such a column.
    """
    keys = ["product_id", "store_id"]
    orders = requests.groupBy(*keys).agg(
        F.sum("reorder_quantity").alias("reorder_quantity"), F.count("*").alias("request_count")
    )
    merged = inventory.join(orders, keys, "full_outer").withColumns(
        {
            "previous_inventory": F.coalesce(
                F.col("inventory_level").cast("long"), F.lit(schemas.DEFAULT_STOCK_FOR_REORDER).cast("long")
            ),
            "ordered": F.coalesce(F.col("reorder_quantity"), F.lit(0).cast("long")),
        }
    ).withColumn("new_inventory", F.col("previous_inventory") + F.col("ordered"))
    others = {c: F.col(c) for c in inventory.columns if c not in (*keys, "inventory_level")}
    if "updated_at" in others:
        now = (F.current_timestamp() if stamp is None else stamp).cast(inventory.schema["updated_at"].dataType)
        others["updated_at"] = F.when(F.col("request_count") > 0, now).otherwise(F.col("updated_at"))
    updated = merged.select(
        *keys, F.col("new_inventory").alias("inventory_level"), *[c.alias(name) for name, c in others.items()]
    )
    receipts = merged.filter(F.col("request_count") > 0).select(
        *keys,
        "request_count",
        "reorder_quantity",
        "previous_inventory",
        "new_inventory",
        F.lit(schemas.RECEIPT_STATUS).alias("status"),
        F.format_string(
            schemas.RECEIPT_MESSAGE, "reorder_quantity", "previous_inventory", "new_inventory"
        ).alias("message"),
    )
    return updated, receipts


def reorder_ledger(
    inventory: DataFrame, requests: DataFrame, order: str, block: int = 1_000_000
) -> DataFrame:
    """A receipt per request, with the balance before and after it; requests of a pair follow
    each other by the number in ``order``. Other columns of the requests are kept.

    A pair's requests are added up in blocks of that number, and the blocks' sums in turn, so a
    pair with very many requests is spread over many tasks.
    """
    keys = ["product_id", "store_id"]
    blocked = requests.withColumn("block", F.floor(F.col(order) / block))
    sums = blocked.groupBy(*keys, "block").agg(F.sum("reorder_quantity").alias("sum"))
    before = W.partitionBy(*keys).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(*keys, "block", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("start"))
    stock = inventory.select(*keys, F.col("inventory_level").cast("long").alias("stock"))
    starts = starts.join(stock, keys, "left").fillna({"stock": schemas.DEFAULT_STOCK_FOR_REORDER})
    inside = W.partitionBy(*keys, "block").orderBy(order, "reorder_quantity").rowsBetween(W.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("reorder_quantity").over(inside), F.lit(0))
    balance = F.col("stock") + F.col("start") + F.col("earlier")
    numbered = blocked.withColumn("earlier", earlier).join(starts, [*keys, "block"])
    return numbered.withColumns(
        {"previous_inventory": balance, "new_inventory": balance + F.col("reorder_quantity")}
    ).select(
        *[c for c in requests.columns if not c.startswith("catalog_")],
        "previous_inventory",
        "new_inventory",
        F.lit(schemas.RECEIPT_STATUS).alias("status"),
        F.format_string(schemas.RECEIPT_MESSAGE, "reorder_quantity", "previous_inventory", "new_inventory").alias("message"),
    )
