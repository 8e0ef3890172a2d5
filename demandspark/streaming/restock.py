"""Restocking as keyed state: the balance of every product and store lives in the stream's state store.

A batch of reorders reads and writes the balances of the pairs it names and emits a receipt for each of them;
the stock table is never rewritten. The stock at the start goes into the state before the first batch. The
balances of all pairs can be read from the checkpoint at any time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from demandspark import schemas
from demandspark.functions import rules as R
from demandspark.operators.lookup import admit
from demandspark.streaming.state import state_in_rocksdb

KEYS = ["product_id", "store_id"]
RECEIPT = (
    "product_id string, store_id string, request_count long, reorder_quantity long, previous_inventory long, new_inventory long"
)
_PARTIAL = "product_id string, store_id string, request_count long, reorder_quantity long"


class Balance(StatefulProcessor):
    """The stock of one product and store."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._level = handle.getValueState("balance", "inventory_level long")

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        self._level.update((int(initialState["inventory_level"].iloc[0]),))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        count = quantity = 0
        for part in rows:
            count += int(part["request_count"].sum())
            quantity += int(part["reorder_quantity"].sum())
        before = self._level.get()[0] if self._level.exists() else schemas.DEFAULT_STOCK_FOR_REORDER
        self._level.update((before + quantity,))
        yield pd.DataFrame([(*key, count, quantity, before, before + quantity)], columns=[f.split()[0] for f in RECEIPT.split(", ")])

    def close(self) -> None:
        pass


def _added_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Requests of a pair added up within a task, so that a pair with very many of them is a few rows in the shuffle."""
    for batch in batches:
        sums = batch.groupby(KEYS, sort=False)["reorder_quantity"].agg(["size", "sum"]).reset_index()
        yield sums.rename(columns={"size": "request_count", "sum": "reorder_quantity"})


def balances(accepted: DataFrame, opening: DataFrame) -> DataFrame:
    """A stream of receipts, one for each pair that a batch of accepted reorders names.

    ``opening`` holds the stock before the first batch, a row per product and store; a pair it lacks starts from zero.
    """
    parts = accepted.select(*KEYS, F.col("reorder_quantity").cast("long").alias("reorder_quantity")).mapInPandas(_added_up, _PARTIAL)
    start = opening.select(*KEYS, F.col("inventory_level").cast("long").alias("inventory_level"))
    changed = parts.groupBy(*KEYS).transformWithStateInPandas(
        Balance(), RECEIPT, outputMode="Append", timeMode="None", initialState=start.groupBy(*KEYS)
    )
    return changed.withColumns(
        {
            "status": F.lit(schemas.RECEIPT_STATUS),
            "message": F.format_string(schemas.RECEIPT_MESSAGE, "reorder_quantity", "previous_inventory", "new_inventory"),
        }
    )


def start_restocking(
    requests: DataFrame, catalog: DataFrame, opening: DataFrame, out_dir: str, checkpoint: str
) -> list[StreamingQuery]:
    """Apply a stream of reorders to the stock ``opening``; ends when the input is used up.

    Receipts go to ``<out_dir>/receipts``, refused requests with reasons to ``<out_dir>/rejects``; both are file
    sinks that count each batch once, also after a failure. Started again with the same ``checkpoint`` the stream
    goes on from its balances, and ``opening`` is not read.
    """
    accepted, rejects = admit(requests, R.REORDER_RULES, catalog)
    with state_in_rocksdb(requests.sparkSession):
        return [
            df.writeStream.format("parquet")
            .outputMode("append")
            .option("path", f"{out_dir}/{name}")
            .option("checkpointLocation", f"{checkpoint}/{name}")
            .trigger(availableNow=True)
            .start()
            for name, df in (("receipts", balances(accepted, opening)), ("rejects", rejects))
        ]


def current_stock(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Balances of all pairs as of the newest batch of a stream of ``start_restocking``, or as of ``batch_id``."""
    reader = spark.read.format("statestore").option("stateVarName", "balance")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(f"{checkpoint}/receipts")
    return state.select("key.product_id", "key.store_id", "value.inventory_level")
