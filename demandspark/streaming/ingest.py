"""Recording sales as they arrive.

Every micro-batch writes to a folder named by its id and overwrites it, so a batch that runs
again after a failure leaves the same result.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from demandspark.operators.lookup import judge_sales, parted, price_sales
from demandspark.streaming.state import state_in_rocksdb


def read_requests(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
    **options,
) -> DataFrame:
    """A stream of the files that arrive in ``folder``. ``files_per_batch`` bounds a batch."""
    reader = spark.readStream.schema(schema).format(file_format).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def start_once_only_stream(
    requests: DataFrame, catalog: DataFrame, out_dir: str, checkpoint: str, keys: list[str], event_time: str, delay: str
) -> list[StreamingQuery]:
    """``start_sales_stream`` for sources that deliver a request more than once: sales and rejects are recorded once
    per request, named by ``keys``.

    The stream remembers a request for ``delay`` behind the newest ``event_time`` it has seen, so its state does not
    grow with the stream; it lies in RocksDB, as it may hold more requests than memory does. A request older than
    that when it comes is not taken, as nobody can tell whether it was taken before; ``late_requests`` tells which
    these are. Requests need a time; one without is late.
    All requests as they came are kept in ``<out_dir>/received``.
    """
    timed = requests.withColumn(event_time, F.col(event_time).cast("timestamp"))
    once = timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    received = (
        requests.writeStream.format("parquet")
        .option("path", f"{out_dir}/received")
        .option("checkpointLocation", f"{checkpoint}/received")
        .trigger(availableNow=True)
        .start()
    )
    with state_in_rocksdb(requests.sparkSession):
        return [start_sales_stream(once, catalog, out_dir, f"{checkpoint}/sales"), received]


def late_requests(spark: SparkSession, out_dir: str, keys: list[str]) -> DataFrame:
    """Requests that came too late to be taken, once each, with the reason: received, but neither recorded nor refused."""
    received = spark.read.parquet(f"{out_dir}/received").dropDuplicates(keys)
    for part in ("sales", "rejects"):
        known = spark.read.parquet(f"{out_dir}/{part}").select(*keys).distinct()
        same = [received[k].eqNullSafe(known[k]) for k in keys]
        received = received.join(known, reduce(and_, same), "left_anti")
    return received.withColumn("reasons", F.array(F.lit("too late")))


def start_sales_stream(
    requests: DataFrame, catalog: DataFrame, out_dir: str, checkpoint: str
) -> StreamingQuery:
    """Check sale requests, price the accepted ones and append them to ``<out_dir>/sales``;
    the others go to ``<out_dir>/rejects`` with reasons. Ends when the input is used up."""

    def record(batch: DataFrame, batch_id: int) -> None:
        judged = judge_sales(batch, catalog).persist()  # joined and judged once for both outputs
        try:
            accepted, rejects = parted(judged, batch.columns)
            price_sales(accepted).write.mode("overwrite").parquet(f"{out_dir}/sales/batch={batch_id}")
            rejects.write.mode("overwrite").parquet(f"{out_dir}/rejects/batch={batch_id}")
        finally:
            judged.unpersist()

    return (
        requests.writeStream.foreachBatch(record)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
