"""Tables that change by key: a batch of changes rewrites only the hash buckets it touches.

A table's rows lie in buckets of a hash of their keys. Every change writes its buckets into a folder of its own and
then adds one small file, the pointer, that names the folder of each bucket. The newest pointer is the table:
readers see the state before a change or after it and never a part of it, and a change that fails half way has no
pointer. Of two changes made at the same time from the same state the second fails and can be made again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from demandspark.operators.replenish import apply_reorders, upsert
from demandspark.sources.staging import files, folders, read_text, remove, write_new_text

BUCKET = "bucket__"


class ConcurrentChange(RuntimeError):
    """Another change of the table was finished first."""


def _pointers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(name.removesuffix(".json")) for name in files(spark, f"{root}/pointers") if name.endswith(".json"))


def _pointer(spark: SparkSession, root: str, number: int | None = None) -> dict:
    number = _pointers(spark, root)[-1] if number is None else number
    return json.loads(read_text(spark, f"{root}/pointers/{number:012d}.json"))


def _publish(spark: SparkSession, root: str, pointer: dict) -> None:
    try:
        write_new_text(spark, f"{root}/pointers/{pointer['number']:012d}.json", json.dumps(pointer))
    except FileExistsError as error:
        raise ConcurrentChange(f"change {pointer['number']} of {root} has been made by another writer") from error


def _new_change(number: int) -> str:
    """A folder of its own for each attempt, so that two writers never share one."""
    return f"change={number}-{uuid.uuid4().hex}"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(df: DataFrame, pointer: dict, folder: str) -> None:
    """The rows in a folder per bucket; a bucket's rows are gathered first, so it is one file."""
    n, keys = pointer["buckets"], pointer["keys"]
    rows = df.withColumn(BUCKET, _bucket(keys, n)).repartition(BUCKET)
    rows.sortWithinPartitions(BUCKET, *keys).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)


def _read(spark: SparkSession, root: str, pointer: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    schema = StructType.fromJson(pointer["schema"])
    held = pointer["held"] if buckets is None else {str(b): pointer["held"][str(b)] for b in buckets if str(b) in pointer["held"]}
    paths = [f"{root}/{folder}/{BUCKET}={bucket}" for bucket, folder in held.items()]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def _written(spark: SparkSession, folder: str) -> list[int]:
    return [int(name.split("=")[1]) for name in folders(spark, folder) if name.startswith(f"{BUCKET}=")]


def create(df: DataFrame, root: str, keys: Sequence[str], buckets: int) -> None:
    """Make a table of ``df``, which has each combination of ``keys`` once. ``buckets`` stays for the table's life;
    the pointer has an entry for each of them, so some thousands are a fair most."""
    spark = df.sparkSession
    pointer = {"number": 0, "keys": list(keys), "buckets": buckets, "schema": df.schema.jsonValue()}
    folder = _new_change(0)
    _write(df, pointer, f"{root}/{folder}")
    pointer["held"] = {str(b): folder for b in _written(spark, f"{root}/{folder}")}
    _publish(spark, root, pointer)


def read(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The table as it is, or as it was after change ``number``."""
    return _read(spark, root, _pointer(spark, root, number))


def _touched(changes: DataFrame, pointer: dict) -> list[int]:
    """The buckets of the keys of ``changes``."""
    return sorted(r[0] for r in changes.select(_bucket(pointer["keys"], pointer["buckets"])).distinct().collect())


def read_touched(spark: SparkSession, root: str, changes: DataFrame) -> DataFrame:
    """The rows of the buckets that hold keys of ``changes``."""
    pointer = _pointer(spark, root)
    return _read(spark, root, pointer, _touched(changes, pointer))


def last_change(spark: SparkSession, root: str) -> int:
    """The number of the newest change; the table as it was made is 0."""
    return _pointers(spark, root)[-1]


def change(changes: DataFrame, root: str, how: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
    """Replace the buckets that hold keys of ``changes`` by ``how(rows of these buckets, changes)``.

    Returns the number of the change. ``how`` gets the buckets' present rows and must return all rows that they hold
    afterwards; its rows of other buckets would be lost and are refused. The driver sees the numbers of the buckets.
    """
    spark = changes.sparkSession
    pointer = _pointer(spark, root)
    touched = _touched(changes, pointer)
    if not touched:
        return pointer["number"]
    new = {**pointer, "number": pointer["number"] + 1}
    folder = _new_change(new["number"])
    present = _read(spark, root, pointer, touched)
    _write(how(present, changes).select(*present.columns), pointer, f"{root}/{folder}")
    written = _written(spark, f"{root}/{folder}")
    if not set(written) <= set(touched):
        raise ValueError("a change must not add rows with other keys than those of its changes")
    new["held"] = {b: f for b, f in pointer["held"].items() if int(b) not in touched} | {str(b): folder for b in written}
    _publish(spark, root, new)
    return new["number"]


def change_by_key(changes: DataFrame, root: str, order: Sequence[str] | None = None, stamp: Column | None = None) -> int:
    """``upsert`` of the touched part of the table."""
    keys = _pointer(changes.sparkSession, root)["keys"]
    return change(changes, root, lambda present, new: upsert(present, new, keys, order, stamp))


def restock(requests: DataFrame, root: str, receipts_to: Callable[[DataFrame], None], stamp: Column | None = None) -> int:
    """``apply_reorders`` to the touched part of a stock table. ``receipts_to`` writes the receipts and is called before
    the stock changes; when it is called again after a failure the receipts are the same."""

    def how(present: DataFrame, new: DataFrame) -> DataFrame:
        after, receipts = apply_reorders(present, new, stamp)
        receipts_to(receipts)
        return after

    return change(requests, root, how)


def drop_old(spark: SparkSession, root: str, keep: int) -> None:
    """Remove all but the newest ``keep`` states, and the folders that none of these names.

    The folder of a change that is being made has a higher number than all pointers and stays.
    """
    numbers = _pointers(spark, root)
    kept, gone = numbers[-max(1, keep) :], numbers[: -max(1, keep)]
    used = {folder for number in kept for folder in _pointer(spark, root, number)["held"].values()}
    for number in gone:
        remove(spark, f"{root}/pointers/{number:012d}.json")
    for name in folders(spark, root):
        if name.startswith("change=") and name not in used and int(name.split("=")[1].split("-")[0]) <= kept[-1]:
            remove(spark, f"{root}/{name}")
