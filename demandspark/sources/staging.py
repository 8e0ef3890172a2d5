"""Where intermediate tables go: the shared folder the session names."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session that runs in this one process may go without it, and then uses a folder that
    goes with the process; a cluster must name one that every executor can reach.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _own_folder()


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="demandspark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def work_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_folder(spark)}/demandspark/{spark.sparkContext.applicationId}"


_SCRATCH: ContextVar[str] = ContextVar("scratch", default="")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet below the application's part of the shared folder."""
    return f"{work_folder(spark)}/{_SCRATCH.get()}{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[None]:
    """What is staged inside is removed at the end; write what is wanted of it to a folder taken before."""
    part = f"{name}-{uuid.uuid4().hex}/"
    token = _SCRATCH.set(part)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        remove(spark, f"{work_folder(spark)}/{part}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Cuts the lineage: an executor lost later re-reads files instead of recomputing, and
    several consumers do not recompute the input. The table stays until ``clear``, since
    results that are not computed yet may read it.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Remove all that this application has staged; call it when its results are written."""
    remove(spark, work_folder(spark))


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, wherever Spark can read it."""
    system, place = _file_system(spark, path)
    return [x.getPath().getName() for x in system.listStatus(place) if x.isDirectory()]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder; none if there is no such folder."""
    system, place = _file_system(spark, path)
    return [x.getPath().getName() for x in system.listStatus(place) if x.isFile()] if system.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    system, place = _file_system(spark, path)
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that nobody has written before; raises ``FileExistsError`` if there is one.

    The file appears whole: it is written under another name first.
    """
    system, place = _file_system(spark, path)
    fs = spark._jvm.org.apache.hadoop.fs
    draft = fs.Path(place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}")
    stream = system.create(draft)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    kind = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE  # refuses to replace a file
    try:
        fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, place, options)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "AlreadyExists" not in error.java_exception.getClass().getName():
            raise
        raise FileExistsError(path) from error
