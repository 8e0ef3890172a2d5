"""Running several jobs of one application at the same time."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import TypeVar

from pyspark import InheritableThread
from pyspark.sql import SparkSession

T = TypeVar("T")


def side_by_side(spark: SparkSession, tasks: Mapping[str, Callable[[], T]]) -> tuple[dict[str, T], dict[str, Exception]]:
    """Results and failures of ``tasks``, each run in a thread with its own scheduler pool and job group.

    One failure does not end the others. Every task is in one of the two: whoever needs all of them must look at the
    failures. Pools share the cores evenly if the application runs with
    ``spark.scheduler.mode`` FAIR; otherwise a task gets what those started before it leave idle.
    """
    results: dict[str, T] = {}
    # A task has failed until it has returned, so one whose thread ends in any other way is told as well.
    failures: dict[str, Exception] = {name: RuntimeError(f"{name} ended without a result") for name in tasks}

    def run(name: str, task: Callable[[], T]) -> None:
        try:
            context = spark.sparkContext
            context.setLocalProperty("spark.scheduler.pool", name)
            context.setJobGroup(name, name)
            results[name] = task()
            del failures[name]
        except Exception as error:  # noqa: BLE001  (told to the caller)
            failures[name] = error
        except BaseException as error:  # noqa: BLE001  (an exit ends this thread only)
            failures[name].__cause__ = error

    threads = [InheritableThread(target=run, args=(name, task), session=spark) for name, task in tasks.items()]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    return {name: results[name] for name in tasks if name in results}, failures
