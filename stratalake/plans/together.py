"""Independent steps of a flow as concurrent jobs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")


def run_together(spark: SparkSession, steps: Mapping[str, Callable[[], Result]], at_once: int = 4) -> dict[str, Result]:
    """Results of all steps by name, in the order given, or the first error.

    Each step has a scheduler pool of its own, which shares the executors evenly where the cluster
    schedules fairly.  Steps must not depend on each other.  When one fails, jobs of the others are
    cancelled and steps that wait are not begun, so the flow ends as a whole.
    """
    context = spark.sparkContext
    group = f"together-{uuid.uuid4().hex}"

    def run(name: str, step: Callable[[], Result]) -> Result:
        context.setJobGroup(group, name, interruptOnCancel=True)
        context.setLocalProperty("spark.scheduler.pool", name)
        return step()

    with ThreadPoolExecutor(max_workers=at_once) as threads:
        # Local properties of this thread go along, those that a step sets stay in its own.
        started = {name: threads.submit(inheritable_thread_target(spark)(run), name, step) for name, step in steps.items()}
        done, _ = wait(started.values(), return_when=FIRST_EXCEPTION)
        failed = [f for f in done if f.exception() is not None]
        if failed:
            for future in started.values():
                future.cancel()
            context.cancelJobGroup(group)
            raise failed[0].exception()
    return {name: future.result() for name, future in started.items()}
