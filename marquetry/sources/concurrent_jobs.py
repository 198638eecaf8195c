"""Independent Spark jobs submitted at the same time.

With ``spark.scheduler.mode=FAIR`` they share the executors evenly.
"""

from __future__ import annotations

import contextvars
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

R = TypeVar("R")

#: Seconds between two cancellations, as a job that has failed to see one may start more.
AGAIN = 0.1


def run_together(
    spark: SparkSession, jobs: Mapping[str, Callable[[], R]], parallelism: int
) -> dict[str, R]:
    """Submit independent Spark jobs at once; the first failure stops all and is raised.

    Jobs that have not begun are dropped, the Spark jobs of those that run are
    cancelled by their tag, and the failure is raised when all have ended, so nothing
    runs on behind the caller's back. The jobs see the caller's context variables, so
    they stage into its scratch.
    """
    sc, tag = spark.sparkContext, f"together-{uuid.uuid4().hex}"

    def tagged(job: Callable[[], R]) -> R:
        sc.addJobTag(tag)
        try:
            return job()
        finally:
            sc.removeJobTag(tag)

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        waiting = {
            n: pool.submit(contextvars.copy_context().run, inheritable_thread_target(spark)(tagged), job)
            for n, job in jobs.items()
        }
        ended, running = wait(waiting.values(), return_when=FIRST_EXCEPTION)
        # In the order of submission, among those that ended before anything was cancelled.
        failed = next((f.exception() for f in waiting.values() if f in ended and f.exception()), None)
        if failed:
            for future in running:
                future.cancel()
            while running:
                sc.cancelJobsWithTag(tag)
                running = wait(running, timeout=AGAIN).not_done
            raise failed
        return {name: future.result() for name, future in waiting.items()}
