"""Independent Spark jobs side by side."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(spark: SparkSession, *steps: Callable[[], Any]) -> list[Any]:
    """Run the steps at once and return their results in order; the first failure is raised.

    Small jobs leave most of a cluster idle; tables that do not read each other can share it.
    """
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [r.result() for r in running]
