"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def run_parallel(spark: SparkSession, jobs: Sequence[Callable[[], T]], workers: int = 4) -> list[T]:
    """Submit the jobs from a few driver threads; the first error is raised after all have ended."""
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [f.result() for f in futures]
