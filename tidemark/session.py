"""Session factory.

Only settings that hold on any cluster are fixed here.  Everything else (executor count, shuffle
partitions, memory) is left to ``spark-submit`` unless the master is local.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

BASE_SETTINGS = {
    # Timestamps are read and compared as UTC in every layer.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesces small partitions, switches to broadcast from measured sizes and
    # splits skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """Return a session; keyword settings use ``__`` for dots and win over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            digits = "".join(ch for ch in master if ch.isdigit())
            cores = int(digits) if digits else (os.cpu_count() or 4)
            builder = builder.config("spark.sql.shuffle.partitions", str(2 * cores)).config("spark.ui.enabled", "false")
    for key, value in BASE_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
