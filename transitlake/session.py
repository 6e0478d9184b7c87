"""Session builder for local runs, tests and the benchmark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def _driver_memory() -> str:
    """Half of physical memory, capped at 8 GB (local mode runs in the driver)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "2g"
    return f"{max(1, min(8, int(total * 0.5 / 2**30)))}g"


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "transitlake") -> SparkSession:
    """Local session with AQE on and the web UI off."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", _driver_memory())
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
