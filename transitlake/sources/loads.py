"""Batch loads of files not loaded before.

A landing folder keeps its files, so a rerun would load them again.  A load
lists the folder, leaves out files that a committed load holds (same name,
size and time of change; a changed file counts as new), writes the rest to
``bronze/<table>.loaded`` under a number of its own, and then appends the files'
names with that number to ``bronze/<table>.loads``.  That append commits the load:
rows whose load is not listed are not read, so a load that died in between is
simply done again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from transitlake.operators import stamp_ingestion
from transitlake.sources.lake import Lake

LOADS = "load string, file string, bytes bigint, changed timestamp"


def _loads(spark: SparkSession, lake: Lake, table: str) -> DataFrame | None:
    name = f"{table}.loads"
    return lake.read(spark, "bronze", name, schema=LOADS) if lake.exists(spark, "bronze", name) else None


def new_files(spark: SparkSession, lake: Lake, table: str, folder: str) -> DataFrame:
    """(file, bytes, changed) of the folder's files that no committed load holds (contents are not read)."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("changed"))
    )
    loads = _loads(spark, lake, table)
    return found if loads is None else found.join(loads, ["file", "bytes", "changed"], "left_anti")


def load_new_files(
    spark: SparkSession, lake: Lake, table: str, folder: str, read: Callable[[SparkSession, Sequence[str]], DataFrame]
) -> dict[str, int]:
    """Load the folder's new files into ``bronze/<table>``; ``{"files": n, "rows": m}``.

    ``read`` turns paths into rows, such as :func:`read_lines`; each row is
    stamped with the file that it came from.
    """
    files = new_files(spark, lake, table, folder).collect()  # names alone, as every scan's file listing
    if not files:
        return {"files": 0, "rows": 0}
    load = uuid.uuid4().hex
    obs = Observation(f"load.{load[:8]}")
    rows = stamp_ingestion(read(spark, [f.file for f in files]), None).withColumn("load", F.lit(load))
    lake.write(
        rows, "bronze", f"{table}.loaded", ["load"], rebalance=False, observation=obs, metrics=[F.count(F.lit(1)).alias("rows")]
    )
    committed = spark.createDataFrame([(load, *f) for f in files], LOADS).coalesce(1)
    lake.write(committed, "bronze", f"{table}.loads", mode="append")
    return {"files": len(files), "rows": int(obs.get["rows"])}


def read_loaded(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """All rows of committed loads."""
    committed = _loads(spark, lake, table).select("load").distinct()
    return lake.read(spark, "bronze", f"{table}.loaded").join(committed, "load", "left_semi").drop("load")
