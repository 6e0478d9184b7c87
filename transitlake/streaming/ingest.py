"""Incremental bronze ingestion of GPS dump files.

The GPS source is a feed that keeps producing dump files; re-reading the
whole landing folder on every run does not scale.  This runs the same
bronze step (text lines + ingestion stamp) as a Structured Streaming query
over the landing folder: each run picks up only files it has not seen
(tracked in the checkpoint), appends them to ``bronze/gps_stream`` (apart from
batch loads; ``Lake.read_gps`` reads both) and stops
(``availableNow``).  The file sink commits through its own metadata log,
so a run that dies half-way is redone from the checkpoint without
duplicating rows.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from transitlake.operators import stamp_ingestion
from transitlake.sources.lake import STREAMED_GPS, Lake

TEXT_SCHEMA = "value string"


def start_gps_bronze_stream(
    spark: SparkSession,
    landing_dir: str,
    lake: Lake,
    source_label: str = "gps",
    table: str = STREAMED_GPS,
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Start an ``availableNow`` stream from ``landing_dir`` into bronze."""
    lines = (
        spark.readStream.schema(TEXT_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .text(landing_dir)
    )
    return (
        stamp_ingestion(lines, source_label)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", lake.path("bronze", table))
        .option("checkpointLocation", os.path.join(lake.root, "_checkpoints", f"bronze_{table}"))
        .trigger(availableNow=True)
        .start()
    )


def ingest_gps_incrementally(spark: SparkSession, landing_dir: str, lake: Lake, **kwargs) -> None:
    """Run one incremental ingestion to completion."""
    query = start_gps_bronze_stream(spark, landing_dir, lake, **kwargs)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
