"""Silver pings over the bronze stream, appended batch by batch.

Each micro-batch of new bronze lines is appended to the live silver table
(:mod:`transitlake.plans.live`) under its number in the stream, which a replayed
batch keeps; :func:`update_silver_pings` can compact the table afterwards.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from transitlake.plans.live import LIVE_PINGS, append_pings, compact_pings
from transitlake.sources.lake import STREAMED_GPS, Lake

BRONZE_GPS_SCHEMA = "value string, _ingestion_timestamp timestamp, _source_file string"


def start_silver_ping_stream(
    spark: SparkSession,
    lake: Lake,
    table: str = LIVE_PINGS,
    max_files_per_trigger: int = 1000,
    source_table: str = STREAMED_GPS,
) -> StreamingQuery:
    """``availableNow`` stream from ``bronze/<source_table>`` into the live silver table."""
    source = (
        spark.readStream.schema(BRONZE_GPS_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(lake.path("bronze", source_table))
    )
    return (
        source.writeStream.foreachBatch(lambda df, batch: append_pings(spark, lake, df, batch, table))
        .option("checkpointLocation", os.path.join(lake.root, "_checkpoints", f"silver_{table}"))
        .trigger(availableNow=True)
        .start()
    )


def update_silver_pings(spark: SparkSession, lake: Lake, compact: bool = False, **kwargs) -> None:
    """Append every bronze file not seen yet to the live silver pings, then stop (and ``compact`` them)."""
    query = start_silver_ping_stream(spark, lake, **kwargs)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    if compact:
        compact_pings(spark, lake, kwargs.get("table", LIVE_PINGS))
