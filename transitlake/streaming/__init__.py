"""Structured Streaming entry points: incremental bronze and silver."""

from transitlake.streaming.ingest import ingest_gps_incrementally, start_gps_bronze_stream
from transitlake.streaming.silver import start_silver_ping_stream, update_silver_pings

__all__ = [
    "ingest_gps_incrementally",
    "start_gps_bronze_stream",
    "start_silver_ping_stream",
    "update_silver_pings",
]
