"""Bucketed silver tables: rows stored the way that gold groups them.

A table bucketed by the keys of an aggregation is read back already dealt out
by them, so the aggregation needs no shuffle: each task reads one bucket and
groups it.  Trips are bucketed by day and line, which the trip indicators group
by (with the consortium, which only refines it), and pings by day and line
code; a line or a day of any size is then spread over buckets, which a bucket key of
the line alone would not do.

Bucketing is known to the session's catalog, not to the files: another session
declares the table again over the same folder (:func:`declare`), with the
schema, keys and number of buckets that it was written with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from transitlake.operators import quoted
from transitlake.sources.lake import Lake

#: Keys of the silver tables that gold aggregates.
GOLD_BUCKETS = {"mco": ("data_viagem", "numero_linha"), "gps": ("data_particao", "numero_linha")}


def write_bucketed(
    df: DataFrame, lake: Lake, layer: str, table: str, keys: Sequence[str], buckets: int, name: str
) -> str:
    """Write ``<layer>/<table>.buckets`` in ``buckets`` buckets as catalog table ``name``; returns the path.

    Rows are dealt out by the same hash first, so a bucket is one file, and
    sorted by the keys inside it.  ``buckets`` fixes the number of tasks that read
    the table: about its bytes over the size wanted for a task.
    """
    path = f"{lake.path(layer, table)}.buckets"
    dealt = df.repartition(buckets, *[quoted(k) for k in keys])
    writer = dealt.write.format(lake.fmt).bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).mode("overwrite").saveAsTable(name)
    return path


def declare(spark: SparkSession, lake: Lake, layer: str, table: str, schema, keys: Sequence[str], buckets: int, name: str) -> DataFrame:
    """The stored table under ``name`` in this session's catalog."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING {lake.fmt} CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS "
        f"LOCATION '{lake.path(layer, table)}.buckets'"
    )
    return spark.table(name)
