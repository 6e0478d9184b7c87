"""Stored profiles: each partition is profiled once, and the parts are merged.

The profile of a table (rows, NULLs of each column, distinct values of each
column) is kept as one row of state for each partition and column: two counts
and a mergeable distinct sketch (HyperLogLog).  A run lists the table's files,
profiles the partitions that are new or whose files have changed, appends their
state and merges the states of the partitions that are there now, so its cost
goes with what is new and not with the table.  The sketch estimates distinct
values within a few percent; :func:`transitlake.operators.duplicate_profile` stays
the exact way, over the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlake.operators import quoted
from transitlake.sources.lake import Lake

#: Buckets of a sketch, as a power of two: a standard error of about 1.6 %.
SKETCH_BITS = 12
STATE = "part string, stamp string, column_name string, rows bigint, nulls bigint, sketch binary"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def partition_stamps(spark: SparkSession, lake: Lake, layer: str, table: str, by: str) -> DataFrame:
    """(part, stamp) of each partition folder: its files' number, bytes and last change (contents are not read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(lake.path(layer, table))
    return (
        files.select(F.regexp_extract("path", f"/{by}=([^/]*)/", 1).alias("part"), "length", "modificationTime")
        .groupBy("part")
        .agg(F.concat_ws(":", F.count(F.lit(1)), F.sum("length"), F.max("modificationTime").cast("string")).alias("stamp"))
    )


def partition_states(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """(part, column_name, rows, nulls, sketch) of each partition value of ``by``, in one aggregate."""
    entries = []
    for c in columns:
        value = quoted(c) if dict(df.dtypes)[c] in ("int", "bigint", "string") else quoted(c).cast("string")
        entries.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(quoted(c).isNull()).alias("nulls"),
                F.hll_sketch_agg(value, F.lit(SKETCH_BITS)).alias("sketch"),
            )
        )
    part = F.coalesce(quoted(by).cast("string"), F.lit(NO_VALUE)).alias("part")
    states = df.groupBy(part).agg(F.count(F.lit(1)).alias("rows"), F.array(*entries).alias("entries"))
    return states.select("part", "rows", F.inline("entries"))


def update_profile(spark: SparkSession, lake: Lake, layer: str, table: str, by: str) -> int:
    """Profile the partitions of ``by`` that are new or changed; how many there were."""
    name = f"{table}.profile"
    stamps = partition_stamps(spark, lake, layer, table, by)
    if lake.exists(spark, layer, name):
        stamps = stamps.join(lake.read(spark, layer, name, schema=STATE), ["part", "stamp"], "left_anti")
    new = {r.part: r.stamp for r in stamps.collect()}  # partition folders, not data
    if not new:
        return 0
    value = quoted(by).cast("string")
    mine = value.isin([p for p in new if p != NO_VALUE])
    mine = F.coalesce(mine, F.lit(NO_VALUE in new))
    rows = lake.read(spark, layer, table).filter(mine)
    columns = [c for c in rows.columns if c != by]
    named = spark.createDataFrame(list(new.items()), "part string, stamp string")
    states = partition_states(rows, by, columns).join(F.broadcast(named), "part")
    lake.write(states.select(*[c.split()[0] for c in STATE.split(", ")]), layer, name, mode="append")
    return len(new)


def merged_profile(spark: SparkSession, lake: Lake, layer: str, table: str, by: str) -> DataFrame:
    """(layer, table_name, column_name, rows, nulls, distinct_estimate) from the stored states of the present partitions."""
    states = lake.read(spark, layer, f"{table}.profile", schema=STATE)
    present = states.join(partition_stamps(spark, lake, layer, table, by), ["part", "stamp"], "left_semi")
    return (
        # a partition may have been profiled twice by runs at the same time: once is enough
        present.dropDuplicates(["part", "column_name"])
        .groupBy("column_name")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("nulls").alias("nulls"),
            F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"),
        )
        .select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "column_name", "rows", "nulls", "distinct_estimate")
    )
