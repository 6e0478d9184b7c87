"""Silver pings kept up to date batch by batch: appended first, compacted later.

A batch of new bronze lines is parsed, typed, de-duplicated on its own and
appended under its batch number (``silver/<table>.batches``), so what is written is
in proportion to the batch; no day of the table is read or written again.  A
batch that is replayed replaces its own files only.

The table is a base (published day folders, see
:mod:`transitlake.sources.published`) and the batches that came after it.
Reading de-duplicates the days that these batches touch; all other days
are read as they are.  :func:`compact_pings` folds the batches into new folders
of the touched days and commits them with the number up to which batches are
now in the base; the other days keep their folders.

The survivor rule is a ``min`` over the non-key columns, which is
associative, commutative and idempotent, so base and batches in any order,
replayed or not, give the table of the batch build over all lines.  A stream
that starts over from an empty checkpoint counts its batches from 0 again, so
it needs a new table name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from transitlake.operators import dedup_by_key, project
from transitlake.plans.pings import PING_KEY, SILVER_PINGS, silver_pings
from transitlake.sources.lake import Lake

LIVE_PINGS = "gps_live"
DAY = SILVER_PINGS.partition_by[0]


def append_pings(spark: SparkSession, lake: Lake, lines: DataFrame, batch: int, table: str = LIVE_PINGS) -> None:
    """Append the pings of one batch of bronze lines, as batch number ``batch``."""
    pings = silver_pings(lines).withColumn("batch", F.lit(batch).cast("bigint"))
    lake.write(pings, "silver", f"{table}.batches", ["batch", DAY], replace="partitions")


def _batches(spark: SparkSession, lake: Lake, table: str, after: int) -> DataFrame | None:
    """Pings of the batches after number ``after``, with their number (a pruned partition filter)."""
    name = f"{table}.batches"
    if not lake.exists(spark, "silver", name):
        return None
    return lake.read(spark, "silver", name).filter(F.col("batch") > after)


def _touched(rows: DataFrame) -> Column | None:
    """Filter for the days of ``rows`` (calendar days, not data); None if there are no rows."""
    days = [r[0] for r in rows.select(DAY).distinct().collect()]
    if not days:
        return None
    known = F.coalesce(F.col(DAY).isin([d for d in days if d is not None]), F.lit(False))
    return known | F.col(DAY).isNull() if None in days else known


def _parts(spark: SparkSession, lake: Lake, table: str):
    """(commit, base, batches after it), each None if it is not there."""
    published = lake.published("silver", table)
    commit = published.latest(spark)
    base = project(published.read_commit(spark, commit), SILVER_PINGS.columns) if commit else None
    return commit, base, _batches(spark, lake, table, commit.through if commit else -1)


def read_live_pings(spark: SparkSession, lake: Lake, table: str = LIVE_PINGS) -> DataFrame:
    """The silver pings: base and later batches, one row for each key."""
    _, base, batches = _parts(spark, lake, table)
    touched = None if batches is None else _touched(batches)
    if touched is None:
        if base is None:
            # no ping yet: an empty batch says what the columns are
            return project(lake.read(spark, "silver", f"{table}.batches").limit(0), SILVER_PINGS.columns)
        return base
    new = project(batches, SILVER_PINGS.columns)
    if base is None:
        return dedup_by_key(new, PING_KEY)
    return base.filter(~touched).unionByName(dedup_by_key(base.filter(touched).unionByName(new), PING_KEY))


def compact_pings(spark: SparkSession, lake: Lake, table: str = LIVE_PINGS, keep: int = 2) -> int:
    """Fold the batches since the last compaction into the base; rows written (0: nothing new)."""
    commit, base, batches = _parts(spark, lake, table)
    upto = None if batches is None else batches.agg(F.max("batch")).first()[0]
    if upto is None:
        return 0
    # batches that arrive from now on stay outside
    new = batches.filter(F.col("batch") <= upto)
    touched, rows = _touched(new), project(new, SILVER_PINGS.columns)
    if base is not None:
        rows = rows.unionByName(base.filter(touched))
    merged = project(dedup_by_key(rows, PING_KEY), SILVER_PINGS.columns)
    published, version = lake.published("silver", table), uuid.uuid4().hex
    obs = Observation(f"compaction.{version[:8]}")
    counted = [F.count(F.lit(1)).alias("rows")]
    lake.write(merged, "silver", table, [DAY], replace="table", observation=obs, metrics=counted, path=published.folder(version))
    name = F.concat(F.lit(f"{DAY}="), F.coalesce(F.col(DAY).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
    renewed = {r[0]: version for r in new.select(name).distinct().collect()}
    schema = merged.schema
    published.commit(spark, schema, {**(commit.folders if commit else {}), **renewed}, through=upto)
    published.retire(spark, keep)
    return int(obs.get["rows"])
