"""Layer runs: landing files -> bronze -> silver -> gold, with profiles.

Layers talk only through tables in the lake, so every layer boundary also
cuts the lineage: a lost executor re-runs tasks of the current layer
only.  Row counts ride on the writes as ``Observation`` metrics instead of
extra ``count()`` jobs.  Gold is written once, as a version of its own; its
rule counts are observed during that single write, and only then is the
version committed (:mod:`transitlake.sources.published`), so readers never see
half a table and a rejected one not at all.
"""

from __future__ import annotations

import logging
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from transitlake.operators import RuleViolation, profile_table, rule_report
from transitlake.plans.daily import GOLD_FACT, daily_performance, gold_rules
from transitlake.plans.live import read_live_pings
from transitlake.plans.pings import HEADER_PREFIX, SILVER_PINGS, silver_pings
from transitlake.plans.routes import SILVER_ROUTES, silver_routes
from transitlake.plans.trips import SILVER_TRIPS, silver_trips
from transitlake.sources.lake import (
    CLEAN,
    RESCUED,
    VERDICT,
    Lake,
    read_delimited,
    read_lines,
    write_delimited,
    write_lines,
)

log = logging.getLogger(__name__)

GOLD_TABLE = "fato_performance_diaria"
SILVER_TABLES = {
    "gps": (silver_pings, SILVER_PINGS),
    "mco": (silver_trips, SILVER_TRIPS),
    "linhas": (silver_routes, SILVER_ROUTES),
}


@dataclass(frozen=True)
class LandingFiles:
    """Where the raw files are: GPS text dump, route CSV (``,``), trip CSV (``;``)."""

    pings: str
    routes: str
    trips: str


def land(
    spark: SparkSession, lake: Lake, pings: DataFrame, routes: DataFrame, trips: DataFrame, parallel: bool = True
) -> LandingFiles:
    """Write raw-shaped DataFrames as the (gzip) landing files the bronze layer reads."""
    paths = _run_tables(
        {
            "gps": lambda: write_lines(pings, lake.path("landing", "gps"), compression="gzip"),
            "linhas": lambda: write_delimited(routes, lake.path("landing", "linhas"), ",", compression="gzip"),
            "mco": lambda: write_delimited(trips, lake.path("landing", "mco"), ";", compression="gzip"),
        },
        parallel,
    )
    return LandingFiles(pings=paths["gps"], routes=paths["linhas"], trips=paths["mco"])


def bronze_frames(spark: SparkSession, landing: LandingFiles) -> dict[str, DataFrame]:
    """Raw files as all-text DataFrames (no stamping yet)."""
    return {
        "gps": read_lines(spark, landing.pings),
        "linhas": read_delimited(spark, landing.routes, ","),
        "mco": read_delimited(spark, landing.trips, ";"),
    }


def _observed_write(lake: Lake, df: DataFrame, layer: str, table: str, partition_by=(), sink=None) -> int:
    # Layer runs rebuild each table from the whole layer below, so the
    # table is replaced as a whole (no stale partitions survive).
    obs = Observation(f"{layer}.{table}.{uuid.uuid4().hex[:8]}")
    (sink or lake.write)(
        df, layer, table, partition_by, replace="table",
        observation=obs, metrics=[F.count(F.lit(1)).alias("rows")],
    )
    return int(obs.get["rows"])


def _run_tables(jobs: dict, parallel: bool) -> dict:
    """Run independent table writes, concurrently when ``parallel``.

    The tables of one layer do not depend on each other; submitting their
    jobs from a few driver threads lets the scheduler run the small ones
    alongside the big one instead of after it.  Any failure is re-raised.
    """
    if not parallel or len(jobs) < 2:
        return {table: job() for table, job in jobs.items()}
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {table: pool.submit(job) for table, job in jobs.items()}
        return {table: f.result() for table, f in futures.items()}


MALFORMED = "malformed"


def bronze_verdicts(spark: SparkSession, landing: LandingFiles) -> dict[str, DataFrame]:
    """Raw files with a verdict on each record: a GPS line without the separator that
    parsing needs, or a CSV record that does not fit its header, is malformed and
    kept whole in ``_rescued``."""
    line = F.col("value")
    broken = ~line.startswith(HEADER_PREFIX) & ~line.contains(",")
    lines = read_lines(spark, landing.pings).withColumn(RESCUED, F.when(broken, line))
    raw = {
        "gps": lines,
        "linhas": read_delimited(spark, landing.routes, ",", rescue=True),
        "mco": read_delimited(spark, landing.trips, ";", rescue=True),
    }
    verdict = F.when(F.col(RESCUED).isNull(), F.lit(CLEAN)).otherwise(F.lit(MALFORMED))
    return {table: df.withColumn(VERDICT, verdict) for table, df in raw.items()}


def run_bronze(
    spark: SparkSession, lake: Lake, landing: LandingFiles, parallel: bool = True, rescue: bool = False
) -> dict[str, int]:
    """Stamp and store the raw files as Parquet; returns rows written.

    With ``rescue``, malformed records are told apart in the same write: readers
    of the table get the clean ones, :meth:`Lake.read_quarantine` the others.
    """
    from transitlake.operators import stamp_ingestion

    frames = bronze_verdicts(spark, landing) if rescue else bronze_frames(spark, landing)

    def job(table, df):
        return lambda: _observed_write(lake, stamp_ingestion(df, table), "bronze", table, [VERDICT] if rescue else ())

    return _run_tables({t: job(t, df) for t, df in frames.items()}, parallel)


def run_silver(
    spark: SparkSession, lake: Lake, parallel: bool = True, tables=None, options: dict | None = None, sink=None
) -> dict[str, int]:
    """Bronze -> silver for the three tables (or those named); returns rows written.

    ``options`` maps a table to keyword arguments of its builder, such as
    ``{"mco": {"flag_labels": ("S",)}, "gps": {"strip_quotes": True}}``.
    ``sink`` takes the place of ``lake.write`` (same arguments; it must run an
    action on the rows, which carry the observed count).
    """
    options = options or {}
    wanted = list(SILVER_TABLES) if tables is None else list(tables)
    unknown = [t for t in (*wanted, *options) if t not in SILVER_TABLES]
    if unknown:
        raise ValueError(f"unknown silver tables {unknown}")

    def job(table, build, contract):
        def write():
            bronze = lake.read_gps(spark) if table == "gps" else lake.read(spark, "bronze", table)
            df = build(bronze, **options.get(table, {}))
            return _observed_write(lake, df, "silver", table, contract.partition_by, sink)

        return write

    return _run_tables({t: job(t, *SILVER_TABLES[t]) for t in wanted}, parallel)


VIOLATING = "violating"


def run_gold(
    spark: SparkSession, lake: Lake, policy: str = "fail", live_pings: bool = False, keep_versions: int = 2, **options
) -> dict[str, int]:
    """Silver -> gold fact table, validated before it is published.

    ``options`` go to :func:`daily_performance` (``line_key``, ``gps_match``);
    ``live_pings`` takes the pings that the stream keeps up to date.

    The rule counts (NULL day, NULL line, negative metric) are observed on
    the one write, which goes to a new version of the table.  Policies on a
    violation: ``"fail"`` raises and publishes nothing; ``"warn"`` publishes
    all rows; ``"quarantine"`` writes a verdict with each row, as the first
    partition level, so that readers of the table get the clean rows and
    ``lake.read_quarantine`` the violating ones, from one write.
    """
    if policy not in ("fail", "warn", "quarantine"):
        raise ValueError(f"unknown policy {policy!r}")
    fact = daily_performance(
        read_live_pings(spark, lake) if live_pings else lake.read(spark, "silver", "gps"),
        lake.read(spark, "silver", "linhas"),
        lake.read(spark, "silver", "mco"),
        **options,
    ).select(*GOLD_FACT.columns)
    rules = gold_rules(fact)
    partition_by = list(GOLD_FACT.partition_by)
    if policy == "quarantine":
        hit = F.greatest(*[F.coalesce(p, F.lit(False)) for p in rules.values()])
        fact = fact.withColumn(VERDICT, F.when(hit, F.lit(VIOLATING)).otherwise(F.lit(CLEAN)))
        partition_by = [VERDICT, *partition_by]
    obs = Observation(f"gold.{uuid.uuid4().hex[:8]}")
    counts = [F.count(F.lit(1)).alias("rows")] + [F.count_if(p).alias(n) for n, p in rules.items()]
    table, version = lake.published("gold", GOLD_TABLE), uuid.uuid4().hex
    lake.write(
        fact, "gold", GOLD_TABLE, partition_by, replace="table", observation=obs, metrics=counts, path=table.folder(version)
    )
    metrics = {k: int(v) for k, v in obs.get.items()}
    broken = [(name, metrics[name]) for name in rules if metrics[name] > 0]
    if broken and policy == "fail":
        table.discard(spark, version)
        name, n = broken[0]
        raise RuleViolation(f"rule {name!r} failed on {n} rows; gold not published")
    table.commit(spark, fact.schema, {"": version})
    table.retire(spark, keep_versions)
    return metrics


def profile_layer(spark: SparkSession, lake: Lake, layer: str, fingerprint: bool = True) -> DataFrame:
    """Null and duplicate profile of every table of a layer, as one DataFrame.

    Duplicates are counted on 128-bit row fingerprints, since whole rows would be
    shuffled and spilled once more; ``fingerprint=False`` groups the rows themselves
    (see :func:`transitlake.operators.duplicate_profile`)."""
    tables = {
        "bronze": ["gps", "linhas", "mco"],
        "silver": ["gps", "linhas", "mco"],
        "gold": [GOLD_TABLE],
    }[layer]
    out = None
    for t in tables:
        p = profile_table(lake.read(spark, layer, t), layer, t, fingerprint=fingerprint)
        out = p if out is None else out.unionByName(p)
    return out


def report_profile(profile: DataFrame) -> list[str]:
    """Log (and return) one message per NULL-bearing column and per table
    with duplicate rows.  The profile has one row per column and table, so
    collecting it is bounded by the schema, not by the data."""
    messages = []
    for r in profile.filter(F.col("value") > 0).collect():
        if r.metric == "null_count":
            msg = f"{r.layer}.{r.table_name}: column {r.column_name!r} has {r.value} NULL values"
        else:
            msg = f"{r.layer}.{r.table_name}: {r.value} duplicate rows"
        log.warning(msg)
        messages.append(msg)
    return messages


def run_layer(
    spark: SparkSession,
    lake: Lake,
    layer: str,
    landing: LandingFiles | None = None,
    policy: str = "fail",
    profile: bool = True,
    silver_options: dict | None = None,
    gold_options: dict | None = None,
) -> dict[str, int]:
    """Build one layer; with ``profile`` (the default) also profile its tables and log
    NULL and duplicate findings (they never fail the run).  The options are those
    of :func:`run_silver` and :func:`run_gold`."""
    if layer == "bronze":
        if landing is None:
            raise ValueError("the bronze layer needs landing files")
        out = run_bronze(spark, lake, landing)
    elif layer == "silver":
        out = run_silver(spark, lake, options=silver_options)
    elif layer == "gold":
        out = run_gold(spark, lake, policy, **(gold_options or {}))
    else:
        raise ValueError(f"unknown layer {layer!r}")
    if profile:
        report_profile(profile_layer(spark, lake, layer))
    return out


def run_medallion(
    spark: SparkSession, lake: Lake, landing: LandingFiles, policy: str = "fail", profile: bool = True, **options
) -> DataFrame:
    """All three layers in order; returns the published gold table."""
    for layer in ("bronze", "silver", "gold"):
        run_layer(spark, lake, layer, landing, policy, profile, **options)
    return lake.read(spark, "gold", GOLD_TABLE)


def gold_rule_report(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rule report over the published gold table (one small pass)."""
    fact = lake.read(spark, "gold", GOLD_TABLE)
    return rule_report(fact, gold_rules(fact))
