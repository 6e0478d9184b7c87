"""Named queries over a warehouse directory, one per operator group.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the warehouse tables (through :mod:`transitlake.sources.adapters`), so
every query grows with the data.  Queries that exercise sinks write under
a fresh directory in the session's shared checkpoint folder and return
what they read back.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlake.operators import (
    RuleViolation,
    contract_report,
    drift_report,
    drop_columns,
    duplicate_profile,
    normalize_names,
    null_profile,
    profile_table,
    project,
    rule_report,
    stamp_ingestion,
)
from transitlake.operators.contracts import Contract
from transitlake.plans import daily, layers, pings, profiles, routes, trips
from transitlake.sources import adapters, bucketed
from transitlake.sources.lake import STREAMED_GPS, Lake

Query = Callable[[SparkSession, str], DataFrame]


# -- silver inputs ---------------------------------------------------------

def _silver_pings(spark, d):
    return pings.silver_pings(adapters.gps_raw(spark, d))


def _silver_trips(spark, d):
    return trips.silver_trips(adapters.trips_raw(spark, d))


def _silver_routes(spark, d):
    return routes.silver_routes(adapters.routes_raw(spark, d))


def _daily(spark, d):
    return daily.daily_performance(_silver_pings(spark, d), _silver_routes(spark, d), _silver_trips(spark, d))


# -- GPS pings -------------------------------------------------------------

def ping_lines_parsed(spark, d):
    return pings.parse_ping_lines(pings.drop_header_lines(adapters.gps_raw(spark, d)))


def _typed_pings(spark, d):
    return pings.type_pings(ping_lines_parsed(spark, d))


def pings_typed(spark, d):
    return project(_typed_pings(spark, d), pings.SILVER_PINGS.columns)


def pings_valid_coordinates(spark, d):
    return project(pings.drop_null_island(_typed_pings(spark, d)), pings.SILVER_PINGS.columns)


def silver_pings(spark, d):
    return _silver_pings(spark, d)


# -- trips -----------------------------------------------------------------

def trips_normalized_names(spark, d):
    return drop_columns(normalize_names(adapters.trips_raw(spark, d)), trips.CONSUMED_COLUMNS)


def trips_blank_to_null(spark, d):
    named = normalize_names(adapters.trips_raw(spark, d))
    return trips.blank_texts(named).select(*trips.TEXT_COLUMNS_TO_BLANK)


def trips_span(spark, d):
    df = trips.add_trip_span(trips.type_trips(adapters.trips_raw(spark, d)))
    return df.select(
        "viagem", "saida", "chegada", "data_fechamento", "data_viagem", "dh_fechamento",
        "ts_saida", "ts_chegada", "duracao_viagem_minutos",
    )


def trips_labels(spark, d):
    df = trips.label_trips(trips.blank_texts(trips.type_trips(adapters.trips_raw(spark, d))))
    return df.select(
        "concessionaria", "pc", "falha_mecanica", "evento_inseguro", "nome_consorcio",
        "desc_tipo_viagem", "teve_falha_mecanica", "teve_evento_inseguro",
        F.col("pc").isin(1, 2).alias("viagem_normal"),
    )


def silver_trips(spark, d):
    return _silver_trips(spark, d)


def silver_trips_sn_flags(spark, d):
    """Trips with S/N flags through the silver layer run, with that coding as an option."""
    lake = Lake.on_shared_storage(spark)
    lake.write(adapters.sn_trips_raw(spark, d), "bronze", "mco")
    layers.run_silver(spark, lake, tables=["mco"], options={"mco": {"flag_labels": ("S",)}})
    return lake.read(spark, "silver", "mco")


# -- routes ----------------------------------------------------------------

def route_codes(spark, d):
    return routes.parse_route_codes(adapters.routes_raw(spark, d)).select(
        "NumeroLinha", "Linha", "numero_linha", "cod_linha_publico", "num_sublinha", "nome_bruto"
    )


def route_itinerary(spark, d):
    df = routes.itinerary_details(routes.split_itinerary(routes.parse_route_codes(adapters.routes_raw(spark, d))))
    return df.select("numero_linha", "nome_bruto", "bairro_origem", "bairro_destino", "desc_variacao")


def silver_routes(spark, d):
    return _silver_routes(spark, d)


# -- gold ------------------------------------------------------------------

def ping_metrics(spark, d):
    return daily.ping_metrics(_silver_pings(spark, d))


def route_lookup(spark, d):
    return daily.route_lookup(_silver_routes(spark, d))


def trips_enriched(spark, d):
    return daily.enrich_trips(_silver_trips(spark, d), daily.route_lookup(_silver_routes(spark, d)))


def trip_indicators(spark, d):
    return daily.trip_indicators(_silver_trips(spark, d), daily.route_lookup(_silver_routes(spark, d)))


def daily_performance(spark, d):
    return _daily(spark, d)


# -- quality and contracts -------------------------------------------------

def trips_null_profile(spark, d):
    return null_profile(_silver_trips(spark, d))


def gps_duplicate_profile(spark, d):
    return duplicate_profile(adapters.gps_raw(spark, d))


def _flawed_daily(spark, d):
    """The fact over trips with malformed line ids and lines of two consortia."""
    flawed = trips.silver_trips(adapters.flawed_trips_raw(spark, d))
    return daily.daily_performance(_silver_pings(spark, d), _silver_routes(spark, d), flawed)


def fact_key_duplicates(spark, d):
    return duplicate_profile(_flawed_daily(spark, d), keys=["data_referencia", "numero_linha"])


def gold_rule_report(spark, d):
    """Rules counted on a fact with NULL lines, and (set here) NULL days and negative counts."""
    line = F.col("numero_linha")
    fact = _flawed_daily(spark, d).withColumns(
        {
            "qtd_falhas_mecanicas": F.when(line % 5 == 0, -F.col("qtd_falhas_mecanicas")).otherwise(F.col("qtd_falhas_mecanicas")),
            "data_referencia": F.when(line % 7 == 3, F.lit(None)).otherwise(F.col("data_referencia")),
        }
    )
    return rule_report(fact, daily.gold_rules(fact))


def contract_checks(spark, d):
    """Contracts of every layer's tables, each stored once and then counted in one
    aggregate, and of a route catalogue that lacks a column."""
    lake = Lake.on_shared_storage(spark)
    raw = {"gps": adapters.gps_raw(spark, d), "linhas": adapters.routes_raw(spark, d), "mco": adapters.trips_raw(spark, d)}
    for table, df in raw.items():
        lake.write(df, "bronze", table)
    layers.run_silver(spark, lake)
    layers.run_gold(spark, lake)
    bronze = {table: lake.read(spark, "bronze", table) for table in raw}
    parsed = pings.parse_ping_lines(pings.drop_header_lines(bronze["gps"]))
    lacking = Contract(routes.RAW_ROUTES.table, "lacking", routes.RAW_ROUTES.columns)
    reports = [
        contract_report(bronze["gps"], Contract("bronze.gps", "input", ["value"])),
        contract_report(parsed, Contract("bronze.gps", "parsed", pings.GPS_FIELDS)),
        contract_report(normalize_names(bronze["mco"]), trips.RAW_TRIPS),
        contract_report(bronze["linhas"], routes.RAW_ROUTES),
        contract_report(bronze["linhas"].drop("Nome"), lacking),
        contract_report(lake.read(spark, "silver", "mco"), trips.SILVER_TRIPS),
        contract_report(lake.read(spark, "silver", "linhas"), routes.SILVER_ROUTES),
        contract_report(lake.read(spark, "gold", layers.GOLD_TABLE), daily.GOLD_FACT),
    ]
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def schema_drift(spark, d):
    """Contracts with types against silver tables as built, and against trips as another
    producer sends them, with the values that the drift would lose."""
    silver = _silver_trips(spark, d)
    reports = [
        drift_report(_silver_pings(spark, d), pings.SILVER_PINGS),
        drift_report(_silver_routes(spark, d), routes.SILVER_ROUTES),
        drift_report(silver, trips.SILVER_TRIPS),
        drift_report(adapters.drifted_trips(silver), replace(trips.SILVER_TRIPS, stage="drifted")),
    ]
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def gold_policies(spark, d):
    """The gold run over trips without line ids, under each policy in turn: whether it
    failed, and what readers of the table and of the quarantine find afterwards."""
    lake = Lake.on_shared_storage(spark)
    lake.write(trips.silver_trips(adapters.flawed_trips_raw(spark, d)), "silver", "mco")
    lake.write(_silver_pings(spark, d), "silver", "gps")
    lake.write(_silver_routes(spark, d), "silver", "linhas")
    out = None
    for policy in ("fail", "warn", "quarantine"):
        failed = False
        try:
            layers.run_gold(spark, lake, policy)
        except RuleViolation:
            failed = True
        there = lake.exists(spark, "gold", layers.GOLD_TABLE)
        facts = lake.read(spark, "gold", layers.GOLD_TABLE) if there else _daily(spark, d).limit(0)
        bad = lake.read_quarantine(spark, "gold", layers.GOLD_TABLE) if there else facts.limit(0)
        line, side = F.col("numero_linha"), F.col("side")
        both = facts.select(line, F.lit("table").alias("side")).unionByName(bad.select(line, F.lit("quarantine").alias("side")))
        one = both.agg(
            F.lit(policy).alias("policy"),
            F.lit(failed).alias("failed"),
            F.count_if(side == "table").alias("published"),
            F.count_if((side == "table") & line.isNull()).alias("published_without_line"),
            F.count_if(side == "quarantine").alias("quarantined"),
        )
        # each policy's counts before the next one publishes
        name = f"_policy_{policy}"
        lake.write(one, "silver", name)
        one = lake.read(spark, "silver", name)
        out = one if out is None else out.unionByName(one)
    return out


def bucketed_trip_indicators(spark, d):
    """Trip indicators from silver trips stored in buckets of day and line, which the
    aggregation reads without a shuffle."""
    lake = Lake.on_shared_storage(spark)
    name = f"silver_mco_{os.path.basename(lake.root)}"
    keys = bucketed.GOLD_BUCKETS["mco"]
    bucketed.write_bucketed(_silver_trips(spark, d), lake, "silver", "mco", keys, 16, name)
    return daily.trip_indicators(spark.table(name), daily.route_lookup(_silver_routes(spark, d)))


def stored_profiles(spark, d):
    """Silver pings profiled as their days arrive: the days up to ``REWRITE_FROM``, then the
    later ones, then nothing.  The merged profile, whether its distinct estimates are within 5 %
    of the exact counts, and the days that each run read."""
    lake = Lake.on_shared_storage(spark)
    day, first = F.col("data_particao"), F.lit(REWRITE_FROM).cast("date")
    lake.write(_silver_pings(spark, d), "silver", "built", ["data_particao"])
    built = lake.read(spark, "silver", "built")
    runs = []
    for run, part in enumerate((day < first, day >= first, None)):
        if part is not None:
            lake.write(built.filter(part), "silver", "gps", ["data_particao"])
        runs.append((run, profiles.update_profile(spark, lake, "silver", "gps", "data_particao")))
    merged = profiles.merged_profile(spark, lake, "silver", "gps", "data_particao")
    names = [c for c in built.columns if c != "data_particao"]
    exact = built.agg(F.array(*[F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("exact")) for c in names]).alias("e"))
    near = F.abs(F.col("distinct_estimate") - F.col("exact")) <= 0.05 * F.col("exact")
    profiled = merged.join(exact.select(F.inline("e")), "column_name").select(
        "column_name", "rows", "nulls", near.alias("distinct_near"), F.lit(None).cast("int").alias("run"), F.lit(None).cast("bigint").alias("days")
    )
    read = spark.createDataFrame(runs, "run int, days bigint").select(
        F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("bigint").alias("rows"),
        F.lit(None).cast("bigint").alias("nulls"), F.lit(None).cast("boolean").alias("distinct_near"), "run", "days",
    )
    return profiled.unionByName(read)


def stamped_files(spark, d):
    """Bronze rows stamped with the file that each came from: rows of each table, those
    whose file lies in its landing folder, and those stamped while the run lasted."""
    lake, landing = _landing(spark, d)
    out = None
    for t, df in layers.bronze_frames(spark, landing).items():
        began = F.lit(spark.sql("SELECT current_timestamp() AS t").first()["t"])
        lake.write(stamp_ingestion(df, None), "bronze", t)
        ended = F.lit(spark.sql("SELECT current_timestamp() AS t").first()["t"])
        one = lake.read(spark, "bronze", t).agg(
            F.lit(t).alias("table_name"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("_source_file").contains(f"/landing/{t}/part-")).alias("rows_with_their_file"),
            F.count_if(F.col("_ingestion_timestamp").between(began, ended)).alias("rows_stamped_in_run"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def substitute_sink(spark, d):
    """The silver run with another sink (a lake of ORC tables): observed rows, and the
    rows found in that sink and in the lake itself."""
    lake, landing = _landing(spark, d)
    layers.run_bronze(spark, lake, landing)
    other = Lake.on_shared_storage(spark, "orc")
    observed = layers.run_silver(spark, lake, sink=other.write)
    out = None
    for t, n in observed.items():
        one = other.read(spark, "silver", t).agg(
            F.lit(t).alias("table_name"),
            F.lit(n).cast("bigint").alias("observed_rows"),
            F.count(F.lit(1)).alias("rows_in_sink"),
            F.lit(lake.exists(spark, "silver", t)).alias("in_lake"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def routes_table_profile(spark, d):
    return profile_table(_silver_routes(spark, d), "silver", "linhas")


# -- sources and sinks -----------------------------------------------------

def _landing(spark, d) -> tuple[Lake, layers.LandingFiles]:
    lake = Lake.on_shared_storage(spark)
    landing = layers.land(
        spark, lake, adapters.gps_raw(spark, d), adapters.routes_raw(spark, d), adapters.trips_raw(spark, d)
    )
    return lake, landing


def _bronze_roundtrip(spark, d, table: str) -> DataFrame:
    """Land one raw table as its file format, read it back as bronze does,
    stamp and store it, and return the stored table (minus the timestamp)."""
    from transitlake.sources.lake import read_delimited, read_lines, write_delimited, write_lines

    lake = Lake.on_shared_storage(spark)
    path = lake.path("landing", table)
    if table == "gps":
        raw = read_lines(spark, write_lines(adapters.gps_raw(spark, d), path))
    elif table == "linhas":
        raw = read_delimited(spark, write_delimited(adapters.routes_raw(spark, d), path, ","), ",")
    else:
        raw = read_delimited(spark, write_delimited(adapters.trips_raw(spark, d), path, ";"), ";")
    lake.write(stamp_ingestion(raw, table), "bronze", table)
    return lake.read(spark, "bronze", table).drop("_ingestion_timestamp")


def bronze_gps_roundtrip(spark, d):
    return _bronze_roundtrip(spark, d, "gps")


def bronze_routes_roundtrip(spark, d):
    return _bronze_roundtrip(spark, d, "linhas")


def bronze_trips_roundtrip(spark, d):
    return _bronze_roundtrip(spark, d, "mco")


def streamed_bronze_gps(spark, d):
    """GPS dump files ingested incrementally into bronze (several
    micro-batches of four files each), then a second run that must find
    nothing new; the bronze table read back."""
    from transitlake.sources.lake import write_lines
    from transitlake.streaming import ingest_gps_incrementally

    lake = Lake.on_shared_storage(spark)
    landing = write_lines(adapters.gps_raw(spark, d), lake.path("landing", "gps"))
    ingest_gps_incrementally(spark, landing, lake, max_files_per_trigger=4)
    ingest_gps_incrementally(spark, landing, lake, max_files_per_trigger=4)
    return lake.read(spark, "bronze", STREAMED_GPS).select("value", "_source_file")


def mixed_bronze_gps(spark, d):
    """The same dump loaded by batch, then by the stream, then by batch again; all
    bronze GPS lines read back (each line once from either writer)."""
    from transitlake.sources.lake import read_lines, write_lines
    from transitlake.streaming import ingest_gps_incrementally

    lake = Lake.on_shared_storage(spark)
    landing = write_lines(adapters.gps_raw(spark, d), lake.path("landing", "gps"))
    raw = stamp_ingestion(read_lines(spark, landing), "batch")
    lake.write(raw, "bronze", "gps")
    ingest_gps_incrementally(spark, landing, lake, source_label="stream")
    lake.write(raw, "bronze", "gps")
    ingest_gps_incrementally(spark, landing, lake, source_label="stream")
    return lake.read_gps(spark).select("value", "_source_file")


def streamed_silver_pings(spark, d):
    """GPS dump files streamed into bronze, then bronze streamed into silver
    pings: each micro-batch is appended, all are compacted at the end; the live table
    read back.  Must equal the batch build."""
    from transitlake.plans.live import read_live_pings
    from transitlake.sources.lake import write_lines
    from transitlake.streaming import ingest_gps_incrementally, update_silver_pings

    lake = Lake.on_shared_storage(spark)
    landing = write_lines(adapters.gps_raw(spark, d), lake.path("landing", "gps"))
    ingest_gps_incrementally(spark, landing, lake, max_files_per_trigger=4)
    update_silver_pings(spark, lake, compact=True, max_files_per_trigger=8)
    return read_live_pings(spark, lake)


def live_silver_pings(spark, d):
    """Half of the dump streamed and compacted, then the other half streamed: the live
    table read over its base and the later batches, which share vehicles and days."""
    from transitlake.plans.live import read_live_pings
    from transitlake.sources.lake import write_lines
    from transitlake.streaming import ingest_gps_incrementally, update_silver_pings

    lake = Lake.on_shared_storage(spark)
    raw, half = adapters.gps_raw(spark, d), F.crc32(F.col("value").cast("binary")) % 2
    for part, compact in ((0, True), (1, False)):
        landing = write_lines(raw.filter(half == part), lake.path("landing", "gps"), mode="append")
        ingest_gps_incrementally(spark, landing, lake)
        update_silver_pings(spark, lake, compact=compact)
    return read_live_pings(spark, lake)


def incremental_bronze_pings(spark, d):
    """Dump files loaded by batch as they arrive: half of the files, the other half, and
    a third time nothing; bronze lines with the run that loaded them, and each run's count."""
    from transitlake.sources.lake import read_lines, write_lines
    from transitlake.sources.loads import load_new_files, read_loaded

    lake = Lake.on_shared_storage(spark)
    raw, folder = adapters.gps_raw(spark, d), lake.path("landing", "gps")
    runs = []
    for run, part in enumerate((0, 1, None)):
        if part is not None:
            write_lines(raw.filter(F.crc32(F.col("value").cast("binary")) % 2 == part), f"{folder}/arrival={part}")
        runs.append((run, load_new_files(spark, lake, "gps", folder, read_lines)["rows"]))
    counted = spark.createDataFrame(runs, "run int, loaded bigint").select(F.lit(None).cast("string").alias("value"), "run", "loaded")
    arrived = F.regexp_extract("_source_file", "arrival=([0-9])", 1).cast("int")
    lines = read_loaded(spark, lake, "gps").select("value", arrived.alias("run"), F.lit(1).cast("bigint").alias("loaded"))
    return lines.unionByName(counted)


def malformed_records(spark, d):
    """Landing files with broken records, loaded with rescue: each quarantined record, and
    how many clean ones each table holds."""
    from transitlake.sources.lake import RESCUED, write_delimited, write_lines

    lake, landing = _landing(spark, d)
    write_lines(adapters.broken_pings_raw(spark, d), landing.pings, mode="append")
    for bad in (adapters.short_routes_raw, adapters.long_routes_raw):
        write_delimited(bad(spark, d), landing.routes, ",", mode="append")
    layers.run_bronze(spark, lake, landing, rescue=True)
    out = None
    for t in ("gps", "linhas", "mco"):
        kept = lake.read(spark, "bronze", t).agg(F.lit(None).cast("string").alias("record"), F.count(F.lit(1)).alias("n"))
        bad = lake.read_quarantine(spark, "bronze", t).groupBy(F.col(RESCUED).alias("record")).agg(F.count(F.lit(1)).alias("n"))
        one = kept.unionByName(bad).select(F.lit(t).alias("table_name"), "record", "n")
        out = one if out is None else out.unionByName(one)
    return out


# Day from which the partition-overwrite query re-writes the ping table.
REWRITE_FROM = "2024-01-16"


def partitioned_overwrite(spark, d, fmt="parquet"):
    """Write silver pings by day, then overwrite the days from ``REWRITE_FROM``
    with their in-range pings only; the earlier days must be untouched."""
    lake = Lake.on_shared_storage(spark, fmt)
    df = _silver_pings(spark, d)
    lake.write(df, "silver", "gps", ["data_particao"])
    later = lake.read(spark, "silver", "gps").filter(F.col("data_particao") >= F.lit(REWRITE_FROM).cast("date"))
    fixed = later.filter(F.col("velocidade_kmh").between(0, daily.MAX_SPEED_KMH))
    # Materialise before overwriting the partitions it was read from.
    staged = "gps_rewrite"
    lake.write(fixed, "silver", staged, ["data_particao"])
    lake.write(lake.read(spark, "silver", staged), "silver", "gps", ["data_particao"])
    return project(lake.read(spark, "silver", "gps"), pings.SILVER_PINGS.columns)


def observed_silver_counts(spark, d):
    """Silver layer written with observed row counts, next to the counts
    Spark reads back from the stored tables."""
    lake, landing = _landing(spark, d)
    layers.run_bronze(spark, lake, landing)
    observed = layers.run_silver(spark, lake)
    stored = None
    for table, n in observed.items():
        one = lake.read(spark, "silver", table).agg(
            F.lit(table).alias("table_name"),
            F.lit(n).cast("bigint").alias("observed_rows"),
            F.count(F.lit(1)).alias("stored_rows"),
        )
        stored = one if stored is None else stored.unionByName(one)
    return stored


def medallion_end_to_end(spark, d):
    """Landing files -> bronze -> silver -> gold through the lake; the
    published gold table read back."""
    lake, landing = _landing(spark, d)
    return layers.run_medallion(spark, lake, landing)


def layer_profiles(spark, d):
    """Null/duplicate profile of every silver table after a layer run."""
    lake, landing = _landing(spark, d)
    layers.run_bronze(spark, lake, landing)
    layers.run_silver(spark, lake)
    return layers.profile_layer(spark, lake, "silver")


def bronze_layer_profiles(spark, d):
    """Null/duplicate profile of every bronze table."""
    lake, landing = _landing(spark, d)
    layers.run_bronze(spark, lake, landing)
    return layers.profile_layer(spark, lake, "bronze")


def gold_layer_profile(spark, d):
    """Null/duplicate profile of the published gold table after all layer runs."""
    lake, landing = _landing(spark, d)
    layers.run_medallion(spark, lake, landing, profile=False)
    return layers.profile_layer(spark, lake, "gold")


QUERIES: dict[str, Query] = {
    "ping_lines_parsed": ping_lines_parsed,
    "pings_typed": pings_typed,
    "pings_valid_coordinates": pings_valid_coordinates,
    "silver_pings": silver_pings,
    "trips_normalized_names": trips_normalized_names,
    "trips_blank_to_null": trips_blank_to_null,
    "trips_span": trips_span,
    "trips_labels": trips_labels,
    "silver_trips": silver_trips,
    "silver_trips_sn_flags": silver_trips_sn_flags,
    "route_codes": route_codes,
    "route_itinerary": route_itinerary,
    "silver_routes": silver_routes,
    "ping_metrics": ping_metrics,
    "route_lookup": route_lookup,
    "trips_enriched": trips_enriched,
    "trip_indicators": trip_indicators,
    "daily_performance": daily_performance,
    "trips_null_profile": trips_null_profile,
    "gps_duplicate_profile": gps_duplicate_profile,
    "fact_key_duplicates": fact_key_duplicates,
    "gold_rule_report": gold_rule_report,
    "contract_checks": contract_checks,
    "routes_table_profile": routes_table_profile,
    "bronze_gps_roundtrip": bronze_gps_roundtrip,
    "bronze_routes_roundtrip": bronze_routes_roundtrip,
    "bronze_trips_roundtrip": bronze_trips_roundtrip,
    "streamed_bronze_gps": streamed_bronze_gps,
    "mixed_bronze_gps": mixed_bronze_gps,
    "streamed_silver_pings": streamed_silver_pings,
    "live_silver_pings": live_silver_pings,
    "incremental_bronze_pings": incremental_bronze_pings,
    "malformed_records": malformed_records,
    "schema_drift": schema_drift,
    "gold_policies": gold_policies,
    "bucketed_trip_indicators": bucketed_trip_indicators,
    "stored_profiles": stored_profiles,
    "stamped_files": stamped_files,
    "substitute_sink": substitute_sink,
    "partitioned_overwrite": partitioned_overwrite,
    "partitioned_overwrite_orc": lambda spark, d: partitioned_overwrite(spark, d, "orc"),
    "observed_silver_counts": observed_silver_counts,
    "medallion_end_to_end": medallion_end_to_end,
    "layer_profiles": layer_profiles,
    "bronze_layer_profiles": bronze_layer_profiles,
    "gold_layer_profile": gold_layer_profile,
}
