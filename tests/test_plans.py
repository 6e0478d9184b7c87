"""The physical-plan properties the design relies on, asserted on the
production path (silver tables read back from a lake)."""

import re

import pytest
from pyspark.sql import functions as F

from transitlake.functions import lenient_int
from transitlake.plans import daily, layers, pings, routes, trips
from transitlake.sources import adapters
from transitlake.sources.lake import Lake


def plan_of(df) -> str:
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


@pytest.fixture(scope="module")
def lake(spark, sf_small):
    lake = Lake.on_shared_storage(spark)
    landing = layers.land(
        spark, lake, adapters.gps_raw(spark, sf_small), adapters.routes_raw(spark, sf_small), adapters.trips_raw(spark, sf_small)
    )
    layers.run_bronze(spark, lake, landing)
    layers.run_silver(spark, lake)
    return lake


def gold(spark, lake):
    s = {t: lake.read(spark, "silver", t) for t in ("gps", "linhas", "mco")}
    return daily.daily_performance(s["gps"], s["linhas"], s["mco"])


def test_trip_filter_and_pruning_reach_the_scan(spark, lake):
    plan = plan_of(gold(spark, lake))
    assert "GreaterThanOrEqual(duracao_viagem_minutos,0.0)" in plan
    assert "LessThanOrEqual(velocidade_kmh,120)" in plan
    # the trip scan reads only the five columns the aggregate needs
    assert "ReadSchema: struct<data_viagem:date,numero_linha:int,duracao_viagem_minutos:double,nome_consorcio:string,teve_falha_mecanica:boolean>" in plan


def test_gold_aggregates_are_partial(spark, lake):
    # no broadcast hint: AQE picks the joins from measured bytes when it runs
    plan = plan_of(gold(spark, lake))
    assert plan.count("partial_count") >= 1 and "partial_sum" in plan


def test_silver_trips_is_narrow(spark, lake):
    plan = plan_of(trips.silver_trips(lake.read(spark, "bronze", "mco")))
    assert "Exchange" not in plan


def method_sizes(df) -> list[int]:
    """Bytes of the largest method of each whole-stage program of a plan without exchanges."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:([0-9]+)", text)]


def test_trip_parsing_is_small_enough_to_be_compiled(spark, lake, sf_small):
    """The JVM interprets methods above 8000 bytes; from stored bronze and over the adapters none is."""
    stored = method_sizes(trips.silver_trips(lake.read(spark, "bronze", "mco")))
    fused = method_sizes(trips.silver_trips(adapters.trips_raw(spark, sf_small)))
    assert stored and max(stored + fused) < 6000


def test_malformed_numbers_do_not_reach_a_cast(spark):
    """A cast that fails raises inside: texts that are no number by the rule must be NULL before any cast."""
    df = spark.createDataFrame([("junk",), ("12x",), ("",), ("7",)], "s string")
    plan = plan_of(df.select(lenient_int("s").alias("n"), lenient_int("s", apart=True).alias("m")))
    assert plan.count("RLIKE") >= 4
    got = df.select(lenient_int("s").alias("n"), lenient_int("s", apart=True).alias("m")).collect()
    assert [tuple(r) for r in got] == [(None, None)] * 3 + [(7, 7)]


def test_bucketed_trips_are_aggregated_without_a_shuffle(spark, lake, sf_small):
    """From buckets of day and line, the trips' aggregate has no exchange below it; unbucketed it has one."""
    from oracle.compare import compare, duck
    from oracle.duckdb_sql import SQL
    from transitlake.sources import bucketed

    stored = lake.read(spark, "silver", "mco")
    keys = bucketed.GOLD_BUCKETS["mco"]
    bucketed.write_bucketed(stored, lake, "silver", "mco_b", keys, 4, "trips_in_buckets")
    again = bucketed.declare(spark, lake, "silver", "mco_b", spark.table("trips_in_buckets").schema, keys, 4, "trips_declared_again")
    lookup = daily.route_lookup(lake.read(spark, "silver", "linhas"))

    def aggregate(trips_of):
        kept = trips_of.filter("duracao_viagem_minutos >= 0")
        return plan_of(kept.groupBy("data_viagem", "numero_linha", "nome_consorcio").count())

    try:
        for t in (spark.table("trips_in_buckets"), again):
            plan = aggregate(t)
            assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
            joined = plan_of(daily.trip_indicators(t, lookup))
            assert "Exchange hashpartitioning(data_viagem" not in joined
        assert "Exchange hashpartitioning(data_viagem" in aggregate(stored)
        ok, msg = compare(daily.trip_indicators(again, lookup), duck(sf_small), SQL["trip_indicators"])
        assert ok, msg
    finally:
        for name in ("trips_in_buckets", "trips_declared_again"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_trip_predicates_are_not_inlined_into_the_parsing(spark, sf_small):
    """The duration filter over trips parsed in the same plan stays above the parsing: each text is made once."""
    parsed = trips.silver_trips(adapters.trips_raw(spark, sf_small))
    plan = plan_of(daily.trip_indicators(parsed, daily.route_lookup(routes.silver_routes(adapters.routes_raw(spark, sf_small)))))
    # the day's text, and hour and minute of both clocks
    assert plan.count("date_format(") == 1 and plan.count("lpad(") == 4


def test_ping_predicates_are_not_inlined_into_the_parsing(spark, sf_small):
    """Header, separator and coordinate tests: a line's time is formatted for the line and for the header's two tests, no more."""
    plan = plan_of(pings.silver_pings(adapters.gps_raw(spark, sf_small)))
    # three branches of the dump
    assert plan.count("date_format(") <= 9


def test_landing_files_are_compressed_and_keep_their_lines(spark, sf_small):
    import os

    out = Lake.on_shared_storage(spark)
    raw = adapters.gps_raw(spark, sf_small), adapters.routes_raw(spark, sf_small), adapters.trips_raw(spark, sf_small)
    landing = layers.land(spark, out, *raw)
    for path in (landing.pings, landing.routes, landing.trips):
        names = [n for n in os.listdir(path) if n.startswith("part-")]
        assert names and all(n.endswith(".gz") for n in names)
    for got, want in zip(layers.bronze_frames(spark, landing).values(), raw, strict=True):
        got = got.na.fill("")
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_layer_profile_shuffles_fingerprints(spark, lake):
    """Rows are grouped by their fingerprint, in the shuffle too, and the counts are those of the rows themselves."""
    plan = plan_of(layers.profile_layer(spark, lake, "silver"))
    exact = layers.profile_layer(spark, lake, "silver", fingerprint=False)
    assert "xxhash64(" in plan and "hashpartitioning(timestamp_gps" not in plan and "hashpartitioning(timestamp_gps" in plan_of(exact)
    assert sorted(map(str, layers.profile_layer(spark, lake, "silver").collect())) == sorted(map(str, exact.collect()))
