"""Sinks and layer runs through a lake on the shared checkpoint folder."""

import pathlib
import zlib

import pytest
from pyspark.sql import functions as F

from oracle.compare import compare, duck
from oracle.duckdb_sql import SQL
from transitlake.catalog import QUERIES
from transitlake.operators import RuleViolation
from transitlake.plans import layers
from transitlake.sources import adapters
from transitlake.sources.lake import Lake, checkpoint_dir, read_lines, write_lines


def test_lake_lives_under_checkpoint_dir(spark):
    lake = Lake.on_shared_storage(spark)
    assert lake.root.startswith(checkpoint_dir(spark))


def test_dynamic_partition_overwrite(spark):
    lake = Lake.on_shared_storage(spark)
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "v int, day string")
    lake.write(df, "silver", "t", ["day"])
    lake.write(spark.createDataFrame([(9, "b")], "v int, day string"), "silver", "t", ["day"])
    got = sorted((r.v, r.day) for r in lake.read(spark, "silver", "t").collect())
    assert got == [(1, "a"), (3, "c"), (9, "b")]


def test_medallion_publishes_gold(spark, sf_small):
    lake = Lake.on_shared_storage(spark)
    landing = layers.land(
        spark, lake, adapters.gps_raw(spark, sf_small), adapters.routes_raw(spark, sf_small), adapters.trips_raw(spark, sf_small)
    )
    gold = layers.run_medallion(spark, lake, landing)
    ok, msg = compare(gold, duck(sf_small), SQL["daily_performance"])
    assert ok, msg
    report = {r.rule: r.violations for r in layers.gold_rule_report(spark, lake).collect()}
    assert report == {"data_referencia_null": 0, "numero_linha_null": 0, "negative_metric": 0}
    profiles = layers.profile_layer(spark, lake, "gold").filter(F.col("metric") == "duplicate_rows").first()
    assert profiles.value == 0


def test_gold_not_published_on_violation(spark, sf_small):
    lake = Lake.on_shared_storage(spark)
    # a silver layer whose trips have no line id -> NULL numero_linha in gold
    trips = QUERIES["silver_trips"](spark, sf_small).withColumn("numero_linha", F.lit(None).cast("int"))
    lake.write(trips, "silver", "mco", ["ano", "mes"])
    lake.write(QUERIES["silver_pings"](spark, sf_small), "silver", "gps", ["data_particao"])
    lake.write(QUERIES["silver_routes"](spark, sf_small), "silver", "linhas")
    with pytest.raises(RuleViolation, match="numero_linha_null"):
        layers.run_gold(spark, lake)
    assert not lake.exists(spark, "gold", layers.GOLD_TABLE)
    assert not list(pathlib.Path(lake.root, "gold").rglob("v=*"))  # the rejected version is gone
    metrics = layers.run_gold(spark, lake, policy="warn")
    assert metrics["numero_linha_null"] == metrics["rows"] > 0


class _FakeConf:
    def __init__(self, master):
        self.master = master

    def get(self, key, default=None):
        return self.master if key == "spark.master" else default


class _FakeContext:
    def __init__(self):
        self.registered = None

    def getCheckpointDir(self):
        return self.registered

    def setCheckpointDir(self, path):
        self.registered = path


class _FakeSession:
    def __init__(self, master="local[2]"):
        self.conf = _FakeConf(master)
        self.sparkContext = _FakeContext()


def test_checkpoint_dir_fallback_registers_without_conf_set():
    fake = _FakeSession()
    first = checkpoint_dir(fake)
    assert fake.sparkContext.registered == first
    assert checkpoint_dir(fake) == first


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]", "yarn", ""])
def test_cluster_without_checkpoint_dir_is_refused(master):
    with pytest.raises(RuntimeError):
        checkpoint_dir(_FakeSession(master))


def test_exists_only_hides_a_missing_path(spark, tmp_path):
    lake = Lake(str(tmp_path))
    assert not lake.exists(spark, "silver", "gps")
    (tmp_path / "silver" / "gps").mkdir(parents=True)
    (tmp_path / "silver" / "gps" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        lake.exists(spark, "silver", "gps")


def test_orc_partition_overwrite_keeps_other_days(spark, tmp_path):
    lake = Lake(str(tmp_path), "orc")
    lake.write(spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string"), "silver", "t", ["day"])
    lake.write(spark.createDataFrame([(9, "b")], "v int, day string"), "silver", "t", ["day"])
    assert sorted((r.v, r.day) for r in lake.read(spark, "silver", "t").collect()) == [(1, "a"), (9, "b")]


def test_whole_table_replace_drops_stale_partitions(spark):
    lake = Lake.on_shared_storage(spark)
    lake.write(spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string"), "gold", "t", ["day"])
    lake.write(spark.createDataFrame([(9, "b")], "v int, day string"), "gold", "t", ["day"], replace="table")
    assert [(r.v, r.day) for r in lake.read(spark, "gold", "t").collect()] == [(9, "b")]


def test_gold_rerun_is_idempotent(spark, sf_small):
    lake = Lake.on_shared_storage(spark)
    landing = layers.land(
        spark, lake, adapters.gps_raw(spark, sf_small), adapters.routes_raw(spark, sf_small), adapters.trips_raw(spark, sf_small)
    )
    first = layers.run_medallion(spark, lake, landing).count()
    layers.run_layer(spark, lake, "gold")
    assert lake.read(spark, "gold", layers.GOLD_TABLE).count() == first


def test_gold_quarantine_policy(spark, sf_small):
    lake = Lake.on_shared_storage(spark)
    silver_trips = QUERIES["silver_trips"](spark, sf_small)
    # every trip of line 5 loses its line id -> those fact rows break a rule
    broken = silver_trips.withColumn(
        "numero_linha", F.when(F.col("numero_linha") == 5, F.lit(None).cast("int")).otherwise(F.col("numero_linha"))
    )
    lake.write(broken, "silver", "mco", ["ano", "mes"])
    lake.write(QUERIES["silver_pings"](spark, sf_small), "silver", "gps", ["data_particao"])
    lake.write(QUERIES["silver_routes"](spark, sf_small), "silver", "linhas")
    metrics = layers.run_gold(spark, lake, policy="quarantine")
    published = lake.read(spark, "gold", layers.GOLD_TABLE)
    quarantined = lake.read_quarantine(spark, "gold", layers.GOLD_TABLE)
    assert quarantined.count() == metrics["numero_linha_null"] > 0
    assert published.filter(F.col("numero_linha").isNull()).count() == 0
    assert published.count() + quarantined.count() == metrics["rows"]


def test_source_file_lineage_option(spark):
    lake = Lake.on_shared_storage(spark)
    from transitlake.operators import stamp_ingestion
    from transitlake.sources.lake import read_lines, write_lines

    path = write_lines(spark.createDataFrame([("a",), ("b",)], "value string"), lake.path("landing", "x"))
    rows = stamp_ingestion(read_lines(spark, path)).select("_source_file").collect()
    assert all(r._source_file.startswith("file:") and "landing/x" in r._source_file for r in rows)


def test_layer_profile_messages(spark, sf_small, caplog):
    import logging

    lake = Lake.on_shared_storage(spark)
    landing = layers.land(
        spark, lake, adapters.gps_raw(spark, sf_small), adapters.routes_raw(spark, sf_small), adapters.trips_raw(spark, sf_small)
    )
    with caplog.at_level(logging.WARNING, logger="transitlake.plans.layers"):
        layers.run_layer(spark, lake, "bronze", landing, profile=True)
    text = caplog.text
    assert "bronze.gps:" in text and "duplicate rows" in text  # repeated dump lines
    assert "bronze.mco: column 'CHEGADA' has" in text  # blank arrivals read back as NULL


def test_lake_format_is_a_parameter(spark):
    # D9: the layer format is chosen once; reads and profiles go through it
    from transitlake.operators import null_profile

    lake = Lake(Lake.on_shared_storage(spark).root, fmt="orc")
    df = spark.createDataFrame([(1, None), (2, "b")], "v int, w string")
    lake.write(df, "silver", "t")
    back = lake.read(spark, "silver", "t")
    assert sorted(back.collect()) == sorted(df.collect())
    assert {r.column_name: r.null_count for r in null_profile(back).collect()} == {"v": 0, "w": 1}


def test_command_line_runs_layers(spark, sf_small, capsys):
    from transitlake.__main__ import main

    lake = Lake.on_shared_storage(spark)
    landing = layers.land(
        spark, lake, adapters.gps_raw(spark, sf_small), adapters.routes_raw(spark, sf_small), adapters.trips_raw(spark, sf_small)
    )
    main(["--lake", lake.root, "--gps", landing.pings, "--routes", landing.routes, "--trips", landing.trips])
    out = [line for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert [json_layer(x) for x in out] == ["bronze", "silver", "gold"]
    assert lake.read(spark, "gold", layers.GOLD_TABLE).count() > 0


def json_layer(line):
    import json

    return json.loads(line)["layer"]


def test_empty_partitioned_table_reads_back_empty(spark):
    lake = Lake.on_shared_storage(spark)
    empty = spark.createDataFrame([], "v int, day string")
    lake.write(empty, "silver", "t", ["day"])
    back = lake.read(spark, "silver", "t")
    assert back.count() == 0 and set(back.columns) == {"v", "day"}
    lake.write(spark.createDataFrame([(1, "a")], "v int, day string"), "silver", "t", ["day"])
    assert [tuple(r) for r in lake.read(spark, "silver", "t").select("v", "day").collect()] == [(1, "a")]


def test_gold_with_no_pings(spark, sf_small):
    lake = Lake.on_shared_storage(spark)
    pings_empty = QUERIES["silver_pings"](spark, sf_small).limit(0)
    lake.write(pings_empty, "silver", "gps", ["data_particao"])
    lake.write(QUERIES["silver_trips"](spark, sf_small), "silver", "mco", ["ano", "mes"])
    lake.write(QUERIES["silver_routes"](spark, sf_small), "silver", "linhas")
    layers.run_gold(spark, lake)
    gold = lake.read(spark, "gold", layers.GOLD_TABLE)
    assert gold.count() > 0 and gold.filter(F.col("vel_maxima_gps").isNotNull()).count() == 0


def test_command_line_layer_subset_and_options(spark, sf_small, capsys, caplog):
    import logging

    from transitlake.__main__ import main

    lake = Lake.on_shared_storage(spark)
    landing = layers.land(
        spark, lake, adapters.gps_raw(spark, sf_small), adapters.routes_raw(spark, sf_small), adapters.trips_raw(spark, sf_small)
    )
    args = ["--lake", lake.root, "--gps", landing.pings, "--routes", landing.routes, "--trips", landing.trips]
    main(args + ["--layers", "bronze,silver"])
    with caplog.at_level(logging.WARNING, logger="transitlake.plans.layers"):
        main(["--lake", lake.root, "--layers", "gold", "--policy", "quarantine", "--profile"])
    out = [json_layer(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert out == ["bronze", "silver", "gold"]
    assert "gold.fato_performance_diaria" in caplog.text  # profile messages were logged


def test_silver_run_with_options_and_a_substitute_sink(spark, sf_small):
    """The builders' options and another sink reach the layer run; unknown tables are refused."""
    lake = Lake.on_shared_storage(spark)
    lake.write(adapters.sn_trips_raw(spark, sf_small), "bronze", "mco")
    seen = []

    def sink(df, layer, table, partition_by=(), observation=None, metrics=(), **_):
        df = df.observe(observation, *metrics)
        seen.append((layer, table, tuple(partition_by), df.filter("teve_falha_mecanica").count()))

    options = {"mco": {"flag_labels": ("S",)}}
    rows = layers.run_silver(spark, lake, tables=["mco"], options=options, sink=sink)
    assert seen[0][:3] == ("silver", "mco", ("ano", "mes")) and seen[0][3] > 0
    assert rows["mco"] == lake.read(spark, "bronze", "mco").count()
    assert not lake.exists(spark, "silver", "mco")
    layers.run_silver(spark, lake, tables=["mco"])
    assert lake.read(spark, "silver", "mco").filter("teve_falha_mecanica").count() == 0
    with pytest.raises(ValueError, match="unknown silver tables"):
        layers.run_silver(spark, lake, options={"buses": {}})


def test_a_reader_keeps_its_version_while_another_is_published(spark, sf_small):
    """Rows of a DataFrame opened before a publish stay as they were; a new reader sees the new table; old versions go."""
    lake = Lake.on_shared_storage(spark)
    table = lake.published("gold", "t")
    readers = []
    for n in range(4):
        version = f"v{n}"
        lake.write(spark.range(n + 1).withColumn("day", F.lit(f"d{n}")), "gold", "t", ["day"], replace="table", path=table.folder(version))
        if readers:
            # written, not committed: nobody sees it
            assert lake.read(spark, "gold", "t").count() == n
            assert readers[-1].count() == n
        table.commit(spark, spark.range(1).withColumn("day", F.lit("")).schema, {"": version})
        table.retire(spark, keep=2)
        readers.append(lake.read(spark, "gold", "t"))
        assert readers[-1].count() == n + 1
        if n:
            assert readers[-2].count() == n  # the version before is still there
    assert sorted(p.name for p in pathlib.Path(table.versions).glob("v=*")) == ["v=v2", "v=v3"]


def test_gold_run_leaves_versions_and_a_log_alone(spark, sf_small):
    lake = Lake.on_shared_storage(spark)
    for name, table in (("silver_trips", "mco"), ("silver_pings", "gps"), ("silver_routes", "linhas")):
        lake.write(QUERIES[name](spark, sf_small), "silver", table)
    for _ in range(3):
        layers.run_gold(spark, lake)
    names = {p.name for p in pathlib.Path(lake.root, "gold").iterdir()}
    assert names == {f"{layers.GOLD_TABLE}.versions", f"{layers.GOLD_TABLE}.commits"}
    assert len(list(pathlib.Path(lake.published("gold", layers.GOLD_TABLE).versions).glob("v=*"))) == 2


def test_unknown_formats_are_refused():
    with pytest.raises(ValueError, match="unknown table format 'delta'"):
        Lake("/nowhere", "delta")


def test_a_load_that_died_is_done_again(spark, monkeypatch):
    from transitlake.sources.lake import read_lines, write_lines
    from transitlake.sources.loads import load_new_files, read_loaded

    lake = Lake.on_shared_storage(spark)
    folder = write_lines(spark.createDataFrame([("a",), ("b",)], "value string").coalesce(1), lake.path("landing", "gps"))
    write = Lake.write

    def dies(self, df, layer, name, *args, **kwargs):
        if name.endswith(".loads"):
            raise RuntimeError("driver lost")
        return write(self, df, layer, name, *args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(Lake, "write", dies)
        with pytest.raises(RuntimeError, match="driver lost"):
            load_new_files(spark, lake, "gps", folder, read_lines)
    assert load_new_files(spark, lake, "gps", folder, read_lines) == {"files": 1, "rows": 2}
    assert load_new_files(spark, lake, "gps", folder, read_lines) == {"files": 0, "rows": 0}
    write_lines(spark.createDataFrame([("c",)], "value string").coalesce(1), folder, mode="append")
    assert load_new_files(spark, lake, "gps", folder, read_lines) == {"files": 1, "rows": 1}
    assert sorted(r.value for r in read_loaded(spark, lake, "gps").collect()) == ["a", "b", "c"]


def test_silver_from_rescued_bronze_is_the_same(spark, sf_small):
    """Malformed records are set aside in the one bronze write, and silver reads the clean ones alone."""
    from transitlake.sources.lake import write_delimited

    lake = Lake.on_shared_storage(spark)
    landing = layers.land(
        spark, lake, adapters.gps_raw(spark, sf_small), adapters.routes_raw(spark, sf_small), adapters.trips_raw(spark, sf_small)
    )
    write_delimited(adapters.short_routes_raw(spark, sf_small), landing.routes, ",", mode="append")
    layers.run_bronze(spark, lake, landing, rescue=True)
    layers.run_silver(spark, lake)
    for name, table in (("silver_pings", "gps"), ("silver_routes", "linhas"), ("silver_trips", "mco")):
        ok, msg = compare(lake.read(spark, "silver", table), duck(sf_small), SQL[name])
        assert ok, (table, msg)
    bad = lake.read_quarantine(spark, "bronze", "linhas")
    assert bad.count() == adapters.short_routes_raw(spark, sf_small).count() and bad.filter("_rescued IS NULL").count() == 0


def test_contract_types(spark):
    from transitlake.operators import Contract, ContractError, check_types, schema_drift

    df = spark.createDataFrame([(1, "x")], "a int, b string")
    contract = Contract("t", "final", ["a", "b", "c"], types={"a": "int", "b": "int"})
    assert schema_drift(df, contract) == [("a", "int", "int", "ok"), ("b", "int", "string", "type"), ("c", None, None, "missing")]
    with pytest.raises(ContractError, match="b \\(string, expected int\\), c \\(missing"):
        check_types(df, contract)
    assert check_types(df.select("a"), Contract("t", "final", ["a"], types={"a": "int"})).columns == ["a"]


def test_landing_files_take_the_quick_gzip_level(spark, tmp_path):
    lines = [f"{i},105;20240101{i % 86400:06d};-19,{900000 + i};{i * 7919 % 1500};{i % 360}" for i in range(20_000)]
    frame = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    write_lines(frame, str(tmp_path / "gps"), compression="gzip")
    assert sorted(r.value for r in read_lines(spark, str(tmp_path / "gps")).collect()) == sorted(lines)
    size = sum(p.stat().st_size for p in (tmp_path / "gps").glob("*.gz"))
    plain = "\n".join(lines).encode()
    quick, usual = (len(zlib.compress(plain, level)) for level in (1, 6))
    assert abs(size - quick) < abs(size - usual)
