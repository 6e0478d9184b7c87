"""Live silver pings: batches appended, folded in later, with the same
survivor as the batch build, and replays changing nothing."""

import pathlib

import pytest

from transitlake.plans import live, pings
from transitlake.sources.lake import Lake


def ping(vehicle, speed, ts):
    return f"1,105;{ts};-19,9;-43,9;{vehicle};{speed};10;90;1;100"


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def rows_of(df):
    return sorted((r.numero_veiculo, str(r.timestamp_gps), r.velocidade_kmh) for r in df.collect())


def files_of(lake):
    return {str(p): p.stat().st_size for p in pathlib.Path(lake.root, "silver").rglob("*.parquet")}


FIRST = [ping(1, 30, "20240101101010"), ping(2, 40, "20240102101010"), "_id,EV;HR", ping(9, 9, "not a time")]
SECOND = [ping(1, 20, "20240101101010"), ping(3, 50, "20240103101010"), ping(9, 8, "not a time")]


@pytest.mark.parametrize("compactions", [(), (0,), (1,), (0, 1)])
def test_batches_and_compactions_give_the_batch_build(spark, compactions):
    lake = Lake.on_shared_storage(spark)
    for batch, values in enumerate((FIRST, SECOND)):
        live.append_pings(spark, lake, lines(spark, values), batch)
        if batch in compactions:
            assert live.compact_pings(spark, lake) > 0
    expected = rows_of(pings.silver_pings(lines(spark, FIRST + SECOND)))
    assert rows_of(live.read_live_pings(spark, lake)) == expected
    assert (1, "2024-01-01 10:10:10", 20) in expected  # the smaller speed won across batches
    # a replayed batch (at-least-once delivery) changes nothing, whether it is in the base or not
    live.append_pings(spark, lake, lines(spark, SECOND), 1)
    assert rows_of(live.read_live_pings(spark, lake)) == expected
    live.compact_pings(spark, lake)
    assert live.compact_pings(spark, lake) == 0
    assert rows_of(live.read_live_pings(spark, lake)) == expected


def test_a_batch_writes_in_proportion_to_itself(spark):
    lake = Lake.on_shared_storage(spark)
    many = [ping(v, 30, f"2024{m:02d}{d:02d}101010") for m in (1, 2) for d in range(1, 21) for v in range(200)]
    live.append_pings(spark, lake, lines(spark, many), 0)
    live.compact_pings(spark, lake)
    before = files_of(lake)
    live.append_pings(spark, lake, lines(spark, [ping(1, 5, "20240103101010")]), 1)
    new = {p: n for p, n in files_of(lake).items() if p not in before}
    assert len(new) == 1 and sum(new.values()) < 10_000 and all("/batch=1/" in p for p in new)
    assert set(before) <= set(files_of(lake))
    # compacting rewrites the one day, and keeps the other 39 folders
    live.compact_pings(spark, lake)
    written = [p for p in files_of(lake) if p not in before and p not in new and "gps_live.versions" in p]
    assert len(written) == 1 and "data_particao=2024-01-03" in written[0]
    assert live.read_live_pings(spark, lake).count() == 8000


def test_empty_batches(spark):
    lake = Lake.on_shared_storage(spark)
    live.append_pings(spark, lake, lines(spark, ["_id,EV;HR", "junk"]), 0)
    assert live.read_live_pings(spark, lake).columns == pings.SILVER_PINGS.columns
    assert live.read_live_pings(spark, lake).count() == 0 and live.compact_pings(spark, lake) == 0
    live.append_pings(spark, lake, lines(spark, [ping(1, 30, "20240101101010")]), 1)
    live.append_pings(spark, lake, lines(spark, ["junk"]), 2)
    assert live.read_live_pings(spark, lake).count() == 1


def test_a_compaction_that_dies_is_not_read(spark, monkeypatch):
    """It dies between writing the days and committing them: readers and the next run see what was there before."""
    from transitlake.sources.published import Published

    lake = Lake.on_shared_storage(spark)
    live.append_pings(spark, lake, lines(spark, FIRST), 0)
    live.compact_pings(spark, lake)
    live.append_pings(spark, lake, lines(spark, SECOND), 1)
    expected = rows_of(pings.silver_pings(lines(spark, FIRST + SECOND)))

    def dies(*args, **kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(Published, "commit", dies)
        with pytest.raises(RuntimeError, match="driver lost"):
            live.compact_pings(spark, lake)
    assert rows_of(live.read_live_pings(spark, lake)) == expected
    live.compact_pings(spark, lake)
    assert rows_of(live.read_live_pings(spark, lake)) == expected


def test_reading_deduplicates_touched_days_alone(spark):
    import contextlib
    import io

    lake = Lake.on_shared_storage(spark)
    live.append_pings(spark, lake, lines(spark, [ping(1, 30, f"202401{d:02d}101010") for d in range(1, 11)]), 0)
    live.compact_pings(spark, lake)
    live.append_pings(spark, lake, lines(spark, [ping(1, 5, "20240103101010")]), 1)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        live.read_live_pings(spark, lake).explain(mode="formatted")
    filters = [ln for ln in buf.getvalue().splitlines() if ln.startswith("PartitionFilters") and "2024-01-03" in ln]
    assert len(filters) >= 2  # days kept as they are, and days that are merged


def test_gold_from_live_pings(spark, sf_small):
    from oracle.compare import compare, duck
    from oracle.duckdb_sql import SQL
    from transitlake.catalog import QUERIES
    from transitlake.plans import layers
    from transitlake.sources import adapters

    lake = Lake.on_shared_storage(spark)
    live.append_pings(spark, lake, adapters.gps_raw(spark, sf_small), 0)
    lake.write(QUERIES["silver_trips"](spark, sf_small), "silver", "mco")
    lake.write(QUERIES["silver_routes"](spark, sf_small), "silver", "linhas")
    layers.run_gold(spark, lake, live_pings=True)
    ok, msg = compare(lake.read(spark, "gold", layers.GOLD_TABLE), duck(sf_small), SQL["daily_performance"])
    assert ok, msg
