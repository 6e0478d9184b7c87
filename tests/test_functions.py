"""Edge values of the scalar rules (FIXTURES.md §3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from transitlake.functions import (
    blank_to_null,
    clock_minutes,
    lenient_double,
    lenient_int,
    lenient_long,
    map_codes,
    parse_day,
    parse_wallclock,
    portable_round,
    truthy_flag,
)
from transitlake.functions.codes import (
    CONSORTIUM_DEFAULT,
    CONSORTIUM_LABELS,
    DIRECTION_DEFAULT,
    DIRECTION_LABELS,
    TRIP_TYPE_DEFAULT,
    TRIP_TYPE_LABELS,
)


def one(spark, value, expr, schema="s string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text,expected",
    [(" 12 ", 12), ("12.7", 12), ("+7", 7), ("-3", -3), ("12.", 12), (".5", 0), (".", 0), ("-.5", 0),
     ("+", None), ("   ", None), ("\t12.5", 12), ("1e3", None), ("", None),
     ("-0012.9", -12), (" -. ", 0), ("- 1", None), ("1.2.3", None), ("\x00 7.5 \x1f", 7), ("5\n", 5),
     ("12x", None), ("S", None), ("99999999999", None), ('"105', None), (None, None)],
)
def test_lenient_int(spark, text, expected):
    assert one(spark, text, lenient_int("s")) == expected
    assert one(spark, text, lenient_int("s", apart=True)) == expected


def test_lenient_long_keeps_large_values(spark):
    assert one(spark, "99999999999", lenient_long("s")) == 99999999999


@pytest.mark.parametrize("text,expected", [("-19,95", -19.95), ("", None), ("1.2.3", None), ("0", 0.0)])
def test_lenient_double(spark, text, expected):
    assert one(spark, text, lenient_double("s")) == expected


@pytest.mark.parametrize(
    "text,expected",
    [("20240101123456", dt.datetime(2024, 1, 1, 12, 34, 56)), ("20240231123456", None),
     ("20240101243456", None), ("2024010112345", None), ("x20240101123456", None), (None, None)],
)
def test_parse_wallclock_compact(spark, text, expected):
    assert one(spark, text, parse_wallclock("s")) == expected


@pytest.mark.parametrize(
    "text,expected",
    [("03/01/2020 15:44", dt.datetime(2020, 1, 3, 15, 44)),
     ("03/01/2020 15:44:00", dt.datetime(2020, 1, 3, 15, 44)),
     ("31/02/2020 10:00", None), ("3/01/2020 15:44", None), ("03/01/2020 15:44:0", None), ("03/01/2020 15:44\n", None),
     ("03/01/2020 15:44:60", None), ("29/02/0004 23:59:59", dt.datetime(4, 2, 29, 23, 59, 59)), ("03/01/2020 15:441", None), ("03/01/2020 24:00", None)],
)
def test_closing_time(spark, text, expected):
    assert one(spark, text, parse_wallclock("s", "dd/MM/yyyy HH:mm[:ss]")) == expected


def test_wallclock_is_zone_free(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # 2018-11-04 00:30 did not exist on Sao Paulo clocks (DST gap).
        assert one(spark, "04/11/2018 00:30", parse_wallclock("s", "dd/MM/yyyy HH:mm")) == dt.datetime(2018, 11, 4, 0, 30)
    finally:
        spark.conf.unset("spark.sql.session.timeZone")


def test_parse_day(spark):
    assert one(spark, "29/07/2018", parse_day("s")) == dt.date(2018, 7, 29)
    assert one(spark, "31/02/2018", parse_day("s")) is None


@pytest.mark.parametrize("text,expected", [("00:00", 0), ("23:59", 1439), ("6:00", None), ("24:00", None), ("", None)])
def test_clock_minutes(spark, text, expected):
    assert one(spark, text, clock_minutes("s")) == expected


@pytest.mark.parametrize(
    "dep,arr,minutes",
    [("23:50", "00:20", 30.0), ("06:00", "06:45", 45.0), ("06:00", "06:00", 0.0),
     ("6:00", "07:00", None), ("24:00", "07:00", None), (None, "07:00", None)],
)
def test_trip_span_timestamps(spark, dep, arr, minutes):
    from transitlake.plans.trips import add_trip_span

    df = spark.createDataFrame([(dt.date(2024, 1, 1), dep, arr)], "data_viagem date, saida string, chegada string")
    row = add_trip_span(df).selectExpr("duracao_viagem_minutos AS m", "ts_chegada AS t").first()
    assert row["m"] == minutes
    if dep == "23:50":
        assert row["t"] == dt.datetime(2024, 1, 2, 0, 20)


def test_portable_round_half_up(spark):
    assert one(spark, 1.005, portable_round("s"), "s double") == 1.01
    assert one(spark, 0.285, portable_round("s"), "s double") == 0.29


@pytest.mark.parametrize("code,label", [("1", "IDA"), ("2", "VOLTA"), ("0", DIRECTION_DEFAULT), ("", DIRECTION_DEFAULT), (None, DIRECTION_DEFAULT)])
def test_direction(spark, code, label):
    assert one(spark, code, map_codes("s", DIRECTION_LABELS, DIRECTION_DEFAULT)) == label


@pytest.mark.parametrize("code", ["801", "802", "803", "804"])
def test_consortium_known(spark, code):
    assert one(spark, code, map_codes("s", CONSORTIUM_LABELS, CONSORTIUM_DEFAULT)) == CONSORTIUM_LABELS[code]


@pytest.mark.parametrize("code", [" 801", "805", None])
def test_consortium_unknown(spark, code):
    assert one(spark, code, map_codes("s", CONSORTIUM_LABELS, CONSORTIUM_DEFAULT)) == "Desconhecido"


@pytest.mark.parametrize("pc,label", [(0, "Ociosa"), (1, "Normal"), (2, "Normal"), (3, "Transferencia"), (4, "Outros"), (None, "Outros")])
def test_trip_type(spark, pc, label):
    assert one(spark, pc, map_codes("s", TRIP_TYPE_LABELS, TRIP_TYPE_DEFAULT), "s int") == label


@pytest.mark.parametrize("text,flag,flag_s", [("1", True, True), ("1.0", True, True), ("0", False, False), ("", False, False), (None, False, False), ("S", False, True)])
def test_truthy_flag(spark, text, flag, flag_s):
    assert one(spark, text, truthy_flag("s")) is flag
    assert one(spark, text, truthy_flag("s", ("S",))) is flag_s


def test_blank_to_null(spark):
    assert one(spark, "", blank_to_null("s")) is None
    assert one(spark, " ", blank_to_null("s")) == " "


def test_speed_range(spark):
    from transitlake.operators import in_range

    df = spark.createDataFrame([(v,) for v in [0, 120, -1, 121, None]], "v int")
    assert sorted(r.v for r in df.filter(in_range(F.col("v"), 0, 120)).collect()) == [0, 120]


@pytest.mark.parametrize("text", ["abc", "ab/cd/efgh ij:kl", "03/01/2020 1x:44:00", "03/01/2020 15:44:0x", ""])
def test_malformed_wallclock_never_raises(spark, text):
    df = spark.createDataFrame([(text,)], "s string")
    row = df.select(
        parse_wallclock("s", "dd/MM/yyyy HH:mm[:ss]").alias("a"),
        parse_day("s").alias("b"),
        clock_minutes("s").alias("c"),
    ).first()
    assert row == (None, None, None)


def test_portable_round_never_raises(spark):
    df = spark.createDataFrame([(1e40,), (float("nan"),), (123456789012.125,)], "s double")
    got = [r.r for r in df.select(portable_round("s").alias("r")).collect()]
    assert got[0] == 1e40 and got[1] != got[1] and got[2] == 123456789012.13


def test_portable_round_is_one_step(spark):
    assert one(spark, 1.0049999, portable_round("s"), "s double") == 1.0
    assert one(spark, 2e12, portable_round("s"), "s double") == 2e12


def test_ratio_round_is_exact(spark):
    from transitlake.functions import ratio_round

    rows = [(1, 8), (-1, 8), (1001, 200_001), (1000, 200_001), (5, 0), (None, 3), (2**63 - 1, 10**18), (2**53 + 1, 1), (-(2**63), 7)]
    df = spark.createDataFrame(rows, "a long, b long")
    got = [r.r for r in df.select(ratio_round("a", "b").alias("r")).collect()]
    assert got == [0.13, -0.13, 0.01, 0.0, None, None, 9.22, (2**53 + 1) * 100 / 100, -(2**63 * 100 // 7 + 1) / 100]


def test_integers_before_a_fraction(spark):
    texts = {
        "12.7": 12, "+3.": 3, "-4.99": -4, "007.0": 7, "123456789.5": 123456789, "1234567890.5": 1234567890,
        "99999999999.1": None, ".5": 0, "-.5": 0, "1.5e3": None, "1.2.3": None, "7.5\n": 7, " 8.1": 8, "9,5": None, "": None,
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for apart in (False, True):
        got = rows.select("t", lenient_int("t", apart).alias("i")).collect()
        assert {r.t: r.i for r in got} == texts
