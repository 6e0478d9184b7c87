"""Raw-shaped inputs derived from the generic test tables.

The test warehouse holds TPC-H-like tables, not bus data.  These
functions derive the three raw shapes the pipeline ingests -- GPS dump
lines, the route catalogue and trip-control records -- from ``events``,
``supplier`` and ``lineitem`` with plain column expressions, so their
size grows with the warehouse.  The shapes deliberately carry the awkward
cases: decimal commas, zero coordinates, out-of-range speeds, negative
distances, repeated and conflicting pings, a header line, a line without
a separator, routes that are missing or repeated, public codes with
letters, itineraries with every separator, trips that cross midnight,
blank arrivals, two closing-time formats and unknown consortium codes.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Trip days are spread over 2024-01-01 .. 2024-01-30 so they overlap the
# GPS pings (``events.ts`` covers January 2024).
TRIP_FIRST_DAY = "2024-01-01"
TRIP_DAY_SPREAD = 30

# Header of the GPS dump and one malformed line, both present in real dumps.
GPS_HEADER_LINE = "_id,EV;HR;LT;LG;NV;VL;NL;DG;SV;DT"
GPS_BROKEN_LINE = "line without separator"

# Published trip-control headers (dictionary spelling, unaccented), in file
# order; one has stray leading space as seen in exported files.
TRIP_HEADERS = {
    "viagem": " VIAGEM",
    "linha": "LINHA",
    "sublinha": "SUBLINHA",
    "pc": "PC",
    "concessionaria": "CONCESSIONARIA",
    "saida": "SAIDA",
    "chegada": "CHEGADA",
    "catraca_saida": "CATRACA SAIDA",
    "catraca_chegada": "CATRACA CHEGADA",
    "ocorrencia": "OCORRENCIA",
    "justificativa": "JUSTIFICATIVA",
    "extensao": "EXTENSAO",
    "falha_mecanica": "FALHA MECANICA",
    "evento_inseguro": "EVENTO INSEGURO",
    "data_fechamento": "DATA FECHAMENTO",
}


def table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """A warehouse table, optionally pruned to ``columns``."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    if columns is not None:
        df = df.select(*columns)
    return df


def _s(c: Column) -> Column:
    return c.cast("string")


def _ping_line(k: int) -> Column:
    eid, uid = F.col("event_id"), F.col("user_id")
    lat = F.when(eid % 50 == 0, F.lit("0")).otherwise(F.concat(F.lit("-19,"), _s(900000 + eid)))
    fields = [
        F.lit("105"),
        F.date_format(F.col("ts"), "yyyyMMddHHmmss"),
        lat,
        F.concat(F.lit("-43,"), _s(900000 + uid)),
        _s(uid),
        _s(F.floor("value").cast("int") + F.lit(k)),
        _s(uid % 100),
        _s(eid % 360),
        _s(eid % 3),
        _s(eid % 977 - 20),
    ]
    parts = [fields[0]]
    for f in fields[1:]:
        parts += [F.lit(";"), f]
    return F.concat(_s(eid), F.lit(","), *parts).alias("value")


def gps_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GPS dump as text lines (``value``): ``<id>,EV;HR;LT;LG;NV;VL;NL;DG;SV;DT``.

    Pings with ``event_id % 20 = 0`` appear twice verbatim; those with
    ``% 20 = 1`` appear again with speed + 1 (same vehicle and time).
    """
    ev = table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    base = ev.select(_ping_line(0))
    repeats = ev.filter(F.col("event_id") % 20 == 0).select(_ping_line(0))
    conflicts = ev.filter(F.col("event_id") % 20 == 1).select(_ping_line(1))
    odd = spark.createDataFrame([(GPS_HEADER_LINE,), (GPS_BROKEN_LINE,)], "value string")
    return base.unionByName(repeats).unionByName(conflicts).unionByName(odd)


def routes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route catalogue (``NumeroLinha, Linha, Nome``), all text, one row per
    supplier plus repeats.

    Suppliers with ``s_suppkey % 10 = 9`` carry a malformed line id (their
    trips find no route); those with ``% 10 = 8`` are listed twice; ``% 7 = 0``
    get a lettered public code.
    """
    sup = table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    k = F.col("s_suppkey")
    line_id = F.when(k % 10 == 9, F.concat(F.lit("L"), _s(k))).otherwise(_s(k))
    code = F.when(k % 7 == 0, F.concat(F.lit("SC"), _s(k), F.lit("A"))).otherwise(
        F.concat(F.lit(" "), _s(k), F.lit("-0"), _s(k % 4))
    )
    sep = F.when(k % 3 == 0, F.lit("/")).when(k % 3 == 1, F.lit(" - ")).otherwise(F.lit("\\"))
    name = F.concat(
        F.lit("Bairro "),
        _s(F.col("s_nationkey")),
        sep,
        F.lit("Bairro "),
        _s((k * 7) % 25),
        F.when(k % 5 == 0, F.lit("/ via centro")).otherwise(F.lit("")),
    )
    listed = sup.select(line_id.alias("NumeroLinha"), code.alias("Linha"), name.alias("Nome"))
    again = sup.filter(k % 10 == 8).select(
        _s(k).alias("NumeroLinha"),
        F.concat(F.lit(" "), _s(k)).alias("Linha"),
        F.lit("Zona repetida").alias("Nome"),
    )
    return listed.unionByName(again)


def _clock(minute_of_day: Column) -> Column:
    return F.concat(
        F.lpad(_s(F.floor(minute_of_day / 60).cast("int")), 2, "0"),
        F.lit(":"),
        F.lpad(_s(minute_of_day % 60), 2, "0"),
    )


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip-control records, all text, one per ``lineitem`` row, with the
    published (upper-case, spaced) headers."""
    li = table(
        spark, sf_dir, "lineitem",
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
         "l_extendedprice", "l_returnflag", "l_linestatus"],
    )
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    day = F.date_format(
        F.date_add(F.lit(TRIP_FIRST_DAY).cast("date"), (ok % TRIP_DAY_SPREAD).cast("int")),
        "dd/MM/yyyy",
    )
    depart = pk % 1440
    arrive = (pk + 10 + F.floor("l_quantity").cast("int") * 2) % 1440
    cols = {
        "viagem": day,
        "linha": _s(sk),
        "sublinha": _s(sk),
        "pc": _s(F.col("l_linenumber") % 5),
        "concessionaria": _s(800 + sk % 6),
        "saida": _clock(depart),
        "chegada": F.when(ok % 97 == 0, F.lit("")).otherwise(_clock(arrive)),
        "catraca_saida": _s(pk * 10),
        "catraca_chegada": _s(pk * 10 + sk),
        "ocorrencia": F.when(F.col("l_linestatus") == "F", F.lit("OC")).otherwise(F.lit("")),
        "justificativa": F.when(F.col("l_linestatus") == "F", F.lit("JU")).otherwise(F.lit("")),
        "extensao": F.concat(
            _s(F.floor("l_extendedprice").cast("int")),
            F.when(pk % 3 == 0, F.lit(".5")).otherwise(F.lit("")),
        ),
        "falha_mecanica": F.when(F.col("l_returnflag") == "R", F.lit("1"))
        .when(F.col("l_returnflag") == "A", F.lit(""))
        .otherwise(F.lit("0")),
        "evento_inseguro": F.when(ok % 11 == 0, F.lit("1")).otherwise(F.lit("0")),
        "data_fechamento": F.concat(
            day, F.when(pk % 2 == 0, F.lit(" 23:10")).otherwise(F.lit(" 23:10:05"))
        ),
    }
    return li.select(*[expr.alias(TRIP_HEADERS[name]) for name, expr in cols.items()])


def flawed_trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip records with faults for the quality rules to find: trips with an unsafe
    event have a malformed line id, and those of type 4 are run by consortium 801
    whatever their line (so a line has two consortia on a day)."""
    return trips_raw(spark, sf_dir).withColumns(
        {
            "SUBLINHA": F.when(F.col("EVENTO INSEGURO") == "1", F.concat(F.lit("X"), "SUBLINHA")).otherwise(F.col("SUBLINHA")),
            "CONCESSIONARIA": F.when(F.col("PC") == "4", F.lit("801")).otherwise(F.col("CONCESSIONARIA")),
        }
    )


def sn_trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip records with the published S/N coding of the two flags."""
    flags = ("FALHA MECANICA", "EVENTO INSEGURO")
    return trips_raw(spark, sf_dir).withColumns(
        {c: F.when(F.col(c) == "1", F.lit("S")).when(F.col(c) == "0", F.lit("N")).otherwise(F.col(c)) for c in flags}
    )


def broken_pings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump lines that lost their separator, one for every hundredth event."""
    eid = F.col("event_id")
    return table(spark, sf_dir, "events", ["event_id"]).filter(eid % 100 == 7).select(F.concat(F.lit("lost "), _s(eid)).alias("value"))


def short_routes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route records that lack their name (two fields)."""
    return routes_raw(spark, sf_dir).filter(F.col("NumeroLinha").startswith("L")).select("NumeroLinha", "Linha")


def long_routes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route records with a field too many (four fields)."""
    return routes_raw(spark, sf_dir).filter(F.col("Nome") == "Zona repetida").withColumn("Extra", F.col("NumeroLinha"))


def drifted_trips(silver: DataFrame) -> DataFrame:
    """Silver trips as another producer might send them: the line as text (of lines 1 to 9 with an
    ``L``), the odometer as floating point, no justification and a new column."""
    line = _s(F.col("numero_linha"))
    return (
        silver.withColumn("numero_linha", F.when(F.length(line) == 1, F.concat(F.lit("L"), line)).otherwise(line))
        .withColumn("catraca_saida", F.col("catraca_saida").cast("double"))
        .withColumn("lote", F.lit(1))
        .drop("justificativa")
    )
