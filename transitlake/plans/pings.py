"""GPS pings: raw dump lines -> typed, valid, de-duplicated silver table.

Every step is a narrow projection or filter except the key de-duplication,
which is the only shuffle (with a map-side partial aggregate).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.functions import (
    after_first,
    lenient_double,
    lenient_int,
    map_codes,
    parse_wallclock,
    piece,
    split_fields,
)
from transitlake.functions.codes import DIRECTION_DEFAULT, DIRECTION_LABELS
from transitlake.operators import Contract, dedup_by_key, fenced, project, require_columns

# Field order of the GPS dump after the row id, as published
# (event, time, latitude, longitude, vehicle, speed, line, heading,
# direction, distance).
GPS_FIELDS = ["EV", "HR", "LT", "LG", "NV", "VL", "NL", "DG", "SV", "DT"]
GPS_TIME_PATTERN = "yyyyMMddHHmmss"
HEADER_PREFIX = "_id"

PING_KEY = ["numero_veiculo", "timestamp_gps"]
# Columns of the silver table, in their published order.
SILVER_PINGS = Contract(
    table="silver.gps",
    stage="final",
    columns=[
        "timestamp_gps", "numero_veiculo", "numero_linha", "sentido_viagem",
        "latitude", "longitude", "velocidade_kmh", "distancia_percorrida",
        "direcao_graus", "cod_evento", "data_particao", "hora",
    ],
    partition_by=("data_particao",),
    types={
        "timestamp_gps": "timestamp_ntz", "numero_veiculo": "int", "numero_linha": "int", "sentido_viagem": "string",
        "latitude": "double", "longitude": "double", "velocidade_kmh": "int", "distancia_percorrida": "int",
        "direcao_graus": "int", "cod_evento": "int", "data_particao": "date", "hora": "int",
    },
)


def drop_header_lines(df: DataFrame, prefix: str = HEADER_PREFIX) -> DataFrame:
    """Drop header lines (text starting with ``prefix``); NULL lines go too."""
    return df.filter(~F.col("value").startswith(prefix))


def parse_ping_lines(
    df: DataFrame, fields: Sequence[str] = GPS_FIELDS, strip_quotes: bool = False
) -> DataFrame:
    """``value`` -> one text column per field.

    The text after the first comma is split on ``;``; missing trailing
    fields are NULL and surplus ones ignored.  Lines without a comma are
    dropped (the first field would be NULL); an empty body keeps an empty
    first field.  ``strip_quotes`` removes double quotes a CSV export may
    wrap around lines that contain decimal commas.
    """
    line = F.col("value")
    if strip_quotes:
        line = F.replace(line, F.lit('"'), F.lit(""))
    arr = split_fields(after_first(line, ","), ";")
    parsed = df.select(*[piece(arr, i).alias(name) for i, name in enumerate(fields)])
    return fenced(parsed).filter(F.col(fields[0]).isNotNull())


# Typed column: its dump field and the parser.
PING_PARSERS = {
    "numero_veiculo": ("NV", lenient_int),
    "cod_evento": ("EV", lenient_int),
    "latitude": ("LT", lenient_double),
    "longitude": ("LG", lenient_double),
    "velocidade_kmh": ("VL", lenient_int),
    "numero_linha": ("NL", lenient_int),
    "direcao_graus": ("DG", lenient_int),
    "distancia_percorrida": ("DT", lenient_int),
    "sentido_viagem": ("SV", lambda c: map_codes(c, DIRECTION_LABELS, DIRECTION_DEFAULT)),
}


def type_pings(df: DataFrame, time_pattern: str = GPS_TIME_PATTERN) -> DataFrame:
    """Typed ping columns from the text fields (malformed -> NULL)."""
    typed = {name: parse(source) for name, (source, parse) in PING_PARSERS.items()}
    timed = df.withColumns(typed | {"timestamp_gps": parse_wallclock("HR", time_pattern)}).withColumns(
        {"data_particao": F.to_date("timestamp_gps"), "hora": F.hour("timestamp_gps")}
    )
    return fenced(timed)


def drop_null_island(df: DataFrame) -> DataFrame:
    """Keep pings whose latitude and longitude are both known and non-zero."""
    return df.filter((F.col("latitude") != 0.0) & (F.col("longitude") != 0.0))


def silver_pings(
    bronze: DataFrame,
    time_pattern: str = GPS_TIME_PATTERN,
    strip_quotes: bool = False,
    survivor_order: Sequence[str] | None = None,
) -> DataFrame:
    """Bronze GPS lines -> silver pings (12 columns, one row per key)."""
    require_columns(bronze, ["value"], "input", "bronze.gps")
    parsed = parse_ping_lines(drop_header_lines(bronze), GPS_FIELDS, strip_quotes)
    require_columns(parsed, GPS_FIELDS, "parsed", "bronze.gps")
    typed = project(drop_null_island(type_pings(parsed, time_pattern)), SILVER_PINGS.columns)
    deduped = dedup_by_key(typed, PING_KEY, survivor_order)
    return SILVER_PINGS.check(project(deduped, SILVER_PINGS.columns))
