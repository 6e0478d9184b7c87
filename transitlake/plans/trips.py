"""Trip-control records ("MCO"): raw text -> typed silver trips.

Map-side only: no shuffle until the table is written.  The schema is open:
source columns that are neither consumed nor dropped pass through.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.functions import (
    blank_to_null,
    clock_minutes,
    lenient_int,
    lenient_long,
    map_codes,
    parse_day,
    parse_wallclock,
    truthy_flag,
)
from transitlake.functions.codes import (
    CONSORTIUM_DEFAULT,
    CONSORTIUM_LABELS,
    TRIP_TYPE_DEFAULT,
    TRIP_TYPE_LABELS,
)
from transitlake.operators import Contract, drop_columns, fenced, normalize_names

TRIP_DAY_PATTERN = "dd/MM/yyyy"
MINUTES_PER_DAY = 24 * 60
# The dictionary's own example closes at "03/01/2020 15:44:00"; files also
# carry the short form.  Both are accepted.
TRIP_CLOSING_PATTERN = "dd/MM/yyyy HH:mm[:ss]"

# Column names of the published trip-control data and of the
# silver table, in their published order.
RAW_TRIPS = Contract(
    table="bronze.mco",
    stage="input",
    columns=[
        "viagem", "data_fechamento", "extensao", "sublinha", "pc",
        "catraca_saida", "catraca_chegada", "saida", "chegada",
        "concessionaria", "falha_mecanica", "evento_inseguro",
        "ocorrencia", "justificativa",
    ],
    open=True,
)
TEXT_COLUMNS_TO_BLANK = ["ocorrencia", "justificativa", "falha_mecanica", "evento_inseguro"]
CONSUMED_COLUMNS = [
    "viagem", "data_fechamento", "extensao", "concessionaria", "pc",
    "falha_mecanica", "evento_inseguro", "saida", "chegada",
    "_ingestion_timestamp", "_source_file",
]
SILVER_TRIPS = Contract(
    table="silver.mco",
    stage="final",
    columns=[
        "data_viagem", "dh_fechamento", "extensao_metros", "numero_linha",
        "catraca_saida", "catraca_chegada", "ts_saida", "ts_chegada",
        "duracao_viagem_minutos", "nome_consorcio", "desc_tipo_viagem",
        "teve_falha_mecanica", "teve_evento_inseguro", "ano", "mes",
        "ocorrencia", "justificativa",
    ],
    open=True,
    partition_by=("ano", "mes"),
    types={
        "data_viagem": "date", "dh_fechamento": "timestamp_ntz", "extensao_metros": "int", "numero_linha": "int",
        "catraca_saida": "bigint", "catraca_chegada": "bigint", "ts_saida": "timestamp_ntz", "ts_chegada": "timestamp_ntz",
        "duracao_viagem_minutos": "double", "nome_consorcio": "string", "desc_tipo_viagem": "string",
        "teve_falha_mecanica": "boolean", "teve_evento_inseguro": "boolean", "ano": "int", "mes": "int",
        "ocorrencia": "string", "justificativa": "string",
    },
)

# Typed column: its text column and the parser.  The numbers are parsed apart
# from whole-stage code, which the whole table would make too large to compile.
TRIP_PARSERS = {
    "data_viagem": ("viagem", lambda c: parse_day(c, TRIP_DAY_PATTERN)),
    "dh_fechamento": ("data_fechamento", lambda c: parse_wallclock(c, TRIP_CLOSING_PATTERN)),
    "extensao_metros": ("extensao", lambda c: lenient_int(c, apart=True)),
    "numero_linha": ("sublinha", lambda c: lenient_int(c, apart=True)),
    "pc": ("pc", lambda c: lenient_int(c, apart=True)),
    "catraca_saida": ("catraca_saida", lambda c: lenient_long(c, apart=True)),
    "catraca_chegada": ("catraca_chegada", lambda c: lenient_long(c, apart=True)),
}


def type_trips(df: DataFrame, strip_accents: bool = False) -> DataFrame:
    """Normalise header names, check the input contract, then type.

    The contract is checked before any cast, so a missing column is
    reported by name rather than as an unresolved reference.
    """
    df = RAW_TRIPS.check(normalize_names(df, strip_accents))
    return df.withColumns({name: parse(source) for name, (source, parse) in TRIP_PARSERS.items()})


def blank_texts(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS_TO_BLANK) -> DataFrame:
    """Exactly-empty text -> NULL on ``columns``."""
    return df.withColumns({c: blank_to_null(c) for c in columns})


def add_trip_span(df: DataFrame) -> DataFrame:
    """Departure/arrival instants on the trip day and the duration.

    An arrival clock earlier than the departure is on the next day.  A
    missing or malformed clock gives NULL instants and a NULL duration.

    Each clock is parsed once, into a column of its own that the instants and
    the duration share; they are minute-of-day integers, so a filter on the
    duration that Catalyst inlines below stays small.
    """
    parsed = df.withColumns({"_departure": clock_minutes("saida"), "_arrival": clock_minutes("chegada")})
    day, dep, arr = F.col("data_viagem"), F.col("_departure"), F.col("_arrival")
    rolled = arr + F.when(arr < dep, F.lit(MINUTES_PER_DAY)).otherwise(F.lit(0))
    day_start = day.cast("timestamp_ntz")
    return parsed.withColumns(
        {
            "ts_saida": F.timestamp_add("MINUTE", dep, day_start),
            "ts_chegada": F.timestamp_add("MINUTE", rolled, day_start),
            # whole minutes: nothing to round
            "duracao_viagem_minutos": F.when(day.isNotNull(), (rolled - dep).cast("double")),
        }
    ).drop("_departure", "_arrival")


def label_trips(df: DataFrame, flag_labels: Iterable[str] = ()) -> DataFrame:
    """Consortium and trip-type labels and the two boolean flags."""
    labels = tuple(flag_labels)
    return df.withColumns(
        {
            "nome_consorcio": map_codes("concessionaria", CONSORTIUM_LABELS, CONSORTIUM_DEFAULT),
            "desc_tipo_viagem": map_codes("pc", TRIP_TYPE_LABELS, TRIP_TYPE_DEFAULT),
            "teve_falha_mecanica": truthy_flag("falha_mecanica", labels),
            "teve_evento_inseguro": truthy_flag("evento_inseguro", labels),
        }
    )


def add_month_partition(df: DataFrame, day: str = "data_viagem") -> DataFrame:
    return df.withColumns({"ano": F.year(day), "mes": F.month(day)})


def silver_trips(
    bronze: DataFrame, flag_labels: Iterable[str] = (), strip_accents: bool = False
) -> DataFrame:
    """Bronze trip records -> silver trips (17 required columns + pass-through)."""
    df = type_trips(bronze, strip_accents)
    df = blank_texts(df)
    df = add_trip_span(df)
    df = label_trips(df, flag_labels)
    df = add_month_partition(df)
    df = drop_columns(df, CONSUMED_COLUMNS)
    return SILVER_TRIPS.check(fenced(df))
