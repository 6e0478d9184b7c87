"""Route catalogue ("linhas"): raw CSV text -> silver routes, one per line id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.functions import lenient_int, piece, split_fields
from transitlake.functions.codes import NO_VARIATION
from transitlake.operators import Contract, dedup_by_key, project

RAW_ROUTES = Contract(table="bronze.linhas", stage="input", columns=["NumeroLinha", "Linha", "Nome"])
ROUTE_KEY = ["numero_linha"]
SILVER_ROUTES = Contract(
    table="silver.linhas",
    stage="final",
    columns=[
        "numero_linha", "cod_linha_publico", "num_sublinha", "nome_bruto",
        "bairro_origem", "bairro_destino", "desc_variacao",
    ],
    types={
        "numero_linha": "int", "cod_linha_publico": "string", "num_sublinha": "int", "nome_bruto": "string",
        "bairro_origem": "string", "bairro_destino": "string", "desc_variacao": "string",
    },
)


def parse_route_codes(df: DataFrame) -> DataFrame:
    """Line id, public code and sub-line number, and the upper-cased name.

    ``' 2004-01'`` -> public code ``2004``, sub-line 1; a code without a
    numeric second piece has sub-line 0.  The public code stays text
    (``SC01A`` is a valid public code).
    """
    code_parts = split_fields(F.trim(F.col("Linha")), "-")
    return df.withColumns(
        {
            "numero_linha": lenient_int("NumeroLinha"),
            "cod_linha_publico": piece(code_parts, 0),
            "num_sublinha": F.coalesce(lenient_int(piece(code_parts, 1)), F.lit(0)),
            "nome_bruto": F.trim(F.upper(F.col("Nome"))),
        }
    )


def split_itinerary(df: DataFrame) -> DataFrame:
    """``arr_itinerario``: the name split on ``/``, ``\\`` or `` - ``.

    A hyphen without surrounding spaces is part of a place name.
    """
    unified = F.replace(F.replace(F.col("nome_bruto"), F.lit("\\"), F.lit("/")), F.lit(" - "), F.lit("/"))
    return df.withColumn("arr_itinerario", split_fields(unified, "/"))


def itinerary_details(df: DataFrame) -> DataFrame:
    """Origin, destination and variation (default when there is no third
    piece; an empty third piece stays empty)."""
    arr = F.col("arr_itinerario")
    return df.withColumns(
        {
            "bairro_origem": F.trim(piece(arr, 0)),
            "bairro_destino": F.trim(piece(arr, 1)),
            "desc_variacao": F.coalesce(F.trim(piece(arr, 2)), F.lit(NO_VARIATION)),
        }
    )


def silver_routes(bronze: DataFrame, survivor_order: Sequence[str] | None = None) -> DataFrame:
    """Bronze route rows -> silver routes (7 columns, unique ``numero_linha``)."""
    RAW_ROUTES.check(bronze)
    df = itinerary_details(split_itinerary(parse_route_codes(bronze)))
    df = project(df, SILVER_ROUTES.columns)
    return SILVER_ROUTES.check(dedup_by_key(df, ROUTE_KEY, survivor_order))
