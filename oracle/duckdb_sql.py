"""Independent DuckDB SQL for every catalogued query.

Written directly in DuckDB's dialect over the warehouse views (``events``,
``supplier``, ``lineitem``), not generated from the Spark code.  It
follows the pipeline the plain way -- join before aggregate, a
``row_number`` window for de-duplication -- so it also checks the Spark
plan's rewrites.  Engine differences handled here (see FIXTURES.md):
DuckDB's text casts round fractions and accept ``24:00``, so integers are
cut out with a regex and clocks are guarded by full-width patterns; sums
are cast to BIGINT and calendar parts to INTEGER; rounding goes through
DECIMAL(18,6).
"""

from __future__ import annotations


_INT_RX = "^[\\x00-\\x20]*([+-]?)([0-9]*)([.][0-9]*)?[\\x00-\\x20]*$"


def _legacy_int(x: str, sql_type: str) -> str:
    sign, digits, frac = (f"regexp_extract({x}, '{_INT_RX}', {i})" for i in (1, 2, 3))
    return (
        f"CASE WHEN regexp_matches({x}, '{_INT_RX}') AND length({digits}) + length({frac}) > 0 "
        f"THEN TRY_CAST({sign} || CASE WHEN {digits} = '' THEN '0' ELSE {digits} END AS {sql_type}) END"
    )


def lint(x: str) -> str:
    """Lenient text -> INTEGER (legacy rule: trim, sign, digits, ignored fraction)."""
    return _legacy_int(x, "INTEGER")


def llong(x: str) -> str:
    return _legacy_int(x, "BIGINT")


def ldouble(x: str) -> str:
    return f"TRY_CAST(replace({x}, ',', '.') AS DOUBLE)"


def round2(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 2)"


def mean2(total: str, count: str) -> str:
    """Mean of integers rounded half up to two decimals (no sign: sums here are not negative)."""
    return f"CAST((200 * CAST({total} AS HUGEINT) + {count}) // (2 * {count}) AS DOUBLE) / 100"


CLOCK = "([01][0-9]|2[0-3]):[0-5][0-9]"
DAY = "(0[1-9]|[12][0-9]|3[01])/(0[1-9]|1[0-2])/[0-9]{4}"


def dmy_date(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({x}, '{DAY}') THEN "
        f"CAST(TRY_CAST(substr({x},7,4) || '-' || substr({x},4,2) || '-' || substr({x},1,2) AS TIMESTAMP) AS DATE) END"
    )


def closing_ts(x: str) -> str:
    iso_day = f"substr({x},7,4) || '-' || substr({x},4,2) || '-' || substr({x},1,2)"
    return (
        f"CASE WHEN regexp_full_match({x}, '{DAY} {CLOCK}:[0-5][0-9]') "
        f"THEN TRY_CAST({iso_day} || ' ' || substr({x},12,8) AS TIMESTAMP) "
        f"WHEN regexp_full_match({x}, '{DAY} {CLOCK}') "
        f"THEN TRY_CAST({iso_day} || ' ' || substr({x},12,5) || ':00' AS TIMESTAMP) END"
    )


def clock_on(day: str, x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({x}, '{CLOCK}') THEN CAST({day} AS TIMESTAMP) "
        f"+ to_minutes(CAST(substr({x},1,2) AS BIGINT) * 60 + CAST(substr({x},4,2) AS BIGINT)) END"
    )


def _ping_line(k: int) -> str:
    return (
        "CAST(event_id AS VARCHAR) || ',' || '105' || ';' || strftime(ts, '%Y%m%d%H%M%S') || ';' || "
        "(CASE WHEN event_id % 50 = 0 THEN '0' ELSE '-19,' || CAST(900000 + event_id AS VARCHAR) END) || ';' || "
        "'-43,' || CAST(900000 + user_id AS VARCHAR) || ';' || CAST(user_id AS VARCHAR) || ';' || "
        f"CAST(CAST(floor(value) AS INTEGER) + {k} AS VARCHAR) || ';' || CAST(user_id % 100 AS VARCHAR) || ';' || "
        "CAST(event_id % 360 AS VARCHAR) || ';' || CAST(event_id % 3 AS VARCHAR) || ';' || "
        "CAST(event_id % 977 - 20 AS VARCHAR)"
    )


def _dmy_text(ok: str = "l_orderkey") -> str:
    return f"strftime(DATE '2024-01-01' + CAST({ok} % 30 AS INTEGER), '%d/%m/%Y')"


def _clock_text(m: str) -> str:
    return (
        f"lpad(CAST(CAST(floor(({m}) / 60) AS INTEGER) AS VARCHAR), 2, '0') || ':' || "
        f"lpad(CAST(({m}) % 60 AS VARCHAR), 2, '0')"
    )


# ---------------------------------------------------------------------------
# CTE fragments, each named after what it produces.
# ---------------------------------------------------------------------------
CTES: dict[str, str] = {}

CTES["gps_raw"] = f"""
SELECT {_ping_line(0)} AS value FROM events
UNION ALL SELECT {_ping_line(0)} FROM events WHERE event_id % 20 = 0
UNION ALL SELECT {_ping_line(1)} FROM events WHERE event_id % 20 = 1
UNION ALL SELECT '_id,EV;HR;LT;LG;NV;VL;NL;DG;SV;DT'
UNION ALL SELECT 'line without separator'
"""

CTES["gps_fields"] = """
SELECT parts[1] AS "EV", parts[2] AS "HR", parts[3] AS "LT", parts[4] AS "LG", parts[5] AS "NV",
       parts[6] AS "VL", parts[7] AS "NL", parts[8] AS "DG", parts[9] AS "SV", parts[10] AS "DT"
FROM (
  SELECT CASE WHEN strpos(value, ',') > 0 THEN string_split(substr(value, strpos(value, ',') + 1), ';') END AS parts
  FROM gps_raw WHERE NOT starts_with(value, '_id')
) WHERE parts[1] IS NOT NULL
"""

CTES["gps_typed"] = f"""
SELECT ts AS timestamp_gps, {lint('"NV"')} AS numero_veiculo, {lint('"NL"')} AS numero_linha,
       CASE "SV" WHEN '1' THEN 'IDA' WHEN '2' THEN 'VOLTA' ELSE 'INDEFINIDO' END AS sentido_viagem,
       {ldouble('"LT"')} AS latitude, {ldouble('"LG"')} AS longitude,
       {lint('"VL"')} AS velocidade_kmh, {lint('"DT"')} AS distancia_percorrida,
       {lint('"DG"')} AS direcao_graus, {lint('"EV"')} AS cod_evento,
       CAST(ts AS DATE) AS data_particao, CAST(hour(ts) AS INTEGER) AS hora
FROM (
  SELECT *, CASE WHEN regexp_full_match("HR", '[0-9]{{4}}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9]')
         THEN TRY_CAST(substr("HR",1,4) || '-' || substr("HR",5,2) || '-' || substr("HR",7,2) || ' ' ||
                       substr("HR",9,2) || ':' || substr("HR",11,2) || ':' || substr("HR",13,2) AS TIMESTAMP) END AS ts
  FROM gps_fields
)
"""

CTES["gps_valid"] = "SELECT * FROM gps_typed WHERE latitude <> 0 AND longitude <> 0"

CTES["silver_pings"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY numero_veiculo, timestamp_gps
    ORDER BY numero_linha NULLS FIRST, sentido_viagem NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST,
             velocidade_kmh NULLS FIRST, distancia_percorrida NULLS FIRST, direcao_graus NULLS FIRST,
             cod_evento NULLS FIRST, data_particao NULLS FIRST, hora NULLS FIRST) AS rn
  FROM gps_valid
) WHERE rn = 1
"""

CTES["trips_raw"] = f"""
SELECT {_dmy_text()} AS " VIAGEM",
       CAST(l_suppkey AS VARCHAR) AS "LINHA",
       CAST(l_suppkey AS VARCHAR) AS "SUBLINHA",
       CAST(l_linenumber % 5 AS VARCHAR) AS "PC",
       CAST(800 + l_suppkey % 6 AS VARCHAR) AS "CONCESSIONARIA",
       {_clock_text('l_partkey % 1440')} AS "SAIDA",
       CASE WHEN l_orderkey % 97 = 0 THEN '' ELSE {_clock_text('(l_partkey + 10 + CAST(floor(l_quantity) AS INTEGER) * 2) % 1440')} END AS "CHEGADA",
       CAST(l_partkey * 10 AS VARCHAR) AS "CATRACA SAIDA",
       CAST(l_partkey * 10 + l_suppkey AS VARCHAR) AS "CATRACA CHEGADA",
       CASE WHEN l_linestatus = 'F' THEN 'OC' ELSE '' END AS "OCORRENCIA",
       CASE WHEN l_linestatus = 'F' THEN 'JU' ELSE '' END AS "JUSTIFICATIVA",
       CAST(CAST(floor(l_extendedprice) AS INTEGER) AS VARCHAR) || CASE WHEN l_partkey % 3 = 0 THEN '.5' ELSE '' END AS "EXTENSAO",
       CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '' ELSE '0' END AS "FALHA MECANICA",
       CASE WHEN l_orderkey % 11 = 0 THEN '1' ELSE '0' END AS "EVENTO INSEGURO",
       {_dmy_text()} || CASE WHEN l_partkey % 2 = 0 THEN ' 23:10' ELSE ' 23:10:05' END AS "DATA FECHAMENTO"
FROM lineitem
"""

CTES["trips_named"] = """
SELECT " VIAGEM" AS viagem, "LINHA" AS linha, "SUBLINHA" AS sublinha, "PC" AS pc,
       "CONCESSIONARIA" AS concessionaria, "SAIDA" AS saida, "CHEGADA" AS chegada,
       "CATRACA SAIDA" AS catraca_saida, "CATRACA CHEGADA" AS catraca_chegada,
       "OCORRENCIA" AS ocorrencia, "JUSTIFICATIVA" AS justificativa, "EXTENSAO" AS extensao,
       "FALHA MECANICA" AS falha_mecanica, "EVENTO INSEGURO" AS evento_inseguro,
       "DATA FECHAMENTO" AS data_fechamento
FROM trips_raw
"""

CTES["trips_typed"] = f"""
SELECT viagem, linha, sublinha, concessionaria, saida, chegada, data_fechamento,
       {lint('pc')} AS pc,
       {llong('catraca_saida')} AS catraca_saida, {llong('catraca_chegada')} AS catraca_chegada,
       NULLIF(ocorrencia, '') AS ocorrencia, NULLIF(justificativa, '') AS justificativa,
       NULLIF(falha_mecanica, '') AS falha_mecanica, NULLIF(evento_inseguro, '') AS evento_inseguro,
       {dmy_date('viagem')} AS data_viagem,
       {closing_ts('data_fechamento')} AS dh_fechamento,
       {lint('extensao')} AS extensao_metros,
       {lint('sublinha')} AS numero_linha
FROM trips_named
"""

CTES["trips_spanned"] = f"""
SELECT *, {round2('(epoch(ts_chegada) - epoch(ts_saida)) / 60.0')} AS duracao_viagem_minutos
FROM (
  SELECT * EXCLUDE (arr0), CASE WHEN arr0 < ts_saida THEN arr0 + INTERVAL 1 DAY ELSE arr0 END AS ts_chegada
  FROM (
    SELECT *, {clock_on('data_viagem', 'saida')} AS ts_saida, {clock_on('data_viagem', 'chegada')} AS arr0
    FROM trips_typed
  )
)
"""

CTES["trips_labelled"] = f"""
SELECT *,
       CASE concessionaria WHEN '801' THEN 'Consórcio Pampulha' WHEN '802' THEN 'Consórcio BHLeste'
            WHEN '803' THEN 'Consórcio Dez' WHEN '804' THEN 'Consórcio Dom Pedro II' ELSE 'Desconhecido' END AS nome_consorcio,
       CASE WHEN pc = 0 THEN 'Ociosa' WHEN pc IN (1, 2) THEN 'Normal' WHEN pc = 3 THEN 'Transferencia' ELSE 'Outros' END AS desc_tipo_viagem,
       coalesce({lint('falha_mecanica')} = 1, false) AS teve_falha_mecanica,
       coalesce({lint('evento_inseguro')} = 1, false) AS teve_evento_inseguro,
       CAST(year(data_viagem) AS INTEGER) AS ano, CAST(month(data_viagem) AS INTEGER) AS mes
FROM trips_spanned
"""

CTES["silver_trips"] = """
SELECT linha, sublinha, catraca_saida, catraca_chegada, ocorrencia, justificativa,
       data_viagem, dh_fechamento, extensao_metros, numero_linha, ts_saida, ts_chegada,
       duracao_viagem_minutos, nome_consorcio, desc_tipo_viagem, teve_falha_mecanica,
       teve_evento_inseguro, ano, mes
FROM trips_labelled
"""

CTES["routes_raw"] = """
SELECT CASE WHEN s_suppkey % 10 = 9 THEN 'L' || CAST(s_suppkey AS VARCHAR) ELSE CAST(s_suppkey AS VARCHAR) END AS "NumeroLinha",
       CASE WHEN s_suppkey % 7 = 0 THEN 'SC' || CAST(s_suppkey AS VARCHAR) || 'A'
            ELSE ' ' || CAST(s_suppkey AS VARCHAR) || '-0' || CAST(s_suppkey % 4 AS VARCHAR) END AS "Linha",
       'Bairro ' || CAST(s_nationkey AS VARCHAR)
         || CASE s_suppkey % 3 WHEN 0 THEN '/' WHEN 1 THEN ' - ' ELSE chr(92) END
         || 'Bairro ' || CAST((s_suppkey * 7) % 25 AS VARCHAR)
         || CASE WHEN s_suppkey % 5 = 0 THEN '/ via centro' ELSE '' END AS "Nome"
FROM supplier
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), ' ' || CAST(s_suppkey AS VARCHAR), 'Zona repetida'
FROM supplier WHERE s_suppkey % 10 = 8
"""

CTES["routes_coded"] = f"""
SELECT "NumeroLinha", "Linha", {lint('"NumeroLinha"')} AS numero_linha,
       string_split(trim("Linha"), '-')[1] AS cod_linha_publico,
       coalesce({lint("string_split(trim(" + '"Linha"' + "), '-')[2]")}, 0) AS num_sublinha,
       trim(upper("Nome")) AS nome_bruto
FROM routes_raw
"""

CTES["routes_detailed"] = """
SELECT numero_linha, cod_linha_publico, num_sublinha, nome_bruto,
       trim(arr[1]) AS bairro_origem, trim(arr[2]) AS bairro_destino,
       coalesce(trim(arr[3]), 'NENHUMA') AS desc_variacao
FROM (
  SELECT *, string_split(replace(replace(nome_bruto, chr(92), '/'), ' - ', '/'), '/') AS arr FROM routes_coded
)
"""

CTES["silver_routes"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY numero_linha
    ORDER BY cod_linha_publico NULLS FIRST, num_sublinha NULLS FIRST, nome_bruto NULLS FIRST,
             bairro_origem NULLS FIRST, bairro_destino NULLS FIRST, desc_variacao NULLS FIRST) AS rn
  FROM routes_detailed
) WHERE rn = 1
"""

CTES["ping_metrics"] = f"""
SELECT data_particao, numero_linha AS join_cod_publico,
       {mean2('sum(velocidade_kmh)', 'count(velocidade_kmh)')} AS vel_media_gps,
       max(velocidade_kmh) AS vel_maxima_gps,
       CAST(sum(distancia_percorrida) AS BIGINT) AS distancia_total_gps_metros
FROM silver_pings
WHERE velocidade_kmh BETWEEN 0 AND 120 AND distancia_percorrida >= 0
GROUP BY data_particao, numero_linha
"""

CTES["route_lookup"] = f"""
SELECT numero_linha, {lint('cod_linha_publico')} AS join_cod_publico, cod_linha_publico,
       nome_bruto, bairro_origem, bairro_destino
FROM silver_routes
"""

CTES["trips_enriched"] = """
SELECT t.*, r.join_cod_publico, r.cod_linha_publico, r.nome_bruto, r.bairro_origem, r.bairro_destino
FROM silver_trips t LEFT JOIN route_lookup r ON t.numero_linha = r.numero_linha
"""

CTES["trip_indicators"] = f"""
SELECT data_viagem, numero_linha, join_cod_publico, cod_linha_publico, nome_bruto, nome_consorcio,
       bairro_origem, bairro_destino,
       count(*) AS qtd_viagens_realizadas,
       CAST(sum(CAST(teve_falha_mecanica AS INTEGER)) AS BIGINT) AS qtd_falhas_mecanicas,
       {mean2('sum(CAST(round(duracao_viagem_minutos * 100) AS BIGINT))', '(100 * count(duracao_viagem_minutos))')} AS duracao_media_viagem_min
FROM trips_enriched
WHERE duracao_viagem_minutos >= 0
GROUP BY data_viagem, numero_linha, join_cod_publico, cod_linha_publico, nome_bruto, nome_consorcio,
         bairro_origem, bairro_destino
"""

CTES["daily_performance"] = """
SELECT * FROM (
  SELECT i.data_viagem AS data_referencia, i.numero_linha, i.cod_linha_publico,
         i.nome_bruto AS nome_linha, i.nome_consorcio, i.qtd_viagens_realizadas,
         i.qtd_falhas_mecanicas, i.duracao_media_viagem_min,
         coalesce(g.vel_media_gps, 0) AS vel_media_gps, g.vel_maxima_gps,
         coalesce(g.distancia_total_gps_metros, 0) AS distancia_total_gps_metros,
         i.bairro_origem, i.bairro_destino
  FROM trip_indicators i
  LEFT JOIN ping_metrics g ON i.data_viagem = g.data_particao AND i.join_cod_publico = g.join_cod_publico
) WHERE vel_media_gps BETWEEN 0 AND 120 AND distancia_total_gps_metros >= 0
"""

# Dependencies of each fragment, in definition order.
DEPENDS = {
    "gps_raw": [],
    "gps_fields": ["gps_raw"],
    "gps_typed": ["gps_fields"],
    "gps_valid": ["gps_typed"],
    "silver_pings": ["gps_valid"],
    "trips_raw": [],
    "trips_named": ["trips_raw"],
    "trips_typed": ["trips_named"],
    "trips_spanned": ["trips_typed"],
    "trips_labelled": ["trips_spanned"],
    "silver_trips": ["trips_labelled"],
    "routes_raw": [],
    "routes_coded": ["routes_raw"],
    "routes_detailed": ["routes_coded"],
    "silver_routes": ["routes_detailed"],
    "ping_metrics": ["silver_pings"],
    "route_lookup": ["silver_routes"],
    "trips_enriched": ["silver_trips", "route_lookup"],
    "trip_indicators": ["trips_enriched"],
    "daily_performance": ["trip_indicators", "ping_metrics"],
}


# Trip records with faults for the quality rules, and with S/N flags.
FLAWED_TRIPS = f"""
SELECT * REPLACE (CASE WHEN "EVENTO INSEGURO" = '1' THEN 'X' || "SUBLINHA" ELSE "SUBLINHA" END AS "SUBLINHA",
                  CASE WHEN "PC" = '4' THEN '801' ELSE "CONCESSIONARIA" END AS "CONCESSIONARIA")
FROM ({CTES["trips_raw"]})
"""
# S/N flags are true for S alone (there is no integer 1 left in the data).
SN_TRIPS = f"""
SELECT * REPLACE (CASE "FALHA MECANICA" WHEN '1' THEN 'S' WHEN '0' THEN 'N' ELSE "FALHA MECANICA" END AS "FALHA MECANICA",
                  CASE "EVENTO INSEGURO" WHEN '1' THEN 'S' WHEN '0' THEN 'N' ELSE "EVENTO INSEGURO" END AS "EVENTO INSEGURO")
FROM ({CTES["trips_raw"]})
"""


def with_ctes(body: str, *needs: str, instead: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding ``needs`` and everything they depend on
    (``instead``: other bodies for some of them)."""
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in DEPENDS[name]:
            visit(dep)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    bodies = CTES | (instead or {})
    ctes = ",\n".join(f"{n} AS ({bodies[n].strip()})" for n in order)
    return f"WITH {ctes}\n{body.strip()}"


def _unpivot_counts(source: str, columns: list[str], agg: str, name_col: str, value_col: str) -> str:
    parts = [
        f"SELECT '{c}' AS {name_col}, CAST({agg.format(c=c)} AS BIGINT) AS {value_col} FROM {source}"
        for c in columns
    ]
    return "\nUNION ALL ".join(parts)


SILVER_TRIP_COLUMNS = [
    "linha", "sublinha", "catraca_saida", "catraca_chegada", "ocorrencia", "justificativa",
    "data_viagem", "dh_fechamento", "extensao_metros", "numero_linha", "ts_saida", "ts_chegada",
    "duracao_viagem_minutos", "nome_consorcio", "desc_tipo_viagem", "teve_falha_mecanica",
    "teve_evento_inseguro", "ano", "mes",
]
SILVER_ROUTE_COLUMNS = [
    "numero_linha", "cod_linha_publico", "num_sublinha", "nome_bruto",
    "bairro_origem", "bairro_destino", "desc_variacao",
]
GOLD_COLUMNS = [
    "data_referencia", "numero_linha", "cod_linha_publico", "nome_linha", "nome_consorcio",
    "qtd_viagens_realizadas", "qtd_falhas_mecanicas", "duracao_media_viagem_min", "vel_media_gps",
    "vel_maxima_gps", "distancia_total_gps_metros", "bairro_origem", "bairro_destino",
]
TRIP_INPUT_COLUMNS = [
    "viagem", "data_fechamento", "extensao", "sublinha", "pc", "catraca_saida", "catraca_chegada",
    "saida", "chegada", "concessionaria", "falha_mecanica", "evento_inseguro", "ocorrencia", "justificativa",
]
SILVER_TRIP_REQUIRED = [
    "data_viagem", "dh_fechamento", "extensao_metros", "numero_linha", "catraca_saida", "catraca_chegada",
    "ts_saida", "ts_chegada", "duracao_viagem_minutos", "nome_consorcio", "desc_tipo_viagem",
    "teve_falha_mecanica", "teve_evento_inseguro", "ano", "mes", "ocorrencia", "justificativa",
]
GPS_FIELDS = ["EV", "HR", "LT", "LG", "NV", "VL", "NL", "DG", "SV", "DT"]


def _contract_rows(table: str, stage: str, source: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{stage}' AS stage, '{c}' AS column_name, true AS present, "
        f'CAST(count("{c}") AS BIGINT) AS non_null_rows FROM {source}'
        for c in columns
    )


def _silver_select(table: str) -> str:
    return f"SELECT * FROM {table}"


_PING_COLUMNS = (
    "timestamp_gps, numero_veiculo, numero_linha, sentido_viagem, latitude, longitude, velocidade_kmh, "
    "distancia_percorrida, direcao_graus, cod_evento, data_particao, hora"
)

SQL: dict[str, str] = {
    "ping_lines_parsed": with_ctes("SELECT * FROM gps_fields", "gps_fields"),
    "pings_typed": with_ctes("SELECT * FROM gps_typed", "gps_typed"),
    "pings_valid_coordinates": with_ctes("SELECT * FROM gps_valid", "gps_valid"),
    "silver_pings": with_ctes("SELECT * FROM silver_pings", "silver_pings"),
    "streamed_silver_pings": with_ctes("SELECT * FROM silver_pings", "silver_pings"),
    "trips_normalized_names": with_ctes(
        "SELECT linha, sublinha, catraca_saida, catraca_chegada, ocorrencia, justificativa FROM trips_named",
        "trips_named",
    ),
    "trips_blank_to_null": with_ctes(
        "SELECT NULLIF(ocorrencia, '') AS ocorrencia, NULLIF(justificativa, '') AS justificativa, "
        "NULLIF(falha_mecanica, '') AS falha_mecanica, NULLIF(evento_inseguro, '') AS evento_inseguro FROM trips_named",
        "trips_named",
    ),
    "trips_span": with_ctes(
        "SELECT viagem, saida, chegada, data_fechamento, data_viagem, dh_fechamento, ts_saida, ts_chegada, "
        "duracao_viagem_minutos FROM trips_spanned",
        "trips_spanned",
    ),
    "trips_labels": with_ctes(
        "SELECT concessionaria, pc, falha_mecanica, evento_inseguro, nome_consorcio, desc_tipo_viagem, "
        "teve_falha_mecanica, teve_evento_inseguro, pc IN (1, 2) AS viagem_normal FROM trips_labelled",
        "trips_labelled",
    ),
    "silver_trips": with_ctes("SELECT * FROM silver_trips", "silver_trips"),
    "route_codes": with_ctes("SELECT * FROM routes_coded", "routes_coded"),
    "route_itinerary": with_ctes(
        "SELECT numero_linha, nome_bruto, bairro_origem, bairro_destino, desc_variacao FROM routes_detailed",
        "routes_detailed",
    ),
    "silver_routes": with_ctes("SELECT * FROM silver_routes", "silver_routes"),
    "ping_metrics": with_ctes("SELECT * FROM ping_metrics", "ping_metrics"),
    "route_lookup": with_ctes("SELECT * FROM route_lookup", "route_lookup"),
    "trips_enriched": with_ctes("SELECT * FROM trips_enriched", "trips_enriched"),
    "trip_indicators": with_ctes("SELECT * FROM trip_indicators", "trip_indicators"),
    "daily_performance": with_ctes("SELECT * FROM daily_performance", "daily_performance"),
    "trips_null_profile": with_ctes(
        _unpivot_counts("silver_trips", SILVER_TRIP_COLUMNS, 'count(*) - count("{c}")', "column_name", "null_count"),
        "silver_trips",
    ),
    "gps_duplicate_profile": with_ctes(
        """
        SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(count(*) AS BIGINT) AS distinct_rows,
               CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
        FROM (SELECT value, count(*) AS n FROM gps_raw GROUP BY value)
        """,
        "gps_raw",
    ),
    "fact_key_duplicates": with_ctes(
        """
        SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_rows, CAST(count(*) AS BIGINT) AS distinct_rows,
               CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows
        FROM (SELECT data_referencia, numero_linha, count(*) AS n FROM daily_performance GROUP BY ALL)
        """,
        "daily_performance",
        instead={"trips_raw": FLAWED_TRIPS},
    ),
    "gold_rule_report": with_ctes(
        """
        , prepared AS (
          SELECT * REPLACE (CASE WHEN numero_linha % 5 = 0 THEN -qtd_falhas_mecanicas ELSE qtd_falhas_mecanicas END AS qtd_falhas_mecanicas,
                            CASE WHEN numero_linha % 7 = 3 THEN NULL ELSE data_referencia END AS data_referencia)
          FROM daily_performance)
        SELECT 'data_referencia_null' AS rule, CAST(count(*) FILTER (WHERE data_referencia IS NULL) AS BIGINT) AS violations FROM prepared
        UNION ALL SELECT 'numero_linha_null', CAST(count(*) FILTER (WHERE numero_linha IS NULL) AS BIGINT) FROM prepared
        UNION ALL SELECT 'negative_metric', CAST(count(*) FILTER (WHERE qtd_viagens_realizadas < 0 OR qtd_falhas_mecanicas < 0
            OR duracao_media_viagem_min < 0 OR vel_media_gps < 0 OR vel_maxima_gps < 0 OR distancia_total_gps_metros < 0) AS BIGINT)
          FROM prepared
        """,
        "daily_performance",
        instead={"trips_raw": FLAWED_TRIPS},
    ),
    "contract_checks": with_ctes(
        "\nUNION ALL ".join(
            [
                _contract_rows("bronze.gps", "input", "gps_raw", ["value"]),
                _contract_rows("bronze.gps", "parsed", "gps_fields", GPS_FIELDS),
                _contract_rows("bronze.mco", "input", "trips_named", TRIP_INPUT_COLUMNS),
                _contract_rows("bronze.linhas", "input", "routes_raw", ["NumeroLinha", "Linha", "Nome"]),
                _contract_rows("bronze.linhas", "lacking", "routes_raw", ["NumeroLinha", "Linha"]),
                "SELECT 'bronze.linhas', 'lacking', 'Nome', false, CAST(NULL AS BIGINT)",
                _contract_rows("silver.mco", "final", "silver_trips", SILVER_TRIP_REQUIRED),
                _contract_rows("silver.linhas", "final", "silver_routes", SILVER_ROUTE_COLUMNS),
                _contract_rows("gold.fato_performance_diaria", "gold", "daily_performance", GOLD_COLUMNS),
            ]
        ),
        "gps_fields", "trips_named", "routes_raw", "silver_trips", "silver_routes", "daily_performance",
    ),
    "routes_table_profile": with_ctes(
        "SELECT 'silver' AS layer, 'linhas' AS table_name, 'null_count' AS metric, column_name, null_count AS value FROM ("
        + _unpivot_counts("silver_routes", SILVER_ROUTE_COLUMNS, 'count(*) - count("{c}")', "column_name", "null_count")
        + ")\nUNION ALL SELECT 'silver', 'linhas', 'duplicate_rows', NULL, "
        "CAST((SELECT count(*) FROM silver_routes) - (SELECT count(*) FROM (SELECT DISTINCT * FROM silver_routes)) AS BIGINT)",
        "silver_routes",
    ),
    "bronze_gps_roundtrip": with_ctes("SELECT value, 'gps' AS _source_file FROM gps_raw", "gps_raw"),
    "streamed_bronze_gps": with_ctes("SELECT value, 'gps' AS _source_file FROM gps_raw", "gps_raw"),
    "mixed_bronze_gps": with_ctes(
        "SELECT value, 'batch' AS _source_file FROM gps_raw UNION ALL SELECT value, 'stream' FROM gps_raw", "gps_raw"
    ),
    "bronze_routes_roundtrip": with_ctes(
        """SELECT NULLIF("NumeroLinha", '') AS "NumeroLinha", NULLIF("Linha", '') AS "Linha",
                  NULLIF("Nome", '') AS "Nome", 'linhas' AS _source_file FROM routes_raw""",
        "routes_raw",
    ),
    "bronze_trips_roundtrip": with_ctes(
        "SELECT "
        + ", ".join(
            f'NULLIF("{h}", \'\') AS "{h}"'
            for h in [
                " VIAGEM", "LINHA", "SUBLINHA", "PC", "CONCESSIONARIA", "SAIDA", "CHEGADA", "CATRACA SAIDA",
                "CATRACA CHEGADA", "OCORRENCIA", "JUSTIFICATIVA", "EXTENSAO", "FALHA MECANICA",
                "EVENTO INSEGURO", "DATA FECHAMENTO",
            ]
        )
        + ", 'mco' AS _source_file FROM trips_raw",
        "trips_raw",
    ),
    "partitioned_overwrite": with_ctes(
        f"SELECT {_PING_COLUMNS} FROM silver_pings "
        "WHERE data_particao < DATE '2024-01-16' OR velocidade_kmh BETWEEN 0 AND 120",
        "silver_pings",
    ),
    "observed_silver_counts": with_ctes(
        """
        SELECT 'gps' AS table_name, CAST(count(*) AS BIGINT) AS observed_rows, CAST(count(*) AS BIGINT) AS stored_rows FROM silver_pings
        UNION ALL SELECT 'mco', CAST(count(*) AS BIGINT), CAST(count(*) AS BIGINT) FROM silver_trips
        UNION ALL SELECT 'linhas', CAST(count(*) AS BIGINT), CAST(count(*) AS BIGINT) FROM silver_routes
        """,
        "silver_pings", "silver_trips", "silver_routes",
    ),
    "medallion_end_to_end": with_ctes("SELECT * FROM daily_performance", "daily_performance"),
}


def _layer_profile(table: str, source: str, columns: list[str], layer: str = "silver") -> str:
    nulls = _unpivot_counts(source, columns, 'count(*) - count("{c}")', "column_name", "null_count")
    return (
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, 'null_count' AS metric, column_name, null_count AS value "
        f"FROM ({nulls})\nUNION ALL SELECT '{layer}', '{table}', 'duplicate_rows', NULL, "
        f"CAST((SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source})) AS BIGINT)"
    )


SQL["partitioned_overwrite_orc"] = SQL["partitioned_overwrite"]

SQL["layer_profiles"] = with_ctes(
    "\nUNION ALL ".join(
        [
            _layer_profile("gps", "silver_pings", [c.strip() for c in _PING_COLUMNS.split(",")]),
            _layer_profile("mco", "silver_trips", SILVER_TRIP_COLUMNS),
            _layer_profile("linhas", "silver_routes", SILVER_ROUTE_COLUMNS),
        ]
    ),
    "silver_pings", "silver_trips", "silver_routes",
)

_TRIP_HEADERS = [
    " VIAGEM", "LINHA", "SUBLINHA", "PC", "CONCESSIONARIA", "SAIDA", "CHEGADA", "CATRACA SAIDA", "CATRACA CHEGADA",
    "OCORRENCIA", "JUSTIFICATIVA", "EXTENSAO", "FALHA MECANICA", "EVENTO INSEGURO", "DATA FECHAMENTO",
]


def _stored(source: str, columns: list[str], label: str) -> str:
    """A bronze table: blanks read back as NULL, one ingestion time, one source label."""
    blanks = ", ".join(f"NULLIF(\"{c}\", '') AS \"{c}\"" for c in columns)
    return f"(SELECT {blanks}, now() AS _ingestion_timestamp, '{label}' AS _source_file FROM {source})"


_STAMP = ["_ingestion_timestamp", "_source_file"]
SQL["bronze_layer_profiles"] = with_ctes(
    "\nUNION ALL ".join(
        _layer_profile(label, _stored(source, columns, label), [*columns, *_STAMP], "bronze")
        for label, source, columns in (
            ("gps", "gps_raw", ["value"]),
            ("linhas", "routes_raw", ["NumeroLinha", "Linha", "Nome"]),
            ("mco", "trips_raw", _TRIP_HEADERS),
        )
    ),
    "gps_raw", "routes_raw", "trips_raw",
)
SQL["gold_layer_profile"] = with_ctes(
    _layer_profile("fato_performance_diaria", "daily_performance", GOLD_COLUMNS, "gold"), "daily_performance"
)
SQL["silver_trips_sn_flags"] = with_ctes(
    "SELECT "
    + ", ".join(
        {
            "teve_falha_mecanica": "coalesce(falha_mecanica = 'S', false) AS teve_falha_mecanica",
            "teve_evento_inseguro": "coalesce(evento_inseguro = 'S', false) AS teve_evento_inseguro",
        }.get(c, c)
        for c in SILVER_TRIP_COLUMNS
    )
    + " FROM trips_labelled",
    "trips_labelled",
    instead={"trips_raw": SN_TRIPS},
)

SQL["live_silver_pings"] = SQL["streamed_silver_pings"]

# crc32 of a text, byte by byte and bit by bit (-1: shift one bit), over its UTF-8 bytes (ASCII here).
_CRC_STEPS = (
    "flatten(list_transform(range(1, length(value) + 1), "
    "lambda i: [ord(substr(value, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
)
_CRC = (
    f"xor(list_reduce({_CRC_STEPS}, lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) "
    "WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END, 4294967295::BIGINT), 4294967295)"
)
SQL["incremental_bronze_pings"] = with_ctes(
    f"""
    , arrived AS (SELECT value, CAST({_CRC} % 2 AS INTEGER) AS run FROM gps_raw)
    SELECT value, run, CAST(1 AS BIGINT) AS loaded FROM arrived
    UNION ALL SELECT NULL, run, CAST(count(*) AS BIGINT) FROM arrived GROUP BY run
    UNION ALL SELECT NULL, 2, CAST(0 AS BIGINT)
    """,
    "gps_raw",
)

SQL["malformed_records"] = with_ctes(
    """
    , bad AS (
      SELECT 'gps' AS table_name, value AS record FROM gps_raw WHERE NOT starts_with(value, '_id') AND strpos(value, ',') = 0
      UNION ALL SELECT 'gps', 'lost ' || CAST(event_id AS VARCHAR) FROM events WHERE event_id % 100 = 7
      UNION ALL SELECT 'linhas', "NumeroLinha" || ',' || "Linha" FROM routes_raw WHERE starts_with("NumeroLinha", 'L')
      UNION ALL SELECT 'linhas', "NumeroLinha" || ',' || "Linha" || ',' || "Nome" || ',' || "NumeroLinha"
        FROM routes_raw WHERE "Nome" = 'Zona repetida')
    SELECT table_name, record, CAST(count(*) AS BIGINT) AS n FROM bad GROUP BY ALL
    UNION ALL SELECT 'gps', NULL, CAST(count(*) FILTER (WHERE starts_with(value, '_id') OR strpos(value, ',') > 0) AS BIGINT) FROM gps_raw
    UNION ALL SELECT 'linhas', NULL, CAST(count(*) AS BIGINT) FROM routes_raw
    UNION ALL SELECT 'mco', NULL, CAST(count(*) AS BIGINT) FROM trips_raw
    """,
    "gps_raw", "routes_raw", "trips_raw",
)

_TYPES = {
    "silver.gps": {
        "timestamp_gps": "timestamp_ntz", "numero_veiculo": "int", "numero_linha": "int", "sentido_viagem": "string",
        "latitude": "double", "longitude": "double", "velocidade_kmh": "int", "distancia_percorrida": "int",
        "direcao_graus": "int", "cod_evento": "int", "data_particao": "date", "hora": "int",
    },
    "silver.linhas": {c: "int" if c in ("numero_linha", "num_sublinha") else "string" for c in SILVER_ROUTE_COLUMNS},
    "silver.mco": {
        "data_viagem": "date", "dh_fechamento": "timestamp_ntz", "extensao_metros": "int", "numero_linha": "int",
        "catraca_saida": "bigint", "catraca_chegada": "bigint", "ts_saida": "timestamp_ntz", "ts_chegada": "timestamp_ntz",
        "duracao_viagem_minutos": "double", "nome_consorcio": "string", "desc_tipo_viagem": "string",
        "teve_falha_mecanica": "boolean", "teve_evento_inseguro": "boolean", "ano": "int", "mes": "int",
        "ocorrencia": "string", "justificativa": "string",
    },
}


def _drift(table: str, stage: str, actual: dict[str, str | None], unfit: dict[str, str] | None = None) -> str:
    """Contract rows of a table whose columns have the types of ``actual`` (None: not there; others: extra)."""
    wanted, rows = _TYPES[table], []
    show = lambda t: "CAST(NULL AS VARCHAR)" if t is None else f"'{t}'"
    for c in [*wanted, *[x for x in actual if x not in wanted]]:
        want = wanted.get(c)
        found = actual.get(c, want)
        status = "extra" if c not in wanted else "missing" if found is None else "ok" if want == found else "type"
        n = (unfit or {}).get(c, "0")
        rows.append(
            f"SELECT '{table}' AS table_name, '{stage}' AS stage, '{c}' AS column_name, {show(want)} AS expected_type, "
            f"{show(found)} AS actual_type, '{status}' AS status, CAST({n} AS BIGINT) AS unfit_rows"
        )
    return "\nUNION ALL ".join(rows)


_PASSED_ON = {"linha": "string", "sublinha": "string"}
SQL["schema_drift"] = with_ctes(
    "\nUNION ALL ".join(
        [
            _drift("silver.gps", "final", {}),
            _drift("silver.linhas", "final", {}),
            _drift("silver.mco", "final", _PASSED_ON),
            _drift(
                "silver.mco",
                "drifted",
                {"numero_linha": "string", "catraca_saida": "double", "justificativa": None, **_PASSED_ON, "lote": "int"},
                {"numero_linha": "(SELECT count(*) FROM silver_trips WHERE numero_linha BETWEEN 0 AND 9)"},
            ),
        ]
    ),
    "silver_trips",
)

SQL["gold_policies"] = with_ctes(
    """
    , n AS (SELECT count(*) AS facts, count(*) FILTER (WHERE numero_linha IS NULL) AS bad FROM daily_performance)
    SELECT 'fail' AS policy, true AS failed, CAST(0 AS BIGINT) AS published, CAST(0 AS BIGINT) AS published_without_line,
           CAST(0 AS BIGINT) AS quarantined
    UNION ALL SELECT 'warn', false, CAST(facts AS BIGINT), CAST(bad AS BIGINT), CAST(0 AS BIGINT) FROM n
    UNION ALL SELECT 'quarantine', false, CAST(facts - bad AS BIGINT), CAST(0 AS BIGINT), CAST(bad AS BIGINT) FROM n
    """,
    "daily_performance",
    instead={"trips_raw": FLAWED_TRIPS},
)

SQL["stamped_files"] = with_ctes(
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS rows_with_their_file, "
        f"CAST(count(*) AS BIGINT) AS rows_stamped_in_run FROM {source}"
        for t, source in (("gps", "gps_raw"), ("linhas", "routes_raw"), ("mco", "trips_raw"))
    ),
    "gps_raw", "routes_raw", "trips_raw",
)

SQL["substitute_sink"] = with_ctes(
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS observed_rows, CAST(count(*) AS BIGINT) AS rows_in_sink, "
        f"false AS in_lake FROM {source}"
        for t, source in (("gps", "silver_pings"), ("mco", "silver_trips"), ("linhas", "silver_routes"))
    ),
    "silver_pings", "silver_trips", "silver_routes",
)

SQL["bucketed_trip_indicators"] = SQL["trip_indicators"]

_PROFILED = [c.strip() for c in _PING_COLUMNS.split(",") if c.strip() != "data_particao"]
SQL["stored_profiles"] = with_ctes(
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) - count({c}) AS BIGINT) AS nulls, "
        "true AS distinct_near, CAST(NULL AS INTEGER) AS run, CAST(NULL AS BIGINT) AS days FROM silver_pings"
        for c in _PROFILED
    )
    + "".join(
        f"\nUNION ALL SELECT NULL, NULL, NULL, NULL, {run}, CAST(count(DISTINCT data_particao) AS BIGINT) FROM silver_pings WHERE {kept}"
        for run, kept in enumerate(("data_particao < DATE '2024-01-16'", "data_particao >= DATE '2024-01-16'", "false"))
    ),
    "silver_pings",
)
