"""SQL counterparts of the registered queries, for DuckDB over the same tables.

Written from the definition of each result, not from the Spark plans: keys by
a global row number, distinct counts and means directly over rows. Two-decimal
rates use whole-number arithmetic (half up), see ``_pct``.
"""

from __future__ import annotations

# Names of months and days.
MONTH_NAMES = (
    "ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO",
    "JULIO", "AGOSTO", "SEPTIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE",
)
DAY_NAMES = ("LUNES", "MARTES", "MIERCOLES", "JUEVES", "VIERNES", "SABADO", "DOMINGO")

_WS = r"[\s\x{3000}]"


def _pct(part: str, whole: str) -> str:
    """100 * part / whole to two decimals, half up; null when whole is 0."""
    return (
        f"CASE WHEN {whole} > 0 THEN "
        f"CAST((20000 * CAST({part} AS BIGINT) + {whole}) // (2 * {whole}) AS DOUBLE) / 100 END"
    )


def _mean2(total: str, n: str) -> str:
    """total / n to two decimals, half up, for whole non-negative totals."""
    return (
        f"CASE WHEN {n} > 0 THEN "
        f"CAST((200 * CAST({total} AS BIGINT) + {n}) // (2 * {n}) AS DOUBLE) / 100 END"
    )


def _even(value: str, digits: int) -> str:
    """Rounding of a double to the even neighbour."""
    scale = 10**digits
    return f"round_even(CAST({value} AS DOUBLE) * {scale}.0, 0) / {scale}.0"


def _rate(part: str, whole: str, digits: int) -> str:
    share = f"(CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE)) * 100.0"
    return f"CASE WHEN {whole} > 0 THEN CAST({_even(share, digits)} AS DOUBLE) END"


def _names(values: tuple[str, ...], index: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values, 1))
    return f"CASE {index} {whens} END"


def _untidy(col: str) -> str:
    return f"' ' || chr(9) || lower({col}) || chr(12288) || ' '"


_STATE = """CASE WHEN o_orderstatus = 'F' THEN 'atendida'
     WHEN o_orderstatus = 'O' THEN 'reservada'
     WHEN substr(o_orderpriority, 1, 1) IN ('1', '2', '3') THEN 'ausente'
     ELSE 'cancelada' END"""

# Every ticket with its untidy state still readable as ``st``.
_BASE = f"""
base AS (
  SELECT orders.*, {_STATE} AS st FROM orders
),
patient AS (
  SELECT c_custkey, c_name, c_mktsegment, c_nationkey,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sexo,
         CASE WHEN c_custkey % 50 <> 0
              THEN DATE '1940-01-01' + CAST(c_custkey % 25000 AS INTEGER) END AS nac
  FROM customer
),
place AS (
  SELECT n_nationkey, n_name, r_name, n_nationkey % 4 AS cap
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_AGE = "CAST(coalesce(trunc(date_diff('day', nac, DATE '2001-12-31') / 365.25), 0) AS BIGINT)"

_SILVER_COLUMNS = f"""
    CAST(o_orderkey AS VARCHAR) AS "codigoFicha",
    CAST(CAST(o_orderdate AS TIMESTAMP) AS VARCHAR) AS "fechaHoraReserva",
    CASE WHEN st = 'atendida'
         THEN CAST(CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 HOUR AS VARCHAR) END
      AS "fechaHoraAtencion",
    upper(st) AS estado,
    o_orderpriority AS prioridad,
    o_orderpriority AS "canalReserva",
    CASE WHEN st IN ('atendida', 'cancelada')
         THEN CAST(CAST(floor(o_totalprice) AS BIGINT) % 120 AS DOUBLE) END AS "tiempoEsperaMin",
    CASE WHEN st = 'cancelada' THEN 'VIAJE' ELSE 'SIN DATO' END AS "motivoReprogramacion",
    CASE WHEN st <> 'atendida' THEN 'SIN DATO'
         WHEN o_orderkey % 2 = 0 THEN 'CONSULTA RESUELTA' ELSE 'DERIVADO' END
      AS "resultadoAtencion",
    CASE WHEN o_orderkey % 3 = 0 THEN 'REPOSO' ELSE 'SIN DATO' END AS indicaciones,
    CASE o_orderkey % 3 WHEN 0 THEN 'SIN DATO' WHEN 1 THEN 'IRA' ELSE 'GRIPE' END AS diagnostico,
    o_custkey AS "idPaciente",
    upper(c_name) AS "nombrePaciente",
    sexo,
    CAST(CAST(nac AS TIMESTAMP) AS VARCHAR) AS "fechaNacimiento",
    o_custkey % 10 AS "idMedico",
    'DOCTOR ' || CAST(o_custkey % 10 AS VARCHAR) AS "nombreMedico",
    c_mktsegment AS especialidad,
    upper(n_name) AS "centroSalud",
    CAST(cap AS BIGINT) AS "capacidadDiaria",
    upper(r_name) AS departamento,
    upper(n_name) AS ciudad,
    CASE WHEN n_nationkey % 2 = 0 THEN 'NORTE' ELSE 'SIN DATO' END AS zona,
    'URBANA' AS area,
    year(o_orderdate) AS anio,
    month(o_orderdate) AS mes,
    day(o_orderdate) AS dia,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS fecha,
    {_AGE} AS edad_aprox"""

_SILVER = f"""{_BASE},
silver AS (
  SELECT {_SILVER_COLUMNS}
  FROM base JOIN patient ON o_custkey = c_custkey JOIN place ON c_nationkey = n_nationkey
)"""

# The star without surrogate keys: tickets with flags, capacity and context.
_WIDE = f"""{_SILVER},
context AS (
  SELECT year(l_shipdate) AS anio, CAST(CAST(sum(l_quantity) AS BIGINT) AS DOUBLE) AS valor_cepal
  FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-01-01' GROUP BY 1
),
wide AS (
  SELECT s.*, {_names(MONTH_NAMES, 'mes')} AS nombre_mes,
         CAST(estado = 'ATENDIDA' AS BIGINT) AS "esAtendida",
         CAST(estado = 'AUSENTE' AS BIGINT) AS "esAusente",
         CAST(estado = 'CANCELADA' AS BIGINT) AS "esCancelada",
         CAST(estado = 'RESERVADA' AS BIGINT) AS "esReservada",
         CAST(1 AS BIGINT) AS "conteoFicha", valor_cepal
  FROM silver s LEFT JOIN context c ON s.anio = c.anio
)"""

_SAT = f"""{_WIDE},
sat AS (
  SELECT fecha, anio, mes, nombre_mes, departamento, ciudad, "centroSalud", "capacidadDiaria",
         count(*) AS total_fichas_dia,
         {_pct('count(*)', '"capacidadDiaria"')} AS indice_saturacion_pct
  FROM wide
  GROUP BY fecha, anio, mes, nombre_mes, departamento, ciudad, "centroSalud", "capacidadDiaria"
)"""

_CHOSEN = """anio IN (1996, 1997, 1999) AND especialidad IN ('BUILDING', 'MACHINERY')"""

_WIDE_SELECT = """fecha, anio, mes, nombre_mes, departamento, ciudad, "centroSalud", especialidad,
  "canalReserva", estado, "tiempoEsperaMin", "esAtendida", "esAusente", "esCancelada",
  "esReservada", "conteoFicha", edad_aprox, "capacidadDiaria", valor_cepal"""


def _sum(column: str) -> str:
    return f'CAST(sum("{column}") AS BIGINT)'


def _dim(label: str, key: str) -> str:
    return f"""WITH {_SILVER}
SELECT row_number() OVER (ORDER BY "{label}") AS {key}, "{label}"
FROM (SELECT DISTINCT "{label}" FROM silver)"""


_CALENDAR = f"""
  SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS fecha_key,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS fecha,
         year(o_orderdate) AS anio, quarter(o_orderdate) AS trimestre, month(o_orderdate) AS mes,
         {_names(MONTH_NAMES, 'month(o_orderdate)')} AS nombre_mes,
         day(o_orderdate) AS dia, isodow(o_orderdate) AS dia_semana,
         {_names(DAY_NAMES, 'isodow(o_orderdate)')} AS nombre_dia
  FROM orders"""

_CENTERS = """
  SELECT row_number() OVER (ORDER BY upper(r_name), upper(n_name)) AS centro_key,
         upper(n_name) AS "centroSalud", upper(n_name) AS ciudad, upper(r_name) AS departamento,
         'URBANA' AS area, CAST(n_nationkey % 4 AS BIGINT) AS "capacidadDiaria"
  FROM nation JOIN region ON n_regionkey = r_regionkey"""

_KEYS = f"""{_WIDE},
d_centro AS ({_CENTERS}),
d_esp AS (SELECT especialidad, row_number() OVER (ORDER BY especialidad) AS k
          FROM (SELECT DISTINCT especialidad FROM silver)),
d_canal AS (SELECT "canalReserva", row_number() OVER (ORDER BY "canalReserva") AS k
            FROM (SELECT DISTINCT "canalReserva" FROM silver)),
d_estado AS (SELECT estado, row_number() OVER (ORDER BY estado) AS k
             FROM (SELECT DISTINCT estado FROM silver)),
d_ctx AS (SELECT anio, row_number() OVER (ORDER BY anio) AS k FROM context)"""

_CAMPAIGNS = f"""
campaigns AS (
  SELECT l_orderkey || '-' || l_linenumber AS codigo, part.*, lineitem.*,
         CASE WHEN l_discount > 0.01 THEN l_linestatus END AS estado,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS rn
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
clean_campaigns AS (
  SELECT codigo AS "codigoCampana", upper(p_type) AS tipo, upper(p_name) AS titulo,
         upper(p_brand) AS descripcion,
         CASE WHEN l_linenumber % 3 = 0 THEN 'https://img.example/' || p_partkey
              ELSE 'SIN DATO' END AS "imagenUrl",
         CAST(CAST(l_shipdate AS TIMESTAMP) AS VARCHAR) AS "fechaInicio",
         CAST(CAST(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS TIMESTAMP) AS VARCHAR)
           AS "fechaFin",
         'PLAZA' AS lugar,
         CASE WHEN l_tax >= 0.04 THEN 'CARNET' ELSE 'SIN DATO' END AS requisitos,
         CASE WHEN l_returnflag = 'A' THEN 'FAMILIAS' ELSE 'SIN DATO' END AS "publicoObjetivo",
         estado, upper(n_name) AS "centroSalud",
         date_diff('day', CAST(l_shipdate AS DATE),
                   CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER)) AS "duracionDias"
  FROM campaigns JOIN nation ON l_suppkey % 25 = n_nationkey
  WHERE rn = 1 AND estado IS NOT NULL
)"""

# Repeated tickets: first line of an order decides, small quantities lose the state.
_REPEATED = f"""{_BASE},
lines AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
                               l_suppkey, l_shipdate, l_extendedprice) AS rn
  FROM lineitem
)"""

_KPI_COLUMNS = f"""
    coalesce({_sum('conteoFicha')}, 0) AS total_fichas,
    coalesce({_sum('esAtendida')}, 0) AS total_atendidas,
    coalesce({_sum('esAusente')}, 0) AS total_ausentes,
    coalesce({_sum('esCancelada')}, 0) AS total_canceladas,
    count(CASE WHEN estado IN ('ATENDIDA', 'AUSENTE', 'CANCELADA') THEN 1 END) AS total_cerradas,
    avg(CASE WHEN "esAtendida" = 1 THEN "tiempoEsperaMin" END) AS espera"""


def _kpi(tickets_where: str, saturation_where: str) -> str:
    return f"""{_SAT},
totals AS (SELECT {_KPI_COLUMNS} FROM wide WHERE {tickets_where}),
idx AS (SELECT CASE WHEN count(*) = 0 THEN 0.0::DOUBLE ELSE
        {_even('CAST(sum(CAST(indice_saturacion_pct AS DECIMAL(10,2))) AS DOUBLE) / nullif(count(indice_saturacion_pct), 0)', 1)}
        END AS indice_saturacion FROM sat WHERE {saturation_where}),
kpi AS (
  SELECT total_fichas, total_atendidas, total_ausentes, total_canceladas, total_cerradas,
         coalesce({_rate('total_ausentes', 'total_cerradas', 2)}, 0.0) AS tasa_ausentismo,
         CAST({_even('espera', 1)} AS DOUBLE) AS espera_promedio,
         coalesce({_rate('total_atendidas', 'total_fichas', 1)}, 0.0) AS tasa_atencion,
         CAST((SELECT indice_saturacion FROM idx) AS DOUBLE) AS indice_saturacion
  FROM totals
)"""


def _drill(where: str, by: str) -> str:
    return f"""WITH {_WIDE},
g AS (
  SELECT "{by}", {_sum('conteoFicha')} AS total_fichas, {_sum('esAtendida')} AS atendidas,
         {_sum('esAusente')} AS ausentes, {_sum('esCancelada')} AS canceladas,
         avg("tiempoEsperaMin") AS espera
  FROM wide WHERE {where} GROUP BY 1
)
SELECT "{by}", total_fichas, atendidas, ausentes, canceladas,
       {_rate('atendidas', 'total_fichas', 1)} AS tasa_atencion,
       {_rate('ausentes', 'total_fichas', 1)} AS tasa_ausentismo,
       CAST({_even('espera', 1)} AS DOUBLE) AS espera_prom
FROM g"""


def _nulls(columns: list[str]) -> str:
    parts = [
        f"SELECT 'fichas' AS tabla, '{c}' AS columna, count(*) AS filas, "
        f'count(*) - count("{c}") AS nulos FROM silver'
        for c in columns
    ]
    return "\nUNION ALL ".join(parts)


_TICKET_SILVER_COLUMNS = [
    "codigoFicha", "fechaHoraReserva", "fechaHoraAtencion", "estado", "prioridad",
    "canalReserva", "tiempoEsperaMin", "motivoReprogramacion", "resultadoAtencion",
    "indicaciones", "diagnostico", "idPaciente", "nombrePaciente", "sexo", "fechaNacimiento",
    "idMedico", "nombreMedico", "especialidad", "centroSalud", "capacidadDiaria",
    "departamento", "ciudad", "zona", "area", "anio", "mes", "dia", "fecha", "edad_aprox",
]

_KEY_COUNTS = (
    ("DimTiempo", "fecha_key"), ("DimCentroSalud", "centro_key"),
    ("DimEspecialidad", "especialidad_key"), ("DimCanal", "canal_key"),
    ("DimEstado", "estado_key"), ("DimContextoCEPAL", "contexto_key"),
)


def _star_checks() -> str:
    """A star without faults: every rule is listed with no violations, counted over the facts."""
    zero = {
        "fecha_key": "fecha IS NULL", "centro_key": '"centroSalud" IS NULL',
        "especialidad_key": "especialidad IS NULL", "canal_key": '"canalReserva" IS NULL',
        "estado_key": "estado IS NULL",
    }
    parts = [
        f"SELECT 'clave {table}' AS regla, '{key}' AS columna, CAST(0 AS BIGINT) AS violaciones"
        for table, key in _KEY_COUNTS
    ]
    parts.append(
        "SELECT 'clave FactAtenciones', 'atencion_key', "
        'count(*) - count(DISTINCT "codigoFicha") FROM wide'
    )
    for key, test in zero.items():
        parts.append(f"SELECT 'claves completas', '{key}', count(*) FILTER ({test}) FROM wide")
    for _, key in _KEY_COUNTS:
        test = zero.get(key, "FALSE")
        parts.append(f"SELECT 'referencia', '{key}', count(*) FILTER ({test}) FROM wide")
    return f"WITH {_WIDE}\n" + "\nUNION ALL ".join(parts)


def all_oracles() -> dict[str, str]:
    q: dict[str, str] = {}

    q["clean_text"] = f"""
SELECT c_custkey,
       upper(regexp_replace(regexp_replace({_untidy('c_mktsegment')}, '^{_WS}+', ''),
                            '{_WS}+$', '')) AS segmento
FROM customer"""
    q["replace_map"] = """
SELECT c_custkey, CASE c_mktsegment WHEN 'FURNITURE' THEN 'MUEBLES'
                  WHEN 'MACHINERY' THEN 'MAQUINARIA' ELSE c_mktsegment END AS segmento
FROM customer"""
    q["fill_default"] = """
SELECT l_orderkey || '-' || l_linenumber AS "codigoCampana", l_partkey,
       CASE WHEN l_linenumber % 3 = 0 THEN 'https://img.example/' || l_partkey
            ELSE 'SIN DATO' END AS "imagenUrl"
FROM lineitem"""
    k = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
    q["decode_year"] = f"""
SELECT event_id, CASE WHEN {k} < 50 THEN 2000 + {k} WHEN {k} < 90 THEN 1950 + {k} END AS anio
FROM events"""
    q["lenient_cast"] = """
SELECT event_id,
       CASE WHEN event_id % 7 <> 0
            THEN CAST(CAST(date_trunc('hour', ts) AS TIMESTAMP) AS VARCHAR) END AS hora,
       CASE WHEN event_id % 5 <> 0 THEN value END AS valor
FROM events"""
    q["date_parts"] = f"""
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS fecha,
       CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS fecha_key,
       year(o_orderdate) AS anio, quarter(o_orderdate) AS trimestre, month(o_orderdate) AS mes,
       {_names(MONTH_NAMES, 'month(o_orderdate)')} AS nombre_mes,
       day(o_orderdate) AS dia, isodow(o_orderdate) AS dia_semana,
       {_names(DAY_NAMES, 'isodow(o_orderdate)')} AS nombre_dia,
       strftime(o_orderdate, '%Y-%m') AS periodo
FROM orders"""
    q["age_years"] = f"""
WITH {_BASE} SELECT c_custkey AS "idPaciente", {_AGE} AS edad_aprox FROM patient"""
    q["duration_days"] = """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(floor((epoch(l_shipdate) - epoch(o_orderdate) - 21600) / 86400) AS BIGINT)
         AS "duracionDias"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
    q["state_flags"] = f"""
WITH {_WIDE}
SELECT "codigoFicha", "esAtendida", "esAusente", "esCancelada", "esReservada", "conteoFicha"
FROM wide"""
    q["flatten_json"] = f"""
SELECT event_id, {k} AS doc_a_k, event_type AS doc_tipo FROM events"""

    q["dedup_first"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice) = 1"""
    q["drop_null_required"] = f"""
WITH {_BASE}
SELECT CAST(o_orderkey AS VARCHAR) AS "codigoFicha",
       CAST(CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 HOUR AS VARCHAR) AS "fechaHoraAtencion",
       CAST(nac AS VARCHAR) AS "fechaNacimiento"
FROM base JOIN patient ON o_custkey = c_custkey
WHERE st = 'atendida' AND nac IS NOT NULL"""
    q["dense_key_ranges"] = """
SELECT o_orderkey, CAST(CAST(o_orderdate AS TIMESTAMP) AS VARCHAR) AS o_orderdate, o_custkey,
       row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS clave
FROM orders"""
    q["csv_roundtrip"] = f"""
WITH {_BASE}
SELECT CAST(o_orderkey AS VARCHAR) AS "codigoFicha", {_untidy('st')} AS estado,
       CAST(CAST(o_orderdate AS TIMESTAMP) AS VARCHAR) AS "fechaHoraReserva",
       CASE WHEN st IN ('atendida', 'cancelada')
            THEN CAST(CAST(floor(o_totalprice) AS BIGINT) % 120 AS DOUBLE) END
         AS "tiempoEsperaMin",
       CASE WHEN o_orderkey % 3 = 0 THEN 'reposo' END AS indicaciones
FROM base"""
    q["top_rows"] = f"""
WITH {_SAT} SELECT * FROM sat ORDER BY total_fichas_dia DESC, fecha, "centroSalud" LIMIT 5"""

    q["extract_tickets"] = f"""
WITH {_BASE}
SELECT CAST(o_orderkey AS VARCHAR) AS "codigoFicha",
       CAST(CAST(o_orderdate AS TIMESTAMP) AS VARCHAR) AS "fechaHoraReserva",
       CASE WHEN st = 'atendida'
            THEN CAST(CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 HOUR AS VARCHAR) END
         AS "fechaHoraAtencion",
       st AS estado, o_orderpriority AS prioridad, o_orderpriority AS "canalReserva",
       CASE WHEN st IN ('atendida', 'cancelada')
            THEN CAST(CAST(floor(o_totalprice) AS BIGINT) % 120 AS DOUBLE) END
         AS "tiempoEsperaMin",
       CASE WHEN st = 'cancelada' THEN 'viaje' END AS "motivoReprogramacion",
       CASE WHEN st = 'atendida' AND o_orderkey % 2 = 0 THEN 'atencion exitosa'
            WHEN st = 'atendida' THEN 'derivado' END AS "resultadoAtencion",
       CASE WHEN o_orderkey % 3 = 0 THEN 'reposo' END AS indicaciones,
       CASE o_orderkey % 3 WHEN 1 THEN 'Infeccion respiratoria aguda' WHEN 2 THEN 'gripe' END
         AS diagnostico,
       o_custkey AS "idPaciente", pat.c_name AS "nombrePaciente", pat.sexo,
       CAST(pat.nac AS VARCHAR) AS "fechaNacimiento",
       s_suppkey AS "idMedico", doc.c_name AS "nombreMedico", esp.r_name AS especialidad,
       lower(n_name) AS "centroSalud", CAST(cap AS BIGINT) AS "capacidadDiaria",
       lower(place.r_name) AS departamento, n_name AS ciudad,
       CASE WHEN n_nationkey % 2 = 0 THEN 'norte' END AS zona, 'urbana' AS area
FROM base
JOIN patient pat ON o_custkey = pat.c_custkey
JOIN supplier ON o_custkey % 10 = s_suppkey
JOIN customer doc ON s_suppkey = doc.c_custkey
JOIN region esp ON o_orderkey % 5 = esp.r_regionkey
JOIN place ON o_custkey % 25 = n_nationkey"""
    q["extract_campaigns"] = f"""
SELECT l_orderkey || '-' || l_linenumber AS "codigoCampana", lower(p_type) AS tipo,
       {_untidy('p_name')} AS titulo, p_brand AS descripcion,
       CASE l_linenumber % 3 WHEN 0 THEN '  https://img.example/' || p_partkey || ' '
            WHEN 1 THEN ' nan ' END AS "imagenUrl",
       CAST(CAST(l_shipdate AS TIMESTAMP) AS VARCHAR) AS "fechaInicio",
       CAST(CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS VARCHAR) AS "fechaFin",
       'plaza' AS lugar, CASE WHEN l_tax >= 0.04 THEN 'carnet' END AS requisitos,
       CASE WHEN l_returnflag = 'A' THEN 'familias' END AS "publicoObjetivo",
       CASE WHEN l_discount > 0.01 THEN l_linestatus END AS estado,
       lower(n_name) AS "centroSalud",
       CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       CAST(CAST(l_shipdate AS TIMESTAMP) AS VARCHAR) AS l_shipdate, l_extendedprice
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN nation ON l_suppkey % 25 = n_nationkey"""
    q["extract_centers"] = f"""
SELECT lower(n_name) AS "centroSalud", n_name AS ciudad,
       lower(r_name) AS departamento, 'urbana' AS area,
       CAST(n_nationkey % 4 AS BIGINT) AS "capacidadDiaria"
FROM nation JOIN region ON n_regionkey = r_regionkey"""

    q["silver_tickets"] = f"WITH {_SILVER} SELECT * FROM silver"
    q["silver_tickets_repeated"] = f"""
WITH {_REPEATED}
SELECT {_SILVER_COLUMNS}, l_partkey
FROM lines JOIN base ON l_orderkey = o_orderkey JOIN patient ON o_custkey = c_custkey
JOIN place ON c_nationkey = n_nationkey
WHERE rn = 1 AND l_quantity >= 10"""
    q["silver_campaigns"] = f"WITH {_CAMPAIGNS} SELECT * FROM clean_campaigns"
    q["silver_indicator"] = """
SELECT y AS anio, CASE WHEN y % 2 = 1 THEN 'BOLIVIA' ELSE 'BOL' END AS pais,
       CAST(CAST(total AS BIGINT) AS DOUBLE) AS valor_cepal
FROM (SELECT year(l_shipdate) AS y, l_returnflag AS f, sum(l_quantity) AS total
      FROM lineitem GROUP BY 1, 2)
WHERE f = CASE WHEN y % 2 = 1 THEN 'N' ELSE 'A' END"""

    q["feed_indicator"] = q["silver_indicator"]

    q["dim_calendar"] = _CALENDAR
    q["dim_center"] = _CENTERS
    q["dim_specialty"] = _dim("especialidad", "especialidad_key")
    q["dim_channel"] = _dim("canalReserva", "canal_key")
    q["dim_state"] = _dim("estado", "estado_key")
    q["dim_context"] = f"""
WITH {_WIDE}
SELECT row_number() OVER (ORDER BY anio) AS contexto_key, anio, 'BOL' AS pais, valor_cepal
FROM context"""
    q["campaign_types"] = f"""
WITH {_CAMPAIGNS}
SELECT row_number() OVER (ORDER BY tipo) AS tipo_campana_key, tipo
FROM (SELECT DISTINCT tipo FROM clean_campaigns)"""
    q["fact_visits"] = f"""
WITH {_KEYS}
SELECT row_number() OVER (ORDER BY "fechaHoraReserva", "codigoFicha") AS atencion_key,
       "codigoFicha", CAST(replace(fecha, '-', '') AS BIGINT) AS fecha_key, centro_key,
       e.k AS especialidad_key, ca.k AS canal_key, es.k AS estado_key, cx.k AS contexto_key,
       "tiempoEsperaMin", edad_aprox, "esAtendida", "esAusente", "esCancelada", "esReservada",
       "conteoFicha"
FROM wide w JOIN d_centro ce ON w."centroSalud" = ce."centroSalud"
JOIN d_esp e ON w.especialidad = e.especialidad
JOIN d_canal ca ON w."canalReserva" = ca."canalReserva"
JOIN d_estado es ON w.estado = es.estado
LEFT JOIN d_ctx cx ON w.anio = cx.anio"""
    q["campaign_fact"] = f"""
WITH {_CAMPAIGNS}, d_centro AS ({_CENTERS}),
d_tipo AS (SELECT tipo, row_number() OVER (ORDER BY tipo) AS k
           FROM (SELECT DISTINCT tipo FROM clean_campaigns))
SELECT row_number() OVER (ORDER BY "codigoCampana") AS campana_key, "codigoCampana", centro_key,
       k AS tipo_campana_key,
       CAST(replace(substr("fechaInicio", 1, 10), '-', '') AS BIGINT) AS fecha_inicio_key,
       CAST(replace(substr("fechaFin", 1, 10), '-', '') AS BIGINT) AS fecha_fin_key,
       estado, "duracionDias", CAST(1 AS BIGINT) AS "totalCampanas"
FROM clean_campaigns c JOIN d_centro d ON c."centroSalud" = d."centroSalud"
JOIN d_tipo t ON c.tipo = t.tipo"""
    q["star_wide"] = f"WITH {_WIDE} SELECT {_WIDE_SELECT} FROM wide"

    q["kpis_general"] = f"""
WITH {_WIDE},
days AS (SELECT 100.0 * count(*) / nullif("capacidadDiaria", 0) AS pct
         FROM wide GROUP BY fecha, "centroSalud", "capacidadDiaria"),
t AS (
  SELECT {_sum('conteoFicha')} AS total_fichas, {_sum('esAtendida')} AS total_atendidas,
         {_sum('esAusente')} AS total_ausentes, {_sum('esCancelada')} AS total_canceladas,
         {_sum('esReservada')} AS total_reservadas,
         count(CASE WHEN estado IN ('ATENDIDA', 'AUSENTE', 'CANCELADA') THEN 1 END) AS cerradas,
         sum(CASE WHEN "esAtendida" = 1 THEN "tiempoEsperaMin" END) AS espera,
         count(CASE WHEN "esAtendida" = 1 THEN "tiempoEsperaMin" END) AS con_espera
  FROM wide)
SELECT {_pct('total_ausentes', 'cerradas')} AS tasa_ausentismo_pct,
       {_mean2('espera', 'con_espera')} AS tiempo_promedio_espera_min,
       CAST(CAST((SELECT avg(pct) FROM days) AS DECIMAL(10,2)) AS DOUBLE)
         AS indice_saturacion_promedio_pct,
       total_fichas, total_atendidas, total_ausentes, total_canceladas, total_reservadas
FROM t"""
    q["saturation_daily"] = f"WITH {_SAT} SELECT * FROM sat"
    q["noshow_specialty"] = f"""
WITH {_WIDE}
SELECT especialidad, {_sum('conteoFicha')} AS total_fichas, {_sum('esAusente')} AS total_ausentes,
       {_pct('sum("esAusente")', 'count(*)')} AS tasa_ausentismo_pct
FROM wide GROUP BY 1"""
    wait = 'CASE WHEN "esAtendida" = 1 THEN "tiempoEsperaMin" END'
    q["monthly_series"] = f"""
WITH {_WIDE}
SELECT anio, mes, nombre_mes, count(*) AS total_fichas, {_sum('esAtendida')} AS total_atendidas,
       {_sum('esAusente')} AS total_ausentes, {_sum('esCancelada')} AS total_canceladas,
       {_mean2(f'sum({wait})', f'count({wait})')} AS espera_promedio_min,
       max(valor_cepal) AS valor_cepal
FROM wide GROUP BY 1, 2, 3"""

    q["views_by_sql"] = f"""
WITH {_WIDE}, months AS (SELECT anio, mes, count(*) AS n FROM wide GROUP BY 1, 2)
SELECT w.anio, "centroSalud", nombre_mes, count(*) AS fichas, max(n) AS fichas_mes
FROM wide w JOIN months m ON w.anio = m.anio AND w.mes = m.mes
GROUP BY w.anio, "centroSalud", nombre_mes"""

    q["slice_filter"] = f"""
WITH {_WIDE} SELECT {_WIDE_SELECT} FROM wide
WHERE {_CHOSEN} AND "centroSalud" IN ('NATION_1', 'NATION_4', 'NATION_7')"""
    q["filter_options"] = f"""
WITH {_WIDE}
SELECT DISTINCT 'anio' AS filtro, CAST(anio AS VARCHAR) AS valor FROM wide
UNION ALL SELECT DISTINCT 'centroSalud', "centroSalud" FROM wide
UNION ALL SELECT DISTINCT 'especialidad', especialidad FROM wide"""
    q["kpi_row"] = f"WITH {_kpi('TRUE', 'TRUE')} SELECT * FROM kpi"
    q["kpi_row_chosen"] = (
        f"WITH {_kpi(_CHOSEN, 'anio IN (1996, 1997, 1999)')} SELECT * FROM kpi"
    )
    q["kpi_row_summary"] = q["kpi_row_chosen"]
    q["kpi_bands"] = f"""
WITH {_kpi('TRUE', 'TRUE')}
SELECT tasa_ausentismo,
       CASE WHEN tasa_ausentismo < 15 THEN 'Bajo' WHEN tasa_ausentismo < 25 THEN 'Moderado'
            ELSE 'Crítico' END AS nivel_ausentismo,
       indice_saturacion,
       CASE WHEN indice_saturacion < 80 THEN 'Normal' WHEN indice_saturacion < 100 THEN 'Elevada'
            ELSE 'Sobrecarga' END AS nivel_saturacion
FROM kpi"""
    q["slice_monthly"] = f"""
WITH {_WIDE}
SELECT anio, mes, {_sum('conteoFicha')} AS total_fichas, {_sum('esAtendida')} AS total_atendidas,
       {_sum('esAusente')} AS total_ausentes, {_sum('esCancelada')} AS total_canceladas,
       anio || '-' || lpad(CAST(mes AS VARCHAR), 2, '0') AS periodo
FROM wide WHERE {_CHOSEN} GROUP BY anio, mes"""
    q["dist_state"] = f"""
WITH {_WIDE}, g AS (SELECT estado, {_sum('conteoFicha')} AS total FROM wide GROUP BY 1)
SELECT estado, total, {_rate('total', '(SELECT sum(total) FROM g)', 1)} AS porcentaje FROM g"""
    q["dist_channel"] = f"""
WITH {_WIDE} SELECT "canalReserva", {_sum('conteoFicha')} AS total FROM wide GROUP BY 1"""
    q["slice_noshow"] = f"""
WITH {_WIDE}, g AS (SELECT especialidad, {_sum('conteoFicha')} AS total_fichas,
                           {_sum('esAusente')} AS total_ausentes FROM wide GROUP BY 1)
SELECT *, {_rate('total_ausentes', 'total_fichas', 2)} AS tasa_ausentismo_pct FROM g"""
    q["drill_specialty"] = _drill("especialidad = 'BUILDING'", "centroSalud")
    q["drill_center"] = _drill("\"centroSalud\" = 'NATION_7'", "especialidad")
    q["drill_center_summary"] = q["drill_center"]
    q["kpis_general_summary"] = q["kpis_general"]
    q["monthly_series_summary"] = q["monthly_series"]
    q["drill_display"] = f"""
SELECT especialidad AS "Especialidad", total_fichas AS "Fichas", atendidas AS "Atendidas",
       ausentes AS "Ausentes", canceladas AS "Canceladas", tasa_atencion AS "Atención %",
       tasa_ausentismo AS "Ausentismo %", espera_prom AS "Espera (min)"
FROM ({q['drill_center']})"""
    mean = (
        "CAST(sum(CAST(indice_saturacion_pct AS DECIMAL(10,2))) AS DOUBLE) "
        "/ nullif(count(indice_saturacion_pct), 0)"
    )
    q["saturation_center"] = f"""
WITH {_SAT}
SELECT "centroSalud", CAST({_even(mean, 1)} AS DOUBLE) AS indice_saturacion_pct
FROM sat GROUP BY 1"""
    q["wait_specialty"] = f"""
WITH {_WIDE}
SELECT especialidad, CAST({_even('avg("tiempoEsperaMin")', 1)} AS DOUBLE) AS espera_promedio
FROM wide WHERE "esAtendida" = 1 GROUP BY 1"""
    q["demand_context"] = f"""
WITH {_WIDE}
SELECT anio, {_sum('conteoFicha')} AS total_fichas, max(valor_cepal) AS valor_cepal
FROM wide GROUP BY 1"""
    q["detail_header"] = f"""
WITH {_WIDE}
SELECT count(*) AS total_registros, count(DISTINCT "centroSalud") AS centros_activos,
       count(DISTINCT especialidad) AS especialidades, min(anio) AS anio_min, max(anio) AS anio_max
FROM wide WHERE {_CHOSEN}"""
    q["detail_rows"] = f"""
WITH {_WIDE}
SELECT fecha, "centroSalud", especialidad, estado, "canalReserva", "tiempoEsperaMin", edad_aprox,
       departamento, ciudad
FROM wide ORDER BY fecha DESC"""

    q["profile_nulls"] = f"WITH {_SILVER}\n{_nulls(_TICKET_SILVER_COLUMNS)}"
    pairs = " || ',' || ".join(
        f"""'"{c}":' || (count(*) - count("{c}"))""" for c in _TICKET_SILVER_COLUMNS
    )
    q["summary_document"] = f"""
WITH {_SILVER}
SELECT count(*) AS filas_fichas, '{{' || {pairs} || '}}' AS nulos_fichas FROM silver"""
    q["check_unique"] = """
SELECT 'lineas unicas' AS regla, 'l_orderkey,l_linenumber' AS columna,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS violaciones
FROM lineitem"""
    q["check_not_null"] = f"""
WITH {_REPEATED},
r AS (SELECT l_quantity, nac, n_nationkey, st FROM lines JOIN base ON l_orderkey = o_orderkey
      JOIN patient ON o_custkey = c_custkey JOIN place ON c_nationkey = n_nationkey)
SELECT 'fichas completas' AS regla, 'codigoFicha' AS columna, CAST(0 AS BIGINT) AS violaciones
UNION ALL SELECT 'fichas completas', 'estado', count(*) FILTER (l_quantity < 10) FROM r
UNION ALL SELECT 'fichas completas', 'fechaNacimiento', count(*) FILTER (nac IS NULL) FROM r
UNION ALL SELECT 'fichas completas', 'zona', count(*) FILTER (n_nationkey % 2 <> 0) FROM r
UNION ALL SELECT 'fichas completas', 'tiempoEsperaMin',
                 count(*) FILTER (st NOT IN ('atendida', 'cancelada')) FROM r"""
    q["check_range"] = """
SELECT 'duracion' AS regla, 'duracionDias>=0' AS columna,
       count(*) FILTER (l_partkey % 10 = 0
                        OR epoch(l_shipdate) < epoch(o_orderdate) + 21600) AS violaciones
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
    q["check_orphans"] = """
SELECT 'referencia' AS regla, 'o_orderkey' AS columna, count(*) AS violaciones FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'referencia', 'o_custkey', count(*) FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"""
    q["check_star"] = _star_checks()
    q["row_counts"] = f"""
WITH {_SAT}
SELECT 'DimTiempo' AS tabla, count(DISTINCT fecha) AS total FROM wide
UNION ALL SELECT 'DimCentroSalud', count(*) FROM nation
UNION ALL SELECT 'DimEspecialidad', count(DISTINCT especialidad) FROM wide
UNION ALL SELECT 'DimCanal', count(DISTINCT "canalReserva") FROM wide
UNION ALL SELECT 'DimEstado', count(DISTINCT estado) FROM wide
UNION ALL SELECT 'DimContextoCEPAL', count(*) FROM context
UNION ALL SELECT 'FactAtenciones', count(*) FROM wide
UNION ALL SELECT 'vw_kpis_generales', CAST(1 AS BIGINT)
UNION ALL SELECT 'vw_saturacion_diaria', count(*) FROM sat
UNION ALL SELECT 'vw_ausentismo_especialidad', count(DISTINCT especialidad) FROM wide
UNION ALL SELECT 'vw_serie_mensual', count(DISTINCT (anio, mes)) FROM wide"""
    q["slice_sizes"] = f"""
WITH {_WIDE}
SELECT 'elegido' AS tabla, count(*) AS total FROM wide WHERE {_CHOSEN}
UNION ALL SELECT 'vacio', CAST(0 AS BIGINT)"""
    q["slice_empty"] = f"""
WITH {_WIDE}
SELECT 'elegido' AS seleccion, count(*) = 0 AS vacia FROM wide WHERE {_CHOSEN}
UNION ALL SELECT 'vacio', true"""
    q["clean_optional_columns"] = f"""
WITH {_BASE}
SELECT CAST(o_orderkey AS VARCHAR) AS "codigoFicha", upper(st) AS estado,
       CASE o_orderkey % 3 WHEN 0 THEN 'SIN DATO' WHEN 1 THEN 'IRA' ELSE 'GRIPE' END AS diagnostico
FROM base"""
    q["enforced_rules"] = f"""
WITH {_REPEATED},
r AS (SELECT l_quantity FROM lines JOIN base ON l_orderkey = o_orderkey
      JOIN patient ON o_custkey = c_custkey JOIN place ON c_nationkey = n_nationkey),
broken AS (SELECT count(*) FILTER (l_quantity < 10) AS n FROM r)
SELECT 'fichas' AS tabla, CASE WHEN n = 0 THEN 'ok'
  ELSE 'quality rules violated: estado presente [estado]: ' || n END AS resultado FROM broken
UNION ALL SELECT 'lineas', 'ok'"""
    q["stored_document"] = f"""
WITH {_SILVER} SELECT columna, filas, nulos FROM ({_nulls(_TICKET_SILVER_COLUMNS)})"""
    q["csv_by_header"] = f"""
WITH {_BASE}
SELECT CAST(o_orderkey AS VARCHAR) AS "codigoFicha", {_untidy('st')} AS estado,
       CASE WHEN o_orderkey % 3 = 0 THEN 'reposo' END AS indicaciones
FROM base"""
    q["silver_mixed_dates"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS "codigoFicha",
       CAST(CAST(o_orderdate AS TIMESTAMP) AS VARCHAR) AS "fechaHoraReserva",
       year(o_orderdate) AS anio, month(o_orderdate) AS mes,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS fecha
FROM orders WHERE o_orderkey % 8 <> 3"""
    q["check_unread_dates"] = """
SELECT 'fechas leidas' AS regla, 'fechaHoraReserva' AS columna,
       count(*) FILTER (o_orderkey % 8 = 3) AS violaciones
FROM orders JOIN customer ON o_custkey = c_custkey"""
    q["star_null_labels"] = f"""
WITH {_SILVER},
t AS (SELECT CASE WHEN CAST("codigoFicha" AS BIGINT) % 7 <> 0 THEN especialidad END AS especialidad,
             CASE WHEN CAST("codigoFicha" AS BIGINT) % 11 <> 0 THEN "canalReserva" END AS "canalReserva"
      FROM silver),
e AS (SELECT especialidad, row_number() OVER (ORDER BY especialidad NULLS LAST) AS especialidad_key
      FROM (SELECT DISTINCT especialidad FROM t)),
c AS (SELECT "canalReserva", row_number() OVER (ORDER BY "canalReserva" NULLS LAST) AS canal_key
      FROM (SELECT DISTINCT "canalReserva" FROM t))
SELECT especialidad_key, e.especialidad, canal_key, c."canalReserva", count(*) AS fichas
FROM t JOIN e ON t.especialidad IS NOT DISTINCT FROM e.especialidad
  JOIN c ON t."canalReserva" IS NOT DISTINCT FROM c."canalReserva"
GROUP BY ALL"""
    q["lookup_fan_out"] = """
SELECT 'pedido ambiguo' AS regla, 'o_orderkey' AS columna, count(*) AS violaciones
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)"""
    q["check_campaigns"] = f"""
WITH {_BASE}, {_CAMPAIGNS},
centers AS ({_CENTERS}),
same AS (SELECT "centroSalud" FROM centers GROUP BY 1 HAVING count(*) > 1),
fact AS (
  SELECT c.*, centro_key FROM clean_campaigns c LEFT JOIN centers USING ("centroSalud")
)
SELECT 'centro ambiguo' AS regla, 'centroSalud' AS columna,
       count(*) FILTER ("centroSalud" IN (SELECT * FROM same)) AS violaciones FROM clean_campaigns
UNION ALL SELECT 'tipo ambiguo', 'tipo', CAST(0 AS BIGINT)
UNION ALL SELECT 'clave DimTipoCampana', 'tipo_campana_key', CAST(0 AS BIGINT)
UNION ALL SELECT 'clave FactCampanas', 'campana_key', CAST(0 AS BIGINT)
UNION ALL SELECT 'campanas unicas en FactCampanas', 'codigoCampana',
  count(*) - count(DISTINCT "codigoCampana") FROM fact
UNION ALL SELECT 'referencia campanas', 'centro_key', CAST(0 AS BIGINT)
UNION ALL SELECT 'referencia campanas', 'tipo_campana_key', CAST(0 AS BIGINT)
UNION ALL SELECT 'claves campanas', 'campana_key', CAST(0 AS BIGINT)
UNION ALL SELECT 'claves campanas', 'codigoCampana', count(*) FILTER ("codigoCampana" IS NULL) FROM fact
UNION ALL SELECT 'claves campanas', 'tipo_campana_key', CAST(0 AS BIGINT)
UNION ALL SELECT 'claves campanas', 'fecha_inicio_key', count(*) FILTER ("fechaInicio" IS NULL) FROM fact
UNION ALL SELECT 'claves campanas', 'fecha_fin_key', count(*) FILTER ("fechaFin" IS NULL) FROM fact"""
    q["published_run"] = "SELECT r_regionkey, r_name FROM region"
    return q
