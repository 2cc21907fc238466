"""Column lists, labels and rules shared by all tiers.

Everything here is data. Names are in Spanish because they are the column
names and labels that existing queries use.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------- fixed values
# Column names, labels and constants below are part of the data contract.

TICKET_COLUMNS = (
    "codigoFicha", "fechaHoraReserva", "fechaHoraAtencion", "estado", "prioridad",
    "canalReserva", "tiempoEsperaMin", "motivoReprogramacion", "resultadoAtencion",
    "indicaciones", "diagnostico", "idPaciente", "nombrePaciente", "sexo",
    "fechaNacimiento", "idMedico", "nombreMedico", "especialidad", "centroSalud",
    "capacidadDiaria", "departamento", "ciudad", "zona", "area",
)

CAMPAIGN_COLUMNS = (
    "codigoCampana", "tipo", "titulo", "descripcion", "imagenUrl", "fechaInicio",
    "fechaFin", "lugar", "requisitos", "publicoObjetivo", "estado", "centroSalud",
)

CENTER_COLUMNS = ("centroSalud", "ciudad", "departamento", "area", "capacidadDiaria")

CALENDAR_COLUMNS = (
    "fecha_key", "fecha", "anio", "trimestre", "mes", "nombre_mes", "dia",
    "dia_semana", "nombre_dia",
)

FACT_COLUMNS = (
    "atencion_key", "codigoFicha", "fecha_key", "centro_key", "especialidad_key",
    "canal_key", "estado_key", "contexto_key", "tiempoEsperaMin", "edad_aprox",
    "esAtendida", "esAusente", "esCancelada", "esReservada", "conteoFicha",
)

CAMPAIGN_FACT_COLUMNS = (
    "campana_key", "codigoCampana", "centro_key", "tipo_campana_key",
    "fecha_inicio_key", "fecha_fin_key", "estado", "duracionDias", "totalCampanas",
)

WIDE_COLUMNS = (
    "fecha", "anio", "mes", "nombre_mes", "departamento", "ciudad", "centroSalud",
    "especialidad", "canalReserva", "estado", "tiempoEsperaMin", "esAtendida",
    "esAusente", "esCancelada", "esReservada", "conteoFicha", "edad_aprox",
    "capacidadDiaria", "valor_cepal",
)

DETAIL_COLUMNS = (
    "fecha", "centroSalud", "especialidad", "estado", "canalReserva",
    "tiempoEsperaMin", "edad_aprox", "departamento", "ciudad",
)

ATTENDED, ABSENT, CANCELLED, RESERVED = "ATENDIDA", "AUSENTE", "CANCELADA", "RESERVADA"
CLOSED_STATES = (ATTENDED, ABSENT, CANCELLED)
STATE_FLAGS = {
    "esAtendida": ATTENDED,
    "esAusente": ABSENT,
    "esCancelada": CANCELLED,
    "esReservada": RESERVED,
}

NO_DATA = "SIN DATO"

MONTH_NAMES = (
    "ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO",
    "JULIO", "AGOSTO", "SEPTIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE",
)
DAY_NAMES = ("LUNES", "MARTES", "MIERCOLES", "JUEVES", "VIERNES", "SABADO", "DOMINGO")

# Texts a CSV reader of the pandas family takes for "missing" (public documentation).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Dates as they are written in the country, day first, beside ISO.
DAY_FIRST = ("d/M/yyyy H:mm:ss", "d/M/yyyy H:mm", "d/M/yyyy", "d-M-yyyy H:mm:ss", "d-M-yyyy H:mm", "d-M-yyyy")

YEAR_CODE_OFFSET = 27170
PLAIN_YEARS = (1900, 2100)
DAYS_PER_YEAR = 365.25

HOME_COUNTRY = "BOL"
HOME_COUNTRY_LABELS = ("BOL", "BOLIVIA")
YEAR_COLUMN_CANDIDATES = ("dim_29117", "dim_1", "Anio", "anio", "year", "Year")

# Upper limit (exclusive) and label; the last label has no limit.
NOSHOW_BANDS = ((15, "Bajo"), (25, "Moderado"), (None, "Crítico"))
SATURATION_BANDS = ((80, "Normal"), (100, "Elevada"), (None, "Sobrecarga"))

DRILL_DISPLAY = {
    "centroSalud": "Centro de Salud",
    "especialidad": "Especialidad",
    "total_fichas": "Fichas",
    "atendidas": "Atendidas",
    "ausentes": "Ausentes",
    "canceladas": "Canceladas",
    "tasa_atencion": "Atención %",
    "tasa_ausentismo": "Ausentismo %",
    "espera_prom": "Espera (min)",
}


@dataclass(frozen=True)
class CleanRules:
    """What the clean tier does to one table.

    ``formats`` are patterns of dates beside ISO, tried in order; a text that none of them
    reads is null, and counted as unread.
    """

    key: tuple[str, ...]
    required: tuple[str, ...]
    text: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    fill: tuple[str, ...] = ()
    replace: tuple[tuple[str, tuple[tuple[str, str], ...]], ...] = ()
    urls: tuple[str, ...] = ()
    formats: tuple[str, ...] = DAY_FIRST


TICKET_RULES = CleanRules(
    key=("codigoFicha",),
    required=("codigoFicha", "fechaHoraReserva", "estado", "centroSalud"),
    timestamps=("fechaHoraReserva", "fechaHoraAtencion", "fechaNacimiento"),
    numbers=("tiempoEsperaMin",),
    integers=("capacidadDiaria",),
    text=(
        "estado", "prioridad", "canalReserva", "motivoReprogramacion",
        "resultadoAtencion", "indicaciones", "diagnostico", "nombrePaciente",
        "nombreMedico", "especialidad", "centroSalud", "departamento", "ciudad",
        "zona", "area",
    ),
    replace=(
        ("diagnostico", (("INFECCION RESPIRATORIA AGUDA", "IRA"),)),
        ("resultadoAtencion", (("ATENCION EXITOSA", "CONSULTA RESUELTA"),)),
    ),
    fill=("motivoReprogramacion", "resultadoAtencion", "indicaciones", "diagnostico", "zona"),
)

CAMPAIGN_RULES = CleanRules(
    key=("codigoCampana",),
    required=("codigoCampana", "fechaInicio", "fechaFin", "estado"),
    timestamps=("fechaInicio", "fechaFin"),
    text=(
        "tipo", "titulo", "descripcion", "lugar", "requisitos", "publicoObjetivo",
        "estado", "centroSalud",
    ),
    urls=("imagenUrl",),
    fill=("imagenUrl", "requisitos", "publicoObjetivo"),
)

CENTER_TEXT = ("centroSalud", "ciudad", "departamento", "area")

# Number of waits behind a sum of waits, in a summarised fact.
WAIT_COUNT = "con_espera"

# Fact key -> (dimension table, its key). The yearly context is optional.
FACT_KEYS = {
    "fecha_key": ("DimTiempo", "fecha_key"),
    "centro_key": ("DimCentroSalud", "centro_key"),
    "especialidad_key": ("DimEspecialidad", "especialidad_key"),
    "canal_key": ("DimCanal", "canal_key"),
    "estado_key": ("DimEstado", "estado_key"),
    "contexto_key": ("DimContextoCEPAL", "contexto_key"),
}
OPTIONAL_FACT_KEYS = ("contexto_key",)
REQUIRED_FACT_KEYS = tuple(k for k in FACT_KEYS if k not in OPTIONAL_FACT_KEYS)
# ------------------------------------------------------------ end fixed values
