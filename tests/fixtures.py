"""Small literal tables: tickets with every edge the rules speak of, and golden rows."""

from __future__ import annotations

from datetime import date, datetime

TICKET_SCHEMA = (
    "orden int, codigoFicha string, fechaHoraReserva string, fechaHoraAtencion string, "
    "estado string, prioridad string, canalReserva string, tiempoEsperaMin string, "
    "motivoReprogramacion string, resultadoAtencion string, indicaciones string, "
    "diagnostico string, idPaciente string, nombrePaciente string, sexo string, "
    "fechaNacimiento string, idMedico string, nombreMedico string, especialidad string, "
    "centroSalud string, capacidadDiaria bigint, departamento string, ciudad string, "
    "zona string, area string"
)


def ticket(order, code, when, state, wait=None, specialty="Medicina", center="Centro A",
           capacity=2, channel="web", birth="1980-01-01", result=None, diagnosis=None):
    return (
        order, code, when, None, state, "normal", channel, wait, None, result, None, diagnosis,
        "p1", "ana", "F", birth, "m1", "luis", specialty, center, capacity, "tarija", "tarija",
        None, "urbana",
    )


TICKETS = [
    ticket(1, "F1", "2024-01-01 08:00:00", " atendida", "10", result="Atencion exitosa"),
    ticket(2, "F2", "2024-01-01 09:00:00", "AUSENTE\t", None, diagnosis=" infeccion respiratoria aguda "),
    ticket(3, "F2", "2024-01-05 09:00:00", "atendida", "99"),
    ticket(4, "F3", "2024-01-01 10:00:00", "cancelada", "50", specialty=None),
    ticket(5, "F4", "bad date", "atendida", "1"),
    ticket(6, "F4", "2024-02-01 10:00:00", "atendida", "1"),
    ticket(7, "F5", "2025-02-03 10:00:00", "reservada", "n.d.", specialty="Ñandú", birth=None),
    ticket(8, "F6", "2025-02-03 23:59:59", "atendida", "33", specialty="Ñandú", center="Centro B",
           capacity=0),
    ticket(9, "F7", "2025-02-03 12:00:00", "ausente", None, center="Centro B", capacity=0,
           channel=None),
    ticket(10, "F8", "2025-12-31 12:00:00", None, "5"),
    ticket(11, None, "2025-12-31 12:00:00", "atendida", "5"),
    ticket(12, "F9", "2025-12-31 12:00:00", "atendida", "20", channel=" WEB　"),
    ticket(13, "F10", "2025-12-31 13:00:00", "ausente"),
    ticket(14, "F11", "2025-12-31 13:30:00", "ausente"),
]

CENTERS = [
    ("centro b ", "Tarija", "tarija", "urbana", 0),
    ("Centro A", "Tarija", "Tarija", "Urbana", 2),
    ("CENTRO A", "TARIJA", "TARIJA", "URBANA", 2),
    ("Hospital", "Trinidad", "Beni", "urbana", 160),
]
CENTER_SCHEMA = (
    "centroSalud string, ciudad string, departamento string, area string, capacidadDiaria bigint"
)

RECORDS = [
    (1, "29194", None, "BOL"), (2, "2024", "12.5", " bol "), (3, "2024", "99", "BOL"),
    (4, "2023", "7", "ARG"), (5, "x", "1", "BOL"), (6, "2022", "3", None),
    (7, "2021", "4", "Bolivia"),
]
RECORD_SCHEMA = "orden int, dim_1 string, value string, iso3 string"

AS_OF = date(2025, 6, 15)

# Golden rows: a few campaigns as landed and as they must come out.
CAMPAIGN_SCHEMA = (
    "orden int, codigoCampana string, tipo string, titulo string, descripcion string, "
    "imagenUrl string, fechaInicio string, fechaFin string, lugar string, requisitos string, "
    "publicoObjetivo string, estado string, centroSalud string"
)
CAMPAIGNS = [
    (1, "C1", "Nutrición", "Consejería nutricional familiar", "Orientación.", None,
     "2026-03-08", "2026-03-10", "Trinidad", None, "Familias", "FINALIZADA",
     "Hospital Germán Busch"),
    (2, "C2", "Vacunación", "Campaña COVID refuerzo", "Vacunación, refuerzo.",
     "  https://img.example/covid_refuerzo.jpg  ", "2025-11-13", "2025-11-18", "Santa Cruz",
     "Carnet de vacunación", "Población general", "FINALIZADA", "Hospital Japonés"),
    (3, "C3", "Respiratoria", "  campaña de bronquiolitis  ", "Detección.", None,
     "2026-01-12", "2026-01-16", "El Alto", None, None, "FINALIZADA", "Hospital del Norte"),
    (4, "C4", "Vacunación", "x", "x", None, "2026-01-12", "mal", "y", None, None, "ACTIVA", "z"),
    (5, "C4", "Vacunación", "x", "x", None, "2026-01-12", "2026-01-13", "y", None, None, "ACTIVA",
     "z"),
]
CLEAN_CAMPAIGNS = {
    ("C1", "NUTRICIÓN", "CONSEJERÍA NUTRICIONAL FAMILIAR", "ORIENTACIÓN.", "SIN DATO",
     datetime(2026, 3, 8), datetime(2026, 3, 10), "TRINIDAD", "SIN DATO", "FAMILIAS",
     "FINALIZADA", "HOSPITAL GERMÁN BUSCH", 2),
    ("C2", "VACUNACIÓN", "CAMPAÑA COVID REFUERZO", "VACUNACIÓN, REFUERZO.",
     "https://img.example/covid_refuerzo.jpg", datetime(2025, 11, 13), datetime(2025, 11, 18),
     "SANTA CRUZ", "CARNET DE VACUNACIÓN", "POBLACIÓN GENERAL", "FINALIZADA",
     "HOSPITAL JAPONÉS", 5),
    ("C3", "RESPIRATORIA", "CAMPAÑA DE BRONQUIOLITIS", "DETECCIÓN.", "SIN DATO",
     datetime(2026, 1, 12), datetime(2026, 1, 16), "EL ALTO", "SIN DATO", "SIN DATO",
     "FINALIZADA", "HOSPITAL DEL NORTE", 4),
}

# Golden order of centres: by department, city, name; capitals with accents sort after Z.
GOLDEN_CENTERS = [
    (1, "HOSPITAL GERMÁN BUSCH", "TRINIDAD", "BENI", "URBANA", 160),
    (2, "HOSPITAL SANTA BÁRBARA", "SUCRE", "CHUQUISACA", "URBANA", 210),
    (3, "HOSPITAL VIEDMA", "COCHABAMBA", "COCHABAMBA", "URBANA", 430),
    (4, "HOSPITAL DEL NORTE", "EL ALTO", "LA PAZ", "URBANA", 300),
    (5, "HOSPITAL DE CLÍNICAS", "LA PAZ", "LA PAZ", "URBANA", 480),
    (6, "HOSPITAL DE MONTERO", "MONTERO", "SANTA CRUZ", "URBANA", 230),
    (7, "HOSPITAL JAPONÉS", "SANTA CRUZ DE LA SIERRA", "SANTA CRUZ", "URBANA", 500),
    (8, "CENTRO DE SALUD AVAROA", "BERMEJO", "TARIJA", "URBANA", 95),
    (9, "CENTRO INTEGRAL BERMEJO", "BERMEJO", "TARIJA", "URBANA", 180),
    (10, "CENTRO DE SALUD SAN JORGE", "TARIJA", "TARIJA", "URBANA", 120),
]

# Golden campaign facts: start, end, length, type key and centre key.
GOLDEN_CAMPAIGN_FACTS = {
    ("C1", 1, 1, 20260308, 20260310, "FINALIZADA", 2, 1),
    ("C2", 7, 3, 20251113, 20251118, "FINALIZADA", 5, 1),
    ("C3", 4, 2, 20260112, 20260116, "FINALIZADA", 4, 1),
}
