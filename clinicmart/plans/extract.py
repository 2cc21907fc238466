"""Wide extracts from the normalised source tables.

The small tables are joined with each other first, so the ticket table meets
four sides instead of seven. Doctors are few of all users: they are looked up once and
stored, so that Spark knows how few. Patients are left to Spark, which shuffles the
ticket table by patient when there are many. So users are read once a role.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicmart.operators.joins import broadcast_if_small, stored_side
from clinicmart.schema import CAMPAIGN_COLUMNS, CENTER_COLUMNS, TICKET_COLUMNS


def extract_tickets(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per ticket with patient, doctor, specialty, centre and place."""
    users = tables["Usuario"].select("idUsuario", "nombreCompleto")
    patients = (
        tables["Paciente"]
        .select("idPaciente", "idUsuario", "sexo", "fechaNacimiento")
        .join(users, "idUsuario")
        .select(
            "idPaciente", F.col("nombreCompleto").alias("nombrePaciente"),
            "sexo", "fechaNacimiento",
        )
    )
    doctors = (
        tables["Medico"]
        .select("idMedico", "idUsuario")
        .join(users, "idUsuario")
        .select("idMedico", F.col("nombreCompleto").alias("nombreMedico"))
    )
    specialties = tables["Especialidad"].select(
        "idEspecialidad", F.col("nombre").alias("especialidad")
    )
    centers = _centers(tables).drop("idGeografia")
    return (
        tables["FichaMedica"]
        .join(specialties, "idEspecialidad")
        .join(broadcast_if_small(centers), "idCentro")
        .join(stored_side(doctors), "idMedico")
        .join(patients, "idPaciente")
        .select(*TICKET_COLUMNS)
    )


def extract_campaigns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per campaign with the name of its centre.

    Columns beyond the contract, such as an ingest order, are carried along.
    """
    names = tables["CentroSalud"].select("idCentro", F.col("nombre").alias("centroSalud"))
    joined = tables["CampanaMedica"].join(names, "idCentro").drop("idCentro")
    extra = [c for c in joined.columns if c not in CAMPAIGN_COLUMNS]
    return joined.select(*CAMPAIGN_COLUMNS, *extra)


def extract_centers(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Centres with place and daily capacity."""
    return _centers(tables).select(*CENTER_COLUMNS)


def _centers(tables: Mapping[str, DataFrame]) -> DataFrame:
    places = tables["Geografia"].select("idGeografia", "departamento", "ciudad", "zona", "area")
    return (
        tables["CentroSalud"]
        .select("idCentro", "idGeografia", F.col("nombre").alias("centroSalud"), "capacidadDiaria")
        .join(places, "idGeografia")
    )
