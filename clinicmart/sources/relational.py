"""Normalised source tables.

The extracts take a mapping from table name to DataFrame, so any Spark
source serves: catalog tables, a folder of Parquet, or a database read with
``spark.read.format("jdbc")`` and partitioned by a numeric column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Names of the normalised source tables.
TICKET_TABLES = (
    "FichaMedica", "Paciente", "Usuario", "Medico", "Especialidad", "CentroSalud", "Geografia",
)
CAMPAIGN_TABLES = ("CampanaMedica", "CentroSalud")
CENTER_TABLES = ("CentroSalud", "Geografia")


def load_tables(
    spark: SparkSession, names: Sequence[str], folder: str | None = None
) -> dict[str, DataFrame]:
    """Tables from a folder of Parquet, or from the catalog when no folder is given."""
    if folder is None:
        return {name: spark.table(name) for name in names}
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}
