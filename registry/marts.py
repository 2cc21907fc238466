"""Stored tiers for the test tables.

The clean tickets and the star are built once per application and source
folder and then read from storage, as a dashboard reads them: the views and
slices scan the stored fact and never repeat the joins behind it.
"""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession

from clinicmart.plans import extract, gold, runs, silver
from clinicmart.sources.store import TierStore, work_root
from registry import bindings as b


def clean_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean tickets, computed from the source tables."""
    return silver.clean_tickets(b.bronze_tickets(spark, sf_dir), b.as_of())


def clean_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean campaigns, computed from the source tables."""
    bronze = extract.extract_campaigns(b.campaign_sources(spark, sf_dir))
    return silver.clean_campaigns(bronze, b.LINE_ORDER)


def indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_indicator(b.yearly_records(spark, sf_dir), ["dim_29117"])


def store(spark: SparkSession, sf_dir: str) -> TierStore:
    path = sf_dir.rstrip("/")
    name = f"{path.rsplit('/', 1)[-1]}-{crc32(path.encode()):08x}"
    return TierStore(spark, f"{work_root(spark)}/{name}")


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean tickets as stored."""
    once(build_tickets, spark, sf_dir)
    return store(spark, sf_dir).read(runs.TICKETS)


def star(spark: SparkSession, sf_dir: str) -> gold.Star:
    """The star as stored."""
    once(build_star, spark, sf_dir)
    return runs.load_star(store(spark, sf_dir))


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean campaigns as stored."""
    once(build_campaigns, spark, sf_dir)
    return store(spark, sf_dir).read(runs.CAMPAIGNS)


def campaign_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign types as stored."""
    once(build_campaign_types, spark, sf_dir)
    return store(spark, sf_dir).read(runs.CAMPAIGN_TYPES)


def summary(spark: SparkSession, sf_dir: str) -> gold.Star:
    """The star with the stored summary of its fact."""
    once(build_summary, spark, sf_dir)
    return gold.Star(star(spark, sf_dir).dims, store(spark, sf_dir).read(SUMMARY))


def build_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(spark, sf_dir).write(runs.TICKETS, clean_tickets(spark, sf_dir))


def build_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(spark, sf_dir).write(runs.CAMPAIGNS, clean_campaigns(spark, sf_dir))


def build_campaign_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = gold.campaign_type_dimension(campaigns(spark, sf_dir))
    return store(spark, sf_dir).write(runs.CAMPAIGN_TYPES, types)


def build_star(spark: SparkSession, sf_dir: str) -> gold.Star:
    centers = extract.extract_centers(b.centers(spark, sf_dir))
    return runs.build_star(
        store(spark, sf_dir),
        tickets(spark, sf_dir),
        centers,
        indicator(spark, sf_dir),
        check=False,
    )


def build_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summed = gold.summarise(star(spark, sf_dir)).fact
    return store(spark, sf_dir).write(SUMMARY, summed)


SUMMARY = "ResumenAtenciones"
_built: set[tuple[str, str, str]] = set()


def once(build: Callable, spark: SparkSession, sf_dir: str) -> None:
    """Run a build step unless this application has already run it on the folder."""
    done = (build.__name__, spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if done not in _built:
        build(spark, sf_dir)
        _built.add(done)
