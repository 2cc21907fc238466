"""The batch runs: landing, clean tier, star, and the acceptance check.

Each table is written and read back, with rows, nulls and row rules counted on the way; keys and
references are checked on what was written. Only then is the run published. A run that fails a
rule raises, and readers keep the tables of the run before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from clinicmart.operators import keys, quality
from clinicmart.plans import extract, gold, silver, views
from clinicmart.sources import feed, landing
from clinicmart.sources.landing import INGEST_ORDER
from clinicmart.sources.store import TierStore

# Names of the stored tables.
TICKETS, CAMPAIGNS, INDICATOR = "fichas_silver", "campanas_silver", "cepal_silver"
SUMMARY = "resumen_limpieza"
#: Dates that no format reads, of the rows chosen, whether or not they are kept.
UNREAD = "fechas_no_leidas"
LANDED_TICKETS, LANDED_CAMPAIGNS = "fichas_bronze.csv", "campanas_bronze.csv"
LANDED_FEED = "cepal_bronze.json"
FACT = "FactAtenciones"
CAMPAIGN_FACT, CAMPAIGN_TYPES = "FactCampanas", "DimTipoCampana"


def land_extracts(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Write the two relational extracts as CSV. The feed is landed by its provider."""
    landing.write_csv(extract.extract_tickets(tables), f"{folder}/{LANDED_TICKETS}")
    landing.write_csv(extract.extract_campaigns(tables), f"{folder}/{LANDED_CAMPAIGNS}")


def clean_landed(
    spark: SparkSession, store: TierStore, folder: str, as_of: Column, multi_line: bool = True
) -> dict[str, DataFrame]:
    """Clean tier from landed files, first rows first.

    ``multi_line`` says whether a value may hold a line break; without, large files are split.
    """
    order = [INGEST_ORDER]
    return build_clean_tier(
        store,
        landing.read_csv(spark, f"{folder}/{LANDED_TICKETS}", multi_line, file_order=True),
        landing.read_csv(spark, f"{folder}/{LANDED_CAMPAIGNS}", multi_line, file_order=True),
        feed.read_feed(spark, f"{folder}/{LANDED_FEED}"),
        as_of,
        order, order, order,
    )


def build_clean_tier(
    store: TierStore,
    tickets: DataFrame,
    campaigns: DataFrame,
    records: DataFrame,
    as_of: Column,
    ticket_order: Sequence[str],
    campaign_order: Sequence[str],
    record_order: Sequence[str],
) -> dict[str, DataFrame]:
    """Clean, store, check, summarise and publish the three source tables.

    Beside the summary, a document says how many dates could not be read: a row whose required date is
    one of them is dropped.
    """
    unread = {TICKETS: silver.UnreadDates(), CAMPAIGNS: silver.UnreadDates()}
    chosen = silver.clean_tickets(tickets, as_of, ticket_order, unread=unread[TICKETS])
    planned = silver.clean_campaigns(campaigns, campaign_order, unread=unread[CAMPAIGNS])
    counted = {
        TICKETS: quality.Counted(chosen.drop(INGEST_ORDER), silver.TICKET_COUNTS),
        CAMPAIGNS: quality.Counted(planned.drop(INGEST_ORDER), silver.CAMPAIGN_COUNTS),
        INDICATOR: quality.Counted(silver.clean_indicator(records, record_order), silver.INDICATOR_COUNTS),
    }
    run = store.run()
    clean = run.write_all({name: c.df for name, c in counted.items()})
    quality.enforce(
        quality.merge_reports(
            silver.unique_rules(clean[TICKETS], clean[CAMPAIGNS]), *[c.report() for c in counted.values()]
        )
    )
    names = {"fichas": TICKETS, "campanas": CAMPAIGNS, "cepal": INDICATOR}
    run.write_document(SUMMARY, quality.counted_summary({n: counted[t] for n, t in names.items()}))
    dates = [(table, c, n) for table, found in unread.items() for c, n in found.counts().items()]
    run.write_document(
        UNREAD, store.spark.createDataFrame(dates, "tabla string, columna string, no_leidas bigint")
    )
    run.publish()
    return clean


def build_star(
    store: TierStore,
    tickets: DataFrame,
    centers: DataFrame,
    indicator: DataFrame,
    check: bool = True,
) -> gold.Star:
    """Store the dimensions, then the fact built on the stored dimensions; publish what passes."""
    run = store.run()
    dims = gold.build_dimensions(tickets, centers, indicator).tables()
    stored = gold.Dimensions.from_tables(run.write_all(dims))
    visits = gold.visit_fact(tickets, stored)
    counted = quality.Counted(visits, gold.FACT_COUNTS)
    star = gold.Star(stored, run.write(FACT, counted.df))
    for numbered in (*dims.values(), visits):
        keys.release(numbered)
    if check:
        quality.enforce(quality.merge_reports(gold.key_rules(star), counted.report()))
    run.publish()
    return star


def build_campaign_star(
    store: TierStore, campaigns: DataFrame, centers: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Campaign types and campaign fact; ``centers`` is the stored centre dimension.

    A centre name that stands for several centres is refused, as its campaigns would be repeated.
    """
    run = store.run()
    kinds = gold.campaign_type_dimension(campaigns)
    types = run.write(CAMPAIGN_TYPES, kinds)
    quality.enforce(gold.campaign_lookup_rules(campaigns, centers, types))
    planned = gold.campaign_fact(campaigns, centers, types)
    counted = quality.Counted(planned, gold.CAMPAIGN_FACT_COUNTS)
    fact = run.write(CAMPAIGN_FACT, counted.df)
    for numbered in (kinds, planned):
        keys.release(numbered)
    quality.enforce(
        quality.merge_reports(gold.campaign_key_rules(fact, centers, types), counted.report())
    )
    run.publish()
    return types, fact


def load_star(store: TierStore) -> gold.Star:
    """The star as stored by an earlier run."""
    names = [table for table, _ in gold.FACT_KEYS.values()]
    tables = store.read_all([*names, FACT])
    return gold.Star(gold.Dimensions.from_tables(tables), tables[FACT])


def export_csv(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Write tables as CSV, one folder per table."""
    for name, df in tables.items():
        landing.write_csv(df, f"{folder}/{name}.csv")


def accept(store: TierStore) -> DataFrame:
    """Final check of what is published; returns the rows per table and view.

    A missing table, a repeated or missing key and a key without its
    dimension row all raise. The campaign star is checked where one is published.
    """
    clean = store.read_all([TICKETS, CAMPAIGNS, INDICATOR])
    star = load_star(store)
    reports = [
        silver.silver_rules(clean[TICKETS], clean[CAMPAIGNS], clean[INDICATOR]),
        gold.gold_rules(star),
    ]
    campaigns = store.read_all([CAMPAIGN_TYPES, CAMPAIGN_FACT]) if store.has(CAMPAIGN_FACT) else {}
    if campaigns:
        reports.append(
            gold.campaign_rules(campaigns[CAMPAIGN_FACT], star.dims.center, campaigns[CAMPAIGN_TYPES])
        )
    quality.enforce(quality.merge_reports(*reports))
    named = {name: build(star) for name, build in views.VIEWS.items()}
    return quality.row_counts({**clean, **star.tables(), **campaigns, **named})
