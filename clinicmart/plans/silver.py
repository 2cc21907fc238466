"""Clean tier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from clinicmart.functions import dates, parse, text
from clinicmart.operators import quality, rows
from clinicmart.schema import (
    CAMPAIGN_RULES,
    HOME_COUNTRY,
    HOME_COUNTRY_LABELS,
    TICKET_RULES,
    YEAR_COLUMN_CANDIDATES,
    CleanRules,
)
from clinicmart.sources.landing import INGEST_ORDER


def clean_columns(df: DataFrame, rules: CleanRules) -> DataFrame:
    """Types, text, replacements and defaults, for the columns that are there."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def formats(column: str) -> tuple[str, ...]:
        return rules.formats if isinstance(types[column], StringType) else ()

    typed = {
        **{c: parse.lenient_timestamp(F.col(c), *formats(c)) for c in rows.present(df, rules.timestamps)},
        **{c: parse.lenient_number(F.col(c), types[c]) for c in rows.present(df, rules.numbers)},
        **{c: parse.lenient_integer(F.col(c), types[c]) for c in rows.present(df, rules.integers)},
        **{c: text.normalize_text(F.col(c)) for c in rows.present(df, rules.text)},
        **{c: text.clean_url(F.col(c)) for c in rows.present(df, rules.urls)},
    }
    replaced = {
        c: text.replace_values(F.col(c), dict(pairs)) for c, pairs in rules.replace if c in types
    }
    filled = {c: text.fill_default(F.col(c)) for c in rows.present(df, rules.fill)}
    for step in (typed, replaced, filled):
        df = df.withColumns(step) if step else df
    return df


def unread_dates(df: DataFrame, rules: CleanRules, rule: str) -> DataFrame:
    """Rows with a date that none of the formats reads, per column, as a report."""
    present = [c for c in rows.present(df, rules.timestamps) if isinstance(df.schema[c].dataType, StringType)]
    marked = df.select(*[F.when(~parse.unread(F.col(c), *rules.formats), True).alias(c) for c in present])
    return quality.completeness(marked, present, rule)


class UnreadDates:
    """Counts unread dates of the chosen rows, before incomplete ones go, while they are written."""

    def __init__(self) -> None:
        self._observation = Observation()
        self._columns: list[str] = []

    def mark(self, df: DataFrame, rules: CleanRules) -> DataFrame:
        """Keep what the dates looked like."""
        types = {f.name: f.dataType for f in df.schema.fields}
        self._columns = [c for c in rows.present(df, rules.timestamps) if isinstance(types[c], StringType)]
        return df.withColumns({f"_unread_{c}": parse.unread(F.col(c), *rules.formats) for c in self._columns})

    def count(self, df: DataFrame) -> DataFrame:
        names = [f"_unread_{c}" for c in self._columns]
        if not names:
            return df
        return df.observe(self._observation, *[F.count_if(F.col(n)).alias(n) for n in names]).drop(*names)

    def counts(self) -> dict[str, int]:
        """Column -> unread dates; known once the rows are written."""
        found = self._observation.get if self._columns else {}
        return {c: found[f"_unread_{c}"] for c in self._columns}


def _arrival(df: DataFrame, order_by: Sequence[str] | None) -> Sequence[str] | None:
    """The stated order, else the ingest order, else none."""
    if order_by is not None:
        return order_by
    return [INGEST_ORDER] if INGEST_ORDER in df.columns else None


def clean_tickets(
    bronze: DataFrame,
    as_of: Column,
    order_by: Sequence[str] | None = None,
    rules: CleanRules = TICKET_RULES,
    unread: UnreadDates | None = None,
) -> DataFrame:
    """Clean tickets, one row per complete ticket.

    ``order_by`` says which of several rows of a ticket came first, by columns
    as they came in. By default that is the ingest order of a landed file; a
    source that has neither must not repeat its keys, which raises.
    ``unread`` counts the dates that no format reads. ``as_of`` is the day ages are counted to; state it, so that a rerun gives
    the same ages.
    """

    def prepare(df: DataFrame) -> DataFrame:
        when = F.col("fechaHoraReserva")
        cleaned = _cleaned(df, rules, unread)
        return cleaned.withColumns(
            {
                "anio": F.year(when),
                "mes": F.month(when),
                "dia": F.dayofmonth(when),
                "fecha": dates.day(when),
                "edad_aprox": dates.age_years(F.col("fechaNacimiento"), as_of),
            }
        )

    return rows.first_complete(
        bronze,
        rules.key,
        rules.required,
        _arrival(bronze, order_by),
        prepare,
    )


def _cleaned(df: DataFrame, rules: CleanRules, unread: UnreadDates | None) -> DataFrame:
    if unread is None:
        return clean_columns(df, rules)
    return unread.count(clean_columns(unread.mark(df, rules), rules))


def clean_campaigns(
    bronze: DataFrame,
    order_by: Sequence[str] | None = None,
    rules: CleanRules = CAMPAIGN_RULES,
    unread: UnreadDates | None = None,
) -> DataFrame:
    """Clean campaigns with their length in days; order and unread dates as for tickets."""

    def prepare(df: DataFrame) -> DataFrame:
        length = dates.whole_days(F.col("fechaInicio"), F.col("fechaFin"))
        return _cleaned(df, rules, unread).withColumn("duracionDias", length)

    return rows.first_complete(
        bronze,
        rules.key,
        rules.required,
        _arrival(bronze, order_by),
        prepare,
    )


def clean_indicator(records: DataFrame, order_by: Sequence[str] = (INGEST_ORDER,)) -> DataFrame:
    """Yearly indicator of the home country: ``anio, pais, valor_cepal``.

    Incomplete records and other countries go first, then the first record
    of each year is kept, so a gap does not hide a later good value.
    """
    year_column = rows.first_present(records, YEAR_COLUMN_CANDIDATES, "year")
    value_column = rows.first_present(records, ("value",), "value")
    types = {f.name: f.dataType for f in records.schema.fields}
    country = text.normalize_text(F.col("iso3")) if "iso3" in types else F.lit(HOME_COUNTRY)
    typed = records.select(
        parse.decode_year(F.col(year_column), types[year_column]).alias("anio"),
        country.alias("pais"),
        parse.lenient_number(F.col(value_column), types[value_column]).alias("valor_cepal"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)],
    )
    complete = rows.require(typed, ["anio", "valor_cepal"])
    home = complete.filter(F.col("pais").isin(*HOME_COUNTRY_LABELS))
    first = rows.first_per_key(home, ["anio"], [f"_o{i}" for i in range(len(order_by))])
    return first.select("anio", "pais", "valor_cepal")


# What is counted while the clean tables are written: (rule, required columns, minimum values).
TICKET_COUNTS = ("fichas completas", ["fechaHoraReserva", "estado", "centroSalud"], None)
CAMPAIGN_COUNTS = ("campanas duracion", [], {"duracionDias": 0})
INDICATOR_COUNTS = ("indicador completo", ["valor_cepal"], None)


def unique_rules(tickets: DataFrame, campaigns: DataFrame) -> DataFrame:
    """The checks on the clean tier that need a shuffle."""
    return quality.merge_reports(
        quality.uniqueness(tickets, ["codigoFicha"], "fichas unicas"),
        quality.uniqueness(campaigns, ["codigoCampana"], "campanas unicas"),
    )


def silver_rules(tickets: DataFrame, campaigns: DataFrame, indicator: DataFrame) -> DataFrame:
    """All checks on the clean tier as one report."""
    return quality.merge_reports(
        unique_rules(tickets, campaigns),
        *[
            quality.completeness(df, columns, rule, minimum)
            for df, (rule, columns, minimum) in (
                (tickets, TICKET_COUNTS), (indicator, INDICATOR_COUNTS), (campaigns, CAMPAIGN_COUNTS),
            )
        ],
    )
