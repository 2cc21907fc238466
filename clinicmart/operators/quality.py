"""Data-quality rules.

Every rule returns rows ``(regla, columna, violaciones)``. ``enforce`` turns
such a report into an error. A report has one row per rule, so collecting it
is cheap whatever the size of the tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clinicmart.operators.joins import lookup

_REPORT = "regla string, columna string, violaciones bigint"


class QualityError(AssertionError):
    """At least one rule is violated."""


def _stack(pairs: Mapping[str, str], names: tuple[str, str]) -> Column:
    """Columns that turn one wide row into (label, value) rows."""
    cells = [part for label, column in pairs.items() for part in (F.lit(label), F.col(f"`{column}`"))]
    return F.stack(F.lit(len(pairs)), *cells).alias(*names)


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """Rows and nulls per column, in one pass: ``(tabla, columna, filas, nulos)``."""
    columns = df.columns
    counts = df.agg(
        F.count("*").alias("filas"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    pairs = {c: f"n{i}" for i, c in enumerate(columns)}
    long = counts.select("filas", _stack(pairs, ("columna", "nulos")))
    return long.select(F.lit(table).alias("tabla"), "columna", "filas", "nulos")


def null_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row with a row count per table and a struct of null counts per table."""
    parts = []
    for name, df in tables.items():
        nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]
        parts.append(
            df.agg(
                F.count("*").alias(f"filas_{name}"),
                F.struct(*nulls).alias(f"nulos_{name}"),
            ).withColumn("_one", F.lit(1))
        )
    # Each part is a single row, so this equi-join is of single rows too.
    merged = reduce(lambda a, b: a.join(b, "_one"), parts)
    order = [f"filas_{n}" for n in tables] + [f"nulos_{n}" for n in tables]
    return merged.select(*order)


def uniqueness(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    """Rows beyond the first of each key; null counts as a value."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    extra = F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint")
    return groups.agg(extra.alias("violaciones")).select(
        F.lit(rule).alias("regla"), F.lit(",".join(keys)).alias("columna"), "violaciones"
    )


def _checks(columns: Sequence[str], minimum: Mapping[str, float] | None) -> dict[str, Column]:
    """Label -> whether a row violates it."""
    checks = {c: F.col(f"`{c}`").isNull() for c in columns}
    for column, low in (minimum or {}).items():
        checks[f"{column}>={low}"] = ~F.coalesce(F.col(column) >= F.lit(low), F.lit(False))
    return checks


class Counted:
    """What is counted while a table is written: rows, nulls per column, and rules.

    ``rules`` are ``(rule, required columns, minimum values)``, as in ``completeness``. The counts
    ride on the write itself, in its last stage, where each task counts once however often it is
    run; so a table that was written with them needs no further scan for these rules.
    """

    def __init__(self, df: DataFrame, *rules: tuple[str, Sequence[str], Mapping[str, float] | None]):
        self.columns = df.columns
        self.spark = df.sparkSession
        self._observation = Observation()
        self._rules = [(rule, _checks(columns, minimum)) for rule, columns, minimum in rules]
        broken = [c for _, checks in self._rules for c in checks.values()]
        self.df = df.observe(
            self._observation,
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(self.columns)],
            *[F.count_if(c).alias(f"r{i}") for i, c in enumerate(broken)],
        )

    @property
    def rows(self) -> int:
        """The number of rows written."""
        return self._observation.get["rows"]

    def nulls(self) -> dict[str, int]:
        """Column -> nulls."""
        counts = self._observation.get
        return {c: counts[f"n{i}"] for i, c in enumerate(self.columns)}

    def report(self) -> DataFrame:
        """The rules, one row each, as ``completeness`` gives them."""
        counts = self._observation.get
        labels = [(rule, label) for rule, checks in self._rules for label in checks]
        rows = [(*label, counts[f"r{i}"]) for i, label in enumerate(labels)]
        return self.spark.createDataFrame(rows, _REPORT)


def counted_summary(tables: Mapping[str, Counted]) -> DataFrame:
    """The row of ``null_summary``, from what was counted while the tables were written."""
    spark = next(iter(tables.values())).spark
    rows = {f"filas_{name}": counted.rows for name, counted in tables.items()}
    nulls = {f"nulos_{name}": counted.nulls() for name, counted in tables.items()}
    fields = [f"{name} bigint" for name in rows]
    for name, counts in nulls.items():
        inner = ", ".join(f"`{c}`: bigint" for c in counts)
        fields.append(f"{name} struct<{inner}>")
    cells = (*rows.values(), *[tuple(c.values()) for c in nulls.values()])
    return spark.createDataFrame([cells], StructType.fromDDL(", ".join(fields)))


def unique_numbers(df: DataFrame, key: str, rule: str) -> DataFrame:
    """``uniqueness`` of a whole number that is dense, by bitmaps of 32,768 numbers.

    A sorted column leaves few bitmaps in each task, so some bits a row are shuffled. A null
    counts as a value.
    """
    number = F.col(f"`{key}`")
    maps = (
        df.groupBy(F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.count("*").alias("n"), F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    )
    distinct = F.when(F.col("bucket").isNull(), F.lit(1)).otherwise(F.bitmap_count("bits"))
    extra = F.coalesce(F.sum(F.col("n") - distinct), F.lit(0)).cast("bigint")
    return maps.agg(extra.alias("violaciones")).select(
        F.lit(rule).alias("regla"), F.lit(key).alias("columna"), "violaciones"
    )


def fan_out(df: DataFrame, reference: DataFrame, on: Sequence[str], rule: str) -> DataFrame:
    """How often a lookup of ``df`` in ``reference`` would repeat a row: rows that meet several.

    Only keys that occur on both sides count; null is a value, as in ``lookup``.
    """
    several = reference.groupBy(*on).agg(F.count("*").alias("_n")).filter("_n > 1")
    used = df.groupBy(*on).agg(F.count("*").alias("_rows"))
    met = lookup(used, several, on, "inner")
    extra = F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint")
    return met.agg(extra.alias("violaciones")).select(
        F.lit(rule).alias("regla"), F.lit(",".join(on)).alias("columna"), "violaciones"
    )


def completeness(
    df: DataFrame, columns: Sequence[str], rule: str, minimum: Mapping[str, float] | None = None
) -> DataFrame:
    """Nulls in required columns and values below a minimum, in one pass.

    A null also violates a minimum.
    """
    checks = _checks(columns, minimum)
    counts = df.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(checks.values())])
    pairs = {label: f"c{i}" for i, label in enumerate(checks)}
    long = counts.select(_stack(pairs, ("columna", "violaciones")))
    return long.select(F.lit(rule).alias("regla"), "columna", "violaciones")


def orphans(
    fact: DataFrame,
    references: Mapping[str, tuple[DataFrame, str]],
    optional: Sequence[str] = (),
    rule: str = "referencia",
) -> DataFrame:
    """Fact rows whose key is missing from its dimension, per key column.

    The fact is read once and shrunk to its distinct keys before any join.
    A null key is an orphan too unless the column is optional.
    """
    pairs = {c: c for c in references}
    types = {fact.schema[c].dataType.simpleString() for c in references}
    types |= {dim.schema[key].dataType.simpleString() for dim, key in references.values()}
    shared = types.pop() if len(types) == 1 else "string"
    keys = fact.select(*[F.col(c).cast(shared).alias(c) for c in references])
    # Facts share few combinations of keys, so that they shrink before they are stacked.
    combined = keys.groupBy(*references).agg(F.count("*").alias("n"))
    used = (
        combined.select("n", _stack(pairs, ("columna", "clave")))
        .groupBy("columna", "clave")
        .agg(F.sum("n").alias("n"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            dim.select(
                F.lit(column).alias("columna"), F.col(key).cast(shared).alias("clave")
            )
            for column, (dim, key) in references.items()
        ],
    ).distinct()
    missing = used.join(known, ["columna", "clave"], "left_anti")
    allowed = F.col("clave").isNull() & F.col("columna").isin(list(optional))
    found = missing.filter(~allowed).groupBy("columna").agg(F.sum("n").alias("n"))
    # One row per key column, also where nothing is missing.
    names = F.array(*[F.lit(c) for c in references])
    listed = fact.sparkSession.range(1).select(F.explode(names).alias("columna"))
    return listed.join(found, "columna", "left").select(
        F.lit(rule).alias("regla"),
        "columna",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("violaciones"),
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(tabla, total)`` for each table or view."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count("*").alias("total")).select(F.lit(name).alias("tabla"), "total")
            for name, df in tables.items()
        ],
    )


def merge_reports(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def enforce(report: DataFrame) -> None:
    """Raise when any rule of the report is violated."""
    broken = report.filter(F.col("violaciones") > 0).collect()
    if broken:
        lines = [f"{r.regla} [{r.columna}]: {r.violaciones}" for r in broken]
        raise QualityError("quality rules violated: " + "; ".join(lines))
