"""Row selection: first of a key, required columns, distinct values, previews."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the first row of each key in the given order.

    ``order_by`` together with the keys should be a total order. Spark turns
    the rank filter into a group limit before the shuffle, so a key that
    holds a large part of the rows leaves one row per input task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c) for c in order_by]))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def single_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows as they are, for a source that repeats no key; a repeated key raises when it is read.

    Without an order there is no first row to keep, and any choice would differ from run to run.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    repeated = F.raise_error(F.lit(f"a key of {list(keys)} is repeated and no order is stated")).cast("boolean")
    return df.withColumn("_rank", rank).filter(F.when(F.col("_rank") > 1, repeated).otherwise(True)).drop("_rank")


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.dropna(subset=list(columns))


def first_complete(
    df: DataFrame,
    keys: Sequence[str],
    required: Sequence[str],
    order_by: Sequence[str] | None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """First row per key, then drop incomplete rows: an incomplete first row removes its key.

    Without ``order_by`` no key may be repeated.

    ``prepare`` runs in between, on the rows that are left and spread evenly by
    the shuffle; it must not change the keys. Rows without a key would
    collapse to one row and then be dropped, so when the key is required they
    are dropped before the shuffle instead.
    """
    always = [k for k in keys if k in required]
    keyed = require(df, always) if always else df
    first = single_per_key(keyed, keys) if order_by is None else first_per_key(keyed, keys, order_by)
    return require(prepare(first) if prepare else first, required)


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of the columns the frame has."""
    return [c for c in columns if c in df.columns]


def first_present(df: DataFrame, candidates: Sequence[str], what: str) -> str:
    """First candidate column the frame has."""
    found = present(df, candidates)
    if not found:
        raise ValueError(f"no {what} column: none of {', '.join(candidates)} in {df.columns}")
    return found[0]


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename for display; names the frame lacks are ignored."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values in ascending order."""
    return df.select(column).dropna().distinct().orderBy(column)


def preview(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """First n rows of a stated order."""
    return df.orderBy(*order_by).limit(n)


def is_empty(df: DataFrame) -> bool:
    """True when no row is left; reads one row at most."""
    return df.isEmpty()
