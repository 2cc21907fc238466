"""Mixing sources to target weights by Poisson replication.

A document of source s is wanted ``rate(s)`` times on average. How often it is written
is drawn from the Poisson distribution of that mean by inverting it at a number in
[0, 1) hashed from the seed and the document id: the count is the number of values of
the distribution function that do not exceed the number. Equal input gives equal output
whatever the partitions, and a lost task draws the same again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicmart.llm.common import saved

SEED = "mix-1"
#: A larger mean is drawn as the sum of several draws: exp(-mean) must stay above 0.
DRAW_MEAN = 500.0


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) of 52 bits from md5."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson(mean: Column, at: Column) -> Column:
    """The count at which the distribution function of the mean first exceeds ``at``."""
    # Terms go on far enough for any number of 52 bits: 12 standard deviations and 40 more.
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")
    start = F.struct(
        F.exp(-mean).alias("term"), F.exp(-mean).alias("below"), F.lit(0).cast("int").alias("count")
    )

    def step(state: Column, k: Column) -> Column:
        term = state["term"] * mean / k
        return F.struct(
            term.alias("term"),
            (state["below"] + term).alias("below"),
            (state["count"] + F.when(state["below"] <= at, 1).otherwise(0)).alias("count"),
        )

    return F.aggregate(F.sequence(F.lit(1), last), start, step)["count"]


def copies(mean: Column, seed: str, key: Column) -> Column:
    """How often a document is written: a Poisson count, as a sum of draws where the mean is large."""
    draws = F.greatest(F.ceil(mean / DRAW_MEAN).cast("int"), F.lit(1))
    each = F.transform(
        F.sequence(F.lit(1), draws), lambda i: poisson(mean / draws, uniform(seed, key, i))
    )
    return F.aggregate(each, F.lit(0), lambda a, b: a + b)


def source_rates(
    docs: DataFrame,
    source_column: str,
    size: Column,
    weights: Mapping[str, float] | None = None,
    temperature: float = 0.5,
    total: float = 1.0,
) -> DataFrame:
    """``(source, rate)``: mean copies that bring each source to its share of the mixture.

    The mixture is ``total`` times the size of the input. Shares follow the stated weights;
    without them, the size of the source to the power of ``temperature``. A source that
    the weights leave out, or with no size, has rate 0. A null source is a source.
    """
    sizes = docs.groupBy(F.col(f"`{source_column}`").alias("source")).agg(
        F.sum(size.cast("double")).alias("size")
    )
    if weights is None:
        weight = F.pow("size", F.lit(temperature))
    else:
        weight = F.coalesce(
            F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])[F.col("source")]
            if weights
            else F.lit(None),
            F.lit(0.0),
        ).cast("double")
    weighed = sizes.withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(F.lit(0.0)))
    # One row, of sums over one row per source.
    both = weighed.agg(F.sum("size").alias("all"), F.sum("weight").alias("weights")).first()
    whole, norm = both["all"] or 0.0, both["weights"] or 0.0
    rate = F.when(F.col("weight") > 0, F.lit(total * whole) * F.col("weight") / F.lit(norm) / F.col("size"))
    return weighed.select("source", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    weights: Mapping[str, float] | None = None,
    temperature: float = 0.5,
    total: float = 1.0,
    seed: str = SEED,
) -> DataFrame:
    """The documents, each repeated by its count, in a global random order.

    All columns stay; ``copy_no`` (from 0) and ``shuffle_key`` are added (a column of that
    name is replaced). Rows are dealt to tasks by the key, a hash of seed, id and copy,
    and sorted by it there, so each task writes a random part of the mixture in random order.
    Size is the length of the text; null and empty texts have none and still follow the
    rate of their source. Repeated ids draw the same count. A row without an id draws by a hash of all its
    columns and its number among the rows that equal it, so that each draws for itself. An empty table gives
    an empty one.
    """
    size = F.coalesce(F.char_length(F.col(f"`{text_column}`")), F.lit(0))
    rates = source_rates(docs, source_column, size, weights, temperature, total)
    key, source = F.col("_mix_key"), F.col(f"`{source_column}`")
    # Stored, so that Spark knows the size: a small table is broadcast without dealing the
    # documents by source first, a larger one is joined by shuffle.
    rates = saved(rates.withColumnsRenamed({"source": "_mix_source", "rate": "_mix_rate"}), "rates")
    named = _with_keys(docs.drop("copy_no", "shuffle_key"), id_column)
    counted = named.join(rates, source.eqNullSafe(F.col("_mix_source")), "left")
    count = copies(F.coalesce("_mix_rate", F.lit(0.0)), seed, key)
    repeated = (
        counted.withColumn("_mix_count", count)
        .filter("_mix_count > 0")
        .withColumn("copy_no", F.explode(F.sequence(F.lit(0), F.col("_mix_count") - 1)))
        .drop("_mix_source", "_mix_rate", "_mix_count")
    )
    text = F.concat_ws(":", F.lit(seed), key, F.col("copy_no"))
    keyed = repeated.withColumn("shuffle_key", F.md5(text)).drop("_mix_key")
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def _with_keys(docs: DataFrame, id_column: str) -> DataFrame:
    """Adds ``_mix_key``: the id, or for a row without one the hash of its values and a number.

    Rows without an id that are equal are counted before they meet, and dealt out again by number.
    """
    known = docs.filter(F.col(f"`{id_column}`").isNotNull())
    columns = [F.col(f"`{c}`") for c in docs.columns]
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in docs.columns if c != id_column]
    nameless = docs.filter(F.col(f"`{id_column}`").isNull()).groupBy(*columns).agg(F.count("*").alias("_mix_n"))
    numbered = nameless.withColumn("_mix_n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_mix_n"))))
    key = F.concat_ws(":", F.concat(F.lit("~"), F.md5(F.concat_ws("\x1f", *values))), F.col("_mix_n"))
    return known.withColumn("_mix_key", F.col(f"`{id_column}`").cast("string")).unionByName(
        numbered.withColumn("_mix_key", key).drop("_mix_n")
    )
