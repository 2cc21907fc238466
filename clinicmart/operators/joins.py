"""Joins: null as a value, and broadcasts behind a size check.

Stored dimensions are joined without a hint: Spark knows the size of their
files, broadcasts below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles
above it, with hot keys split by adaptive execution. For a computed side
Spark only has an estimate, which for a join is the product of its inputs;
``broadcast_if_small`` measures such a side instead, and ``stored_side`` computes it
once and leaves the choice to Spark, which then knows its size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicmart.sources.store import work_root


def lookup(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join in which null matches null; the key columns of ``left`` are kept."""
    aliases = {c: f"_r_{c}" for c in on}
    other = right.withColumnsRenamed(aliases)
    match = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(alias)) for c, alias in aliases.items()]
    )
    return left.join(other, match, how).drop(*aliases.values())


BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a side for broadcast if its rows, written out, fit in ``max_bytes``.

    The size is measured in a distributed pass over the side, so this is for
    sides that are small beside the other one. A larger side is returned as it
    is and joined by shuffle.
    """
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def stored_side(df: DataFrame) -> DataFrame:
    """A computed side, written to the shared work folder and read back.

    For a side whose inputs are large, such as the few users of a role among all: measuring it would
    read them once more. Spark broadcasts it below ``spark.sql.autoBroadcastJoinThreshold``
    and shuffles it above.
    """
    path = f"{work_root(df.sparkSession)}/sides/{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
