"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicmart.llm.common import discard, saved

#: Links that one task holds: 16 bytes each, and some arrays of that size.
ONE_TASK = 1 << 20


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids in some links, and the smallest id each reaches by them."""
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(ids))
    while len(a):
        # Larger roots are hung below smaller ones, then all paths are cut short.
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return ids, ids[root]


def contracted(links: DataFrame) -> DataFrame:
    """``(hi, lo)``: the links ``(hi, lo)`` of each task as stars that connect the same ids."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def star() -> tuple[np.ndarray, np.ndarray]:
            ids, root = roots(*(np.concatenate(part) for part in zip(*held)))
            return ids[ids != root], root[ids != root]

        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy() for c in ("hi", "lo")))
            size += len(batch)
            if size > ONE_TASK:
                held = [star()]
                size = len(held[0][0])
                if size > ONE_TASK // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["hi", "lo"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in star()], ["hi", "lo"])

    return links.mapInArrow(contract, "hi bigint, lo bigint")


def components(links: DataFrame, left: str = "a", right: str = "b", one_task: int = ONE_TASK) -> DataFrame:
    """``(id, component)`` for every id that occurs in a link; component is the smallest id reached.

    Each task first contracts its links. If ``one_task`` links at most are left, one task contracts them all;
    that is a bound on its memory, and gives the same components with fewer rounds. More links are rewritten until each id points at the smallest of its component:
    larger neighbours of a node are tied to its smallest neighbour, then smaller
    ones. Each round is a few aggregates and joins over the links that are left
    and is written to the shared folder. The number of rounds grows with the
    logarithm of the longest path. A node with very many links is reduced to one
    minimum per task before the shuffle, and the join back to it is one that
    adaptive execution can split.

    Links with a null end or equal ends are ignored. An empty table has no
    components.
    """
    a, b = F.col(f"`{left}`"), F.col(f"`{right}`")
    edges = links.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(
        F.greatest(a, b).cast("bigint").alias("hi"), F.least(a, b).cast("bigint").alias("lo")
    )
    edges = saved(contracted(edges), "links")
    before, few = None, edges.count() <= one_task
    if few:
        # A task holds all of them, and each id but the smallest of its component has one link.
        edges = saved(contracted(edges.coalesce(1)), "links")
    while not few:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = edges.selectExpr("hi AS u", "lo AS v").unionAll(edges.selectExpr("lo AS u", "hi AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        upward = both.filter("v > u").join(least, "u").selectExpr("v AS hi", "m AS lo").distinct()
        root = upward.groupBy("hi").agg(F.min("lo").alias("m"))
        tied = upward.join(root, "hi").filter("lo <> m").selectExpr("lo AS hi", "m AS lo")
        last, edges = edges, saved(tied.unionAll(root.selectExpr("hi", "m AS lo")).distinct(), "links")
        discard(last)
    tops = edges.select(F.col("lo").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.selectExpr("hi AS id", "lo AS component").unionByName(tops)


def extended(joined: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: only components are tied together, not the ids in them again.

    ``joined`` is ``(id, component)`` as ``components`` gives it, ``links`` are ``(a, b)`` of ids, some of
    which may be new.
    """
    known = joined.withColumnRenamed("component", "_component")
    for end in ("a", "b"):
        links = links.join(known.withColumnRenamed("id", end), end, "left").withColumn(
            end, F.coalesce("_component", end)
        ).drop("_component")
    ties = saved(components(links), "ties").select(F.col("id").alias("_id"), F.col("component").alias("_top"))
    moved = joined.join(ties, F.col("component") == F.col("_id"), "left").select(
        "id", F.coalesce("_top", "component").alias("component")
    )
    # Ids that had no link before are their own component in the ties.
    new = ties.join(joined, F.col("_id") == F.col("id"), "left_anti")
    return saved(moved.unionByName(new.select(F.col("_id").alias("id"), F.col("_top").alias("component"))), "joined")
