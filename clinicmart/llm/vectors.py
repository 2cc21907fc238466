"""Pairs of similar vectors by dual traversal of cover trees.

On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2c). A cover tree
holds nested levels of centres: those of a level are further apart than its radius, each
point lies within the radius of a centre, and the radius halves from level to level.
Two nodes whose centres are further apart than both covering radii and the distance
asked for hold no pair, and neither does anything below them.

The upper levels are fitted on a bounded sample and deal the vectors to cells; the lower
ones are built inside blocks of a bounded size, so that cells that hold very many
vectors are split. Pairs of blocks are searched in tasks of their own. Every vector is in a
block and every pair of cells within reach is searched, so the pairs are exact whatever
the sample. Equal vectors are reduced to one first.

What the bounds can prune depends on the data: where vectors fall into clusters, most
pairs of nodes go at the upper levels; where all vectors are about equally far from each other,
as random ones in many dimensions are, the levels tell nothing apart and the work is that of
comparing all pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicmart.llm.common import bound_batches, named, saved
from clinicmart.llm.graph import components

COSINE = 0.9
#: Vectors of a block, and bytes of one if vectors are long.
BLOCK_ROWS = 2048
BLOCK_BYTES = 4 << 20
#: Vectors the upper levels are fitted on, and cells they may make.
SAMPLE = 1024
CELLS = 64
LEVELS = 5
_SLACK = 1e-9


def usable(vector: Column) -> Column:
    """True for vectors that are there, finite and not zero."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def distance(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosines, 0))


def net(cosines: np.ndarray, radius: float, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres, beginning with those given, and the centre each point is covered by."""
    least = 1 - radius * radius / 2
    centre = np.full(len(cosines), -1)
    chosen = []
    for i in [*first.tolist(), *range(len(cosines))]:
        if len(chosen) < len(first) or centre[i] < 0:
            new = (centre < 0) & (cosines[i] >= least)
            new[i] = centre[i] < 0
            centre[new] = len(chosen)
            chosen.append(i)
    return np.array(chosen), centre


def build(points: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of a cover tree, top first: (centres, parent of each, covering radius of each).

    The last level is the points themselves. Levels that would hold more than half of
    them are left out: they would cost more than they prune.
    """
    cosines = points @ points.T
    levels, centres = [], np.zeros(1, np.int64)
    holder = np.zeros(len(points), np.int64)
    levels.append((centres, np.zeros(1, np.int64), np.array([distance(cosines[0]).max()])))
    radius = 1.0
    for _ in range(LEVELS):
        chosen, centre = net(cosines, radius, centres)
        radius /= 2
        if len(chosen) > len(points) // 2:
            break
        if len(chosen) == len(centres):
            continue
        parent = holder[chosen]
        # Points stay below the parent of their centre, so that the tree is one.
        holder, centres = centre, chosen
        cover = np.zeros(len(chosen))
        np.maximum.at(cover, holder, distance(cosines[chosen[holder], np.arange(len(points))]))
        levels.append((chosen, parent, cover))
    # Covering radii of upper nodes over all points that ended below them.
    above = holder
    for k in range(len(levels) - 1, -1, -1):
        chosen, parent, cover = levels[k]
        cover = np.zeros(len(chosen))
        np.maximum.at(cover, above, distance(cosines[chosen[above], np.arange(len(points))]))
        levels[k] = (chosen, parent, cover)
        above = parent[above]
    levels.append((np.arange(len(points)), holder, np.zeros(len(points))))
    return levels


def traverse(
    left: np.ndarray, left_levels: list, right: np.ndarray, right_levels: list, cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """Points of either side that are similar enough, level by level."""
    reach = float(np.sqrt(max(2 - 2 * cosine, 0.0))) + _SLACK
    live = np.ones((1, 1), bool)
    depth = max(len(left_levels), len(right_levels))
    a_at = b_at = -1
    for step in range(depth):
        # The shorter tree waits at its last level before the points.
        a_new = _next(a_at, step, depth, len(left_levels))
        b_new = _next(b_at, step, depth, len(right_levels))
        a, b = left_levels[a_new], right_levels[b_new]
        live = live[a[1]] if a_new != a_at and a_at >= 0 else live
        live = live[:, b[1]] if b_new != b_at and b_at >= 0 else live
        a_at, b_at = a_new, b_new
        rows, columns = np.flatnonzero(live.any(1)), np.flatnonzero(live.any(0))
        if not len(rows):
            break
        part = left[a[0][rows]] @ right[b[0][columns]].T
        if step == depth - 1:
            hit = live[np.ix_(rows, columns)] & (part >= cosine - _SLACK)
            i, j = np.nonzero(hit)
            return rows[i], columns[j]
        near = distance(part) <= a[2][rows][:, None] + b[2][columns][None, :] + reach
        live[np.ix_(rows, columns)] &= near
    return np.empty(0, np.int64), np.empty(0, np.int64)


def _next(at: int, step: int, depth: int, levels: int) -> int:
    return levels - 1 if step == depth - 1 else min(at + 1, levels - 2)


def exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosines of matching rows in double precision, whatever their scale."""
    left, right = _scaled(left), _scaled(right)
    dots = np.einsum("ij,ij->i", left, right)
    return dots / np.sqrt(np.einsum("ij,ij->i", left, left) * np.einsum("ij,ij->i", right, right))


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two, which is exact, so that squares neither overflow nor vanish."""
    exponent = np.frexp(np.abs(rows).max(1, initial=0))[1]
    return np.ldexp(rows, -exponent[:, None])


def _cells(sample: np.ndarray) -> np.ndarray:
    """Centres of the deepest upper level that is still small."""
    centres = sample[:1]
    if len(sample):
        cosines = sample @ sample.T
        chosen, radius = np.zeros(1, np.int64), 1.0
        for _ in range(LEVELS):
            chosen, _ = net(cosines, radius, chosen)
            if len(chosen) > CELLS:
                break
            centres, radius = sample[chosen], radius / 2
    return centres


def links(distinct: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(a, b)`` of all pairs of ``(id, vector)`` with a cosine of at least ``cosine``, a < b.

    Vectors are usable and of one length; ids are distinct.
    """
    spark = distinct.sparkSession
    # Bounded by SAMPLE.
    some = distinct.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    if not some:
        return spark.createDataFrame([], "a bigint, b bigint")
    centres = _cells(unit(np.array([r["vector"] for r in some], float)))
    width = len(some[0]["vector"])
    rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * width)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _points(batch.column("vector"), width)
            cosines = unit(points) @ centres.T
            cell = cosines.argmax(1)
            far = distance(cosines[np.arange(len(cell)), cell])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), pa.array(cell.astype(np.int32)), pa.array(far)],
                ["id", "vector", "cell", "far"],
            )

    vector = distinct.schema["vector"].dataType.simpleString()
    dealt = saved(
        distinct.select("id", "vector").mapInArrow(
            deal, f"id bigint, vector {vector}, cell int, far double"
        ),
        "cells",
    )
    # One row per cell.
    cells = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()
    blocks = {c["cell"]: -(-c["n"] // rows) for c in cells}
    reach = float(np.sqrt(max(2 - 2 * cosine, 0.0))) + _SLACK
    near = [
        (c["cell"], blocks[c["cell"]], d["cell"], blocks[d["cell"]])
        for c in cells
        for d in cells
        if c["cell"] <= d["cell"]
        and distance(centres[c["cell"]] @ centres[d["cell"]]) <= c["far"] + d["far"] + reach
    ]
    count = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair])[F.col("cell")]
    placed = dealt.withColumn("part", F.pmod(F.xxhash64("id"), count).cast("int"))
    trees = saved(
        placed.repartition("cell", "part").groupBy("cell", "part").applyInPandas(
            _tree(width), "cell int, part int, ids binary, points binary"
        ),
        "trees",
    )
    pairs = (
        spark.createDataFrame(near, "a_cell int, a_parts int, b_cell int, b_parts int")
        .withColumn("a_part", F.explode(F.sequence(F.lit(0), F.col("a_parts") - 1)))
        .withColumn("b_part", F.explode(F.sequence(F.lit(0), F.col("b_parts") - 1)))
        .filter("a_cell < b_cell OR a_part <= b_part")
        .select("a_cell", "a_part", "b_cell", "b_part")
    )

    def side(name: str) -> DataFrame:
        return trees.withColumnsRenamed({c: f"{name}_{c}" for c in trees.columns})

    both = pairs.join(side("a"), ["a_cell", "a_part"]).join(side("b"), ["b_cell", "b_part"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, tuple] = {}
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                a, b = _block(row, "a", width, known), _block(row, "b", width, known)
                i, j = traverse(a[2], a[3], b[2], b[3], cosine)
                same = a[0][i] != b[0][j]
                if a is b:
                    same &= i < j
                i, j = i[same], j[same]
                sure = exact(a[1][i], b[1][j]) >= cosine
                x, y = a[0][i[sure]], b[0][j[sure]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"]
                )

    shape = ["a_cell", "a_part", "a_ids", "a_points", "b_cell", "b_part", "b_ids", "b_points"]
    # Rows of blocks are large: few of them go to Python at once.
    with_few = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(with_few)
    spark.conf.set(with_few, "4")
    try:
        return saved(both.select(*shape).mapInArrow(search, "a bigint, b bigint"), "links")
    finally:
        spark.conf.set(with_few, before)


def _points(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width)


def _tree(width: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        points = np.array(rows["vector"].tolist(), float).reshape(len(rows), width)
        first = rows.iloc[0]
        return pd.DataFrame(
            {
                "cell": [first["cell"]],
                "part": [first["part"]],
                "ids": [rows["id"].to_numpy(np.int64).tobytes()],
                "points": [points.tobytes()],
            }
        )

    return pack


def _block(row: dict, side: str, width: int, known: dict) -> tuple:
    """Ids, vectors, unit vectors and tree of a block; the last few are kept."""
    name = row[f"{side}_cell"].as_py(), row[f"{side}_part"].as_py()
    if name not in known:
        while len(known) >= 4:
            known.pop(next(iter(known)))
        ids = np.frombuffer(row[f"{side}_ids"].as_buffer(), np.int64)
        points = np.frombuffer(row[f"{side}_points"].as_buffer(), float).reshape(len(ids), width)
        ones = unit(points)
        known[name] = (ids, points, ones, build(ones))
    return known[name]


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    cosine: float = COSINE,
) -> DataFrame:
    """Per row ``(id, n_links, component_id, kept)``.

    Two rows are linked when their cosine in double precision is at least ``cosine``. Vectors
    that are null, empty, zero or hold a null or a number that is not finite link with
    nothing, and neither do rows without an id (they are kept, without a component).
    Vectors of different lengths are not compared. Rows that repeat an id are vectors
    of their own with one name: each counts as a link of the other if they are similar. An
    empty table gives an empty result.
    """
    bound_batches(vectors.sparkSession)
    rows = named(vectors, id=id_column, vector=vector_column).withColumn("id", F.col("id").cast("bigint"))
    good = rows.filter(usable(F.col("vector")) & F.col("id").isNotNull())
    # 128 bits stand for a vector.
    keys = F.xxhash64("vector").alias("k"), F.xxhash64(F.lit(7), "vector").alias("l")
    distinct = good.groupBy(*keys).agg(
        F.min("id").alias("who"), F.count("*").alias("n"), F.first("vector").alias("vector")
    )
    distinct = saved(distinct.withColumn("id", F.col("k")), "vectors")
    widths = [r[0] for r in distinct.select(F.size("vector")).distinct().collect()]
    found = None
    for width in sorted(widths):
        some = links(distinct.filter(F.size("vector") == width), cosine)
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "a bigint, b bigint")
    both = found.unionByName(found.selectExpr("b AS a", "a AS b"))
    others = both.join(distinct.select(F.col("id").alias("b"), "n"), "b").groupBy("a").agg(
        F.sum("n").alias("others")
    )
    joined = components(found).withColumnRenamed("id", "a")
    each = (
        distinct.select("k", "l", "who", "n", F.col("id").alias("a"))
        .join(others, "a", "left")
        .join(joined, "a", "left")
        .withColumn("component", F.coalesce("component", "a"))
    )
    least = each.groupBy("component").agg(F.min("who").alias("component_id"))
    each = each.join(least, "component").select(
        F.col("k").alias("_k"),
        F.col("l").alias("_l"),
        (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links"),
        "component_id",
    )
    compared = usable(F.col("vector")) & F.col("id").isNotNull()
    all_rows = rows.select("id", *[F.when(compared, k).alias(n) for k, n in zip(keys, ("k", "l"))])
    match = (F.col("k") == F.col("_k")) & (F.col("l") == F.col("_l"))
    component = F.coalesce("component_id", "id")
    return all_rows.join(each, match, "left").select(
        "id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
