"""A manifest of a dataset as a content-addressed tree of digests, with proofs for its rows.

Rows are leaves, ordered within their group. Every three neighbours become the digest of
their digests, level by level, until one node of the group is left; these roots, by group,
become the root of all in the same way.

What is stored is records: digest -> children, as ``HEIGHT`` levels in one row, found by
the digest of its top node. So a row stays small (3^HEIGHT leaves at most), and a tree over
10^11 leaves is six tables instead of 23. Equal subtrees are one record.

A proof is found by descent from the root. A request carries the digest it stands at, joins
the record of that digest, and follows the digits of its rank to the base of three; the
children it does not select are collected. Requests that stand at the same digest are one
row with the list of what they want below, so the root is no hot key. The path collected from
the top is reversed at the leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicmart.llm.common import saved
from clinicmart.operators.keys import dense_key

FAN = 3
#: Levels of the tree in one record.
HEIGHT = 4
_WIDTH = FAN**HEIGHT

_RECORD = "digest string, levels int, nodes array<struct<digest:string,children:array<string>>>"
_PATH = "array<struct<place:int,others:array<string>>>"


@dataclass(frozen=True)
class Manifest:
    """Stored parts of a manifest.

    ``leaves``: ``(tree, place, size, digest, item)``, one per row; ``item`` is what the row came with.
    ``trees``: ``(tree, size, digest, top)``, the root of each group. ``records`` are those of
    the trees, lowest level first, ``top`` those above the trees,
    whose leaves are ``above``. ``entry`` is the row of the
    root and ``root`` its digest, none without rows.
    """

    leaves: DataFrame
    trees: DataFrame
    records: list[DataFrame]
    top: list[DataFrame]
    above: DataFrame
    entry: DataFrame
    root: str | None


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` for null, else its length in bytes, a colon, and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """The digest of a row."""
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def build(rows: DataFrame, group: str, order: Sequence[str], digest: str, keep: Sequence[str] = ()) -> Manifest:
    """The manifest of rows that have their ``digest`` already.

    ``order`` decides within a group, nulls first, then the digest: rows equal in both are
    equal leaves, in any order. Groups are ordered as UTF-8 bytes, null first. The columns of
    ``keep`` come back with the proofs. An empty table has no root.
    """
    item = F.struct(F.col(f"`{group}`").alias("_group"), *[F.col(f"`{c}`") for c in keep])
    flat = {"g": group, **{f"o{i}": c for i, c in enumerate(order)}}
    keys = []
    for name, column in flat.items():
        # Nulls come first: whether there is a value sorts before the value.
        keys += [F.col(f"`{column}`").isNotNull().alias(f"{name}_given"), F.col(f"`{column}`").alias(name)]
    narrow = saved(rows.select(*keys, F.col(f"`{digest}`").alias("digest"), item.alias("item")), "leaves")
    names = [f"{n}{part}" for n in flat for part in ("_given", "")]
    ranked = dense_key(narrow, [*names, "digest"], "rank", stored=True).select("g", "digest", "item", "rank")
    groups = saved(ranked.groupBy("g").agg(F.min("rank").alias("first"), F.count("*").alias("size")), "groups")
    groups = dense_key(groups, ["first"], "number", stored=True)
    groups = saved(groups.select(F.col("g").alias("_g"), "first", "size", (F.col("number") - 1).alias("tree")), "groups")
    leaves = ranked.join(groups, F.col("g").eqNullSafe(F.col("_g"))).select(
        "tree", (F.col("rank") - F.col("first")).alias("place"), "size", "digest", "item"
    )
    leaves = saved(leaves, "leaves")
    records, tops = _grow(leaves.drop("item"))
    trees = saved(tops, "trees")
    count = groups.count()
    above = trees.select(
        (F.col("tree") * 0).alias("tree"),
        F.col("tree").alias("place"),
        F.lit(count).cast("bigint").alias("size"),
        "digest",
    )
    # Stored, so that joins from the root have a key and no constant.
    above = saved(above, "above")
    top, root = _grow(above)
    found = root.first()
    return Manifest(leaves, trees, records, top, above, root, found and found.digest)


def _grow(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Records from the leaves up, and ``(tree, size, top, digest)`` of the root of each tree.

    ``nodes`` are ``(tree, place, size, digest)``; ``size`` is the number of leaves of the tree,
    ``top`` the number of tables its records are in.
    """
    tables, roots, height = [], [], 0
    largest = nodes.agg(F.max("size")).first()[0] or 0
    while True:
        # How many nodes the tree has at this height.
        left = F.ceil(F.col("size") / F.lit(_WIDTH**height)).cast("bigint")
        nodes = nodes.withColumn("left", left)
        roots.append(nodes.filter("left = 1").select("tree", "size", F.lit(height).alias("top"), "digest"))
        if -(-largest // _WIDTH**height) <= 1:
            break
        block = F.floor(F.col("place") / _WIDTH).cast("bigint")
        grouped = (
            nodes.filter("left > 1")
            .groupBy("tree", block.alias("place"), "size", "left")
            .agg(F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("nodes"))
            .select("tree", "place", "size", "left", F.col("nodes.digest").alias("leaves"))
        )
        table = saved(grouped.mapInArrow(_combine, f"tree bigint, place bigint, size bigint, {_RECORD}"), "records")
        tables.append(table)
        nodes = table.select("tree", "place", "size", "digest")
        height += 1
    return tables, reduce(DataFrame.unionByName, roots)


def _digest(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The levels above each block of nodes."""
    for batch in batches:
        digests, levels, records = [], [], []
        for left, now in zip(batch.column("left").to_pylist(), batch.column("leaves").to_pylist()):
            nodes, height = [], 0
            while height < HEIGHT and left > 1:
                runs = [now[i : i + FAN] for i in range(0, len(now), FAN)]
                now = [_digest(run) for run in runs]
                nodes += [{"digest": d, "children": run} for d, run in zip(now, runs)]
                height, left = height + 1, -(-left // FAN)
            digests.append(now[0])
            levels.append(height)
            records.append(nodes)
        node = pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("tree"),
                batch.column("place"),
                batch.column("size"),
                pa.array(digests, pa.string()),
                pa.array(levels, pa.int32()),
                pa.array(records, pa.list_(node)),
            ],
            ["tree", "place", "size", "digest", "levels", "nodes"],
        )


def _descend(tables: list[DataFrame], starts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(tree, place, item, digest, path)`` of the leaves wanted.

    ``starts``: ``(tree, top, digest, path)`` where each tree is entered; ``wanted``: ``(tree, place, item)``.
    """
    kind = wanted.schema["item"].dataType.simpleString()
    state = None
    for height in reversed(range(len(tables))):
        entered = starts.filter(F.col("top") == height + 1).select(
            "tree", F.lit(0).cast("bigint").alias("place"), "digest", "path"
        )
        state = entered if state is None else state.unionByName(entered)
        # What is wanted below: leaves at the bottom, else the blocks that hold some.
        ask = wanted if height == 0 else wanted.select(
            "tree", F.floor(F.col("place") / _WIDTH**height).cast("bigint").alias("place")
        ).distinct().withColumn("item", F.lit(None).cast(kind))
        asked = ask.groupBy("tree", F.floor(F.col("place") / _WIDTH).cast("bigint").alias("place")).agg(
            F.collect_list(F.struct((F.col("place") % _WIDTH).cast("int").alias("rank"), "item")).alias("asked")
        )
        records = tables[height].select("digest", "levels", "nodes").dropDuplicates(["digest"])
        rows = state.join(asked, ["tree", "place"]).join(records, "digest")
        below = rows.select("tree", "place", "digest", "path", "levels", "nodes", "asked").mapInArrow(
            _select, f"tree bigint, place bigint, item {kind}, digest string, path {_PATH}"
        )
        state = below if height == 0 else saved(below.drop("item"), "descent")
    # Trees of one leaf have no record: the request has arrived where it enters.
    single = starts.filter("top = 0").select("tree", "digest", "path").join(wanted, "tree")
    single = single.select("tree", "place", "item", "digest", "path")
    return single if state is None else state.unionByName(single)


def _select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follow the digits of each rank from the top of a record; collect the children not selected."""
    step = pa.struct([("place", pa.int32()), ("others", pa.list_(pa.string()))])
    for batch in batches:
        asked = batch.column("asked")
        items = asked.flatten().field("item")
        rows, places, digests, paths = [], [], [], []
        columns = (batch.column(c).to_pylist() for c in ("place", "digest", "path", "levels", "nodes"))
        ranks = asked.flatten().field("rank").to_pylist()
        at = 0
        for i, (block, top, path, levels, nodes) in enumerate(zip(*columns)):
            children = {n["digest"]: n["children"] for n in nodes}
            for rank in ranks[at : at + len(asked[i])]:
                now, steps = top, []
                for level in reversed(range(levels)):
                    place = rank // FAN**level % FAN
                    run = children[now]
                    steps.append({"place": place, "others": run[:place] + run[place + 1 :]})
                    now = run[place]
                rows.append(i)
                places.append(block * _WIDTH + rank)
                digests.append(now)
                paths.append(path + steps)
            at += len(asked[i])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("tree").take(pa.array(rows, pa.int64())),
                pa.array(places, pa.int64()),
                items,
                pa.array(digests, pa.string()),
                pa.array(paths, pa.list_(step)),
            ],
            ["tree", "place", "item", "digest", "path"],
        )


def prove(manifest: Manifest, wanted: Column | None = None) -> DataFrame:
    """``(group, place, the columns kept, digest, subroot, root, proof)`` for each leaf wanted.

    ``wanted`` is a condition on ``item`` and ``place``; all leaves by default. ``proof`` goes
    from the leaf to the root: at each level the place of the node in its run, and the
    digests of the others there.
    """
    leaves = manifest.leaves if wanted is None else manifest.leaves.filter(wanted)
    requests = leaves.select("tree", "place", "item")
    down = manifest.above.select("tree", "place", F.col("place").alias("item"))
    if wanted is not None:
        down = down.join(requests.select(F.col("tree").alias("item")).distinct(), "item", "left_semi")
        down = down.select("tree", "place", "item")
    entry = manifest.entry.select("tree", "top", "digest", F.array().cast(_PATH).alias("path"))
    arrived = _descend(manifest.top, entry, down)
    starts = arrived.select(F.col("item").alias("tree"), "digest", "path").join(
        manifest.trees.select("tree", "top"), "tree"
    )
    starts = saved(starts.select("tree", "top", "digest", "path"), "descent")
    found = _descend(manifest.records, starts, requests).select("tree", "place", "item", "digest", F.reverse("path").alias("proof"))
    roots = manifest.trees.select("tree", F.col("digest").alias("subroot"))
    out = found.join(roots, "tree").withColumn("root", F.lit(manifest.root))
    return out.select(F.col("item._group").alias("group"), "place", "item", "digest", "subroot", "root", "proof")


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""

    def up(below: Column, step: Column) -> Column:
        before = F.array_join(F.slice(step["others"], F.lit(1), step["place"]), "")
        after = F.array_join(F.slice(step["others"], step["place"] + 1, F.lit(FAN)), "")
        return F.sha2(F.concat(before, below, after).cast("binary"), 256)

    return F.aggregate(proof, digest, up)


def proof_digest(proof: Column) -> Column:
    """The hash of all digests of a proof, level by level."""
    return F.sha2(F.array_join(F.flatten(F.transform(proof, lambda s: s["others"])), "").cast("binary"), 256)
