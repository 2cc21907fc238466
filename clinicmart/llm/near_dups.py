"""Near-duplicate documents by one-permutation MinHash.

Each document becomes its set of five-word shingles. One hash function deals the
shingles to bins and the least hash of each bin is the signature; empty bins copy a
bin that a hash of their own number picks (optimal densification). Groups of
consecutive bins are bands, and documents that agree in a band share a bucket.

A bucket proposes a star: its members against one centre, never all pairs. Proposed
pairs are confirmed on the full shingle sets. Most buckets then lie in one component and
are done. In the others, the members outside the largest component are compared with all of the
bucket, in blocks, by sizes, sketches and (up to ``WHOLE`` shingles) the hashes themselves; pairs of
different components that may be similar are confirmed too. So no link between members of a bucket that would join two components is lost.

Before all that, documents with equal sets are reduced to one, the smallest id. Small
sets have too few hashes for sure signatures. They get buckets for the shingles of their
prefix instead: of two sets that are similar enough, the smallest hashes of
either hold one that both have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinicmart.llm import hashing
from clinicmart.llm.common import bound_batches, discard, named, saved, text_chunks
from clinicmart.llm.graph import components, extended

SHINGLE = 5
#: A link: 100 times the intersection is at least this many times the union.
PERCENT = 75
BINS = 128
ROWS = 4
#: Sets up to this size are compared by prefixes, which miss nothing.
SMALL = 32
#: Sets up to this size carry their hashes, halved, beside the sketch, and are compared by them.
WHOLE = 256
#: Members of a bucket in one block.
BLOCK = 2048
_TRIES = 64

_source = np.random.Generator(np.random.PCG64(77)).integers(0, BINS, (BINS, _TRIES))
_EDGES = (np.arange(BINS, dtype=np.uint64) << np.uint64(57)).astype(np.uint64)
_BAND = hashing.mix(np.arange(1, BINS // ROWS + 1, dtype=np.uint64))
_PREFIX = np.uint64(0x5851F42D4C957F2D)


def shingle_hashes(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = hashing.LOWER[data]
    starts, ends, first = hashing.find_words(data, bounds, hashing.SPACE)
    words = hashing.hash_words(data, starts, ends)
    rolled = hashing.mix(hashing.roll(words, SHINGLE))
    out = []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        if high - low >= SHINGLE:
            out.append(np.unique(rolled[low : high - SHINGLE + 1]))
        elif high > low:
            # Fewer words than a shingle: the whole sequence, kept apart by its length.
            whole = hashing.roll(words[low:high], high - low) + np.uint64(high - low)
            out.append(hashing.mix(whole ^ _PREFIX))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hash of each bin (the top bits of a hash), empty bins filled from others."""
    at = np.searchsorted(hashes, _EDGES)
    least = hashes[np.minimum(at, len(hashes) - 1)]
    full = (at < len(hashes)) & (least >> np.uint64(57) == np.arange(BINS, dtype=np.uint64))
    if not full.all():
        empty = np.flatnonzero(~full)
        choices = _source[empty]
        usable = full[choices]
        picked = choices[np.arange(len(empty)), usable.argmax(1)]
        picked[~usable.any(1)] = np.flatnonzero(full)[0]
        least[empty] = least[picked]
    return least


def _buckets(hashes: np.ndarray, least: np.ndarray, small: int) -> np.ndarray:
    """Bucket keys of a set: its prefix if it is small, its bands if it is not, both in between."""
    size, keys = len(hashes), []
    if size <= small * 100 // PERCENT + 1:
        keep = size - -(-size * PERCENT // 100) + 1
        keys.append(hashing.mix(hashes[:keep] ^ _PREFIX))
    if size > small:
        bands = least.reshape(-1, ROWS)
        key = _BAND.copy()
        for column in bands.T:
            key = hashing.mix(key ^ column)
        keys.append(key)
    return np.concatenate(keys).view(np.int64)


def _sketch(hashes: np.ndarray, least: np.ndarray) -> bytes:
    """A byte of each bin, followed by the upper halves of all hashes of a set that is not large."""
    bins = (hashing.mix(least) & np.uint64(0xFF)).astype(np.uint8).tobytes()
    return bins + (hashes >> np.uint64(32)).astype(np.uint32).tobytes() if len(hashes) <= WHOLE else bins


def profiles(docs: DataFrame, id_column: str, text_column: str, small: int = SMALL) -> DataFrame:
    """``(id, digest, n_shingles, set_a, set_b, sketch, buckets)`` per row.

    ``digest`` is a hash of the text, ``set_a`` and ``set_b`` are 128 bits of the set.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in text_chunks(batch, "text"):
                sizes, set_a, set_b, sketches, buckets = [], [], [], [], []
                for hashes in shingle_hashes(data, bounds):
                    sizes.append(len(hashes))
                    set_a.append(int(hashing.mix(hashes).sum(dtype=np.uint64).view(np.int64)))
                    set_b.append(int(hashing.mix(hashes ^ _PREFIX).sum(dtype=np.uint64).view(np.int64)))
                    if len(hashes):
                        least = signature(hashes)
                        sketches.append(_sketch(hashes, least))
                        buckets.append(_buckets(hashes, least, small))
                    else:
                        sketches.append(b"")
                        buckets.append([])
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("id"),
                        rows.column("digest"),
                        pa.array(sizes, pa.int64()),
                        pa.array(set_a, pa.int64()),
                        pa.array(set_b, pa.int64()),
                        pa.array(sketches, pa.binary()),
                        pa.array(buckets, longs),
                    ],
                    ["id", "digest", "n_shingles", "set_a", "set_b", "sketch", "buckets"],
                )

    rows = named(docs, id=id_column, text=text_column)
    return rows.select(F.col("id").cast("bigint"), F.xxhash64("text").alias("digest"), "text").mapInArrow(
        build,
        "id bigint, digest bigint, n_shingles bigint, set_a bigint, set_b bigint, sketch binary, "
        "buckets array<bigint>",
    )


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(a, b)`` of those pairs whose full shingle sets are similar enough.

    Both texts are joined to each pair; the pairs of a frequent centre are split by
    adaptive execution. The set of a centre is kept while its pairs follow each other.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, np.empty(0, np.uint64)
        for batch in batches:
            for rows, data, bounds in text_chunks(batch, "other"):
                ids = rows.column("a").to_pylist()
                texts = rows.column("text")
                keep = []
                for i, other in enumerate(shingle_hashes(data, bounds)):
                    if ids[i] != last:
                        own = np.frombuffer(texts[i].as_py().encode(), np.uint8)
                        held = shingle_hashes(own, np.array([0, len(own)]))[0]
                        last = ids[i]
                    both = len(np.intersect1d(held, other, assume_unique=True))
                    keep.append(100 * both >= PERCENT * (len(held) + len(other) - both))
                yield rows.select(["a", "b"]).filter(pa.array(keep))

    right = texts.select(F.col("node").alias("b"), F.col("text").alias("other"))
    left = texts.select(F.col("node").alias("a"), "text")
    return (
        pairs.join(right, "b").join(left, "a").select("a", "b", "text", "other")
        .mapInArrow(compare, "a bigint, b bigint")
    )


def _alike(sizes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many bins two sets that are similar enough agree in at least, by their sizes.

    On average they agree in three quarters of the bins they fill; five and a half standard
    deviations less are let through (two pairs in a hundred million go beyond). Small sets, which
    fill few bins, pass whatever their sketches are.
    """
    smaller = np.minimum(sizes, others)
    filled = BINS * -np.expm1(-smaller / BINS)
    low = BINS * (PERCENT / 100) - 5.5 * BINS * np.sqrt(PERCENT / 100 * (1 - PERCENT / 100) / np.maximum(filled, 1))
    return np.where(smaller <= SMALL, 0, low)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs ``(a, b)`` of each group of rows that follow each other, of different components and possibly similar.

    Rows of a group are ``far`` members first; each of those is compared with all others.
    """
    names = ["key", "part", "first", "second"]
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        keys = np.stack([table.column(c).to_numpy() for c in names], 1)
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        last = int(cut[-1]) if len(cut) else 0
        if last:
            yield from _compared(table.slice(0, last), np.concatenate([[0], cut]))
        rest = table.slice(last)
    if rest is not None and len(rest):
        yield from _compared(rest, np.array([0, len(rest)]))


def _compared(table: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
    table = table.combine_chunks()
    node, component, size, far = (
        table.column(c).to_numpy() for c in ("node", "component", "n_shingles", "far")
    )
    cells = table.column("sketch").to_pylist()
    sketch = np.frombuffer(b"".join(c[:BINS] for c in cells), np.uint8).reshape(len(table), BINS)
    out = []
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        some = low + np.flatnonzero(far[low:high])
        overlap = _Overlap(cells[low:high])
        for start in range(0, len(some), 128):
            left = some[start : start + 128]
            n, m = size[left][:, None], size[low:high][None]
            open_ = component[left][:, None] != component[low:high][None]
            open_ &= np.maximum(n, m) * PERCENT <= np.minimum(n, m) * 100
            i, j = np.nonzero(open_)
            same = (sketch[left[i]] == sketch[low + j]).sum(1)
            hit = same >= _alike(size[left[i]], size[low + j])
            i, j = i[hit], j[hit]
            for one, others in zip(*_by_first(i, j)):
                both = overlap.of(left[one] - low, others)
                near = 100 * both >= PERCENT * (size[left[one]] + size[low + others] - both)
                out.append(np.stack([np.full(int(near.sum()), node[left[one]]), node[low + others[near]]], 1))
    pairs = np.unique(np.sort(np.concatenate(out), 1), axis=0) if out else np.empty((0, 2), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _by_first(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct values of ``i``, which is sorted, and the ``j`` of each."""
    first = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else i
    return i[first], np.split(j, first[1:])


class _Overlap:
    """How many hashes the sets of a group have in common; for sets without their hashes, all."""

    def __init__(self, cells: list[bytes]):
        parts = [np.frombuffer(c, np.uint32, offset=BINS) for c in cells]
        self.sizes = np.array([len(p) for p in parts])
        self.starts = np.cumsum(self.sizes) - self.sizes
        values, self.ids = np.unique(np.concatenate(parts), return_inverse=True)
        self.held = np.zeros(len(values), bool)

    def of(self, one: int, others: np.ndarray) -> np.ndarray:
        out = np.full(len(others), WHOLE * WHOLE)
        known = np.flatnonzero(self.sizes[others] > 0) if self.sizes[one] else others[:0]
        if len(known):
            own = self.ids[self.starts[one] : self.starts[one] + self.sizes[one]]
            sizes = self.sizes[others[known]]
            ends = np.cumsum(sizes)
            place = np.repeat(self.starts[others[known]] - ends + sizes, sizes) + np.arange(int(ends[-1]))
            self.held[own] = True
            out[known] = np.add.reduceat(self.held[self.ids[place]].astype(np.int64), ends - sizes)
            self.held[own] = False
        return out


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", small: int = SMALL
) -> DataFrame:
    """Per row ``(id, n_shingles, component_id, kept)``.

    ``component_id`` is the smallest id reached by links, the own id included; ``kept`` is
    true for that one. Null, empty and wordless texts have no shingles and link with
    nothing. Rows that repeat an id are one document: its links are those of all
    its texts. A row without an id cannot be named by a link: it has no component, links
    nothing and is kept. Ids are integers. An empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    known = saved(profiles(docs, id_column, text_column, small), "profiles")
    listed = known.filter("id IS NOT NULL AND n_shingles > 0")
    sets = saved(_distinct_sets(listed), "sets")

    members = sets.select("node", "n_shingles", F.explode("buckets").alias("key"))
    shared = (
        members.groupBy("key")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .filter("low <> high")
    )
    members = saved(members.join(shared.select("key"), "key"), "buckets")

    involved = sets.select("node", "who.*").join(members.select("node").distinct(), "node")
    rows = named(docs, id=id_column, text=text_column).withColumn("digest", F.xxhash64("text"))
    texts = rows.join(involved, ["id", "digest"]).select("node", "text")
    texts = saved(texts.dropDuplicates(["node"]), "texts")

    first = members.groupBy("key").agg(F.min(F.struct("node", "n_shingles")).alias("c"))
    tested = saved(_propose(members, first), "pairs")
    links = saved(confirm(tested, texts), "links")
    joined = saved(components(links), "joined")
    across = saved(_across(members, sets, joined), "pairs")
    more = saved(confirm(across.join(tested, ["a", "b"], "left_anti"), texts), "links")
    if not more.isEmpty():
        joined = extended(joined, more)
    for table in (members, texts, tested, across, links, more):
        discard(table)
    return _named_components(known, listed, sets, joined)


def _distinct_sets(listed: DataFrame) -> DataFrame:
    """One row per distinct shingle set, named by a node.

    The node is the smallest id with the set. Where an id repeats with several texts it may be
    the smallest of several sets; the others get a negative number from their hash.
    """
    groups = listed.groupBy("set_a", "set_b", "n_shingles").agg(
        F.min(F.struct("id", "digest")).alias("who"),
        F.first("sketch").alias("sketch"),
        F.first("buckets").alias("buckets"),
    )
    rank = F.row_number().over(Window.partitionBy("who.id").orderBy("set_a", "set_b", "n_shingles"))
    other = F.lit(-1).cast("bigint") - F.col("set_a").bitwiseAND(F.lit((1 << 62) - 1))
    return groups.withColumn("rank", rank).withColumn(
        "node", F.when(F.col("rank") == 1, F.col("who.id")).otherwise(other)
    ).drop("rank")


def _propose(members: DataFrame, centres: DataFrame) -> DataFrame:
    """Distinct pairs of a centre and a member of its bucket whose sizes allow it, smaller node first."""
    c = F.col("c")
    near = (F.col("node") != c["node"]) & (
        F.greatest("n_shingles", c["n_shingles"]) * PERCENT <= F.least("n_shingles", c["n_shingles"]) * 100
    )
    pair = F.least("node", c["node"]).alias("a"), F.greatest("node", c["node"]).alias("b")
    return members.join(centres, "key").filter(near).select(*pair).distinct()


def _across(members: DataFrame, sets: DataFrame, joined: DataFrame) -> DataFrame:
    """Distinct pairs of different components in a bucket that may be similar.

    Members outside the largest component of their bucket are far, the others near. Both are cut into
    blocks by a hash; far blocks meet each other and each near block, and a group of rows is one
    such meeting. Pairs of near members need no comparison.
    """
    own = F.coalesce("component", "node")
    placed = members.join(joined.withColumnRenamed("id", "node"), "node", "left").withColumn("component", own)
    counts = (
        placed.groupBy("key", "component")
        .agg(F.count("*").alias("n"))
        .groupBy("key")
        .agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("n"), F.count("*").alias("kinds"))
        .filter("kinds > 1")
    )

    def blocks(n: Column) -> Column:
        return F.ceil(n / F.lit(BLOCK)).cast("int")

    counts = counts.select(
        "key",
        F.col("main.component").alias("main"),
        blocks(F.col("n") - F.col("main.n")).alias("fars"),
        blocks(F.col("main.n")).alias("nears"),
    )
    mixed = placed.join(counts, "key").withColumn("far", F.col("component") != F.col("main"))
    hashed = F.xxhash64("key", "node")
    block = F.pmod(hashed, F.when(F.col("far"), F.col("fars")).otherwise(F.col("nears"))).cast("int")

    def meeting(part: int, first: Column, second: Column) -> Column:
        return F.struct(F.lit(part).alias("part"), first.cast("int").alias("first"), second.cast("int").alias("second"))

    def upto(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    with_far = F.transform(upto("fars"), lambda i: meeting(0, F.least(i, F.col("block")), F.greatest(i, F.col("block"))))
    with_near = F.transform(upto("nears"), lambda i: meeting(1, F.col("block"), i))
    of_near = F.transform(upto("fars"), lambda i: meeting(1, i, F.col("block")))
    rows = mixed.withColumn("block", block).select(
        "key",
        "node",
        "component",
        "n_shingles",
        "far",
        F.explode(F.when(F.col("far"), F.concat(with_far, with_near)).otherwise(of_near)).alias("m"),
    )
    sketches = sets.select("node", "sketch")
    dealt = rows.select("key", "m.*", "node", "component", "n_shingles", "far").join(sketches, "node")
    groups = ["key", "part", "first", "second"]
    ordered = dealt.repartition(*groups).sortWithinPartitions(*groups)
    return ordered.mapInArrow(_compare, "a bigint, b bigint").distinct()


def _named_components(known: DataFrame, listed: DataFrame, sets: DataFrame, joined: DataFrame) -> DataFrame:
    """Components of documents from those of sets."""
    keys = ["set_a", "set_b", "n_shingles"]
    placed = listed.select("id", *keys).join(sets.select(*keys, "node"), keys).select("id", "node")
    # Several texts under one id tie their sets together.
    several = (
        placed.groupBy("id")
        .agg(F.min("node").alias("low"), F.max("node").alias("high"))
        .filter("low <> high")
        .select("id", "low")
    )
    ties = placed.join(several, "id").selectExpr("low AS a", "node AS b").filter("a <> b")
    if not ties.isEmpty():
        joined = extended(joined, ties)
    joined = joined.withColumnRenamed("id", "node")
    of_row = placed.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = of_row.groupBy("component").agg(F.min("id").alias("component_id"))
    of_id = of_row.select("id", "component").distinct().join(least, "component").select(
        F.col("id").alias("_id"), "component_id"
    )
    rows = known.select("id", "n_shingles").join(of_id, F.col("id") == F.col("_id"), "left")
    component = F.coalesce("component_id", "id")
    return rows.select(
        "id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
