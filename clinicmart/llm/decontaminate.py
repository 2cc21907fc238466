"""Benchmark decontamination by Wu-Manber search for many patterns.

Patterns are the windows of the benchmark texts: ``WINDOW`` consecutive words, or
all words of a shorter text. Texts and patterns are brought to one form (lower
case, single spaces, a space at either end), so that a pattern found in the bytes
is a run of whole words.

The search looks at the last ``BLOCK`` bytes of a position. A shift table says how
far the next place is at which a pattern could end its first m bytes (m is the
length of the shortest pattern); most positions are skipped this way. Where the
shift is 0, the block selects the patterns that have it as their suffix, their
first bytes are compared, and then all of them. All texts of a batch are searched
in lanes that step together, so each step is a few array operations.

Patterns of very different lengths would make m, and with it all shifts, small.
They are searched in classes of lengths, each with its own tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicmart.llm import hashing
from clinicmart.llm.common import bound_batches, named, sha256_text, text_chunks, with_id

WINDOW = 10
BLOCK = 8
#: Patterns that are searched in one pass, in bytes of windows and item names. Larger
#: benchmarks take several passes over the documents.
PASS_BYTES = 16 << 20
LANE = 2048
_TABLE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Tables:
    """Shift table and suffix buckets of the patterns of one class of lengths."""

    patterns: list[bytes]
    words: np.ndarray
    least: int
    block: int
    bits: int
    shift: np.ndarray
    suffixes: np.ndarray
    buckets: np.ndarray
    prefixes: np.ndarray
    order: np.ndarray

    @classmethod
    def build(cls, patterns: list[bytes], words: list[int]) -> Tables:
        least = min(map(len, patterns))
        block = min(BLOCK, least)
        heads = np.frombuffer(b"".join(p[:least] for p in patterns), np.uint8)
        heads = heads.reshape(len(patterns), least)
        bits = min(24, max(12, int(np.ceil(np.log2(8 * heads.size)))))
        shift = np.full(1 << bits, least - block + 1, np.int32)
        mask = _mask(block)
        for end in range(block, least + 1):
            at = np.ascontiguousarray(heads[:, end - block : end])
            np.minimum.at(shift, _slot(_value(at, mask), bits), least - end)
        suffix = _value(np.ascontiguousarray(heads[:, least - block :]), mask)
        prefix = _value(np.ascontiguousarray(heads[:, :block]), mask)
        order = np.argsort(suffix, kind="stable")
        values, begins = np.unique(suffix[order], return_index=True)
        buckets = np.append(begins, len(order))
        return cls(
            patterns, np.array(words), least, block, bits, shift, values, buckets, prefix[order], order
        )

    def find(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all occurrences and the pattern of each."""
        size = len(text)
        none = np.empty(0, np.int64)
        if size < self.least:
            return none, none
        raw = np.concatenate([text, np.zeros(8, np.uint8)])
        # Eight bytes from any place on, of which the block is the first part.
        at = np.ndarray((size + 1,), "<u8", raw, strides=(1,))
        mask = _mask(self.block)
        lanes = np.arange(self.least - 1, size, LANE)
        stops = np.minimum(lanes + LANE, size)
        ends, found = lanes, []
        while len(ends):
            step = self.shift[_slot(at[ends - (self.block - 1)] & mask, self.bits)]
            here = step == 0
            if here.any():
                found.append(ends[here])
            ends = ends + np.maximum(step, 1)
            live = ends < stops
            if not live.all():
                ends, stops = ends[live], stops[live]
        if not found:
            return none, none
        ends = np.concatenate(found)
        value = at[ends - (self.block - 1)] & mask
        bucket = np.searchsorted(self.suffixes, value)
        bucket[bucket == len(self.suffixes)] = 0
        same = self.suffixes[bucket] == value
        begin, bucket = ends[same] - (self.least - 1), bucket[same]
        many = self.buckets[bucket + 1] - self.buckets[bucket]
        place = np.repeat(begin, many)
        entry = np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many)
        entry += np.repeat(self.buckets[bucket], many)
        alike = (at[place] & mask) == self.prefixes[entry]
        place, entry = place[alike], self.order[entry[alike]]
        whole = text.tobytes() if len(place) else b""
        right = [whole.startswith(self.patterns[k], p) for p, k in zip(place.tolist(), entry.tolist())]
        right = np.array(right, bool)
        return place[right], entry[right]


def _mask(width: int) -> np.uint64:
    return np.uint64((1 << (8 * width)) - 1)


def _value(rows: np.ndarray, mask: np.uint64) -> np.ndarray:
    wide = np.zeros((len(rows), 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    return wide.view("<u8")[:, 0] & mask


def _slot(value: np.ndarray, bits: int) -> np.ndarray:
    return ((value ^ (value >> np.uint64(29))) * _TABLE >> np.uint64(64 - bits)).astype(np.int64)


def windows(benchmark: DataFrame, item: str, text: str, width: int = WINDOW) -> DataFrame:
    """Distinct ``(window, n_words, item)`` of the benchmark; item is text, as results name it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in text_chunks(batch, "text"):
                flat, place, end, first = hashing.normalise(data, bounds, hashing.PUNCTUATION)
                flat, items = flat.tobytes(), rows.column("item").to_pylist()
                out: list[tuple[bytes, int, str | None]] = []
                for i, name in enumerate(items):
                    low, high = int(first[i]), int(first[i + 1])
                    n = min(width, high - low)
                    if n:
                        out += [
                            (flat[place[k] - 1 : end[k + n - 1] + 1], n, name)
                            for k in range(low, high - n + 1)
                        ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x[0] for x in out], pa.binary()),
                        pa.array([x[1] for x in out], pa.int32()),
                        pa.array([x[2] for x in out], pa.string()),
                    ],
                    ["window", "n_words", "item"],
                )

    bound_batches(benchmark.sparkSession)
    return (
        named(benchmark, item=item, text=text)
        .withColumn("item", F.col("item").cast("string"))
        .mapInArrow(cut, "window binary, n_words int, item string")
        .distinct()
    )


def occurrences(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """Per document ``(id, n_words, hits, items)``: runs of hit words and the items they come from.

    ``hits`` are disjoint word ranges (start, end exclusive) in order; ``items`` the
    sorted distinct item ids, as text. Every row gets a row, also repeated ones. A
    null or empty text has no words. An item with a null or empty text has no
    window; the windows of an item without an id are searched, and name no item. An empty
    benchmark hits nothing.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    known = windows(benchmark, item_column, item_text, width).persist()
    size = known.agg(F.sum(F.length("window") + F.coalesce(F.length("item"), F.lit(0)) + 16)).first()[0] or 0
    passes = max(1, -(-size // pass_bytes))
    texts = named(docs, id=id_column, text=text_column)
    found = []
    for k in range(passes):
        mine = known.filter(F.pmod(F.xxhash64("window"), F.lit(passes)) == k)
        # At most about pass_bytes, as measured.
        rows = mine.groupBy("window", "n_words").agg(F.collect_list("item").alias("items")).collect()
        tables = spark.sparkContext.broadcast(_classes(rows))
        found.append(_search(texts, tables))
    known.unpersist()
    if passes > 1:
        # The same id and text have the same hits: repeated rows are searched alike and joined back.
        both = reduce(DataFrame.unionAll, found).groupBy("id", "key").agg(
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("hits")).alias("hits"),
            F.flatten(F.collect_list("items")).alias("items"),
        )
        rows = texts.select("id", F.xxhash64("text").alias("key")).withColumnsRenamed(
            {"id": "_id", "key": "_key"}
        )
        match = F.col("_id").eqNullSafe(F.col("id")) & F.col("_key").eqNullSafe(F.col("key"))
        found = [rows.join(both, match).select("id", "key", "n_words", "hits", "items")]
    return found[0].select(
        "id",
        "n_words",
        merged(F.col("hits")).alias("hits"),
        F.array_sort(F.array_distinct("items")).alias("items"),
    )


def merged(ranges: Column) -> Column:
    """The union of word ranges as disjoint ranges in order."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def add(done: Column, new: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], new["end"]).alias("end")
        )
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= new["start"])
        return F.when(
            joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
        ).otherwise(F.concat(done, F.array(new)))

    return F.aggregate(F.array_sort(ranges), empty, add)


def _classes(rows: list) -> tuple[list[Tables], list[list[list[str]]]]:
    """Tables per class of lengths (powers of two), and the items of each pattern."""
    groups: dict[int, list] = {}
    for row in rows:
        groups.setdefault(len(row.window).bit_length(), []).append(row)
    tables, items = [], []
    for group in groups.values():
        tables.append(Tables.build([bytes(r.window) for r in group], [r.n_words for r in group]))
        items.append([r.items for r in group])
    return tables, items


def _search(texts: DataFrame, tables) -> DataFrame:

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, items = tables.value
        ranges = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for rows, data, bounds in text_chunks(batch, "text"):
                flat, place, _, first = hashing.normalise(data, bounds, hashing.PUNCTUATION)
                hits: list[list] = [[] for _ in range(len(rows))]
                names: list[set] = [set() for _ in range(len(rows))]
                for table, known in zip(classes, items):
                    at, pattern = table.find(flat)
                    word = np.searchsorted(place, at + 1)
                    text = np.searchsorted(first, word, "right") - 1
                    start = word - first[text]
                    for i, s, k in zip(text.tolist(), start.tolist(), pattern.tolist()):
                        hits[i].append((s, s + int(table.words[k])))
                        names[i].update(known[k])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("id"),
                        rows.column("key"),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array([_union(h) for h in hits], ranges),
                        pa.array([sorted(n) for n in names], pa.list_(pa.string())),
                    ],
                    ["id", "key", "n_words", "hits", "items"],
                )

    return texts.withColumn("key", F.xxhash64("text")).mapInArrow(
        search,
        with_id(
            texts,
            "key bigint, n_words bigint, hits array<struct<start:int,end:int>>, items array<string>",
        ),
    )


def _union(ranges: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and out[-1][1] >= start:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [{"start": s, "end": e} for s, e in out]


def contamination(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """One row per document: ``(id, n_words, n_hit, n_items, items_sha256, contaminated)``."""
    found = occurrences(docs, benchmark, **columns)
    hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"])
    return found.select(
        "id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        sha256_text(F.array_join("items", ",")).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
