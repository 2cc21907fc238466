"""Cells: numbered rows of some MB of whole texts that ask about parts of their texts and are answered.

A string that stands in a third of all texts is asked about once a cell, and the answers meet
the cells again by their number. Cells are a bucketed table, so that they are not shuffled for it. As
they are stored, a lost executor computes the same questions again.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicmart.sources.store import work_root

#: Text of one cell, of a bucket of cells, and text that one part of the anchors stands for.
CELL_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20
PART_BYTES = 64 << 20
#: Anchors sampled over all cells (in the mean) and from one.
SAMPLE = 1 << 16
CELL_SAMPLE = 256


def trim() -> None:
    """Give freed memory back to the system, where the C library can: other tasks of the machine need it."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)


def trimmed(function: Callable) -> Callable:
    """The function of a group, or of a cell and its answers, which keeps no memory it has freed."""

    def of_group(table: pa.Table) -> pa.Table:
        out = function(table)
        trim()
        return out

    def of_cell(table: pa.Table, answers: pa.Table) -> pa.Table:
        out = function(table, answers)
        trim()
        return out

    # Spark tells the two apart by their arguments.
    return of_group if function.__code__.co_argcount == 1 else of_cell


def packed(values: np.ndarray) -> pa.Array:
    return pa.array([compressed(values.tobytes())], pa.binary())


def compressed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpacked(data: bytes | pa.Buffer, kind: np.dtype | type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def sampled(n: int) -> np.ndarray:
    """Up to ``CELL_SAMPLE`` of n places, evenly."""
    return np.linspace(0, n - 1, min(CELL_SAMPLE, n)).astype(np.int64)


def stored(cells: DataFrame, size: int) -> DataFrame:
    """The cells with a number, as a table bucketed by it. ``size`` are the bytes of all texts."""
    spark = cells.sparkSession
    name = f"cells_{uuid4().hex}"
    numbered = cells.withColumn("cell", F.monotonically_increasing_id())
    # Their data is packed already.
    writer = numbered.write.bucketBy(max(1, -(-size // BUCKET_BYTES)), "cell").option("compression", "none")
    writer.option("path", f"{work_root(spark)}/llm/{name}").saveAsTable(name)
    table = spark.table(name)
    # The files stay; only the name goes.
    spark.sql(f"DROP TABLE {name}")
    return table


def sample(cells: DataFrame) -> bytes:
    """The samples of all cells, or of a share of them by their number where they are too many."""
    share = max(1, cells.count() * CELL_SAMPLE // SAMPLE)
    taken = cells.filter(F.pmod(F.xxhash64("cell"), F.lit(share)) == 0).select("sample").collect()
    return b"".join(bytes(r.sample) for r in taken)


def parts_of(size: int) -> int:
    """A power of two of parts for the anchors of so many bytes of text."""
    return 1 << (max(1, -(-size // PART_BYTES)) - 1).bit_length()


class Asked:
    """The distinct anchors of a cell in order, whether they count as several, and where each part begins."""

    def __init__(self, hashes: np.ndarray, several: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], parts: int):
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(order) else order
        self.anchors = ordered[at]
        self.several = several(order, at, np.append(at[1:], len(order))) if len(at) else np.empty(0, bool)
        self.bits = parts.bit_length() - 1
        edges = np.arange(1, parts, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.cuts = np.concatenate([[0], np.searchsorted(self.anchors, edges), [len(self.anchors)]])

    def rows(self, cell: int) -> pa.RecordBatch:
        """What the cell asks of each part: the halves of hashes that tell anchors of a part apart."""
        low = (self.anchors >> np.uint64(32 - self.bits)).astype(np.uint32)
        spans = [slice(a, b) for a, b in zip(self.cuts[:-1], self.cuts[1:])]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([cell] * len(spans), pa.int64()),
                pa.array(range(len(spans)), pa.int32()),
                pa.array([low[s][~self.several[s]].tobytes() for s in spans], pa.binary()),
                pa.array([low[s][self.several[s]].tobytes() for s in spans], pa.binary()),
            ],
            ["cell", "part", "once", "several"],
        )

    def shared(self, answers: pa.Table) -> np.ndarray:
        """The anchors that are several here or that another cell has, in order."""
        keep = self.several.copy()
        for part, mask in zip(answers.column("part").to_pylist(), answers.column("mask").to_pylist()):
            low, high = self.cuts[part], self.cuts[part + 1]
            mine = np.flatnonzero(~self.several[low:high]) + low
            keep[mine] = np.unpackbits(np.frombuffer(mask, np.uint8), count=len(mine)).astype(bool)
        return self.anchors[keep]


ASKED = "cell bigint, part int, once binary, several binary"
ANSWERED = "cell bigint, part int, mask binary"


def answer_shared(asked: pa.Table) -> pa.Table:
    """Which of the anchors of each cell another cell has as well, for one part."""
    once, several = ([np.frombuffer(b, np.uint32) for b in asked.column(c).to_pylist()] for c in ("once", "several"))
    values, count = np.unique(np.concatenate(once + several), return_counts=True)
    again = values[count > 1]
    masks = [np.packbits(member(again, mine)).tobytes() for mine in once]
    return pa.table({"cell": asked.column("cell"), "part": asked.column("part"), "mask": pa.array(masks, pa.binary())})


def member(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the values are among the ordered ones."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def expanded(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, number in it) for each size: 0 to size - 1."""
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def runs_of(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, np.int64)


def multikey(
    n: int, columns: Iterable[np.ndarray | Callable[[np.ndarray], np.ndarray]]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multikey quicksort of n rows: (order, group of equal rows at each place, columns shared with the place before).

    One column after the other, and each only among rows that are equal so far. A column is an
    array, or a function that gives its values for some rows.
    """
    order, group, shared = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    tied, depth = np.arange(n), 0
    for column in columns:
        if len(tied) < 2:
            break
        rows = order[tied]
        key = column(rows) if callable(column) else column[rows]
        inner = np.lexsort((key, group[tied]))
        order[tied], key = rows[inner], key[inner]
        # A new group begins where the one before did, or where the key changes.
        new = np.append(True, group[1:] != group[:-1])
        apart = tied[1:][(key[1:] != key[:-1]) & (tied[1:] == tied[:-1] + 1)]
        shared[apart[~new[apart]]] = depth
        new[apart] = True
        group = np.cumsum(new) - 1
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        depth += 1
    if n:
        same = np.append(False, group[1:] == group[:-1])
        shared[same] = depth
    return order, group, shared


def batches(rows: np.ndarray, cuts: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Whole groups of rows, whose sizes come to about ``most``. ``cuts`` are where groups begin."""
    start, held = 0, 0
    for low, high in zip(cuts, [*cuts[1:], len(rows)]):
        held += int(sizes[rows[low:high]].sum())
        if held >= most:
            yield rows[start:high]
            start, held = high, 0
    if start < len(rows):
        yield rows[start:]
