"""Repeated byte strings by sorting suffixes.

All suffixes of a corpus are as many as its bytes, and each would be sent with fifty of them. Sent
are those at anchors instead: the least hash of ``ANCHOR`` bytes in each string of ``LENGTH``.
Consecutive strings with one anchor are a run, and one row stands for all of them: the suffix at
the anchor, as far as the run reaches, and the bytes of the run before it. Equal strings have
equal anchors at equal places, so nothing is lost.

The corpus is stored in cells of some MB of whole texts, which ask and are answered:

1. Anchors that occur in one text only are dropped, by hashes dealt to parts.
2. Splitters sampled from the anchors deal the other suffixes to ranges by their leading bytes. An anchor
   that is frequent in the sample has its strings dealt one by one, by all of their bytes.
3. Each range is sorted by multikey quicksort: eight bytes at a time, ties only. Neighbours with
   the same anchor are compared, those that are equal first, then their strings. All rows of an anchor are in one range and
   equal strings of a frequent one too, so that no boundary lies between strings that are equal.
4. The least id of each string goes back to the cells that hold it under a larger one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicmart.llm import cells, hashing
from clinicmart.llm.cells import expanded, multikey, packed
from clinicmart.llm.common import CHUNK_BYTES, bound_batches, text_chunks

LENGTH = 50
ANCHOR = 16
#: Text that a range of suffixes stands for.
RANGE_BYTES = 32 << 20
#: An anchor with this many places in the sample is dealt string by string.
FREQUENT = 16
#: Strings of a run, in the mean.
_STRINGS = (LENGTH - ANCHOR + 2) / 2
#: Strings compared at once.
_AT_ONCE = 1 << 18
_ROWS = 1 << 16

_BEFORE = LENGTH - ANCHOR
_LEFT = -(-_BEFORE // 8)
_RIGHT = -(-LENGTH // 8)
_PLACES = np.uint64((1 << 23) - 1)
_NONE = np.iinfo(np.int64).max
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes at each place, as a number that sorts like them."""
    return np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))


def _anchor_hash(words: np.ndarray, place: np.ndarray | slice) -> np.ndarray:
    out = np.zeros(0, np.uint64)
    for j in range(0, ANCHOR, 8):
        part = (words[place + j] if isinstance(place, np.ndarray) else words[j:][place]).astype(np.uint64)
        out = hashing.mix(part + np.uint64(1) if j == 0 else out ^ part)
    return out


def _padded(data: np.ndarray) -> np.ndarray:
    """With room around it, so that words before the first and behind the last byte can be read."""
    return np.concatenate([np.zeros(8 * _LEFT, np.uint8), data, np.zeros(8 * _RIGHT, np.uint8)])


def find_runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First string, number of strings and anchor of each run in some texts."""
    total = len(data) - LENGTH + 1
    if total <= 0:
        return (np.empty(0, np.int64),) * 3
    hashes = _anchor_hash(_words(_padded(data)[8 * _LEFT :]), slice(0, len(data) - ANCHOR + 1))
    width, step = _BEFORE + 1, 1 << 22
    least = np.empty(total, np.int64)
    for low in range(0, total, step):
        part = hashes[low : low + step + width - 1]
        # The place behind the high bits of the hash: one minimum finds both.
        key = part & ~_PLACES | np.arange(len(part), dtype=np.uint64)
        have = 1
        while have < width:
            shift = min(have, width - have)
            key = np.minimum(key[:-shift], key[shift:])
            have += shift
        least[low : low + step] = (key & _PLACES).astype(np.int64) + low
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    strings = np.flatnonzero(text[:total] == text[LENGTH - 1 :])
    least, text = least[strings], text[strings]
    cut = np.ones(len(strings), bool)
    cut[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(cut)
    return strings[at], np.diff(np.append(at, len(strings))), least[at]


def _cut(cell_bytes: int):
    """Texts that follow each other in a task, as one row with its runs."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, runs, size = [], [], [], 0
        for batch in batches:
            for rows, data, bounds in text_chunks(batch, "text", min(CHUNK_BYTES, cell_bytes) // 2):
                if size and size + len(data) > cell_bytes:
                    yield _cell(ids, texts, runs)
                    ids, texts, runs, size = [], [], [], 0
                    cells.trim()
                begin, strings, anchor = find_runs(data, bounds)
                ids.append(rows.column("id"))
                texts.append((data, np.diff(bounds)))
                runs.append((begin + size, strings, anchor + size))
                size += len(data)
        if ids:
            yield _cell(ids, texts, runs)
        ids, texts, runs = [], [], []
        cells.trim()

    return cut


def _cell(ids, texts, runs) -> pa.RecordBatch:
    data = np.concatenate([d for d, _ in texts])
    begin, strings, anchor = (np.concatenate(part) for part in zip(*runs))
    # Evenly over the runs: the suffix at the anchor, and one of the strings of the run.
    some = cells.sampled(len(anchor))
    string = begin[some] + np.arange(len(some)) * 7919 % np.maximum(strings[some], 1)
    place = np.stack([anchor[some], string], 1) + 8 * _LEFT
    sample = _padded(data)[place[:, :, None] + np.arange(8 * _RIGHT)]
    lists = pa.chunked_array(ids).combine_chunks()
    values = [
        pa.ListArray.from_arrays(pa.array([0, len(lists)], pa.int32()), lists),
        *[packed(x) for x in (np.concatenate([n for _, n in texts]), data, strings.astype(np.uint8))],
        packed((anchor - begin).astype(np.uint8)),
        pa.array([sample.tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(values, ["ids", "sizes", "data", "strings", "anchors", "sample"])


class Cell:
    """A stored cell: its texts, and runs as the suffixes at their anchors."""

    def __init__(self, table: pa.Table):
        row = {c: table.column(c)[0] for c in table.column_names}
        self.number = row["cell"].as_py()
        self.ids = row["ids"].values
        kinds = {"sizes": np.int64, "data": np.uint8, "strings": np.uint8, "anchors": np.uint8}
        parts = {c: cells.unpacked(row[c].as_buffer(), kind) for c, kind in kinds.items()}
        self.bounds = np.concatenate([[0], np.cumsum(parts["sizes"])])
        self.data, self.strings = parts["data"], parts["strings"].astype(np.int64)
        # The strings of all texts, run after run.
        sizes = np.maximum(parts["sizes"] - LENGTH + 1, 0)
        number = np.cumsum(self.strings) - self.strings
        self.text = np.searchsorted(np.cumsum(sizes), number, "right")
        self.begin = number - (np.cumsum(sizes) - sizes)[self.text] + self.bounds[:-1][self.text]
        self.anchor = self.begin + parts["anchors"]
        ids = self.ids.fill_null(_NONE).to_numpy()
        self.owner = ids[self.text]
        self._words = _words(_padded(self.data))

    def hashes(self) -> np.ndarray:
        return _anchor_hash(self._words, self.anchor + 8 * _LEFT)

    def asked(self, parts: int) -> cells.Asked:
        """Its anchors; several are those that more than one text here has."""

        def several(order: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
            text = self.text[order]
            return text[first] != text[end - 1]

        return cells.Asked(self.hashes(), several, parts)

    def rows(self, wanted: np.ndarray, frequent: np.ndarray) -> "Suffixes":
        """The suffixes of the wanted runs, and with each the run and string it starts with."""
        run = np.flatnonzero(wanted)
        begin, strings, anchor = self.begin[run], self.strings[run], self.anchor[run]
        first = np.zeros(len(run), np.int64)
        if len(frequent) and len(run):
            key = np.stack([self._words[anchor + 8 * _LEFT + j] for j in range(0, ANCHOR, 8)], 1)
            often = np.isin(np.ascontiguousarray(key).view(f"S{ANCHOR}").ravel(), frequent)
            which, inner = expanded(strings[often])
            single = begin[often][which] + inner
            run = np.concatenate([run[~often], run[often][which]])
            first = np.concatenate([first[~often], inner])
            begin, anchor = np.concatenate([begin[~often], single]), np.concatenate([anchor[~often], single])
            strings = np.concatenate([strings[~often], np.ones(len(single), np.int64)])
        before = anchor - begin
        after = strings - 1 + LENGTH - before
        words = np.empty((len(run), _LEFT + _RIGHT), np.uint64)
        for j in range(_LEFT):
            keep = np.clip(before - 8 * (_LEFT - 1 - j), 0, 8)
            words[:, j] = self._words[anchor + 8 * j] & _last_bytes(keep)
        for j in range(_RIGHT):
            keep = np.clip(after - 8 * j, 0, 8)
            words[:, _LEFT + j] = self._words[anchor + 8 * (_LEFT + j)] & ~_last_bytes(8 - keep)
        return Suffixes(words, before, strings, self.owner[run], self.owner[run]), run, first


def _last_bytes(n: np.ndarray) -> np.ndarray:
    """A mask of the last n bytes of a word."""
    return np.where(n > 0, _FULL >> (np.uint64(8) * (8 - np.maximum(n, 1)).astype(np.uint64)), np.uint64(0))


class Suffixes:
    """Rows of bytes around an anchor, which is behind the first ``_LEFT`` words.

    ``before``: bytes of the row in front of the anchor; ``strings``: how many strings start in it;
    ``least`` and ``most``: ids of the texts that have it.
    """

    def __init__(self, words, before, strings, least, most):
        self.words, self.before, self.strings = words, before, strings
        self.least, self.most = least, most

    def hashes(self) -> np.ndarray:
        out = (self.before << 8 | self.strings).astype(np.uint64)
        for column in self.words.T:
            out = hashing.mix(out ^ column) * np.uint64(0x9E3779B97F4A7C15)
        return out

    def take(self, at: np.ndarray) -> "Suffixes":
        return Suffixes(self.words[at], self.before[at], self.strings[at], self.least[at], self.most[at])

    def distinct(self) -> tuple["Suffixes", np.ndarray]:
        """One row of each content in the order of its hash, and the hashes."""
        hashes = self.hashes()
        order = np.argsort(hashes)
        hashes = hashes[order]
        at = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else order
        one = self.take(order[at])
        if len(at):
            one.least = np.minimum.reduceat(self.least[order], at)
            one.most = np.maximum.reduceat(self.most[order], at)
        return one, hashes[at]

    def suffix_order(self) -> np.ndarray:
        return multikey(len(self.words), self.words[:, _LEFT:].T)[0]

    def leading(self) -> np.ndarray:
        """The bytes that decide on the range: those of the anchor, or all of a single string."""
        key = self.words[:, _LEFT:].copy()
        key[(self.strings != 1) | (self.before != 0), ANCHOR // 8 :] = 0
        return np.ascontiguousarray(key.astype(">u8")).view(f"S{8 * _RIGHT}").ravel()

    def pack(self) -> bytes:
        parts = self.words.astype(">u8"), self.before.astype(np.uint8), self.strings.astype(np.uint8)
        raw = b"".join(p.tobytes() for p in (*parts, self.least, self.most))
        return cells.compressed(raw)

    @staticmethod
    def unpack(blob: bytes) -> "Suffixes":
        """The rows of a blob, as views of its bytes."""
        raw = cells.unpacked(blob, np.uint8)
        width = _LEFT + _RIGHT
        n = len(raw) // (8 * width + 18)
        words = np.frombuffer(raw, ">u8", n * width).reshape(n, width)
        at = 8 * width * n
        small = [np.frombuffer(raw, np.uint8, n, at + k * n) for k in range(2)]
        ids = [np.frombuffer(raw, np.int64, n, at + 2 * n + 8 * k * n) for k in range(2)]
        return Suffixes(words, *small, *ids)

    @staticmethod
    def joined(parts: list["Suffixes"]) -> "Suffixes":
        fields = zip(*[(p.words, p.before, p.strings, p.least, p.most) for p in parts])
        kinds = (np.uint64, *[np.int64] * 4)
        return Suffixes(*[np.concatenate(field, dtype=kind) for field, kind in zip(fields, kinds)])


def slices(blobs: list[Suffixes]) -> Iterator[tuple[list[tuple[int, int]], Suffixes]]:
    """The rows of sorted blobs by their leading word, some at a time: where they are in each blob, and the rows.

    Rows with the same leading word come together, so that those of an anchor do.
    """
    heads = [blob.words[:, _LEFT].astype(np.uint64) for blob in blobs]
    some = np.sort(np.concatenate([head[::64] for head in heads])) if heads else np.empty(0, np.uint64)
    cuts = np.unique(some[_ROWS // 64 :: _ROWS // 64])
    bounds = [np.concatenate([[0], np.searchsorted(head, cuts), [len(head)]]) for head in heads]
    for k in range(len(cuts) + 1):
        spans = [(int(b[k]), int(b[k + 1])) for b in bounds]
        yield spans, Suffixes.joined([blob.take(np.arange(*span)) for blob, span in zip(blobs, spans)])


def least_ids(rows: Suffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(row, first string, end, least id)`` of strings that a smaller id has too, for rows sorted here."""
    right = list(rows.words[:, _LEFT:].T)
    order, anchor, _ = multikey(len(rows.words), right[: ANCHOR // 8])
    none = (np.empty(0, np.int64),) * 4
    if not len(order):
        return none
    at = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    shared = np.minimum.reduceat(rows.least[order], at) < np.maximum.reduceat(rows.most[order], at)
    keep = shared[anchor]
    order, anchor = order[keep], anchor[keep]
    if not len(order):
        return none
    # Rows that are equal altogether become one, with the least id of them.
    part = rows.take(order)
    rest = list(part.words[:, _LEFT + ANCHOR // 8 :].T) + list(part.words[:, :_LEFT].T)
    inner, same, _ = multikey(len(order), [anchor, *rest, part.before, part.strings])
    first = np.flatnonzero(np.append(True, same[1:] != same[:-1]))
    one = part.take(inner[first])
    one.least = np.minimum.reduceat(part.least[inner], first)
    anchor = anchor[inner][first]
    kind = np.empty(len(order), np.int64)
    kind[inner] = same

    sizes = np.bincount(anchor)[anchor]
    least = np.repeat(one.least, one.strings)
    bounds = np.concatenate([[0], np.cumsum(one.strings)])
    # Several different rows at one anchor: their strings, a bounded number of rows at a time.
    open_rows = np.flatnonzero(sizes > 1)
    cuts = np.flatnonzero(np.append(True, anchor[open_rows][1:] != anchor[open_rows][:-1])) if len(open_rows) else []
    for group in cells.batches(open_rows, cuts, one.strings, _AT_ONCE):
        which, inner = expanded(one.strings[group])
        where = np.repeat(bounds[group], one.strings[group]) + inner
        least[where] = _least_of_strings(one, anchor, group[which], inner)
    found = [_below(part, kind, one.strings, bounds, least, low) for low in range(0, len(kind), _ROWS)]
    row, low, high, least = (np.concatenate(column) for column in zip(*found))
    return order[row], low, high, least


def _below(rows: Suffixes, kind, strings, bounds, least, start: int):
    """For some rows, stretches of strings with one least id below the largest id that has the row."""
    kind = kind[start : start + _ROWS]
    which, inner = expanded(strings[kind])
    low = least[bounds[kind[which]] + inner]
    hit = np.flatnonzero(low < rows.most[start + which])
    which, inner, low = which[hit], inner[hit], low[hit]
    if not len(which):
        return (np.empty(0, np.int64),) * 4
    new = np.append(True, (which[1:] != which[:-1]) | (inner[1:] != inner[:-1] + 1) | (low[1:] != low[:-1]))
    at = np.flatnonzero(new)
    ends = inner[np.append(at[1:], len(inner)) - 1] + 1
    return start + which[at], inner[at], ends, low[at]


def _least_of_strings(rows: Suffixes, anchor: np.ndarray, row: np.ndarray, string: np.ndarray) -> np.ndarray:
    """The least id of each string: equal ones have one anchor, at one place, and the same bytes."""
    width = 8 * (_LEFT + _RIGHT)
    # A word more, for strings that end with the last row.
    data = np.concatenate([rows.words.astype(">u8").view(np.uint8).ravel(), np.zeros(8, np.uint8)])
    words = _words(data)
    before = rows.before[row] - string
    place = row * width + 8 * _LEFT - before
    columns = [anchor[row] << 8 | before]
    for j in range(0, LENGTH, 8):
        word = words[place + j].astype(np.uint64)
        columns.append(word & ~_last_bytes(np.full(1, max(0, j + 8 - LENGTH))))
    order, group, _ = multikey(len(row), columns)
    at = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    out = np.empty(len(row), np.int64)
    out[order] = np.minimum.reduceat(rows.least[row][order], at)[group]
    return out


def repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row ``(id, n_bytes, n_removed, spans, kept)``.

    ``spans`` are the ranges of bytes (start, end exclusive) covered by a string of ``LENGTH`` bytes that
    also starts in a document with a smaller id; ``kept`` are the bytes of the text without them.
    Strings are judged on the input and do not cross documents. Ids are integers. Null texts are empty. Rows that repeat an id are one
    document, which does not remove its own; rows without an id come after all others and remove
    nothing. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    texts = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text_column}`").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    stored = cells.stored(
        texts.mapInArrow(
            _cut(cells.CELL_BYTES), "ids array<bigint>, sizes binary, data binary, strings binary, anchors binary, sample binary"
        ),
        size,
    )
    ranges = max(1, -(-size // RANGE_BYTES))
    parts = cells.parts_of(size)
    splitters, frequent = _splitters(stored, ranges)

    asked = stored.mapInArrow(_ask(parts), cells.ASKED)
    shared = asked.groupBy("part").applyInArrow(cells.trimmed(cells.answer_shared), cells.ANSWERED)
    dealt = stored.groupBy("cell").cogroup(shared.groupBy("cell")).applyInArrow(
        _deal(parts, splitters, frequent), "cell bigint, range int, rows binary"
    )
    answers = dealt.groupBy("range").applyInArrow(cells.trimmed(_answer), "cell bigint, found binary")
    return stored.groupBy("cell").cogroup(answers.groupBy("cell")).applyInArrow(
        _remove(frequent),
        "id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary",
    )


def _splitters(stored: DataFrame, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading bytes that cut the suffixes into ranges, and the frequent anchors, from a bounded sample.

    A frequent anchor stands for the strings of its runs, each of which a cell sends once.
    """
    kind = f"S{8 * _RIGHT}"
    sample = np.frombuffer(cells.sample(stored), [("anchor", kind), ("string", kind)])
    if not len(sample):
        return np.empty(0, kind), np.empty(0, f"S{ANCHOR}")
    anchors, which, count = np.unique(sample["anchor"].astype(f"S{ANCHOR}"), return_inverse=True, return_counts=True)
    often = count >= FREQUENT
    seen_cells = max(1, len(sample) // cells.CELL_SAMPLE)
    weight = np.where(often, _STRINGS * np.minimum(count, seen_cells) / count, 1.0)[which]
    keys = np.where(often[which], sample["string"], sample["anchor"])
    order = np.argsort(keys, kind="stable")
    sums = np.cumsum(weight[order])
    at = np.searchsorted(sums, sums[-1] * np.arange(1, ranges) / ranges)
    return np.unique(keys[order][at]), anchors[often]


def _ask(parts: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cell = Cell(pa.Table.from_batches([batch.slice(i, 1)]))
                yield cell.asked(parts).rows(cell.number)

    return ask


def _deal(parts: int, splitters: np.ndarray, frequent: np.ndarray):
    def deal(table: pa.Table, answers: pa.Table) -> pa.Table:
        cell = Cell(table)
        wanted = cells.member(cell.asked(parts).shared(answers), cell.hashes())
        rows, _, _ = cell.rows(wanted, frequent)
        rows, _ = rows.distinct()
        rows = rows.take(rows.suffix_order())
        number = np.searchsorted(splitters, rows.leading(), "right")
        order = np.argsort(number, kind="stable")
        full, start = np.unique(number[order], return_index=True)
        blobs = [rows.take(part).pack() for part in np.split(order, start[1:])] if len(full) else []
        return pa.table(
            {
                "cell": pa.array([cell.number] * len(full), pa.int64()),
                "range": pa.array(full, pa.int32()),
                "rows": pa.array(blobs, pa.binary()),
            }
        )

    return cells.trimmed(deal)


_FOUND = np.dtype([("hash", np.uint64), ("low", np.uint8), ("high", np.uint8), ("least", np.int64)])


def _answer(dealt: pa.Table) -> pa.Table:
    """The strings of each cell that a smaller id has, by the hashes of their suffixes."""
    blobs = [Suffixes.unpack(blob) for blob in dealt.column("rows").to_pylist()]
    found: list[list[bytes]] = [[] for _ in blobs]
    for spans, rows in slices(blobs):
        row, low, high, least = least_ids(rows)
        out = np.empty(len(row), _FOUND)
        out["hash"], out["low"], out["high"], out["least"] = rows.hashes()[row], low, high, least
        blob = np.searchsorted(np.cumsum([b - a for a, b in spans]), row, "right")
        order = np.argsort(blob, kind="stable")
        full, start = np.unique(blob[order], return_index=True)
        for i, part in zip(full.tolist(), np.split(out[order], start[1:]) if len(full) else []):
            found[i].append(part.tobytes())
    hit = [i for i, parts in enumerate(found) if parts]
    return pa.table(
        {
            "cell": dealt.column("cell").take(pa.array(hit, pa.int64())),
            "found": pa.array([b"".join(found[i]) for i in hit], pa.binary()),
        }
    )


def _remove(frequent: np.ndarray):
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        cell = Cell(table)
        depth = np.zeros(len(cell.data) + 1, np.int64)
        found = np.frombuffer(b"".join(answers.column("found").to_pylist()), _FOUND)
        if len(found):
            found = found[np.argsort(found["hash"], kind="stable")]
            rows, run, first = cell.rows(np.ones(len(cell.begin), bool), frequent)
            hashes = rows.hashes()
            low, high = (np.searchsorted(found["hash"], hashes, side) for side in ("left", "right"))
            which, inner = expanded(high - low)
            hit = found[low[which] + inner]
            keep = rows.most[which] > hit["least"]
            which, hit = which[keep], hit[keep]
            start = cell.begin[run[which]] + first[which]
            np.add.at(depth, start + hit["low"], 1)
            np.add.at(depth, start + hit["high"] - 1 + LENGTH, -1)
        gone = np.cumsum(depth)[:-1] > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
        text = np.repeat(np.arange(len(cell.ids)), np.diff(cell.bounds))
        # Where two texts meet, a removed stretch ends and another begins.
        meet = cell.bounds[1:-1]
        meet = np.unique(meet[(meet > 0) & (meet < len(gone))])
        meet = meet[gone[meet - 1] & gone[meet]]
        edges = np.sort(np.concatenate([edges, meet, meet]))
        starts, ends = edges[::2], edges[1::2]
        owner = text[starts]
        removed = np.bincount(text[gone], minlength=len(cell.ids))
        cuts = np.searchsorted(owner, np.arange(len(cell.ids) + 1)).astype(np.int32)
        spans = pa.StructArray.from_arrays(
            [pa.array(starts - cell.bounds[owner]), pa.array(ends - cell.bounds[owner])], fields=list(span)
        )
        sizes = np.diff(cell.bounds)
        places = np.concatenate([[0], np.cumsum(sizes - removed)]).astype(np.int32)
        kept = pa.BinaryArray.from_buffers(
            pa.binary(), len(cell.ids), [None, pa.py_buffer(places), pa.py_buffer(cell.data[~gone])]
        )
        return pa.table(
            {
                "id": cell.ids,
                "n_bytes": pa.array(sizes, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "spans": pa.ListArray.from_arrays(pa.array(cuts), spans),
                "kept": kept,
            }
        )

    return cells.trimmed(remove)


def digest(found: DataFrame) -> DataFrame:
    """Counts, and the hash of the bytes kept."""
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
