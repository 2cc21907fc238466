"""Repeated word windows by a relative Lempel-Ziv parse against blocks of the corpus.

The reference is the corpus itself, in blocks that hold the texts in which a window can occur again:
the anchor of a window is its least hash of ``ANCHOR`` words, consecutive windows with one
anchor are a phrase, and a block has all phrases of some anchors. Equal windows have equal
anchors, so a phrase is parsed against the block of its anchor and needs no other.

A block is indexed by its suffixes: all places of its phrases at which a window starts, sorted by
their words (multikey quicksort), with the number of words that neighbours share. The longest factor at a
place is the longer of the two stretches it shares with its neighbours. Each phrase is
factored greedily from its first word; a factor of at least a window is repeated, and after it the
windows across its end are looked up before the parse goes on behind it. So every window that
occurs again lies in a factor.

Phrases that a block has twice are one factor as a whole and need no parse; phrases of an anchor that occurs
once are not sent. A frequent anchor would fill a block, so its phrases are sent as hashes of
their windows, dealt by these: factors of one window each.

The corpus is stored in cells of some MB of whole texts (:mod:`cells`), so that a passage that a
third of all texts share is one row a cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicmart.llm import cells, hashing
from clinicmart.llm.cells import expanded, member, multikey, packed, runs_of
from clinicmart.llm.common import CHUNK_BYTES, bound_batches, named, text_chunks

WINDOW = 35
ANCHOR = 8
#: Text that a block stands for.
BLOCK_BYTES = 16 << 20
#: An anchor with this many places in the sample is dealt window by window.
FREQUENT = 16
#: Windows sorted at once, where they belong to several anchors.
_AT_ONCE = 1 << 18
_LOW = np.uint64((1 << 23) - 1)


def find_phrases(words: np.ndarray, first: np.ndarray, window: int, anchor: int):
    """``(first window, windows, anchor, phrase)`` of the phrases of some texts.

    ``words`` are hashes of words, ``first`` the first word of each text and the total; windows are
    counted by the word they start at, ``anchor`` and ``phrase`` are hashes.
    """
    none = np.empty(0, np.int64)
    total = len(words) - window + 1
    if total <= 0:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    owner = hashing.owners(first)
    whole = np.flatnonzero(owner[:total] == owner[window - 1 :])
    parts = hashing.mix(hashing.roll(words, anchor))
    place = _least(parts, window - anchor + 1)[whole]
    cut = np.ones(len(whole), bool)
    cut[1:] = (place[1:] != place[:-1]) | (owner[whole[1:]] != owner[whole[:-1]])
    at = np.flatnonzero(cut)
    begin, windows = whole[at], np.diff(np.append(at, len(whole)))
    rolled = hashing.roll(words, window)
    # A phrase is shorter than two windows, so its first and last window hold all its words.
    ends = hashing.mix(rolled[begin]) * np.uint64(0x9E3779B97F4A7C15) + rolled[begin + windows - 1]
    return begin, windows, parts[place[at]], hashing.mix(ends + windows.astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the least of each ``width`` consecutive values; the first of equal ones."""
    out = np.empty(len(values) - width + 1, np.int64)
    step = 1 << 22
    for low in range(0, len(out), step):
        part = values[low : low + step + width - 1]
        # The high bits of the hash in front of the place: one minimum finds both.
        key = part & ~_LOW | np.arange(len(part), dtype=np.uint64)
        have = 1
        while have < width:
            shift = min(have, width - have)
            key = np.minimum(key[:-shift], key[shift:])
            have += shift
        out[low : low + step] = (key & _LOW).astype(np.int64) + low
    return out


def _cut(window: int, anchor: int, cell_bytes: int):
    """Texts that follow each other in a task, as one row with their phrases."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, found, size = [], [], [], 0
        for batch in batches:
            for rows, data, bounds in text_chunks(batch, "text", min(CHUNK_BYTES, cell_bytes) // 2):
                if size and size + len(data) > cell_bytes:
                    yield _cell(ids, texts, found)
                    ids, texts, found, size = [], [], [], 0
                    cells.trim()
                starts, ends, first = hashing.find_words(data, bounds, hashing.SPACE)
                words = hashing.hash_words(data, starts, ends)
                ids.append(rows.column("id"))
                texts.append((data, np.diff(bounds)))
                found.append(find_phrases(words, first, window, anchor)[1:])
                size += len(data)
        if ids:
            yield _cell(ids, texts, found)
        ids, texts, found = [], [], []
        cells.trim()

    return cut


def _cell(ids: list, texts: list, found: list) -> pa.RecordBatch:
    windows, anchors, phrases = (np.concatenate(part) for part in zip(*found))
    lists = pa.chunked_array(ids).combine_chunks()
    values = [
        pa.ListArray.from_arrays(pa.array([0, len(lists)], pa.int32()), lists),
        packed(np.concatenate([n for _, n in texts])),
        packed(np.concatenate([d for d, _ in texts])),
        packed(windows.astype(np.uint16)),
        *[pa.array([x.tobytes()], pa.binary()) for x in (anchors, phrases, anchors[cells.sampled(len(anchors))])],
    ]
    return pa.RecordBatch.from_arrays(values, ["ids", "sizes", "data", "windows", "anchors", "phrases", "sample"])


class Cell:
    """A stored cell: its texts, their words, and their phrases."""

    def __init__(self, table: pa.Table, window: int, texts: bool = True):
        row = {c: table.column(c)[0] for c in table.column_names}
        self.number, self.window = row["cell"].as_py(), window
        self.anchors, self.phrases = (np.frombuffer(row[c].as_buffer(), np.uint64) for c in ("anchors", "phrases"))
        if not texts:
            return
        self.ids = row["ids"].values
        sizes = cells.unpacked(row["sizes"].as_buffer(), np.int64)
        self.data = cells.unpacked(row["data"].as_buffer(), np.uint8)
        self.windows = cells.unpacked(row["windows"].as_buffer(), np.uint16).astype(np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.starts, self.ends, self.first = hashing.find_words(self.data, self.bounds, hashing.SPACE)
        # The windows of all texts, phrase after phrase.
        many = np.maximum(np.diff(self.first) - window + 1, 0)
        number = np.cumsum(self.windows) - self.windows
        text = np.searchsorted(np.cumsum(many), number, "right")
        self.begin = number - (np.cumsum(many) - many)[text] + self.first[:-1][text]

    def asked(self, parts: int) -> cells.Asked:
        """Its anchors; several are those that it has more than once."""
        return cells.Asked(self.anchors, lambda order, first, end: end - first > 1, parts)

    def windows_of(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(first word, hash)`` of the windows of some phrases."""
        which, inner = expanded(self.windows[phrases])
        place = self.begin[phrases][which] + inner
        needed = np.zeros(len(self.starts) + 1, np.int64)
        np.add.at(needed, self.begin[phrases], 1)
        np.add.at(needed, self.begin[phrases] + self.windows[phrases] + self.window - 1, -1)
        used = np.flatnonzero(np.cumsum(needed)[:-1] > 0)
        words = hashing.hash_words(self.data, self.starts[used], self.ends[used]) if len(used) else used.astype(np.uint64)
        # Words in use stand next to each other wherever a window does.
        hashes = hashing.mix(hashing.roll(words, self.window)) if len(used) else words
        return place, hashes[np.searchsorted(used, place)]


def _once_or_twice(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, a place of each, and how often each occurs (at most twice)."""
    values, place, count = np.unique(hashes, return_index=True, return_counts=True)
    return values, place, np.minimum(count, 2)


def _ask(parts: int, window: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cell = Cell(pa.Table.from_batches([batch.slice(i, 1)]), window, texts=False)
                yield cell.asked(parts).rows(cell.number)

    return ask


def _block_of(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return (hashing.mix(hashes) % np.uint64(blocks)).astype(np.int64)


def _deal(parts: int, blocks: int, frequent: np.ndarray, window: int):
    """The phrases of a cell for each block: whose anchors occur elsewhere, each once."""

    def deal(table: pa.Table, answers: pa.Table) -> pa.Table:
        cell = Cell(table, window)
        wanted = member(cell.asked(parts).shared(answers), cell.anchors)
        often = wanted & member(frequent, cell.anchors)
        rare = np.flatnonzero(wanted & ~often)
        phrases, place, count = _once_or_twice(cell.phrases[rare])
        rare = rare[place]
        _, single = cell.windows_of(np.flatnonzero(often))
        single, _, single_count = _once_or_twice(single)
        of_phrase, of_single = _block_of(cell.anchors[rare], blocks), _block_of(single, blocks)
        names, rows = [], []
        for block in np.union1d(of_phrase, of_single):
            mine = np.flatnonzero(of_phrase == block)
            alone = np.flatnonzero(of_single == block)
            at = rare[mine]
            low, high = cell.starts[cell.begin[at]], cell.ends[cell.begin[at] + cell.windows[at] + window - 2]
            texts = b"".join(cell.data[a:b].tobytes() for a, b in zip(low.tolist(), high.tolist()))
            parts_ = (
                np.array([len(mine), len(alone)], np.int64), cell.anchors[at], phrases[mine], count[mine].astype(np.uint8),
                (high - low).astype(np.uint32), single[alone], single_count[alone].astype(np.uint8),
            )
            names.append(int(block))
            rows.append(cells.compressed(b"".join(p.tobytes() for p in parts_) + texts))
        return pa.table(
            {
                "cell": pa.array([cell.number] * len(names), pa.int64()),
                "block": pa.array(names, pa.int32()),
                "rows": pa.array(rows, pa.binary()),
            }
        )

    return cells.trimmed(deal)


class Block:
    """The phrases of some anchors and the windows dealt one by one, from several cells."""

    def __init__(self, blobs: list[bytes]):
        fields: list[list] = [[] for _ in range(6)]
        texts = []
        for blob in blobs:
            raw = cells.unpacked(blob, np.uint8)
            n, m = np.frombuffer(raw, np.int64, 2)
            at = 16
            kinds = ((np.uint64, n), (np.uint64, n), (np.uint8, n), (np.uint32, n), (np.uint64, m), (np.uint8, m))
            for field, (kind, size) in zip(fields, kinds):
                field.append(np.frombuffer(raw, kind, size, at))
                at += int(size) * np.dtype(kind).itemsize
            texts.append(raw[at:])
        self.sizes = np.array([len(x) for x in fields[0]]), np.array([len(x) for x in fields[4]])
        self.anchors, self.phrases, count, lengths, self.single, single_count = (np.concatenate(x) for x in fields)
        self.count, self.single_count = count.astype(np.int64), single_count.astype(np.int64)
        self.data = np.concatenate(texts)
        self.bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def repeated_singles(block: Block) -> np.ndarray:
    """Which of the windows dealt one by one occur again."""
    values, which = np.unique(block.single, return_inverse=True)
    return np.bincount(which, block.single_count, len(values))[which] > 1


def factors(block: Block, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, start, words)`` of the long factors of each phrase of a block."""
    none = (np.empty(0, np.int64),) * 3
    if not len(block.phrases):
        return none
    kinds, example, kind = np.unique(block.phrases, return_index=True, return_inverse=True)
    again = np.bincount(kind, block.count, len(kinds)) > 1
    starts, ends, first = hashing.find_words(block.data, block.bounds, hashing.SPACE)
    length = np.diff(first)[example]
    # Anchors with several phrases, of which some occur once.
    order = np.argsort(block.anchors[example], kind="stable")
    cuts = runs_of(block.anchors[example][order])
    sizes = np.diff(np.append(cuts, len(order)))
    alone = np.add.reduceat((~again[order]).astype(np.int64), cuts)
    mixed = np.repeat((sizes > 1) & (alone > 0), sizes)
    order = order[mixed]
    cuts = runs_of(block.anchors[example][order])
    found = [(np.flatnonzero(again), np.zeros(int(again.sum()), np.int64), length[again])]
    for group in cells.batches(order, cuts, length - window + 1, _AT_ONCE):
        texts = example[group]
        which, inner = expanded(length[group])
        place = first[texts][which] + inner
        used = np.unique(place)
        words = hashing.hash_words(block.data, starts[used], ends[used])[np.searchsorted(used, place)]
        phrase, start, size = _parse(words, length[group], window)
        once = ~again[group[phrase]]
        found.append((group[phrase[once]], start[once], size[once]))
    which, start, size = (np.concatenate(x) for x in zip(*found))
    # From distinct phrases back to all rows.
    order = np.argsort(which, kind="stable")
    which, start, size = which[order], start[order], size[order]
    low, high = np.searchsorted(which, kind, "left"), np.searchsorted(which, kind, "right")
    row, inner = expanded(high - low)
    return row, start[low[row] + inner], size[low[row] + inner]


def _parse(words: np.ndarray, lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(phrase, start, words)``: long factors of different phrases, each against all of them.

    ``words`` are the hashes of the words of one phrase after another.
    """
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    which, inner = expanded(lengths - window + 1)
    place, left = bounds[which] + inner, lengths[which] - inner

    def word(k: int):
        # Words end with their phrase; what is behind it is shared with nothing that goes on.
        return lambda rows: np.where(k < left[rows], words[np.minimum(place[rows] + k, len(words) - 1)], np.uint64(0))

    order, _, shared = multikey(len(place), (word(k) for k in range(int(lengths.max()))))
    longest = np.zeros(len(place), np.int64)
    if len(order) > 1:
        before = np.minimum(shared[1:], np.minimum(left[order][1:], left[order][:-1]))
        longest[order[1:]] = before
        longest[order[:-1]] = np.maximum(longest[order[:-1]], before)
    # The next place of the same phrase at which a long factor begins.
    long = np.where(longest >= window, np.arange(len(place)), len(place))
    follows = np.append(np.minimum.accumulate(long[::-1])[::-1], len(place))
    ends = np.cumsum(lengths - window + 1)
    now, out = ends - (lengths - window + 1), []
    phrase = np.arange(len(lengths))
    while len(now):
        at = follows[now]
        inside = at < ends[phrase]
        phrase, at = phrase[inside], at[inside]
        out.append((phrase, inner[at], longest[at]))
        # Behind the factor, but first at the windows across its end.
        now = np.minimum(np.maximum(at + 1, at + longest[at] - window + 1), ends[phrase])
        going = now < ends[phrase]
        phrase, now = phrase[going], now[going]
    return tuple(np.concatenate(x) for x in zip(*out))


_FOUND = np.dtype([("hash", np.uint64), ("start", np.uint16), ("words", np.uint16)])


def _answer(window: int):
    """The factors of the phrases of each cell, and its single windows that occur again, by their hashes."""

    def answer(dealt: pa.Table) -> pa.Table:
        block = Block(dealt.column("rows").to_pylist())
        row, start, words = factors(block, window)
        out = np.empty(len(row), _FOUND)
        out["hash"], out["start"], out["words"] = block.phrases[row], start, words
        again = np.flatnonzero(repeated_singles(block))
        ends, single_ends = (np.cumsum(sizes) for sizes in block.sizes)
        of_row, of_single = np.searchsorted(ends, row, "right"), np.searchsorted(single_ends, again, "right")
        full = np.union1d(of_row, of_single)
        order = np.argsort(of_row, kind="stable")
        lows, highs = (np.searchsorted(of_row[order], full, side) for side in ("left", "right"))
        first, last = (np.searchsorted(of_single, full, side) for side in ("left", "right"))
        return pa.table(
            {
                "cell": dealt.column("cell").take(pa.array(full, pa.int64())),
                "found": pa.array([out[order[a:b]].tobytes() for a, b in zip(lows, highs)], pa.binary()),
                "single": pa.array([block.single[again[a:b]].tobytes() for a, b in zip(first, last)], pa.binary()),
            }
        )

    return cells.trimmed(answer)


def repeated(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
) -> DataFrame:
    """Per row ``(id, n_words, n_removed, kept, spans)``.

    ``spans`` are the word ranges (start, end exclusive) covered by a window whose words also start
    elsewhere, in the same document or another; ``kept`` is the text without them, its words
    joined by one space. Windows are judged on the input. Null texts have no words and
    keep the empty text; a row that repeats another with its id and text makes all its
    windows repeated, as any copy does. Rows without an id are treated like others. An
    empty table gives an empty result.
    """
    if anchor > window:
        raise ValueError("an anchor is not longer than a window")
    bound_batches(docs.sparkSession)
    texts = named(docs, id=id_column, text=text_column)
    kind = texts.schema["id"].dataType.simpleString()
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    stored = cells.stored(
        texts.mapInArrow(
            _cut(window, anchor, cells.CELL_BYTES),
            f"ids array<{kind}>, sizes binary, data binary, windows binary, anchors binary, phrases binary, sample binary",
        ),
        size,
    )
    parts, blocks = cells.parts_of(size), max(1, -(-size // BLOCK_BYTES))
    values, count = np.unique(np.frombuffer(cells.sample(stored), np.uint64), return_counts=True)
    frequent = values[count >= FREQUENT]

    asked = stored.select("cell", "anchors", "phrases").mapInArrow(_ask(parts, window), cells.ASKED)
    shared = asked.groupBy("part").applyInArrow(cells.trimmed(cells.answer_shared), cells.ANSWERED)
    dealt = stored.groupBy("cell").cogroup(shared.groupBy("cell")).applyInArrow(
        _deal(parts, blocks, frequent, window), "cell bigint, block int, rows binary"
    )
    answers = dealt.groupBy("block").applyInArrow(_answer(window), "cell bigint, found binary, single binary")
    return stored.groupBy("cell").cogroup(answers.groupBy("cell")).applyInArrow(
        _remove(frequent, window),
        f"id {kind}, n_words bigint, n_removed bigint, kept string, spans array<struct<start:int,end:int>>",
    )


def _remove(frequent: np.ndarray, window: int):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        cell = Cell(table, window)
        depth = np.zeros(len(cell.starts) + 1, np.int64)
        found = np.frombuffer(b"".join(answers.column("found").to_pylist()), _FOUND)
        found = found[np.argsort(found["hash"], kind="stable")]
        rare = ~member(frequent, cell.anchors)
        low, high = (np.searchsorted(found["hash"], cell.phrases, side) for side in ("left", "right"))
        which, inner = expanded(np.where(rare, high - low, 0))
        hit = found[low[which] + inner]
        begin = cell.begin[which] + hit["start"]
        np.add.at(depth, begin, 1)
        np.add.at(depth, begin + hit["words"], -1)
        single = np.sort(np.frombuffer(b"".join(answers.column("single").to_pylist()), np.uint64))
        if len(single):
            place, hashes = cell.windows_of(np.flatnonzero(~rare))
            place = place[member(single, hashes)]
            np.add.at(depth, place, 1)
            np.add.at(depth, place + window, -1)
        gone = np.cumsum(depth)[:-1] > 0
        many = len(cell.ids)
        owner = hashing.owners(cell.first)
        removed = np.bincount(owner[gone], minlength=many)
        edge = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else owner
        before, after = np.append(False, gone[:-1])[: len(gone)], np.append(gone[1:], False)[: len(gone)]
        # Texts do not go on in the next one.
        before[edge] = False
        after[edge[1:] - 1] = False
        starts, ends = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
        base = cell.first[owner[starts]]
        spans = pa.StructArray.from_arrays(
            [pa.array((starts - base).astype(np.int32)), pa.array((ends - base).astype(np.int32))], fields=list(span)
        )
        cuts = np.searchsorted(owner[starts], np.arange(many + 1)).astype(np.int32)
        stay = np.flatnonzero(~gone)
        kept = hashing.join_words(cell.data, cell.starts[stay], cell.ends[stay], owner[stay], many)
        return pa.table(
            {
                "id": cell.ids,
                "n_words": pa.array(np.diff(cell.first), pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept": kept.cast(pa.string()),
                "spans": pa.ListArray.from_arrays(pa.array(cuts), spans),
            }
        )

    return cells.trimmed(remove)


def digest(found: DataFrame) -> DataFrame:
    """Counts, and the hash of the kept text."""
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )
