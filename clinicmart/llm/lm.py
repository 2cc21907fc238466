"""Scores of texts by a bigram model whose counts stand in a Bloom filter.

Counts are kept as their logarithm: a word pair of quantised count q is entered q times,
as (key, 1) to (key, q). Looking up 1, 2, ... until the first miss gives the count back; an
error can only make it larger, and rarely by more than a step. The filter grows with its
entries: it is a block of bounded size per hash partition, and no task holds more than one.
Probabilities interpolate the relative frequency of the pair with that of the word.

The counts come from the whole training part. Tasks count their own texts first and send
sorted arrays, one per hash partition, so that Spark shuffles few rows. Neither the blocks nor
the exact counts of single words are broadcast: texts are dealt to groups of a bounded size,
each group asks for the distinct words and pairs it holds, and the answers are joined to its
texts. Words are known exactly then; the pair model takes their counts by logarithm too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicmart.llm import hashing
from clinicmart.llm.common import bound_batches, named, saved, text_chunks, with_id

#: Bits of the filter for each entry, and the most of one block; more entries make more blocks.
BITS_PER_ENTRY = 16
MAX_BITS = 1 << 28
#: Bytes of a pair inside its hash partition.
SHORT = 5
PROBES = 4
#: Base of the logarithm in which counts are kept.
QUANT = 2.0
#: Every pair seen in training is entered, a single one too.
LEAST_PAIR = 1
PAIR_WEIGHT = 0.6
#: Tokens a task counts before it sends its sums on, and bytes of a group of texts.
FLUSH_KEYS = 4_000_000
GROUP_BYTES = 6 << 20
_END = np.uint64(0xA24BAED4963EE407)
_PAIR = np.uint64(0x9FB21C651E98DF25)


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text and an end after them, and where each text begins."""
    data = hashing.LOWER[data]
    starts, ends, first = hashing.find_words(data, bounds, hashing.SPACE)
    words = hashing.hash_words(data, starts, ends)
    begins = first + np.arange(len(first))
    out = np.full(begins[-1], _END, np.uint64)
    inside = np.ones(len(out), bool)
    inside[begins[1:] - 1] = False
    out[inside] = words
    return out, begins


def pairs(words: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A key for each token and the one before it; before the first word stands an end."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[begins[:-1]] = _END
    return hashing.mix(before * _PAIR + words)


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, at = np.unique(keys, return_inverse=True)
    return values, np.bincount(at, counts, len(values)).astype(np.int64)


def shortened(keys: np.ndarray, part: int, parts: int) -> bytes:
    """Keys of one hash partition by their place in it, in 40 bits, as bytes.

    Two pairs of a partition share a place far more rarely than the filter errs.
    """
    spare = max(0, ((1 << 64) // parts).bit_length() - 8 * SHORT)
    place = (keys - _edges(parts)[part]) >> np.uint64(spare)
    return place.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SHORT].tobytes()


def lengthened(cell: bytes) -> np.ndarray:
    """The numbers that :func:`shortened` wrote."""
    out = np.zeros((len(cell) // SHORT, 8), np.uint8)
    out[:, :SHORT] = np.frombuffer(cell, np.uint8).reshape(-1, SHORT)
    return out.reshape(-1).view("<u8").astype(np.uint64)


_COUNTED = "kind string, part int, keys binary, counts binary"


def count(texts: DataFrame, parts: int) -> DataFrame:
    """``(kind, part, keys, counts)`` of each hash partition, a range of hashes, counted whole.

    Rows of the kind ``word`` hold words and their counts, 8 bytes each; rows of the kind
    ``pair`` the block of the filter for all pairs, and its highest level.
    """

    def send(kind: str, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        edges = np.searchsorted(keys, _edges(parts))
        for k, (low, high) in enumerate(zip(edges, np.append(edges[1:], len(keys)))):
            if low < high:
                # Most pairs occur once in a task: those are sent without a count.
                one = counts[low:high] == 1
                for pick in (one, ~one):
                    if pick.any():
                        number = b"" if pick is one else counts[low:high][pick].astype(np.int64).tobytes()
                        mine = keys[low:high][pick]
                        cell = shortened(mine, k, parts) if kind == "pair" else mine.tobytes()
                        yield _row(kind, k, cell, number)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_held: list[np.ndarray] = []
        pairs_held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for _, data, bounds in text_chunks(batch, "text"):
                words, begins = tokens(data, bounds)
                words_held.append(words)
                pairs_held.append(pairs(words, begins))
                size += len(words)
                if size >= FLUSH_KEYS:
                    yield from send("word", words_held)
                    yield from send("pair", pairs_held)
                    words_held, pairs_held, size = [], [], 0
        yield from send("word", words_held)
        yield from send("pair", pairs_held)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The rows of a partition follow each other; small sums of them are merged as they come.
        at, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["kind"], row["part"]) != at:
                    yield from _sum(at, held)
                    at, held = (row["kind"], row["part"]), []
                pair = row["kind"] == "pair"
                keys = lengthened(row["keys"]) if pair else np.frombuffer(row["keys"], np.uint64)
                number = np.frombuffer(row["counts"], np.int64) if row["counts"] else np.ones(len(keys), np.int64)
                held.append((keys, number))
                if len(held) >= 32:
                    held = [_merged(*map(np.concatenate, zip(*held)))]
        yield from _sum(at, held)

    bound_batches(texts.sparkSession)
    sent = texts.select("text").mapInArrow(tally, _COUNTED)
    dealt = sent.repartition(2 * parts, "kind", "part").sortWithinPartitions("kind", "part")
    return dealt.mapInArrow(total, _COUNTED)


def _edges(parts: int) -> np.ndarray:
    return np.array([(k << 64) // parts for k in range(parts)], np.uint64)


def _row(kind: str, part: int, keys: bytes, counts: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([kind]), pa.array([part], pa.int32()), pa.array([keys], pa.binary()), pa.array([counts], pa.binary())],
        ["kind", "part", "keys", "counts"],
    )


def _sum(at: tuple[str, int] | None, held: list) -> Iterator[pa.RecordBatch]:
    if at is not None:
        keys, counts = _merged(*map(np.concatenate, zip(*held)))
        if at[0] == "pair":
            block = LogBloom.build(keys, counts)
            yield _row(*at, block.words.tobytes(), np.array([block.top]).tobytes())
        else:
            yield _row(*at, keys.tobytes(), counts.tobytes())


def quantised(counts: np.ndarray) -> np.ndarray:
    """1 for a count of 1, one more for each factor of ``QUANT``."""
    return 1 + np.floor(np.log(counts) / np.log(QUANT) + 1e-9).astype(np.int64)


def restored(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level, 0 for level 0."""
    low = QUANT ** (levels - 1.0)
    return np.where(levels > 0, np.maximum((low + np.ceil(low * QUANT) - 1) / 2, 1.0), 0.0)


class LogBloom:
    """Bloom filter of (key, level) entries; all probes of an entry fall in one 64-bit word.

    No entry has a level above ``top``.
    """

    def __init__(self, words: np.ndarray, top: int):
        self.words = words
        self.top = top

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray) -> LogBloom:
        level = quantised(counts)
        words = np.zeros(max(1, -(-BITS_PER_ENTRY * int(level.sum()) // 64)), np.uint64)
        top = int(level.max(initial=0))
        for k in range(1, top + 1):
            place, bits = cls.places(keys[level >= k], k, len(words))
            np.bitwise_or.at(words, place.astype(np.int64), bits)
        return cls(words, top)

    @staticmethod
    def places(keys: np.ndarray, level: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        h = hashing.mix(keys + np.uint64((level * 0x632BE59BD9B4E019) % (1 << 64)))
        bits = np.zeros(len(h), np.uint64)
        for k in range(PROBES):
            bits |= np.uint64(1) << (h >> np.uint64(6 * k) & np.uint64(63))
        return (h >> np.uint64(24)) % np.uint64(size), bits

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The quantised count of each key: as many levels as are found without a miss."""
        out = np.zeros(len(keys), np.int64)
        live = np.arange(len(keys))
        for level in range(1, self.top + 1):
            place, bits = self.places(keys[live], level, len(self.words))
            live = live[self.words[place.astype(np.int64)] & bits == bits]
            out[live] = level
        return out


def _totals(counted: DataFrame) -> tuple[int, int]:
    """Training tokens and distinct training tokens."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.frombuffer(c, np.int64) for c in batch.column("counts").to_pylist()]
            columns = [pa.array([f(c) for c in counts], pa.int64()) for f in (lambda c: int(c.sum()), len)]
            yield pa.RecordBatch.from_arrays(columns, ["n", "v"])

    words = counted.filter("kind = 'word'").select("counts")
    sums = words.mapInArrow(measure, "n bigint, v bigint").agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "v")]
    )
    return tuple(sums.first())


def _size(texts: DataFrame) -> int:
    """Bytes of all texts and 64 for each."""
    return texts.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0


def score(
    docs: DataFrame,
    training: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    group_bytes: int = GROUP_BYTES,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Per row ``(id, n_tokens, n_known, train_tokens, base_score, score)``.

    ``base_score`` adds log10((c + 1) / (N + V + 1)) over the words of a text and its end, with exact
    counts c of the training texts, N in all and V distinct. ``score`` is the log10 probability
    under the pair model, whose filter has as many blocks as keep each below ``group_bytes`` of text
    and ``max_bits`` in the mean. A null text counts as empty, in training too: an end alone. Without
    training texts N and V are 0. Repeated rows give repeated results; ids may be null.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    texts = named(docs, id=id_column, text=text_column)
    kind = texts.schema["id"].dataType
    # As text, since pandas would turn whole numbers with a null among them into fractions.
    texts = texts.withColumn("id", F.col("id").cast("string"))
    training = named(training, text=text_column)
    # No text has more words and pairs than bytes and 64, so no more entries.
    size = max(_size(texts), _size(training))
    parts = max(1, -(-size // group_bytes), -(-size * BITS_PER_ENTRY // max_bits))
    counted = saved(count(training, parts), "counts")
    n, v = _totals(counted)

    dealt = texts.mapInArrow(_deal(group_bytes), with_id(texts, "text string, group bigint"))
    asked = dealt.select("group", "text").mapInArrow(
        _ask(parts), "group bigint, part int, words binary, pairs binary"
    )
    known = counted.select("kind", "part", "keys", "counts")
    answers = asked.groupBy("part").cogroup(known.groupBy("part")).applyInPandas(
        _answer, "group bigint, part int, counts binary, levels binary"
    )
    schema = with_id(texts, "n_tokens bigint, n_known bigint, base_score double, score double")
    scored = (
        dealt.groupBy("group")
        .cogroup(answers.groupBy("group"))
        .applyInPandas(_scorer(parts, n, v), schema)
    )
    return scored.select(
        F.col("id").cast(kind), "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score"
    )


def _deal(group_bytes: int):
    """Adds a group of about ``group_bytes`` of text that follow each other in one task."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task that is run again reads the same rows and names the same groups.
        group, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for rows, data, _ in text_chunks(batch, "text"):
                if size and size + len(data) > group_bytes:
                    group, size = group + 1, 0
                size += len(data) + 64 * len(rows)
                column = pa.array(np.full(len(rows), group))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("text"), column], ["id", "text", "group"]
                )

    return deal


def _ask(parts: int):
    """The distinct words and pairs of each group, by hash partition."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, words_held, pairs_held = None, [], []
        for batch in batches:
            for rows, data, bounds in text_chunks(batch, "text"):
                groups = rows.column("group").to_numpy()
                for group in np.unique(groups):
                    mine = np.flatnonzero(groups == group)
                    part = bounds[mine[0] : mine[-1] + 2]
                    words, begins = tokens(data[part[0] : part[-1]], part - part[0])
                    if group != now:
                        yield from _asked(now, words_held, pairs_held, parts)
                        now, words_held, pairs_held = group, [], []
                    words_held.append(np.unique(words))
                    pairs_held.append(np.unique(pairs(words, begins)))
        yield from _asked(now, words_held, pairs_held, parts)

    return ask


def _asked(
    group: int | None, words_held: list[np.ndarray], pairs_held: list[np.ndarray], parts: int
) -> Iterator[pa.RecordBatch]:
    if group is None:
        return
    words, two = np.unique(np.concatenate(words_held)), np.unique(np.concatenate(pairs_held))
    cuts, ends = _cuts(words, parts), _cuts(two, parts)
    full = _asked_parts(cuts, ends)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(full), group)),
            pa.array(full.astype(np.int32)),
            pa.array([words[cuts[p] : cuts[p + 1]].tobytes() for p in full], pa.binary()),
            pa.array([shortened(two[ends[p] : ends[p + 1]], p, parts) for p in full], pa.binary()),
        ],
        ["group", "part", "words", "pairs"],
    )


def _asked_parts(cuts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash partitions that a group has words or pairs in."""
    return np.flatnonzero(np.diff(cuts) + np.diff(ends))


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each hash partition begins in sorted keys, with the total at the end."""
    return np.append(np.searchsorted(keys, _edges(parts)), len(keys))


def _answer(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """The counts of the asked words of one partition and the levels of its pairs, in order.

    0 for what no training text holds.
    """
    of = {k: (keys, counts) for k, keys, counts in zip(known["kind"], known["keys"], known["counts"])}
    words, counts = [np.frombuffer(c, t) for c, t in zip(of.get("word", (b"", b"")), (np.uint64, np.int64))]
    block = None
    if "pair" in of:
        block = LogBloom(np.frombuffer(of["pair"][0], np.uint64), int(np.frombuffer(of["pair"][1], np.int64)[0]))
    numbers, levels = [], []
    for cell, two in zip(asked["words"], asked["pairs"]):
        keys = np.frombuffer(cell, np.uint64)
        found = np.zeros(len(keys), np.int64)
        if len(words):
            at = np.minimum(np.searchsorted(words, keys), len(words) - 1)
            found = np.where(words[at] == keys, counts[at], 0)
        # Most counts are small; the array says itself how wide its numbers are.
        numbers.append(found.astype(np.min_scalar_type(int(found.max(initial=0)))).tobytes())
        level = block.levels(lengthened(two)) if block else np.zeros(len(two) // SHORT)
        # No count of 64 bits has more than 64 levels.
        levels.append(level.astype(np.uint8).tobytes())
    return pd.DataFrame({"group": asked["group"], "part": asked["part"], "counts": numbers, "levels": levels})


def _scorer(parts: int, n: int, v: int):
    def scorer(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(texts["text"].where(texts["text"].notna(), None), pa.string())], ["text"]
        )
        chunks = [tokens(data, bounds) for _, data, bounds in text_chunks(batch, "text")]
        keys = np.unique(np.concatenate([np.unique(words) for words, _ in chunks]))
        two = [pairs(words, begins) for words, begins in chunks]
        pair_keys = np.unique(np.concatenate([np.unique(p) for p in two]))
        cuts, ends = _cuts(keys, parts), _cuts(pair_keys, parts)
        counts, levels = np.zeros(len(keys), np.int64), np.zeros(len(pair_keys), np.int64)
        if len(answers) != len(_asked_parts(cuts, ends)):
            raise ValueError("the answers of a group do not match its words")
        for part, cell, level in zip(answers["part"], answers["counts"], answers["levels"]):
            low, high = cuts[part], cuts[part + 1]
            if len(cell) % max(high - low, 1) or len(level) != ends[part + 1] - ends[part]:
                raise ValueError("the answers of a group do not match its words")
            if low < high:
                counts[low:high] = np.frombuffer(cell, f"u{len(cell) // (high - low)}")
            levels[ends[part] : ends[part + 1]] = np.frombuffer(level, np.uint8)
        out: list[tuple] = []
        end = counts[np.searchsorted(keys, _END)]
        for (words, begins), p in zip(chunks, two):
            exact = counts[np.searchsorted(keys, words)]
            base = np.log10((exact + 1) / (n + v + 1))
            pair = levels[np.searchsorted(pair_keys, p)]
            log = np.log10(_probability(exact, pair, end, begins, n, v))
            first = begins[:-1]
            out.append(
                (
                    np.diff(begins),
                    np.add.reduceat((exact > 0).astype(np.int64), first),
                    np.add.reduceat(base, first),
                    np.add.reduceat(log, first),
                )
            )
        columns = [np.concatenate(c) for c in zip(*out)]
        names = ("n_tokens", "n_known", "base_score", "score")
        return pd.DataFrame({"id": texts["id"]} | dict(zip(names, columns)))

    return scorer


def _probability(
    exact: np.ndarray, pair: np.ndarray, end: int, begins: np.ndarray, n: int, v: int
) -> np.ndarray:
    """Interpolated probability of each token after the one before it, from quantised counts.

    ``exact`` are the counts of the tokens, ``pair`` the levels of their pairs, ``end`` the count of ends.
    """
    single = _rounded(exact)
    word = (single + 1) / (n + v + 1)
    before = np.empty(len(exact))
    before[1:] = single[:-1]
    # In front of the first word stands the end of another text.
    before[begins[:-1]] = _rounded(np.array([end]))[0]
    share = np.minimum(restored(pair) / np.maximum(before, 1), 1.0)
    return np.where(before > 0, PAIR_WEIGHT * share + (1 - PAIR_WEIGHT) * word, word)


def _rounded(counts: np.ndarray) -> np.ndarray:
    """Counts as their logarithm keeps them."""
    return restored(np.where(counts > 0, quantised(np.maximum(counts, 1)), 0))
