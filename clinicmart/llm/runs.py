"""Periodic runs of words, found on a grammar of each text.

The word ids of a text are compressed by pair replacement: of the pairs of neighbours that
occur twice or more, those more frequent than the pairs they overlap with become a
nonterminal, until no pair occurs twice. (Classic Re-Pair replaces one pair at a time; here
all pairs of one round that do not touch each other go together, so that a round is a few
array operations over all texts of a chunk.) What is left of a text is paired up evenly, so
that every text has one root and every nonterminal two parts.

A run lies in the lowest nonterminal that holds all of it, and crosses the boundary between
its two parts. So each nonterminal is searched once, around its boundary, whatever the
number of places it is derived at: one of its parts holds two periods of the run, which
makes a square at the boundary, and the run is as far as that square can be extended. Runs
are then handed down the derivation to all places of their nonterminal, and those of one
period that overlap by a period are one run.

Texts are independent, so nothing is shuffled; memory is in proportion to one chunk
(or one text, if it is longer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicmart.llm import hashing
from clinicmart.llm.common import bound_batches, sha256_text, text_chunks, with_id

#: A run has at least this many words, and this many times its period.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Candidates looked at together.
_AT_ONCE = 1 << 20

# Two primes and bases for hashes of word sequences; both must agree.
_FIELDS = ((np.uint64((1 << 31) - 1), 910276013), (np.uint64((1 << 31) - 19), 1318699421))


class Grammar:
    """Nonterminals of the texts of a chunk.

    ``words`` are ids, ``first`` the first word of each text and the total. Symbols below
    ``terminals`` are words; rule r is symbol ``terminals + r`` and stands for the words
    ``begin[r]`` to ``end[r]`` (its first place), split at ``middle[r]`` into the symbols
    ``left[r]`` and ``right[r]``. ``levels`` are the rules at which each round starts:
    the parts of a rule are of earlier rounds. ``roots`` has a symbol for each text with words.
    """

    def __init__(self, words: np.ndarray, first: np.ndarray):
        self.words = words
        self.terminals = int(words.max()) + 1 if len(words) else 0
        self._rules: list[np.ndarray] = []
        self.levels = [0]
        self._lengths = np.ones(self.terminals, np.int64)
        symbols, place, text = words, np.arange(len(words)), hashing.owners(first)
        done = []
        while len(symbols):
            symbols, place, text, over = self._round(symbols, place, text)
            done.append(over)
        if done:
            symbols, place, text = (np.concatenate(part) for part in zip(*done))
            order = np.argsort(place)
            symbols, place, text = symbols[order], place[order], text[order]
        while len(text) and (text[1:] == text[:-1]).any():
            symbols, place, text = self._pair_up(symbols, place, text)
        self.roots, self.root_place = symbols, place
        rules = np.concatenate(self._rules, 1) if self._rules else np.empty((5, 0), np.int64)
        self.left, self.right, self.begin, self.middle, self.end = rules

    def _round(self, symbols, place, text):
        """Replace pairs that occur again; texts without any are handed back as finished."""
        pair = symbols[:-1] << 32 | symbols[1:]
        inside = text[:-1] == text[1:]
        # In a a a a the pair (a, a) occurs at every other place only.
        again = np.zeros(len(pair), bool)
        again[1:] = (pair[1:] == pair[:-1]) & inside[1:] & inside[:-1]
        number = np.arange(len(pair))
        start = np.maximum.accumulate(np.where(again, 0, number))
        at = np.flatnonzero(inside & ((number - start) % 2 == 0))
        distinct, which, count = np.unique(pair[at], return_inverse=True, return_counts=True)
        order = np.argsort(count, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        often = count[which] >= 2
        at, which = at[often], which[often]
        active = np.zeros(int(text[-1]) + 1, bool)
        active[text[at]] = True
        goes_on = active[text]
        over = symbols[~goes_on], place[~goes_on], text[~goes_on]
        if not len(at):
            return symbols[:0], place[:0], text[:0], over
        weight = np.full(len(pair) + 2, -1)
        weight[at + 1] = rank[which]
        best = (weight[at + 1] > weight[at]) & (weight[at + 1] > weight[at + 2])
        at, which = at[best], which[best]
        # A rule used once would compress nothing; the most frequent pair of a text always stays.
        used = np.bincount(which, minlength=len(distinct)) >= 2
        stays = used[which]
        at, which = at[stays], which[stays]
        new, example, which = np.unique(which, return_index=True, return_inverse=True)
        self._add(symbols[at[example]], symbols[at[example] + 1], place[at[example]], place[at[example] + 1])
        symbols = symbols.copy()
        symbols[at] = len(self._lengths) - len(new) + which
        keep = goes_on
        keep[at + 1] = False
        return symbols[keep], place[keep], text[keep], over

    def _pair_up(self, symbols, place, text):
        number = np.arange(len(symbols))
        head = np.ones(len(text), bool)
        head[1:] = text[1:] != text[:-1]
        inner = number - np.maximum.accumulate(np.where(head, number, 0))
        at = np.flatnonzero((inner[:-1] % 2 == 0) & (text[1:] == text[:-1]))
        before = len(self._lengths)
        self._add(symbols[at], symbols[at + 1], place[at], place[at + 1])
        symbols = symbols.copy()
        symbols[at] = before + np.arange(len(at))
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        return symbols[keep], place[keep], text[keep]

    def _add(self, left, right, begin, middle):
        end = middle + self._lengths[right]
        self._rules.append(np.stack([left, right, begin, middle, end]))
        self._lengths = np.concatenate([self._lengths, end - begin])
        self.levels.append(self.levels[-1] + len(left))

    def places(self, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(rules, places)`` of all derivations of the wanted rules, round by round from the roots."""
        holds = np.zeros(self.terminals + len(wanted), bool)
        for low, high in zip(self.levels[:-1], self.levels[1:]):
            part = slice(low, high)
            holds[self.terminals + low : self.terminals + high] = (
                wanted[part] | holds[self.left[part]] | holds[self.right[part]]
            )
        keep = holds[self.roots]
        symbols, place = self.roots[keep], self.root_place[keep]
        for low in reversed(self.levels[:-1]):
            now = symbols >= self.terminals + low
            rules, at = symbols[now] - self.terminals, place[now]
            yield rules, at
            children = np.concatenate([self.left[rules], self.right[rules]])
            where = np.concatenate([at, at + self.middle[rules] - self.begin[rules]])
            keep = holds[children]
            symbols = np.concatenate([symbols[~now], children[keep]])
            place = np.concatenate([place[~now], where[keep]])


class _Sequence:
    """Hashes of all stretches of a sequence, and how far two of its places agree."""

    def __init__(self, words: np.ndarray):
        spread = hashing.mix(words.astype(np.uint64) + np.uint64(1))
        self.fields = []
        for prime, base in _FIELDS:
            powers = _powers(np.uint64(base), len(words) + 1, prime)
            sums = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(spread % prime * powers[:-1] % prime, out=sums[1:])
            self.fields.append((prime, powers, sums % prime))

    def equal(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches at i and, further on, at j are the same."""
        out = np.ones(len(i), bool)
        for prime, powers, sums in self.fields:
            one = (sums[i + length] + prime - sums[i]) % prime * powers[j - i] % prime
            out &= one == (sums[j + length] + prime - sums[j]) % prime
        return out

    def agree(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words agree from i and j on, or before them; at most ``limit``."""
        low, high = np.zeros(len(i), np.int64), limit.copy()
        while (low < high).any():
            half = (low + high + 1) // 2
            shift = half if back else 0
            same = self.equal(i - shift, j - shift, half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low


def _powers(base: np.uint64, n: int, prime: np.uint64) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have, step = 1, base
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * step % prime
        have += more
        step = step * step % prime
    return out


def _crossing(grammar: Grammar) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(rule, start, end, period)`` of the runs around the boundary of each rule, in its first place."""
    words, n = grammar.words, len(grammar.words)
    rules = np.flatnonzero(grammar.end - grammar.begin >= LEAST_WORDS)
    found = []
    if len(rules):
        # Places with the same two words around them, in order: (pair, place) as one number.
        pair = np.zeros(n, np.int64)
        pair[1:] = words[:-1] << 32 | words[1:]
        pair = np.unique(pair, return_inverse=True)[1]
        index = np.sort(pair * n + np.arange(n))
        sequence = _Sequence(words)
        begin, middle, end = grammar.begin[rules], grammar.middle[rules], grammar.end[rules]
        longest = (end - begin) // LEAST_PERIODS
        key = pair[middle] * n + middle
        own = np.searchsorted(index, key)
        after = np.searchsorted(index, key + np.minimum((end - middle) // 2, longest), "right")
        before = np.searchsorted(index, key - np.minimum((middle - begin) // 2, longest))
        for low, high in ((own + 1, after), (before, own)):
            # Other pairs lie before and behind the places of this one.
            for rule, at in _ranges(low, high):
                other = index[at] - pair[middle[rule]] * n
                ok = (other >= begin[rule]) & (other < end[rule])
                rule, other = rule[ok], other[ok]
                found.append(_extend(sequence, rules[rule], begin[rule], middle[rule], end[rule], other))
    if not found:
        return (np.empty(0, np.int64),) * 4
    rule, start, stop, period = (np.concatenate(part) for part in zip(*found))
    return _smallest_period(rule, start, stop, period)


def _ranges(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the range, value) for all values of many ranges, some at a time."""
    sizes = np.maximum(high - low, 0)
    total = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        done = int(total[start - 1]) if start else 0
        to = max(start + 1, int(np.searchsorted(total, done + _AT_ONCE, "right")))
        part = sizes[start:to]
        which = np.repeat(np.arange(start, to), part)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(part) - part, part)
        yield which, low[which] + inner
        start = to


def _extend(sequence, rule, begin, middle, end, other):
    """Stretches of period ``|other - middle|`` around the middle that are long enough."""
    i, j = np.minimum(middle, other), np.maximum(middle, other)
    period = j - i
    # Two periods on one side of the middle: its word sequence occurs again right there.
    right = other > middle
    square = np.where(right, i, i - period)
    ok = (square >= begin) & (square + 2 * period <= end)
    ok[ok] = sequence.equal(square[ok], square[ok] + period[ok], period[ok])
    rule, begin, end, i, j, period = (x[ok] for x in (rule, begin, end, i, j, period))
    start = i - sequence.agree(i, j, i - begin, back=True)
    stop = j + sequence.agree(i, j, end - j)
    ok = stop - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    return rule[ok], start[ok], stop[ok], period[ok]


def _smallest_period(rule, start, stop, period):
    """Of equal stretches the one with the smallest period; the others are multiples of it."""
    order = np.lexsort((period, stop, start, rule))
    rule, start, stop, period = (x[order] for x in (rule, start, stop, period))
    new = np.ones(len(rule), bool)
    new[1:] = (rule[1:] != rule[:-1]) | (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    return rule[new], start[new], stop[new], period[new]


def find_runs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, period)`` of the runs in texts of word ids, by start, then period."""
    grammar = Grammar(words, first)
    rule, start, stop, period = _crossing(grammar)
    # By rule already: the runs of a rule follow each other.
    size = np.bincount(rule, minlength=len(grammar.left)) if len(rule) else np.zeros(len(grammar.left), np.int64)
    low = np.cumsum(size) - size
    start, stop = start - grammar.begin[rule], stop - grammar.begin[rule]
    parts = []
    for rules, place in grammar.places(size > 0):
        for which, run in _ranges(low[rules], low[rules] + size[rules]):
            parts.append((place[which] + start[run], place[which] + stop[run], period[run]))
    if not parts:
        return (np.empty(0, np.int64),) * 3
    start, stop, period = _merge(*(np.concatenate(part) for part in zip(*parts)))
    _, start, stop, period = _smallest_period(np.zeros(len(start), np.int64), start, stop, period)
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def _merge(start, stop, period):
    """Stretches of one period that overlap by a period or more are one."""
    order = np.lexsort((start, period))
    start, stop, period = start[order], stop[order], period[order]
    apart = int(stop.max()) + 1 if len(stop) else 1
    reach = np.maximum.accumulate(stop + period * apart) - period * apart
    new = np.ones(len(start), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] > reach[:-1] - period[1:])
    at = np.flatnonzero(new)
    return start[at], np.maximum.reduceat(stop, at) if len(at) else stop, period[at]


def _repeat_tails(first: np.ndarray, seeds: pa.Array) -> np.ndarray | None:
    """The word that stands at each place, where texts with a seed repeat a stretch to their end."""
    if seeds.null_count == len(seeds):
        return None
    number = np.arange(first[-1])
    for i, g in enumerate(seeds.to_pylist()):
        low, n = int(first[i]), int(first[i + 1] - first[i])
        if g is not None and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            number[low + a : low + n] = low + a + np.arange(n - a) % p
    return number


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tail_seed: Column | None = None
) -> DataFrame:
    """Per row ``(id, n_words, runs, collapsed)``.

    ``runs`` are ``(start, length, period)`` in words, by start, then period: maximal stretches
    of at least six words and four periods. ``collapsed`` is the text without what a run
    has after its first period, words joined by one space. Null, empty and blank texts have
    no words, no runs and the empty text; rows are judged one by one, so repeated rows and ids
    and null ids are nothing special, and an empty table gives an empty result.

    ``tail_seed`` plants runs: a text of n words with a seed g reads, from word ``a = g % n`` on,
    as its ``1 + (n - a) // (3 + g % 8)`` words from there over and over. Null plants nothing.
    """
    bound_batches(docs.sparkSession)
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    seed = F.lit(None) if tail_seed is None else tail_seed
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"), seed.cast("bigint").alias("seed")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in text_chunks(batch, "text"):
                starts, ends, first = hashing.find_words(data, bounds, hashing.SPACE)
                hashes = hashing.hash_words(data, starts, ends)
                moved = _repeat_tails(first, part.column("seed"))
                if moved is not None:
                    starts, ends, hashes = starts[moved], ends[moved], hashes[moved]
                owner = hashing.owners(first)
                # Ids tell texts apart, so that pairs are counted in each text by itself.
                own = hashes ^ hashing.mix(owner.astype(np.uint64) + np.uint64(1))
                words = np.unique(own, return_inverse=True)[1].astype(np.int64)
                start, stop, period = find_runs(words, first)
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, start + period, 1)
                np.add.at(depth, stop, -1)
                kept = np.cumsum(depth)[:-1] == 0
                text = owner[start]
                runs = pa.StructArray.from_arrays(
                    [pa.array(start - first[text]), pa.array(stop - start), pa.array(period)], fields=list(run_type)
                )
                cuts = np.searchsorted(text, np.arange(len(part) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(np.diff(first), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cuts), runs),
                        hashing.join_words(data, starts[kept], ends[kept], owner[kept], len(part)).cast(pa.string()),
                    ],
                    ["id", "n_words", "runs", "collapsed"],
                )

    schema = with_id(rows, "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return rows.mapInArrow(search, schema)


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: first, then smallest period), and hashes."""
    longest = F.get(
        F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"], r["period"]))), 0
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length, period = -longest["l"], longest["period"]
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("bigint").alias("n_runs"),
        longest["start"].alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"),
        sha256_text(F.array_join(lines, "")).alias("runs_sha256"),
        sha256_text(F.col("collapsed")).alias("collapsed_sha256"),
    )
