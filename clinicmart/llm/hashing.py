"""Words and word sequences as 64-bit hashes, computed on whole batches of bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_random = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = 1 << 16
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_PLACE = _powers(_ODD, _PLACES)

#: White space as the word rules of these operators have it.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything that is neither an ASCII letter or digit nor part of a longer character.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[0x30:0x3A] = PUNCTUATION[0x41:0x5B] = PUNCTUATION[0x61:0x7B] = False
PUNCTUATION[0x80:] = False
#: Everything that is neither an ASCII letter nor part of a longer character.
NO_LETTER = PUNCTUATION.copy()
NO_LETTER[0x30:0x3A] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def find_words(
    data: np.ndarray, bounds: np.ndarray, separators: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the first word of each text (with the total at the end)."""
    inside = ~separators[data]
    size = len(data)
    before = np.zeros(size, bool)
    before[1:] = inside[:-1]
    after = np.zeros(size, bool)
    after[:-1] = inside[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < size)]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        # About a MB at a time keeps the arrays of eight bytes a character small.
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + (1 << 20), "right")))
        first, last = starts[at:to], ends[at:to]
        low = first[0]
        part = data[low : last[-1]]
        lengths = np.diff(np.append(first, last[-1]))
        place = np.arange(len(part)) - np.repeat(first - low, lengths)
        # Separators between two words stand behind the end of a word and count nothing.
        value = _BYTE[part] * _PLACE[place & (_PLACES - 1)]
        if lengths.max() > _PLACES:
            value *= (2 * (place >> 16) + 1).astype(np.uint64)
        value[place >= np.repeat(last - first, lengths)] = 0
        sums = np.add.reduceat(value, first - low)
        out[at:to] = mix(sums + (last - first).astype(np.uint64))
        at = to
    return out


def roll(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash for each run of ``length`` consecutive values; not yet mixed."""
    total = len(hashes) - length + 1
    if total <= 0:
        return np.empty(0, np.uint64)
    # Blocks of 1, 2, 4, ... values; those in the binary form of the length are strung together.
    done, width, have = None, 0, 1
    block, factor = hashes, _STEP
    rest = length
    while rest:
        if rest & 1:
            if done is None:
                done, width = block, have
            else:
                done = done[: len(done) - have] * factor + block[width:]
                width += have
        rest >>= 1
        if rest:
            block = block[:-have] * factor + block[have:]
            factor = np.uint64(int(factor) ** 2 % (1 << 64))
            have *= 2
    return done[:total]


def owners(first_word: np.ndarray) -> np.ndarray:
    """The text each word belongs to."""
    return np.repeat(np.arange(len(first_word) - 1), np.diff(first_word))


def normalise(
    data: np.ndarray, bounds: np.ndarray, separators: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts as ``' a b c '`` in lower case (A-Z), one after another.

    Returns the bytes, the place of each word and its end in them, and the first
    word of each text.
    """
    data = LOWER[data]
    starts, ends, first_word = find_words(data, bounds, separators)
    lengths = ends - starts
    text = owners(first_word)
    number = np.arange(len(starts))
    place = np.cumsum(lengths) - lengths + number + text + 1
    out = np.full(int(lengths.sum()) + len(starts) + len(bounds) - 1, 0x20, np.uint8)
    word = np.repeat(number, lengths)
    inside = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[place[word] + inside] = data[starts[word] + inside]
    return out, place, place + lengths, first_word


def join_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, texts: int) -> pa.Array:
    """Some words of each of ``texts`` texts, in order of the texts, joined by one space."""
    lengths = ends - starts
    count = np.bincount(text, minlength=texts)
    sizes = np.bincount(text, weights=lengths, minlength=texts).astype(np.int64) + np.maximum(count - 1, 0)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    out = np.full(int(bounds[-1]), 0x20, np.uint8)
    # Words stand one space apart, texts without.
    place = np.cumsum(lengths) - lengths + np.arange(len(starts))
    place -= np.concatenate([[0], np.cumsum(count > 0)])[text]
    word = np.repeat(np.arange(len(starts)), lengths)
    inside = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[place[word] + inside] = data[starts[word] + inside]
    return pa.LargeStringArray.from_buffers(texts, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out))
