"""The pair model with a filter of many blocks, against exact counts."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from clinicmart.llm import lm


def test_scores_with_a_filter_of_many_blocks(spark):
    rng = random.Random(7)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7)) % 3000}" for _ in range(60)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.id: r for r in lm.score(docs, docs, group_bytes=8_000, max_bits=1 << 14).collect()}

    split = {i: [None, *t.split(), None] for i, t in enumerate(texts)}
    singles = Counter(t for ts in split.values() for t in ts[1:])
    twos = Counter(p for ts in split.values() for p in zip(ts, ts[1:]))
    total, distinct = sum(singles.values()), len(singles)

    def rounded(count):
        return float(lm.restored(lm.quantised(np.array([count])))[0]) if count else 0.0

    above = []
    for i, ts in split.items():
        exact = 0.0
        for a, b in zip(ts, ts[1:]):
            pair = twos[a, b] if twos[a, b] >= lm.LEAST_PAIR else 0
            share = min(rounded(pair) / rounded(singles[a]), 1.0)
            word = (rounded(singles[b]) + 1) / (total + distinct + 1)
            exact += math.log10(lm.PAIR_WEIGHT * share + (1 - lm.PAIR_WEIGHT) * word)
        # A false hit can only make a count larger.
        assert rows[i].score >= exact - 1e-6
        above.append(rows[i].score - exact)
    assert np.mean(np.array(above) < 1e-6) > 0.5
    assert np.mean(above) < 0.5


def test_levels_end_in_a_full_filter():
    full = lm.LogBloom(np.full(4, 2**64 - 1, np.uint64), top=9)
    assert lm.LogBloom.build(np.arange(3, dtype=np.uint64), np.array([2, 5, 9])).top == 4
    assert full.levels(np.arange(5, dtype=np.uint64)).tolist() == [9] * 5


def test_short_keys_come_back():
    keys = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, np.uint64))
    for parts in (1, 3, 5000):
        edge = int(lm._edges(parts)[parts - 1])
        mine = keys[keys >= edge]
        short = lm.lengthened(lm.shortened(mine, parts - 1, parts))
        assert len(short) == len(mine) and (np.diff(short.astype(np.int64)) >= 0).all()
    assert lm.lengthened(b"").tolist() == []


def test_a_pair_seen_once_counts(spark):
    texts = ["a b", "c d", "c d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.id: r.score for r in lm.score(docs, docs).collect()}

    def rounded(count):
        return float(lm.restored(lm.quantised(np.array([count])))[0])

    # Tokens: a, b, end, c, d, end, c, d, end; the pair (a, b) occurs once.
    total, distinct = 9, 5
    word = lambda c: (rounded(c) + 1) / (total + distinct + 1)
    step = lambda pair, before, c: math.log10(
        lm.PAIR_WEIGHT * min(rounded(pair) / rounded(before), 1.0) + (1 - lm.PAIR_WEIGHT) * word(c)
    )
    exact = step(1, 3, 1) + step(1, 1, 1) + step(1, 1, 3)
    assert got[0] == pytest.approx(exact, abs=1e-9)
