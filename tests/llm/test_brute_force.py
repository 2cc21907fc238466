"""Registered queries that SQL cannot express, against plain versions over the smallest tables."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from clinicmart.llm.queries import all_queries

public_tokenizers = pytest.importorskip("public_tokenizers")
SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def read(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def docs():
    return read("documents")


def found(spark, name, key="doc_id"):
    rows = all_queries()[name](spark, SF_DIR).collect()
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def bucket(doc_id, buckets):
    return zlib.crc32(str(doc_id).encode()) % buckets


def smallest_reached(ids, links):
    """The smallest id each one reaches."""
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {i: top(i) for i in ids}


def test_language_on_held_out_documents(spark, docs):
    rows = found(spark, "op1_language")
    assert rows.keys() == {d["doc_id"] for d in docs}
    right = []
    for d in docs:
        row, text = rows[d["doc_id"]], d["text"] or ""
        assert row.held_out == (bucket(d["doc_id"], 4) == 2)
        assert 0 <= row.score <= 1
        if not any(c.isalpha() for c in text):
            assert (row.lang_pred, row.score) == ("und", 0.0)
        elif row.held_out and d["lang"] is not None:
            right.append(row.lang_pred == d["lang"])
    assert len(right) > 20 and np.mean(right) >= 0.9


def test_repeated_windows(spark, docs):
    words = {d["doc_id"]: WORD.findall(d["text"] or "") for d in docs}
    starts = Counter(tuple(w[i : i + 35]) for w in words.values() for i in range(len(w) - 34))
    rows = found(spark, "op4_substrings")
    assert rows.keys() == words.keys()
    for doc_id, w in words.items():
        gone = {
            i + k for i in range(len(w) - 34) if starts[tuple(w[i : i + 35])] > 1 for k in range(35)
        }
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        assert tuple(rows[doc_id][:4]) == (doc_id, len(w), len(gone), sha(kept))


def test_base_scores(spark, docs):
    tokens = {
        d["doc_id"]: [*WORD.findall((d["text"] or "").translate(LOWER)), None] for d in docs
    }
    counts = Counter(t for i, ts in tokens.items() if bucket(i, 7) != 2 for t in ts)
    total, distinct = sum(counts.values()), len(counts)
    rows = found(spark, "op6_lm")
    assert rows.keys() == tokens.keys()
    for doc_id, ts in tokens.items():
        row = rows[doc_id]
        assert row.held_out == (bucket(doc_id, 7) == 2)
        known = sum(counts[t] > 0 for t in ts)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(ts), known, total)
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in ts)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert math.isfinite(row.score) and row.score <= 0


def test_near_vectors(spark):
    table = read("embeddings")
    column = next(c for c, v in table[0].items() if isinstance(v, list))
    usable = [
        r for r in table
        if r[column] and None not in r[column] and np.isfinite(r[column]).all() and np.any(r[column])
    ]
    unit = np.array([r[column] for r in usable], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = np.argwhere(np.triu(unit @ unit.T >= 0.9, 1))
    ids = [r["vec_id"] for r in usable]
    links = [(ids[a], ids[b]) for a, b in near]
    degree = Counter(i for pair in links for i in pair)
    reached = smallest_reached([r["vec_id"] for r in table], links)
    rows = found(spark, "op7_vectors", "vec_id")
    assert rows.keys() == reached.keys()
    for i, least in reached.items():
        assert (rows[i].n_links, rows[i].component_id, rows[i].kept) == (degree[i], least, i == least)


def base_spans(text):
    """Personal data by the patterns as they are stated."""
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(s))]
        return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0

    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]
    return sorted(
        (m.start(), rank, m.end(), kind)
        for rank, (kind, pattern, fits) in enumerate(rules)
        for m in re.finditer(pattern, text)
        if fits(m[0])
    )


def test_base_personal_data(spark, docs):
    rows = found(spark, "op8_pii")
    assert rows.keys() == {d["doc_id"] for d in docs}
    for d in docs:
        row, spans = rows[d["doc_id"]], base_spans(d["text"] or "")
        number = Counter(s[3] for s in spans)
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(
            number[k] for k in ("email", "ip", "card", "phone")
        )
        stated = [f"{k}:{s}:{e}" for s, _, e, k in spans]
        assert row.base_sha256 == sha(",".join(stated))
        assert set(stated) <= set(row.spans.split(",")) | {""}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_groups(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    links = []
    for a, b in combinations([i for i, s in sets.items() if s], 2):
        x, y = sets[a], sets[b]
        if min(len(x), len(y)) * 100 >= 75 * max(len(x), len(y)):
            both = len(x & y)
            if 100 * both >= 75 * (len(x) + len(y) - both):
                links.append((a, b))
    return sets, smallest_reached(texts, links)


def test_near_duplicates(spark, docs):
    sets, reached = near_groups({d["doc_id"]: d["text"] for d in docs})
    rows = found(spark, "op9_near_dups")
    assert rows.keys() == reached.keys()
    for i, least in reached.items():
        row = rows[i]
        assert (row.n_shingles, row.component_id, row.kept) == (len(sets[i]), least, i == least)


def test_token_counts(spark, docs):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    rows = found(spark, "op10_tokens")
    assert rows.keys() == {d["doc_id"] for d in docs}
    for d in docs:
        text = d["text"] or ""
        n = len(model.encode(text))
        row = rows[d["doc_id"]]
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 4096)


def repetitive(words, doc_id):
    """Every tenth id reads with a repeated tail."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def periodic(words):
    """Maximal stretches per period; of equal ones that with the smallest period."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        same = [x == y for x, y in zip(words, words[q:])] + [False]
        start = None
        for i, s in enumerate(same):
            if s and start is None:
                start = i
            elif not s and start is not None:
                if i + q - start >= max(6, 4 * q):
                    found.setdefault((start, i + q), q)
                start = None
    return sorted((s, e - s, q) for (s, e), q in found.items())


def test_periodic_runs(spark, docs):
    rows = found(spark, "op11_runs")
    assert rows.keys() == {d["doc_id"] for d in docs}
    seen = 0
    for d in docs:
        words = repetitive(WORD.findall(d["text"] or ""), d["doc_id"])
        stretches = periodic(words)
        seen += len(stretches)
        drop = {i for s, n, q in stretches for i in range(s + q, s + n)}
        best = min(stretches, key=lambda r: (-r[1], r[0], r[2]), default=None)
        longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in stretches)
        kept = " ".join(w for i, w in enumerate(words) if i not in drop)
        assert tuple(rows[d["doc_id"]]) == (d["doc_id"], len(stretches), *longest, sha(lines), sha(kept))
    assert seen > 10


def windows_of(words):
    size = min(10, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def poisson(mean, at):
    term = below = math.exp(-mean)
    n = 0
    while below <= at:
        n += 1
        term *= mean / n
        below += term
    return n


def test_pipeline(spark, docs):
    now = corpus_pipeline.table(spark, SF_DIR, "documents")
    before = {d["doc_id"]: d["text"] for d in docs}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.saved(stage(spark, now, SF_DIR), name)
        rows = now.collect()
        after = {r.doc_id: r.text for r in rows}
        assert len(after) == len(rows)
        if name == "language_id":
            assert all(any(c.isalpha() for c in t or "") for t in after.values())
            labelled = {d["doc_id"] for d in docs if d["lang"] and len(WORD.findall(d["text"] or "")) >= 20}
            assert len(labelled & after.keys()) >= 0.95 * len(labelled)
        elif name == "near_dedup":
            _, reached = near_groups(before)
            assert after == {i: before[i] for i, least in reached.items() if i == least}
        elif name == "decontaminate":
            asked = set()
            for item in read("benchmark"):
                asked |= windows_of(ITEM_WORD.findall((item["text"] or "").translate(LOWER)))
            clean = {}
            for i, text in before.items():
                words = ITEM_WORD.findall((text or "").translate(LOWER))
                hit = any(
                    tuple(words[k : k + n]) in asked
                    for n in {len(w) for w in asked} for k in range(len(words) - n + 1)
                )
                if not hit:
                    clean[i] = text
            assert after == clean
        elif name == "pii":
            assert after.keys() == before.keys()
            for row in rows:
                spans = base_spans(before[row.doc_id] or "")
                assert (row.text != before[row.doc_id]) >= bool(spans)
                for s, _, e, kind in spans:
                    assert kind not in ("email", "phone") or before[row.doc_id][s:e] not in row.text
                if row.text != before[row.doc_id]:
                    assert row.n_chars == len(row.text)
        before = after
    size = Counter()
    rows = now.collect()
    for r in rows:
        size[r.source] += len(r.text or "")
    norm = sum(math.sqrt(s) for s in size.values())
    rate = {k: sum(size.values()) * math.sqrt(s) / norm / s if s else 0.0 for k, s in size.items()}
    expected = Counter()
    for r in rows:
        at = int(hashlib.md5(f"mix-1:{r.doc_id}:1".encode()).hexdigest()[:13], 16) / (1 << 52)
        if rate[r.source]:
            expected[r.doc_id] = poisson(rate[r.source], at)
    mixed = corpus_pipeline.STAGES[-1][1](spark, now, SF_DIR).collect()
    assert Counter(r.doc_id for r in mixed) == +expected
    assert len({(r.doc_id, r.copy_no) for r in mixed}) == len(mixed)
