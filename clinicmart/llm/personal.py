"""Personal data by rules, candidates and gradient-boosted trees.

The base rules find e-mail and network addresses, card and phone numbers. Generators of
high recall propose further spans, which may overlap: other spellings of the same kinds
(``name (at) host (dot) tld``, numbers with other separators, phone numbers without a
plus). Boosted trees score each candidate by its format and its context.

Labels do not depend on the spelling: what a base rule accepts is written in another
spelling at its place, and the candidate found there is an example; what has the form of a
rule and fails its check is written so too and is a counterexample, and so is an accepted
address with an ending that no host has. Of the proposals in the texts, numbers and addresses in
plain words (``name at host dot tld``) without any word of their kind in front are
counterexamples. Other proposals have no label; they are only scored. Probabilities are calibrated on a held-out part, and each kind gets the least
threshold that is precise enough there, provided both labels back it. Accepted
candidates that touch no base span are added to the base spans.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicmart.llm.boosting import Boosted, calibrate_table, fit, fit_table
from clinicmart.llm.common import bound_batches, joined_spans, named, saved, sha256_text, spans_of, text_chunks, with_id

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
LEAST_EVIDENCE = 20
CONTEXT = 24

# The character classes and patterns of the base rules.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_QUAD = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PLUS = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Generators: more spellings than the rules take.
_SPELLED = re.compile(
    r"(?<![\w.+-])[\w.+-]{1,64}\x20?(?:\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9-]{1,63}"
    r"(?:(?:\.|\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?)[A-Za-z0-9-]{1,63}){1,8}"
    r"|(?<![\w.+-])[\w.+-]{1,64}\x20at\x20[A-Za-z0-9-]{1,63}(?:\x20dot\x20[A-Za-z0-9-]{1,63}){1,8}",
    re.I,
)
# Digits are taken possessively: a long run of them would else be cut up in every possible way.
_NUMBER = re.compile(r"(?<![0-9])(?:\(?[0-9]{1,6}+\)?[\x20./_-]{0,2}){1,12}(?<=[0-9])(?![0-9])")
_WORDS = {
    "email": ("mail", "@", "contact", "courriel", "correo"),
    "ip": ("ip", "host", "server", "addr", "login"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta", "cc"),
    "phone": ("tel", "phone", "call", "fax", "mobil", "móvil", "anruf"),
}


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the e-mail rule; each sign is looked at once, however long the text."""
    low, at = 0, text.find("@")
    while at >= 0:
        name = text[low:at]
        begin = low + len(name.rstrip(_LOCAL))
        host = _DOMAIN.match(text, at + 1) if begin < at else None
        if host:
            yield begin, host.end()
        low = host.end() if host else at + 1
        at = text.find("@", low)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _quad_ok(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in text.split("."))


def _card_ok(text: str) -> bool:
    digits = _only_digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(text: str) -> bool:
    return 9 <= len(_only_digits(text)) <= 15


def rule_matches(text: str) -> Iterator[tuple[int, int, str, bool]]:
    """(start, end, kind, accepted) of everything that has the form of a base rule."""
    for start, end in emails(text):
        yield start, end, "email", True
    for m in _QUAD.finditer(text):
        yield m.start(), m.end(), "ip", _quad_ok(m[0])
    for m in _DIGITS.finditer(text):
        yield m.start(), m.end(), "card", _card_ok(m[0])
    for m in _PLUS.finditer(text):
        yield m.start(), m.end(), "phone", _phone_ok(m[0])


def proposals(text: str) -> Iterator[tuple[int, int, str]]:
    """Candidate spans of other spellings; one place may be proposed as several kinds."""
    folded = text.lower()
    if "at)" in folded or "at]" in folded or "at}" in folded or (" dot " in folded and " at " in folded):
        for m in _SPELLED.finditer(text):
            yield m.start(), m.end(), "email"
    for m in _NUMBER.finditer(text):
        digits = sum("0" <= c <= "9" for c in m[0])
        if 12 <= digits <= 19:
            yield m.start(), m.end(), "card"
        if 7 <= digits <= 15:
            yield m.start(), m.end(), "phone"
        if m[0].count(".") == 3:
            yield m.start(), m.end(), "ip"


FEATURES = 22


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    """Format and context of a candidate as numbers."""
    span = text[start:end]
    digits = _only_digits(span)
    groups = re.findall(r"[0-9]+", span)
    sizes = [len(g) for g in groups] or [0]
    before = text[max(0, start - CONTEXT) : start].lower()
    after = text[end : end + CONTEXT].lower()
    near = [any(w in before for w in _WORDS[k]) for k in KINDS]
    quad = len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    return [
        float(KINDS.index(kind)),
        float(len(span)),
        float(len(digits)),
        float(len(groups)),
        float(max(sizes)),
        float(min(sizes)),
        float(max(sizes) - min(sizes)),
        float(len(set(digits))),
        float(sum(c.isalpha() for c in span)),
        float(len({c for c in span if not c.isalnum()})),
        float(12 <= len(digits) <= 19 and luhn(digits)),
        float(quad),
        float(9 <= len(digits) <= 15),
        float(span[:1] in "+("),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        *map(float, near),
        float(any(c in "([{" for c in span)),
        float(_lettered(span)),
    ]


@dataclass
class Detector:
    """Trees and the least probability at which each kind is accepted; without trees nothing is."""

    trees: Boosted | None
    thresholds: dict[str, float]

    def spans(self, text: str) -> tuple[list[tuple[int, int, int, str]], list[tuple[int, int, int, str]]]:
        """Base spans and all spans, as (start, rank of the kind, end, kind)."""
        base = sorted(
            (s, KINDS.index(k), e, k) for s, e, k, fits in rule_matches(text) if fits
        )
        if self.trees is None or not self.thresholds:
            return base, base
        places = [p for p in proposals(text) if p[2] in self.thresholds]
        if not places:
            return base, base
        covered = _cover(text, base)
        places = [p for p in places if not _touches(covered, p[0], p[1])]
        if not places:
            return base, base
        rows = np.array([features(text, *p) for p in places])
        scored = sorted(zip((-self.trees.probability(rows)).tolist(), places))
        added: list[tuple[int, int, int, str]] = []
        for score, (start, end, kind) in scored:
            if -score >= self.thresholds[kind] and not _touches(covered, start, end):
                added.append((start, KINDS.index(kind), end, kind))
                covered[start:end] = bytes([1]) * (end - start)
        return base, sorted(base + added)


def _cover(text: str, spans: list[tuple[int, int, int, str]]) -> bytearray:
    """A mark for each character inside a span, so that a long text with many spans stays linear."""
    covered = bytearray(len(text))
    for start, _, end, _ in spans:
        covered[start:end] = bytes([1]) * (end - start)
    return covered


def _touches(covered: bytearray, start: int, end: int) -> bool:
    return covered.find(1, start, end) >= 0


def _lettered(span: str) -> bool:
    """Whether the last part of a span can end the name of a host."""
    ending = re.split(r"[^A-Za-z0-9-]+", span.rstrip(")]}"))[-1]
    return len(ending) >= 2 and ending.isalpha()


#: Other spellings of an address: what stands for the @ and for each dot of the host.
_SIGNS = ((" (at) ", " (dot) "), ("(at)", "."), (" [at] ", " [dot] "), ("[at]", "[dot]"), (" {at} ", " {dot} "))
_PLAIN_SIGNS = (" at ", " dot ")


def respelled(span: str, kind: str, spoken: bool) -> str:
    """A base match in another spelling of its kind, which one its hash says.

    An address is written in plain words only where a word of its kind is in front (``spoken``).
    """
    pick = zlib.crc32(span.encode())
    if kind == "email":
        signs = _SIGNS + (_PLAIN_SIGNS,) * spoken
        at, dot = signs[pick % len(signs)]
        name, _, host = span.rpartition("@")
        return name + at + host.replace(".", dot)
    if kind == "ip":
        return span.replace(".", (". ", " .", ".")[pick % 3])
    if kind == "card":
        return re.sub(r"[\x20-]", "", span) if pick % 4 == 0 else re.sub(r"[\x20-]", "./_"[pick % 3], span)
    plain = span[1:]
    return plain if pick % 2 else re.sub(r"[\x20.-]+", "-./ "[pick // 2 % 4], plain)


def _placed(text: str, start: int, end: int, kind: str, spelling: str) -> list[float] | None:
    """Features of the candidate that the generators find in a spelling put in place of a span."""
    before, after = text[max(0, start - 2 * CONTEXT) : start], text[end : end + 2 * CONTEXT]
    changed = before + spelling + after
    low, high = len(before), len(before) + len(spelling)
    for s, e, k in proposals(changed):
        if k == kind and s < high and e > low:
            return features(changed, s, e, k)
    return None


def examples(text: str) -> Iterator[tuple[str, bool, list[float]]]:
    """(kind, label, features) of the labelled candidates of a text."""
    rules = list(rule_matches(text))
    for start, end, kind, fits in rules:
        # A few digits are no near miss of a card number.
        if kind == "card" and end - start < 12:
            continue
        span = text[start:end]
        before = text[max(0, start - CONTEXT) : start].lower()
        other = respelled(span, kind, any(w in before for w in _WORDS[kind]))
        if kind != "email":
            wanted = [(other, fits)]
        elif _lettered(span):
            wanted = [(other, True), (re.sub("[A-Za-z]+$", str(len(span)), other), False)]
        else:
            wanted = [(other, False)]
        for spelling, label in wanted:
            row = _placed(text, start, end, kind, spelling)
            if row is not None:
                yield kind, label, row
    taken = {}
    for start, end, kind in proposals(text):
        if kind not in taken:
            taken[kind] = _cover(text, [(s, 0, e, k) for s, e, k, _ in rules if k == kind])
        span, before = text[start:end], text[max(0, start - CONTEXT) : start].lower()
        if _touches(taken[kind], start, end) or any(w in before for w in _WORDS[kind]):
            continue
        # An address in brackets is one, whatever stands in front, unless no host ends so.
        if kind != "email" or not _lettered(span) or not any(c in "([{" for c in span):
            yield kind, False, features(text, start, end, kind)


def labelled(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``(kind, label, features, weight)``: every example and counterexample, copies as a count."""
    bound_batches(docs.sparkSession)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, _, _ in text_chunks(batch, "text"):
                kinds, labels, numbers = [], [], []
                for text in rows.column("text").to_pylist():
                    for kind, fits, row in examples(text or ""):
                        kinds.append(kind)
                        labels.append(int(fits))
                        numbers.append(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds, pa.string()), pa.array(labels, pa.int32()), pa.array(numbers, pa.list_(pa.float64()))],
                    ["kind", "label", "features"],
                )

    found = named(docs, text=text_column).mapInArrow(
        collect, "kind string, label int, features array<double>"
    )
    # Copies meet as a count, so that no task gets those of one example.
    return saved(found.groupBy("kind", "label", "features").agg(F.count("*").alias("weight")), "examples")


def learn(examples: DataFrame, precision: float = PRECISION) -> Detector:
    """Fit trees on all labelled candidates and choose a threshold per kind, by Spark aggregations.

    Every fourth copy of an example is held out for calibration and thresholds: of ``n`` copies,
    ``(n + o) // 4``, where ``o`` (0 to 3) comes from the example's hash. A kind is only added to
    where at least ``LEAST_EVIDENCE`` held-out examples and as many counterexamples back its
    threshold. Examples without both labels give a detector that adds nothing.
    """
    if examples.select("label").distinct().limit(2).count() < 2:
        return Detector(None, {})
    offset = F.pmod(F.xxhash64("kind", "label", "features"), F.lit(4))
    split = examples.withColumn("_held", ((F.col("weight") + offset) / 4).cast("long"))
    trees = fit_table(
        split.select("features", "label", (F.col("weight") - F.col("_held")).alias("weight")), FEATURES
    )
    if trees is None:
        return Detector(None, {})
    model = trees

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(table[:, 0].astype(np.int32)), pa.array(model.margin(table) if len(table) else []),
                 batch.column("label"), batch.column("weight")],
                ["rank", "margin", "label", "weight"],
            )

    held = split.filter("_held > 0").select("features", "label", F.col("_held").alias("weight"))
    scored = held.mapInArrow(margins, "rank int, margin double, label int, weight bigint")
    scored = saved(scored.groupBy("rank", "margin", "label").agg(F.sum("weight").alias("weight")), "examples-held")
    calibrate_table(trees, scored)
    return Detector(trees, _thresholds(scored, trees, precision))


def _thresholds(scored: DataFrame, trees: Boosted, precision: float) -> dict[str, float]:
    """Per kind the least probability at which the held-out examples above it are precise enough.

    Probabilities are sorted over the partitions; each partition learns the counts before it.
    """
    p = 1 / (1 + F.exp(-F.greatest(F.least(F.lit(trees.slope) * F.col("margin") + F.lit(trees.offset), F.lit(40.0)), F.lit(-40.0))))
    sums = scored.groupBy("rank", p.alias("p")).agg(
        F.sum(F.col("label") * F.col("weight")).alias("ones"), F.sum("weight").alias("all")
    )
    ordered = sums.rdd.map(lambda r: ((r["rank"], -r["p"]), (r["ones"], r["all"]))).sortByKey().cache()
    try:
        def totals(index, part):
            seen: dict[int, list[int]] = {}
            for (rank, _), (ones, every) in part:
                got = seen.setdefault(rank, [0, 0])
                got[0] += ones
                got[1] += every
            yield index, seen

        before: dict[tuple[int, int], tuple[int, int]] = {}
        whole: dict[int, list[int]] = {}
        for index, seen in sorted(ordered.mapPartitionsWithIndex(totals).collect()):
            for rank, (ones, every) in seen.items():
                got = whole.setdefault(rank, [0, 0])
                before[index, rank] = tuple(got)
                got[0] += ones
                got[1] += every

        def least(index, part):
            running: dict[int, list[int]] = {}
            best: dict[int, float] = {}
            for (rank, minus_p), (ones, every) in part:
                got = running.setdefault(rank, list(before.get((index, rank), (0, 0))))
                got[0] += ones
                got[1] += every
                if got[0] >= precision * got[1]:
                    best[rank] = -minus_p
            yield best

        least_good: dict[int, float] = {}
        for best in ordered.mapPartitionsWithIndex(least).collect():
            for rank, prob in best.items():
                least_good[rank] = min(prob, least_good.get(rank, prob))
    finally:
        ordered.unpersist()
    thresholds = {}
    for rank, kind in enumerate(KINDS):
        ones, every = whole.get(rank, (0, 0))
        if min(every - ones, ones) < LEAST_EVIDENCE or rank not in least_good:
            continue
        thresholds[kind] = max(0.9, least_good[rank])
    return thresholds


def learn_from(sample: list[tuple[str, int, tuple[float, ...]]], precision: float = PRECISION) -> Detector:
    """:func:`learn` on collected rows ``(kind, label, features)``."""
    rows = sorted(sample)
    labels = np.array([r[1] for r in rows], float)
    if len(set(labels)) < 2:
        return Detector(None, {})
    table = np.array([r[2] for r in rows])
    held = np.arange(len(rows)) % 4 == 3
    trees = fit(table[~held], labels[~held])
    trees.calibrate(table[held], labels[held])
    sure = trees.probability(table[held])
    thresholds = {}
    for rank, kind in enumerate(KINDS):
        mine = table[held][:, 0] == rank
        against = int((1 - labels[held][mine]).sum())
        if min(against, int(mine.sum()) - against) < LEAST_EVIDENCE:
            continue
        order = np.argsort(-sure[mine], kind="stable")
        right = np.cumsum(labels[held][mine][order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(right >= precision)
        if len(good):
            thresholds[kind] = max(0.9, float(sure[mine][order][good[-1]]))
    return Detector(trees, thresholds)


_SPANS = pa.list_(
    pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
)
_SPAN_TYPE = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _cells(spans: list[tuple[int, int, int, str]]) -> list[dict]:
    return [{"start": s, "rank": r, "end": e, "kind": k} for s, r, e, k in spans]


def redacted(text: str, spans: list[tuple[int, int, int, str]]) -> str:
    """The text with each run of overlapping spans replaced by the kind of its first."""
    out, at = [], 0
    for start, _, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def detect(
    docs: DataFrame, detector: Detector, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document ``(id, base, spans, redacted)``: base spans, all spans, and the text without them.

    Positions are code points, ends exclusive. A null text counts as empty and stays null when
    redacted. Each row is read on its own, so repeated rows give repeated results.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(detector)
    texts = named(docs, id=id_column, text=text_column)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            for rows, _, _ in text_chunks(batch, "text"):
                texts = rows.column("text").to_pylist()
                both = [found.spans(t or "") for t in texts]
                clean = [t and redacted(t, s) for t, (_, s) in zip(texts, both)]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("id"),
                        pa.array([_cells(b) for b, _ in both], _SPANS),
                        pa.array([_cells(s) for _, s in both], _SPANS),
                        pa.array(clean, pa.string()),
                    ],
                    ["id", "base", "spans", "redacted"],
                )

    return texts.mapInArrow(
        search, with_id(texts, f"base {_SPAN_TYPE}, spans {_SPAN_TYPE}, redacted string")
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts and hash of the base spans, and all spans as text."""
    counts = [spans_of("base", k) for k in KINDS]
    return found.select(
        F.col("id").alias("doc_id"),
        *counts,
        sha256_text(joined_spans(F.col("base"))).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )
