"""Language identification as the inference of a mixture.

Each language is a distribution of byte trigrams inside words. A document is a mixture
of languages and of noise (all trigrams alike): its proportions come from expectation
maximisation over the likelihoods of its units of a few words. Which languages it holds
is decided by penalised likelihood: starting from all of them, the one with the
smallest share goes as long as the likelihood loses less than the penalty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinicmart.llm import hashing
from clinicmart.llm.common import bound_batches, named, saved, text_chunks, with_id

BINS = 1 << 16
#: Distinct texts per language the trigram counts are taken from: those with the smallest
#: hash. All texts that are predicted are read whole.
TRAIN_DOCS = 5_000
#: Hashes ranked for each text to be learned from, in the mean. They are hashes of distinct texts, so
#: that eight times as many never hold too few; a label with fewer texts has all of them ranked.
SPARE = 8
#: Languages a model may have; more distinct labels are an error, as labels are then no languages.
MAX_LANGUAGES = 500
#: Share of the uniform distribution in each language: a trigram it has never seen has the same
#: probability whether much or little text was learned from.
SMOOTHING = 0.05
#: Probability of any trigram under noise: well below what a language gives to a trigram it
#: has, above what it gives to one it has never seen.
NOISE = 2.0**-19
UNIT_WORDS = 4
PENALTY = 2.0
UNKNOWN = "und"
_SPREAD = np.uint32(2654435761)


def grams(flat: np.ndarray, place: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams around each byte of the words, and where those of each word begin."""
    if not len(place):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    padded = flat.astype(np.uint32)
    code = padded[:-2] << 16 | padded[1:-1] << 8 | padded[2:]
    slot = (code * _SPREAD >> np.uint32(16)).astype(np.int64)
    inside = flat[1:-1] != 0x20
    begins = np.cumsum(end - place) - (end - place)
    return slot[inside], begins


def train(
    docs: DataFrame, lang_column: str = "lang", text_column: str = "text", train_docs: int = TRAIN_DOCS
) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log-probability of each trigram bin under each.

    Learns from rows with a text and a label; others are left out. Reads up to ``train_docs``
    distinct texts of each label, chosen by a hash, so copies of a text count once. Hashes are
    ranked, and only chosen texts are shuffled. Counts are summed per task and then by Spark; the
    driver gets one array per language. No labelled row gives no language.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = named(docs, lang=lang_column, text=text_column).filter("lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    hashes = saved(rows.select("lang", "_hash").distinct(), "hashes")
    # More than enough of the smallest hashes go to the ranking, whatever the size of a label.
    labels = saved(hashes.groupBy("lang").agg(F.count("*").alias("_all")), "labels")
    upto = F.lit(-(2.0**63)) + F.lit(2.0**64) * SPARE * train_docs / F.col("_all")
    near = hashes.join(labels, "lang").filter(F.col("_hash").cast("double") <= upto)
    order = Window.partitionBy("lang").orderBy("_hash")
    first = near.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= train_docs)
    # Stored, so that Spark knows how few they are. All copies of a text have its hash: one is taken.
    first = saved(first.select("lang", "_hash"), "chosen")
    chosen = rows.join(first, ["lang", "_hash"]).groupBy("lang", "_hash").agg(F.min("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part, data, bounds in text_chunks(batch, "text"):
                flat, place, end, first = hashing.normalise(data, bounds, hashing.NO_LETTER)
                slot, begins = grams(flat, place, end)
                cuts = np.append(begins, len(slot))[first]
                for i, lang in enumerate(part.column("lang").to_pylist()):
                    total = totals.setdefault(lang, np.zeros(BINS, np.int64))
                    total += np.bincount(slot[cuts[i] : cuts[i + 1]], minlength=BINS)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(total[at])],
                ["lang", "bin", "n"],
            )

    counts = chosen.select("lang", "text").mapInArrow(count, "lang string, bin int, n bigint")
    per_lang = (
        counts.groupBy("lang", "bin")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list(F.struct("bin", "n")).alias("bins"))
    )
    # At most BINS pairs per language.
    found = per_lang.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels in {lang_column}")
    found.sort(key=lambda r: r["lang"])
    table = np.zeros((BINS, len(found)))
    for k, row in enumerate(found):
        for cell in row["bins"]:
            table[cell["bin"], k] = cell["n"]
    table = np.log((1 - SMOOTHING) * table / np.maximum(table.sum(0), 1) + SMOOTHING / BINS)
    return [r["lang"] for r in found], table.astype(np.float32)


def _sums(rows: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of rows per segment; no segment is empty."""
    return np.add.reduceat(rows, begins, axis=0)


def _maximise(
    like: np.ndarray, begins: np.ndarray, owner: np.ndarray, share: np.ndarray, steps: int
) -> tuple[np.ndarray, np.ndarray]:
    """Expectation maximisation for all documents at once; shares and gain in log-likelihood."""
    size = np.diff(np.append(begins, len(like)))[:, None]
    for _ in range(steps):
        part = like * share[owner]
        part /= part.sum(1, keepdims=True)
        share = _sums(part, begins) / size
    total = np.einsum("wc,wc->w", like, share[owner])
    return share, _sums(np.log(total), begins)


def proportions(
    scores: np.ndarray, begins: np.ndarray, penalty: float = PENALTY, steps: int = 6
) -> np.ndarray:
    """Shares of the components in each document.

    ``scores`` are the log-likelihoods of each unit (rows) under each component;
    ``begins`` says where the units of each document begin.
    """
    units = np.diff(np.append(begins, len(scores)))
    # Only differences between components matter; a floor keeps a share possible for each.
    like = np.exp(np.maximum(scores - scores.max(1, keepdims=True), -60)).astype(np.float64)
    docs, count = len(begins), scores.shape[1]
    owner = np.repeat(np.arange(docs), units)
    share, gain = _maximise(like, begins, owner, np.full((docs, count), 1 / count), steps)
    cost = penalty * np.log(units + 1.0)
    open_ = np.arange(docs)
    for _ in range(count - 1):
        shares = share[open_]
        held = (shares > 0).sum(1) > 1
        open_, shares = open_[held], shares[held]
        if not len(open_):
            break
        least = np.where(shares > 0, shares, np.inf).argmin(1)
        shares[np.arange(len(open_)), least] = 0
        shares /= shares.sum(1, keepdims=True)
        pick = np.repeat(np.isin(np.arange(docs), open_), units)
        sizes = units[open_]
        fewer, lower = _maximise(
            like[pick], np.cumsum(sizes) - sizes, np.repeat(np.arange(len(open_)), sizes), shares, steps
        )
        better = lower + cost[open_] >= gain[open_]
        taken = open_[better]
        share[taken], gain[taken] = fewer[better], lower[better]
        open_ = taken
    return share


def identify(
    docs: DataFrame,
    model: tuple[list[str], np.ndarray],
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per document ``(id, lang_pred, score, noise, langs)``.

    ``lang_pred`` is the language with the largest share, ``score`` that share, ``noise`` the
    share of text that no language explains, ``langs`` the chosen languages and their
    shares, largest first. Where noise holds the whole text, ``langs`` is empty, ``lang_pred`` the
    language under which the text is likeliest and ``score`` its probability among the languages;
    whether such a text is kept is for the caller to decide by ``noise``. A text that is null,
    empty or without a letter is ``und`` with score 0, as is every text when the model has
    no language. Nothing but the text is read; a tie goes to
    the first language in order. Repeated rows give repeated results.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    languages, table = model
    shared = spark.sparkContext.broadcast(table)
    texts = named(docs, id=id_column, text=text_column)
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probability = shared.value
        kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        for batch in batches:
            for rows, data, bounds in text_chunks(batch, "text", limit=1 << 20):
                lang: list[str] = [UNKNOWN] * len(rows)
                score, noise = np.zeros(len(rows)), np.zeros(len(rows))
                chosen: list[list] = [[] for _ in range(len(rows))]
                flat, place, end, first = hashing.normalise(data, bounds, hashing.NO_LETTER)
                live = np.flatnonzero(np.diff(first))
                if len(live) and languages:
                    scores, begins = _unit_scores(probability, flat, place, end, first, live)
                    share = proportions(scores, begins)
                    # Where noise has the whole share, by the likelihood of the languages alone.
                    total = _sums(scores[:, :-1].astype(np.float64), begins)
                    alone = np.exp(total - total.max(1, keepdims=True))
                    alone /= alone.sum(1, keepdims=True)
                    held = share[:, :-1]
                    sure = np.where((held > 0).any(1, keepdims=True), held, alone)
                    best = sure.argmax(1)
                    for i, row, k, chance in zip(live.tolist(), share, best.tolist(), sure.max(1).tolist()):
                        lang[i], score[i] = languages[k], min(1.0, chance)
                        noise[i] = row[-1]
                        chosen[i] = [
                            {"lang": languages[c], "share": float(row[c])}
                            for c in np.argsort(-row[:-1], kind="stable")
                            if row[c] > 0
                        ]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("id"),
                        rows.column("letter"),
                        pa.array(lang),
                        pa.array(score),
                        pa.array(noise),
                        pa.array(chosen, kind),
                    ],
                    ["id", "letter", "lang_pred", "score", "noise", "langs"],
                )

    out = texts.withColumn("letter", letter).mapInArrow(
        predict,
        with_id(
            texts,
            "letter boolean, lang_pred string, score double, noise double, "
            "langs array<struct<lang:string,share:double>>",
        ),
    )
    return out.select(
        "id",
        F.when(F.col("letter"), F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("letter"), F.col("score")).otherwise(0.0).alias("score"),
        "noise",
        "langs",
    )


def _unit_scores(
    probability: np.ndarray,
    flat: np.ndarray,
    place: np.ndarray,
    end: np.ndarray,
    first: np.ndarray,
    live: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihoods of the units of the documents that have words, and their first units."""
    slot, begins = grams(flat, place, end)
    words = np.diff(first)[live]
    units = -(-words // UNIT_WORDS)
    starts = np.cumsum(units) - units
    inside = np.arange(int(units.sum())) - np.repeat(starts, units)
    word = np.repeat(first[live], units) + inside * UNIT_WORDS
    cuts = begins[word]
    scores = np.empty((len(word), probability.shape[1] + 1), np.float32)
    # One language at a time: the trigrams of a batch under all languages would be large.
    for k in range(probability.shape[1]):
        scores[:, k] = np.add.reduceat(probability[slot, k], cuts)
    sizes = np.diff(np.append(cuts, len(slot)))
    scores[:, -1] = sizes * np.log(NOISE)
    return scores, starts
