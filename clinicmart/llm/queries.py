"""The queries of this package over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinicmart.llm import (
    decontaminate,
    language,
    lm,
    merkle,
    mixing,
    near_dups,
    personal,
    runs,
    secrets,
    substrings,
    suffixes,
    token_counts,
    vectors,
)
from clinicmart.llm.common import held_out, table
from clinicmart.llm.oracles import ORACLES
from clinicmart.sources.store import work_root


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    model = language.train(docs.filter(~out))
    found = language.identify(docs, model)
    return found.select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id"), 4, 2).alias("held_out"),
        "lang_pred",
        "score",
        "noise",
        F.size("langs").cast("bigint").alias("n_langs"),
    )


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents mixed to shares by the square root of the size of each source."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through a ledger that starts empty."""
    ledger = secrets.BlobLedger(spark, f"{work_root(spark)}/ledger-{uuid4().hex}")
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents"), ledger))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 35-word windows that also start elsewhere."""
    return substrings.digest(substrings.repeated(table(spark, sf_dir, "documents")))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.withColumnRenamed("id", "doc_id")


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under models of those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = lm.score(docs, docs.filter(~held_out(F.col("doc_id"), 7, 2)))
    return found.select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id"), 7, 2).alias("held_out"),
        *[c for c in found.columns if c != "id"],
    )


def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors with a cosine of at least 0.9."""
    found = vectors.near_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents")
    detector = personal.learn(personal.labelled(docs))
    return personal.digest(personal.detect(docs, detector))


def op9_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents."""
    found = near_dups.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def op10_tokens(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Token counts of every document; ``model`` is the path of the vocabulary file."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), model)
    return counted.withColumnRenamed("id", "doc_id")


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document; every tenth id reads with a repeated tail."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    seed = F.when(h % 10 == 0, F.floor(h / 10))
    return runs.digest(runs.periodic_runs(table(spark, sf_dir, "documents"), tail_seed=seed))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A proof for every document, folded with the text as it is or, for half of the ids, tampered."""
    docs = table(spark, sf_dir, "documents")
    before = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars")]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = docs.select(
        "doc_id",
        "source",
        merkle.leaf(*before, F.col("text")).alias("leaf"),
        merkle.leaf(*before, tampered).alias("claimed"),
    )
    manifest = merkle.build(rows, "source", ["doc_id"], "leaf", keep=["doc_id", "claimed"])
    found = merkle.prove(manifest)
    folded = merkle.fold(F.col("item.claimed"), F.col("proof"))
    return found.select(
        F.col("item.doc_id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


def op13_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that also start in one with a smaller id."""
    return suffixes.digest(suffixes.repeated_bytes(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language,
        op2_mix,
        op3_secrets,
        op4_substrings,
        op5_decontaminate,
        op6_lm,
        op7_vectors,
        op8_pii,
        op9_near_dups,
        op10_tokens,
        op11_runs,
        op12_manifest,
        op13_suffixes,
    )
}


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
