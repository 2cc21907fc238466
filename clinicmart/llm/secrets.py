"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content. The ledger
holds which blobs each version of each rule has seen, and what it found. A scan

1. reduces the given versions to distinct blobs (one per task before the shuffle, so
   a text with very many copies costs no more than any other),
2. takes the blob and rule-version pairs the ledger has not seen,
3. searches those texts and appends pairs and findings to the ledger,
4. joins the findings of the asked rule versions back to all paths.

Positions come from the text between the matches: a match starts after all pieces
up to it and all matches before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinicmart.llm.common import joined_spans, sha256_text, spans_of


@dataclass(frozen=True)
class Rule:
    """A pattern of Java's regular expressions, and the least length of one of its groups."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base patterns. ``access`` and ``hex`` state their least length in the
#: pattern: a run is matched as a whole or not at all, so nothing else can match inside it.
RULES = (
    Rule(
        "assign",
        1,
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=12,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
)

_SCANNED = "blob string, rules array<string>"
_FOUND = "blob string, rule string, kind string, start bigint, `end` bigint"


class BlobLedger:
    """Two Parquet tables below a folder that all executors reach.

    Each scan appends one folder to either table, findings first. A scan that dies in
    between leaves findings of pairs that are not marked as seen; they are found
    again and read once.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        for name, schema in (("scanned", _SCANNED), ("found", _FOUND)):
            path = f"{self.root}/{name}"
            # An empty part makes a new ledger readable.
            spark.createDataFrame([], schema).write.mode("append").parquet(path)

    def scanned(self) -> DataFrame:
        return self.spark.read.schema(_SCANNED).parquet(f"{self.root}/scanned")

    def found(self) -> DataFrame:
        return self.spark.read.schema(_FOUND).parquet(f"{self.root}/found").distinct()

    def append(self, name: str, rows: DataFrame) -> DataFrame:
        """Write under a folder of its own first, so that a failed try leaves nothing half read."""
        own = f"{self.root}/runs/{uuid4().hex}-{name}"
        rows.write.parquet(own)
        written = self.spark.read.parquet(own)
        written.write.mode("append").parquet(f"{self.root}/{name}")
        return written


def _matches(text: Column, rule: Rule) -> Column:
    """(piece, match, fits) of each match: lengths in code points of the text before and of it."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    sized = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    pieces = F.split(text, rule.pattern, -1)
    cells = F.transform(
        F.arrays_zip(
            F.slice(pieces, 1, F.size(whole)).alias("piece"),
            whole.alias("match"),
            sized.alias("sized"),
        ),
        lambda c: F.struct(
            F.char_length(c["piece"]).cast("bigint").alias("piece"),
            F.char_length(c["match"]).cast("bigint").alias("match"),
            (F.char_length(c["sized"]) >= rule.least).alias("fits"),
        ),
    )
    # Most texts have no match at all; a plain search is cheaper than taking them apart.
    return F.when(text.rlike(rule.pattern), cells)


def find(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(blob, rule, kind, start, end)`` of the texts, for the rules each row asks for."""
    cells = F.array(
        *[
            F.struct(
                F.lit(r.key).alias("rule"),
                F.lit(r.kind).alias("kind"),
                F.when(F.array_contains("rules", r.key), _matches(F.col("text"), r)).alias("cells"),
            )
            for r in rules
        ]
    )
    per_rule = blobs.select("blob", F.inline(cells)).filter(F.size("cells") > 0)
    each = per_rule.select("blob", "rule", "kind", F.posexplode("cells").alias("place", "cell"))
    upto = Window.partitionBy("blob", "rule").orderBy("place")
    end = F.sum(F.col("cell.piece") + F.col("cell.match")).over(upto)
    return (
        each.withColumn("end", end)
        .filter("cell.fits")
        .select("blob", "rule", "kind", (F.col("end") - F.col("cell.match")).alias("start"), "end")
    )


def scan(
    versions: DataFrame,
    ledger: BlobLedger,
    path_columns: Sequence[str] = ("doc_id",),
    text_column: str = "text",
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """Findings of all given versions: ``(path columns, blob, spans)``.

    ``spans`` are structs (start, rank, end, kind); rank is the place of the rule. Only
    pairs of blob and rule version that the ledger lacks are searched. A null text
    counts as empty. Repeated rows are one blob and give a row each; null path values stay
    null. Path columns may have any name.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    keys = F.array(*[F.lit(r.key) for r in rules])
    blobs = versions.select(sha256_text(text).alias("blob"), text.alias("text"))
    blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    seen = ledger.scanned().groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_set("rules"))).alias("seen")
    )
    pending = (
        blobs.join(seen, "blob", "left")
        .withColumn("rules", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>"))))
        .filter(F.size("rules") > 0)
    )
    ledger.append("found", find(pending, rules))
    unseen = versions.select(sha256_text(text).alias("blob")).distinct().withColumn("rules", keys)
    known = seen.withColumnRenamed("blob", "_blob")
    fresh = unseen.join(
        known, (F.col("blob") == F.col("_blob")) & (F.size(F.array_except("rules", "seen")) == 0), "left_anti"
    )
    ledger.append("scanned", fresh)

    rank = reduce(
        lambda out, x: out.when(F.col("rule") == x[1].key, F.lit(x[0])),
        list(enumerate(rules))[1:],
        F.when(F.col("rule") == rules[0].key, F.lit(0)),
    )
    spans = (
        ledger.found()
        .filter(F.col("rule").isin([r.key for r in rules]))
        .groupBy(F.col("blob").alias("_blob"))
        .agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("spans"))
    )
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    paths = versions.select(*[F.col(f"`{c}`") for c in path_columns], sha256_text(text).alias("blob"))
    return paths.join(spans, F.col("blob") == F.col("_blob"), "left").select(
        *[F.col(f"`{c}`") for c in path_columns], "blob", F.coalesce("spans", empty).alias("spans")
    )


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts, hash and text of the spans, per path."""
    base = joined_spans(F.col("spans"))
    return found.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        *[spans_of("spans", r.kind) for r in RULES],
        sha256_text(base).alias("base_sha256"),
        base.alias("spans"),
    )
