"""A corpus from raw documents to a weighted mixture, in five stages.

Each stage reads the table the one before it wrote, decides on all of its rows and
returns documents with the columns they came with; the last adds the number of a copy and
its place in the shuffled order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinicmart.llm import decontaminate, language, mixing, near_dups, personal
from clinicmart.llm.common import discard, saved, table, whole_rows

#: Share of a text that no language explains, above which it goes.
MOST_NOISE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without texts that are null, empty, without a letter, or mostly in no known language.

    The model learns from the labelled documents. Where no document has a label, there is no
    language to compare with and only texts without a letter go.
    """
    model = language.train(docs)
    found = language.identify(whole_rows(docs, "text"), model, "row")
    if not model[0]:
        lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
        return docs.filter(lettered)
    kept = found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("noise") <= MOST_NOISE))
    return kept.select("id.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; of rows that repeat an id, one.

    Rows without an id cannot be grouped and stay.
    """
    found = near_dups.near_duplicates(docs)
    kept = found.filter("kept AND id IS NOT NULL").select("id").distinct()
    rows = whole_rows(docs, "text").withColumn("id", F.col("row.doc_id").cast("bigint"))
    first = Window.partitionBy("id").orderBy(F.xxhash64("text"), F.xxhash64("row"))
    one_each = (
        rows.filter("id IS NOT NULL")
        .join(kept, "id", "left_semi")
        .withColumn("rank", F.row_number().over(first))
        .filter("rank = 1")
    )
    return one_each.select("row").unionByName(rows.filter("id IS NULL").select("row")).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of the benchmark."""
    benchmark = table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(whole_rows(docs, "text"), benchmark, id_column="row")
    return found.filter(~F.col("contaminated")).select("id.*")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; ``n_chars`` follows the text."""
    detector = personal.learn(personal.labelled(docs))
    # The text goes to the detector once: where nothing is found, the redacted text is the text.
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    found = personal.detect(docs.select(rest.alias("row"), "text"), detector, "row")
    changed = F.size("spans") > 0
    columns = {c: F.col("redacted") if c == "text" else F.col("id").getField(c) for c in docs.columns}
    if "n_chars" in columns:
        length = F.char_length("redacted").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(changed, length).otherwise(columns["n_chars"])
    return found.select(*[value.alias(name) for name, value in columns.items()])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: sources by the square root of their size, in a global random order."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", redact_personal_data),
    ("mix", mix_sources),
]

#: SQL has no trained trees and no mixture inference; the stages are tested on their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of the documents of a folder."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, before = saved(stage(spark, docs, sf_dir), name), last
        # The table a stage has read is not needed once its own is stored.
        if before is not None:
            discard(before)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
