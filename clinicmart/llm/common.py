"""Helpers shared by the operators: stored tables, Arrow batches, span lists.

Every operator names its id and text columns, reads only those, and leaves all
other columns alone, so that further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clinicmart.sources.store import remove_folder, work_root

#: Rows of one Arrow batch sent to Python. Texts may be very long, so a batch holds few.
ROWS_PER_BATCH = 512
#: Bytes of text handled at once inside a batch; one longer text is handled alone.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Keep the batches that go to Python small, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared work folder and read back.

    This cuts the lineage: a lost executor costs the tasks that are running,
    and never what has been written.
    """
    path = f"{work_root(df.sparkSession)}/llm/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table that ``saved`` wrote and that nothing reads any more."""
    files = df.inputFiles()
    if files:
        remove_folder(df.sparkSession, files[0].rsplit("/", 1)[0])


def named(df: DataFrame, **columns: str) -> DataFrame:
    """Only the given columns, under the given names: ``named(df, id="doc_id")``."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def whole_rows(df: DataFrame, text_column: str) -> DataFrame:
    """``(row, text)``: each row as one value, which an operator takes as its id and hands through."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(row.alias("row"), F.col(f"`{text_column}`").alias("text"))


def with_id(texts: DataFrame, rest: str) -> StructType:
    """The schema of a result: the id of the texts, then the given columns."""
    return StructType([texts.schema["id"], *StructType.fromDDL(rest).fields])


def held_out(id_column: Column, buckets: int, bucket: int) -> Column:
    """True for the ids whose crc32 falls in the bucket; a null id is never held out."""
    crc = F.crc32(id_column.cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(buckets)) == bucket, F.lit(False))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` by start and kind, comma-joined, of structs (start, rank, end, kind)."""
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def spans_of(spans: str, kind: str) -> Column:
    """How many of the spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def sha256_text(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def text_chunks(
    batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with the bytes of their texts and the place of each text in them.

    Yields (rows, bytes, bounds): text i is ``bytes[bounds[i]:bounds[i + 1]]``,
    empty where it is null.
    """
    values = batch.column(column).cast(pa.large_binary())
    if values.null_count:
        values = values.fill_null(b"")
    _, offsets, data = values.buffers()
    bounds = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    start = 0
    while start < len(values):
        end = int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1
        end = min(max(end, start + 1), len(values))
        part = bounds[start : end + 1]
        yield batch.slice(start, end - start), data[part[0] : part[-1]], part - part[0]
        start = end
