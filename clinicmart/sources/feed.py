"""JSON feeds of nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from clinicmart.sources.landing import INGEST_ORDER, listed_files, number_files


def read_feed(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """Records of a feed, one row each, nested fields flattened to dotted names.

    A document is ``{"body": {"data": [...]}}``, ``{"data": [...]}`` or a bare
    list; all documents under one path share a shape. Each document is read by
    one task. Give ``schema`` to skip the pass that infers it. The column
    ``_ingest_order`` sorts like the records in their documents.
    """
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    raw = (reader.schema(schema) if schema else reader).json(path)
    names = raw.columns
    scan = raw.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.monotonically_increasing_id().alias("_row"),
    )
    scan = number_files(scan, listed_files(spark, path))
    items = _items(raw.schema)
    if items is not None:
        records = scan.select("_file", "_row", F.posexplode(items).alias("_pos", "_record"))
        order = F.struct(F.col("_file").alias("file"), F.col("_row").alias("row"), "_pos")
        listed = records.select("_record.*", order.alias(INGEST_ORDER))
    else:
        _require_lists(spark, path)
        order = F.struct(F.col("_file").alias("file"), F.col("_row").alias("row"))
        listed = scan.select(*[F.col(f"`{c}`") for c in names], order.alias(INGEST_ORDER))
    return flatten(listed, keep=(INGEST_ORDER,))


def flatten(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Struct columns to one column per leaf, named by the dotted path."""
    out: list[Column] = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name in keep:
            out.append(column)
        else:
            out.extend(_leaves(column, field.name, field.dataType))
    return df.select(*out)


def parse_records(df: DataFrame, column: str, schema: str, prefix: str) -> DataFrame:
    """Parse a column of JSON text with a stated schema and flatten it.

    Leaves are named ``prefix.path``. Text that is not valid JSON gives nulls.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    return flatten(df.select(*others, F.from_json(F.col(column), schema).alias(prefix)))


def _leaves(column: Column, path: str, dtype: DataType) -> list[Column]:
    if not isinstance(dtype, StructType):
        return [column.alias(path)]
    found: list[Column] = []
    for field in dtype.fields:
        found.extend(_leaves(column.getField(field.name), f"{path}.{field.name}", field.dataType))
    return found


def _is_record_list(dtype: DataType | None) -> bool:
    return isinstance(dtype, ArrayType) and isinstance(dtype.elementType, StructType)


def _items(schema: StructType) -> Column | None:
    """The list of records inside a document, or None for a bare list."""
    top = {f.name: f.dataType for f in schema.fields}
    body = top.get("body")
    if isinstance(body, StructType) and "data" in body.names:
        if not _is_record_list(body["data"].dataType):
            raise ValueError("feed: body.data is not a list of records")
        return F.col("body").getField("data")
    if "data" in top:
        if not _is_record_list(top["data"]):
            raise ValueError("feed: data is not a list of records")
        return F.col("data")
    return None


def _require_lists(spark: SparkSession, path: str) -> None:
    """A reader shows a bare list and a lone object alike; only the list is a feed."""
    text = spark.read.text(path, wholetext=True)
    first = F.substring(F.regexp_replace("value", r"^[\s\x{FEFF}]+", ""), 1, 1)
    if not text.filter(first != "[").isEmpty():
        raise ValueError("feed: document is neither a list nor has a data list")
