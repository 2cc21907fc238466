"""Landed CSV files."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clinicmart.functions.text import null_tokens
from clinicmart.sources.store import work_root

INGEST_ORDER = "_ingest_order"
#: First lines read at the same time; each is a small request to the file system.
_READERS = 32


class HeaderError(ValueError):
    """A landed file has a header that does not fit the others."""


def natural_key(path: str) -> list:
    """Sorts names with numbers as people do: ``part-99999`` before ``part-100000``."""
    return [(int(p), "") if p.isdigit() else (-1, p) for p in re.split(r"(\d+)", path) if p]


def listed_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The files a read of the path opens, in natural order."""
    return sorted(spark.read.format("text").load(path).inputFiles(), key=natural_key)


def number_files(df: DataFrame, files: Sequence[str], name: str = "_file") -> DataFrame:
    """Add the place of each row's file in the list. ``df`` has the path as ``name``.

    The list is a stored table of two columns, so Spark knows its size and broadcasts it where it
    is small, which it is for some hundred thousand files. A file that is not in it, because it
    was landed while the run went on, raises.
    """
    spark = df.sparkSession
    place = f"{work_root(spark)}/files/{uuid4().hex}"
    # A path without a host is spelled with one slash or with three.
    rows = spark.createDataFrame(list(enumerate(files)), "_number int, _path string").withColumn(
        "_path", _one_spelling(F.col("_path"))
    )
    rows.coalesce(1).write.parquet(place)
    numbers = spark.read.parquet(place)
    unknown = F.raise_error(F.concat(F.lit("file landed during the run: "), F.col(name)))
    number = F.coalesce("_number", unknown.cast("int"))
    joined = df.join(numbers, _one_spelling(F.col(name)) == F.col("_path"), "left")
    return joined.withColumn(name, number).drop("_number", "_path")


def _one_spelling(path: Column) -> Column:
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


def with_file_order(df: DataFrame, files: Sequence[str], name: str = INGEST_ORDER) -> DataFrame:
    """Add a column that sorts like the rows in their files, files in the order of the list.

    File, then block within the file, then row within the block, as three numbers. Only valid
    directly on a file scan. The running id grows within a block, and rows of
    different blocks are told apart by the first two parts, so the order does
    not depend on how Spark packs files into tasks.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    order = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_row").alias("row"))
    return number_files(placed, files).withColumn(name, order).drop("_file", "_block", "_row")


def read_headers(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Header -> files that have it, in the order of the files. Only first lines are read.

    Empty files are left out. A header is one line.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(file: str) -> str | None:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream = path.getFileSystem(conf).open(path)
        codec = codecs.getCodec(path)
        if codec is not None:
            stream = codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        try:
            return reader.readLine()
        finally:
            reader.close()

    with ThreadPoolExecutor(_READERS) as pool:
        lines = list(pool.map(first_line, files))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        if line is not None and line.lstrip("﻿"):
            header = tuple(next(csv.reader([line.lstrip("﻿")])))
            found.setdefault(header, []).append(file)
    return found


def _fitting(found: dict[tuple[str, ...], list[str]], columns: Sequence[str] | None) -> list[str]:
    """The columns of all headers; any header with other or repeated names is refused."""
    expected = list(columns) if columns is not None else list(next(iter(found), ()))
    for header, files in found.items():
        if len(set(header)) < len(header) or set(header) != set(expected):
            raise HeaderError(f"{files[0]} has the header {list(header)}, expected the columns {expected}")
    return expected


def read_csv(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    file_order: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Read CSV files by their headers as text columns; spellings of "missing" become null.

    Files may have their columns in different orders: those with one header are read together, and
    columns are matched by name. All must have the same names, those of ``columns`` where given and
    else of the first file; a file with others raises, and so does a row with too few
    or too many values. A byte order mark is skipped. Quoted line breaks are allowed in values,
    which makes each file one task: land many files of moderate size, or pass
    ``multi_line=False`` when no value holds a line break, so that large files
    are split. ``file_order`` adds the order of arrival.
    """
    files = listed_files(spark, path)
    found = read_headers(spark, files)
    names = _fitting(found, columns)
    reader = (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        # Every value of a row is read, so that a short row is noticed whichever columns are used.
        .option("columnPruning", False)
    )
    parts = []
    for header, group in found.items():
        schema = StructType([StructField(c, StringType()) for c in header])
        # One header is the usual case, and its path may be a folder of any number of files.
        raw = reader.schema(schema).csv(path if len(found) == 1 else group)
        ordered = [F.col(f"`{c}`") for c in names]
        parts.append((with_file_order(raw, files) if file_order else raw).select(*ordered, *_order(file_order)))
    if not parts:
        schema = StructType([StructField(c, StringType()) for c in names])
        parts = [spark.createDataFrame([], schema)]
    df = reduce(DataFrame.unionByName, parts)
    return df.withColumns({c: null_tokens(F.col(f"`{c}`")) for c in names}) if names else df


def _order(file_order: bool) -> list[Column]:
    return [F.col(INGEST_ORDER)] if file_order else []


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    """Write with header, replacing what is there or beside it."""
    (
        df.write.mode("append" if append else "overwrite")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
