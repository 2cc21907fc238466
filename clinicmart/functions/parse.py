"""Lenient parsing: what cannot be read becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType

from clinicmart.functions.text import strip
from clinicmart.schema import PLAIN_YEARS, YEAR_CODE_OFFSET

# Java also reads "1d" or "0x1p3" as numbers; a data file never means that.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def lenient_timestamp(col: Column, *formats: str) -> Column:
    """Timestamp without zone. ISO text first, then the given patterns in order."""
    parsed = [col.try_cast("timestamp_ntz")]
    parsed += [F.try_to_timestamp(col, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*parsed) if formats else parsed[0]


def unread(col: Column, *formats: str) -> Column:
    """Whether there is something that is no timestamp in any of the formats."""
    text = strip(col.cast("string"))
    return (F.coalesce(text, F.lit("")) != "") & lenient_timestamp(col, *formats).isNull()


def lenient_number(col: Column, dtype: DataType) -> Column:
    """Double, or null. ``dtype`` is the type of ``col`` in its frame."""
    if isinstance(dtype, StringType):
        text = strip(col)
        col = F.when(text.rlike(_NUMBER), text)
    number = col.try_cast("double")
    return F.when(~F.isnan(number), number)


def lenient_integer(col: Column, dtype: DataType) -> Column:
    """Bigint, or null; a number with a fraction is truncated."""
    if isinstance(dtype, IntegralType):
        return col.cast("bigint")
    return lenient_number(col, dtype).try_cast("bigint")


def decode_year(col: Column, dtype: DataType) -> Column:
    """Calendar year from a plain year or from a provider's member code.

    A number is truncated; a text must be a whole number, otherwise null.
    """
    if isinstance(dtype, StringType):
        col = strip(col)
    whole = col.try_cast("bigint")
    low, high = PLAIN_YEARS
    return F.when(whole.between(low, high), whole).otherwise(whole - F.lit(YEAR_CODE_OFFSET))
