"""Text cleaning."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinicmart.schema import NO_DATA, NULL_TOKENS

# Every character Unicode counts as white space. Spark's plain trim knows
# only the blank, so the set is passed to btrim.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(col: Column) -> Column:
    """Remove white space of any kind at both ends.

    Trimming against a set of characters costs several times a comparison, and
    most values need none: those that begin and end with a visible ASCII
    character ("!" to "~") are passed through.
    """
    text = col.cast("string")
    last = F.right(text, F.lit(1))
    low, high = F.lit("!"), F.lit("\x7f")
    clean = (text >= low) & (text < high) & (last >= low) & (last < high)
    return F.when(clean, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def normalize_text(col: Column) -> Column:
    """Strip and upper-case; null stays null."""
    return F.upper(strip(col))


def replace_values(col: Column, mapping: Mapping[str, str]) -> Column:
    """Swap whole values; anything not in the map is kept."""
    out = None
    for old, new in mapping.items():
        hit = F.lit(new)
        out = F.when(col == old, hit) if out is None else out.when(col == old, hit)
    return col if out is None else out.otherwise(col)


def fill_default(col: Column, default: str = NO_DATA) -> Column:
    return F.coalesce(col, F.lit(default))


def clean_url(col: Column) -> Column:
    """Strip, and read the texts ``nan`` and ``None`` as missing."""
    text = strip(col)
    return F.when(~text.isin("nan", "None"), text)


def null_tokens(col: Column) -> Column:
    """Turn the usual spellings of "missing" in a text file into null."""
    return F.when(~col.isin(*NULL_TOKENS), col)
