"""Text helpers that follow Python's string rules inside Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes.
_SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# A finite decimal number as Python's float() reads it, underscores already removed.
_FLOAT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(_SPACES))


def bare_number(text: Column) -> Column:
    """Numeric text without the spaces and digit separators a number may have."""
    bare = strip(text)
    return F.when(text.contains("_"), F.regexp_replace(bare, r"(?<=\d)_(?=\d)", "")).otherwise(bare)


def parse_number(bare: Column) -> Column:
    """``bare_number`` text to a double: '42.5', '1e3' and '.5' are numbers."""
    return F.when(bare.rlike(_FLOAT), bare.try_cast("double"))


def finite(number: Column) -> Column:
    """Null for NaN and infinities; they would spoil every later mean."""
    # NaN is larger than any number here.
    return F.when((number > F.lit(float("-inf"))) & (number < F.lit(float("inf"))), number)


def iso_text(ts: Column) -> Column:
    """A timestamp as ISO-8601 UTC text; the fraction is left out when it is zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    exact = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.date_trunc("second", ts) == ts, whole).otherwise(exact)
