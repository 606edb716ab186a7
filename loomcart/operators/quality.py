"""Checks on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DataQualityError(Exception):
    """A table does not have the shape its consumer needs."""


def require_columns(df: DataFrame, required: list[str]) -> None:
    """Raise when a column is missing; looks at the schema only."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise DataQualityError(f"Missing columns: {missing}")


def column_report(df: DataFrame, required: list[str]) -> DataFrame:
    """(column_name, is_present, row_count, null_count) per required column.

    One pass over the table. NaN counts as null; a missing column has no null count.
    """
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def nulls(name):
        if name not in df.columns:
            return F.lit(None).cast("bigint")
        empty = F.col(name).isNull()
        return F.count_if(empty | F.isnan(name) if name in floats else empty)

    counted = df.agg(F.count(F.lit(1)).alias("_rows"),
                     *[nulls(c).alias(f"_c{i}") for i, c in enumerate(required)])
    lines = [F.struct(F.lit(c).alias("column_name"), F.lit(c in df.columns).alias("is_present"),
                      F.col("_rows").alias("row_count"), F.col(f"_c{i}").alias("null_count"))
             for i, c in enumerate(required)]
    return counted.select(F.inline(F.array(*lines)))


def validate_table(df: DataFrame, required: list[str]) -> dict[str, int]:
    """Null count per required column; raises when one is missing."""
    require_columns(df, required)
    return {r["column_name"]: r["null_count"] for r in column_report(df, required).collect()}


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once; empty when ``keys`` is a key."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_count"))
            .filter(F.col("key_count") > 1))


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    if not duplicate_keys(df, keys).isEmpty():
        raise DataQualityError(f"Not unique: {keys}")
