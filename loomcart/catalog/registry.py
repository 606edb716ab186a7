"""Where queries and the SQL they are checked against are put down side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir.rstrip("/"))

        run.__module__ = build.__module__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return build
    return register


def six(col) -> Column:
    """A double to six decimals, by operations both engines do alike. The limit lies a
    little below one half: means of round numbers often end in an exact half, which the
    order of summation would otherwise tip either way."""
    number = (F.col(col) if isinstance(col, str) else col).cast("double")
    return F.floor(number * F.lit(1e6) + F.lit(0.5001)) / F.lit(1e6)


def six_sql(expr: str) -> str:
    return f"(floor(({expr})::DOUBLE * 1e6 + 0.5001) / 1e6)"


def text_list(col: str) -> Column:
    return F.array_join(F.col(col), "; ").alias(col)
