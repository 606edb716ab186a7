"""Reference checks: rows whose key is unknown to a dimension."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcart.functions.joins import BROADCAST_ROWS, lookup_join


def _flag_known(df: DataFrame, known: DataFrame, column: str, flag: str, spread_by: list[str],
                limit: int) -> DataFrame:
    keys = known.select(F.col(known.columns[0]).cast("string").alias(column)).filter(
        F.col(column).isNotNull()).distinct().withColumn(flag, F.lit(True))
    return lookup_join(df, keys, [column], spread_by, limit)


def check_references(df: DataFrame, users: DataFrame | None = None,
                     sessions: DataFrame | None = None, spread_by: list[str] | None = None,
                     limit: int = BROADCAST_ROWS) -> DataFrame:
    """Adds ``violations``: user and session ids that the key tables do not hold.

    A null or empty id is no violation, and an empty key table switches its check off.
    The first column of each key table is its key.
    """
    messages = []
    result = df
    for column, known in (("user_id", users), ("session_id", sessions)):
        if known is None or known.isEmpty():
            continue
        flag = f"_known_{column}"
        result = _flag_known(result, known, column, flag, spread_by or df.columns[:1], limit)
        unknown = F.col(flag).isNull() & (F.col(column) != "")
        messages.append((flag, F.when(unknown, F.concat(
            F.lit(f"Unknown {column}: '"), F.col(column), F.lit("'")))))
    texts = [m for _, m in messages]
    none = F.array().cast("array<string>")
    result = result.withColumn("violations", F.array_compact(F.array(*texts)) if texts else none)
    return result.drop(*[flag for flag, _ in messages]).select(*df.columns, "violations")


def foreign_key_violations(fact: DataFrame, references: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per foreign key: how many rows and how many distinct keys have no parent.

    The fact is reduced to one row per key value first, so the anti join has no hot
    key. A null key is no violation.
    """
    reports = []
    for column, (parent, parent_key) in references.items():
        used = (fact.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key"))
                .agg(F.count(F.lit(1)).alias("_rows")))
        orphans = used.join(parent.select(F.col(parent_key).alias("_key")), "_key", "left_anti")
        reports.append(orphans.agg(
            F.lit(column).alias("foreign_key"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("violating_rows"),
            F.count(F.lit(1)).alias("violating_keys"),
        ).select("foreign_key", "violating_rows", "violating_keys"))
    return reduce(DataFrame.unionByName, reports)
