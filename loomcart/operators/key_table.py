"""Registered keys: reference tables that grow while streams run.

Users and sessions are registered as they become known. A table of keys is a Parquet
folder with a key index (``operators.key_index``): registering adds the keys that are not
there yet, and a check looks the distinct keys of a batch up in the index, so the Bloom
filters stand ahead of any join and the table itself is not read. Every check sees what was
registered before it began, also within a running stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.functions.joins import lookup_join
from loomcart.operators.key_index import KeyIndex
from loomcart.operators.sinks import insert_ignore
from loomcart.session import cut_lineage, folder_names

KEY = "key"


class KeyTable:
    """Known keys of one kind, such as user ids, below ``path``. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def register(self, keys: DataFrame) -> int:
        """Add the first column of ``keys``; returns how many were new. Null and empty ids
        are none; a repeated call adds nothing."""
        named = keys.select(F.col(keys.columns[0]).cast("string").alias(KEY)).filter(F.col(KEY) != "")
        return insert_ignore(named.distinct(), self.path, key=KEY, order_by=[KEY])["inserted"]

    def is_empty(self) -> bool:
        return not any(not n.startswith(("_", ".")) for n in folder_names(self.spark, self.path))

    def known(self, keys: DataFrame) -> DataFrame:
        """Those of ``keys`` (distinct, not null, first column) that are registered."""
        return KeyIndex(self.spark, self.path, KEY).lookup(keys.select(F.col(keys.columns[0]).alias(KEY))).keys


def unknown_keys(rows: DataFrame, tables: dict[str, KeyTable], spread_by: list[str]) -> DataFrame:
    """Adds ``violations``: the ids in ``rows`` that the key table of their column does not
    hold, in the order of ``tables``.

    As ``integrity.check_references``: null and empty ids are no violations, and a table
    without keys switches its check off. ``rows`` should be materialised, they are read
    once for each table. Only distinct ids meet the index; the rows are joined with the
    unknown ones, which are few as a rule and salted if not.
    """
    result, texts = rows, []
    for column, table in tables.items():
        if table.is_empty():
            continue
        ids = rows.filter(F.col(column) != "").select(F.col(column).cast("string").alias(KEY)).distinct()
        ids = cut_lineage(ids)
        strange = cut_lineage(ids.join(table.known(ids), KEY, "left_anti"))
        flag = f"_unknown_{column}"
        marked = strange.select(F.col(KEY).alias(column), F.lit(True).alias(flag))
        result = lookup_join(result, marked, [column], spread_by)
        texts.append((flag, _text(column, F.col(flag))))
    found = F.array_compact(F.array(*[t for _, t in texts])) if texts else F.array().cast("array<string>")
    return result.withColumn("violations", found).select(*rows.columns, "violations")


def _text(column: str, unknown: Column) -> Column:
    return F.when(unknown, F.concat(F.lit(f"Unknown {column}: '"), F.col(column), F.lit("'")))


def reference_check(tables: dict[str, KeyTable], spread_by: list[str]) -> Callable[[DataFrame], DataFrame]:
    """``unknown_keys`` as a step for a micro-batch: the tables are read anew every time."""
    return lambda rows: unknown_keys(rows, tables, spread_by)
