"""Joins against key tables whose size is not known in advance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when a count shows it has at most this many rows.
BROADCAST_ROWS = 500_000
# Otherwise rows are spread over this many sub-keys per key.
SALTS = 16


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``limit`` rows; counts no further than that."""
    return df.limit(limit + 1).count() <= limit


def lookup_join(df: DataFrame, keys: DataFrame, on: list[str], spread_by: list[str],
                limit: int = BROADCAST_ROWS) -> DataFrame:
    """Left join of many rows with a table that has one row per key.

    A small key table is broadcast. A large one is joined on (key, salt): rows of a hot
    key go to ``SALTS`` partitions instead of one, at the price of that many copies of
    the (narrow) key table. AQE may split further. The copies are never broadcast: Spark
    estimates them by the size of the key table, without the factor ``SALTS``.
    """
    if fits_broadcast(keys, limit):
        return df.join(F.broadcast(keys), on, "left")
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int")
    salted = df.withColumn("_salt", salt)
    copies = keys.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return salted.join(copies.hint("merge"), [*on, "_salt"], "left").drop("_salt")
