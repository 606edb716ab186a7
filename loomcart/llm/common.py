"""What several operators need: scratch tables, word patterns, checked broadcasts."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.session import remove_path, scratch_path

# Rows of a few dozen bytes each: well below a hundred megabytes in memory.
BROADCAST_ROWS = 500_000

WHITE = "[\\x20\\x09-\\x0D]"
NOT_WHITE = "[^\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    """The public byte-level BPE; TOKENIZER_FILE names another file."""
    named = os.environ.get("TOKENIZER_FILE")
    if named:
        return named
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Paths of the tables that ``stored`` makes, while somebody frees them.
_made: list[list[str]] = []


@contextmanager
def scratch_freed(spark: SparkSession):
    """Remove the tables stored within. What is returned out of it must not read them."""
    _made.append([])
    try:
        yield
    finally:
        for path in _made.pop():
            remove_path(spark, path)


def give_back(run):
    """A function over Arrow batches whose worker gives its memory back to the system when
    its task is done. Idle workers stay, and later stages need the room."""
    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            import pyarrow as pa

            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:  # another C library
                pass

    return wrapped


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` below the shared folder, or to ``path``, and read it back.

    Cuts lineage: later reads survive lost executors and prune columns.
    """
    spark = df.sparkSession
    if path is None:
        path = scratch_path(spark, name)
        if _made:
            _made[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checked_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a narrow table of ``rows`` counted rows if that is safe, else leave the
    join to shuffle. Both ways give the same rows."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it is.

    ``lower`` is quick but lowers other letters too, so texts with such letters go
    through ``translate``.
    """
    return F.when(text.rlike("[\\p{IsUppercase}\\p{Lt}&&[^A-Z]]"),
                  F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), 0)


def text_hash(text: Column) -> Column:
    """Tells the texts of rows apart that share a doc_id; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))
