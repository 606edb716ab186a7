"""Exact dedup through a minimal perfect hash over known digests.

A text's digest is the SHA-256 of its UTF-8 bytes without ASCII white space. Known
digests are cut into shards by their first bytes; each shard gets a minimal perfect
hash (levels of bit sets, a key sits at the first level where nothing collides with it)
whose slots hold the full digest and the locator of the row that stays. A lookup
computes the slot and compares all 32 bytes, so a digest that is not known can not be
taken for one that is; such rows are grouped among themselves.

Without a history of its own a table is cut in two: the digests of the first part are the
history, the rows of the second are looked up in it. What they bring to known digests is
merged into the slots' locators, and every row of a known digest gets its winner from there.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcart.llm.common import stored

SHARD_KEYS = 4096  # digests in a shard, and rows that are looked up in one, on average
LEAST_SHARDS = 64
HOT_ROWS = 1000  # rows of one digest that a lookup group gets at least before it is split
HOT_DIGESTS = 100_000  # at most so many digests are split, which bounds their broadcast
GAMMA = 2.0  # bits for each key and level
LEVELS = 64
_WHITE = b" \t\n\x0b\x0c\r"

_DIGESTS = "doc_id long, digest binary, n_chars long, place long"
_INDEX = "shard long, salt int, sizes binary, bits binary, digests binary, ids binary, counts binary"
_FOUND = "doc_id long, digest binary, n_chars long, place long, member boolean, keep_id long, group_size long"


def digest_rows(docs: DataFrame) -> DataFrame:
    """doc_id, digest, code points of the original text, and the digest's first bytes as
    a number, for every row. A null text counts as empty."""

    def digest(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            digests = [hashlib.sha256(t.as_py().translate(None, _WHITE)).digest() for t in texts]
            places = [int.from_bytes(d[:8], "big") >> 1 for d in digests]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()),
                 pc.cast(pc.utf8_length(batch.column(1)), pa.int64()), pa.array(places, pa.int64())],
                names=["doc_id", "digest", "n_chars", "place"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce("text", F.lit("")).alias("text"))
    return narrow.mapInArrow(digest, _DIGESTS)


def _winners(by_length: DataFrame) -> DataFrame:
    """digest, place, keep_id, group_size and n_chars from rows (digest, place, n_chars,
    doc_id, n): of the longest texts the smallest doc_id."""
    each = by_length.groupBy("digest", "place", "n_chars").agg(F.min("doc_id").alias("doc_id"), F.sum("n").alias("n"))
    return each.groupBy("digest", "place").agg(
        F.max_by("doc_id", "n_chars").alias("keep_id"), F.sum("n").alias("group_size"), F.max("n_chars").alias("n_chars"))


def classes(rows: DataFrame) -> DataFrame:
    """One row per digest: keep_id (most code points, then smallest doc_id), group_size and
    n_chars of the row that stays.

    Grouping by length first leaves few rows for the ordered choice, and a digest that
    many rows share is reduced before the shuffle.
    """
    return _winners(rows.withColumn("n", F.lit(1).cast("long")))


def merged(known: DataFrame, more: DataFrame) -> DataFrame:
    """The classes of two sets of rows as those of both."""
    both = known.unionByName(more).select("digest", "place", "n_chars", F.col("keep_id").alias("doc_id"),
                                          F.col("group_size").alias("n"))
    return _winners(both)


def hot_digests(rows: DataFrame, limit: int) -> DataFrame:
    """Digests with more than ``limit`` rows, and how many groups theirs are dealt over."""
    counts = rows.groupBy("digest", "place").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    return counts.select(F.col("digest").alias("hot_digest"), "place",
                         F.ceil(F.col("n") / F.lit(limit)).cast("int").alias("pieces"))


def _slots(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Positions at a level, from 128 bits of each digest."""
    with np.errstate(over="ignore"):
        x = words[:, 1] + words[:, 2] * np.uint64(2 * level + 1)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return (x % np.uint64(size)).astype(np.int64)


def _matrix(digests) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)


def build_hash(words: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, all levels' bits in a row, and the slot of each key (0 .. n-1)."""
    left, sizes, bits = np.arange(len(words)), [], []
    place = np.zeros(len(words), np.int64)
    offset = 0
    while len(left):
        if len(sizes) == LEVELS:
            raise ValueError("digests repeat in a shard")
        size = max(64, int(GAMMA * len(left)))
        at = _slots(words[left], len(sizes), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        level = np.zeros(size, bool)
        level[at[alone]] = True
        place[left[alone]] = offset + at[alone]
        left = left[~alone]
        sizes.append(size)
        bits.append(level)
        offset += size
    every = np.concatenate(bits) if bits else np.zeros(0, bool)
    rank = np.cumsum(every) - 1
    return sizes, every, rank[place] if len(words) else place


def find_slots(words: np.ndarray, sizes, bits: np.ndarray) -> np.ndarray:
    """The slot each digest would have; -1 where no level has its bit."""
    slots, left, offset = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
    rank = np.cumsum(bits) - 1
    for level, size in enumerate(sizes):
        at = offset + _slots(words[left], level, int(size))
        hit = bits[at]
        slots[left[hit]] = rank[at[hit]]
        left = left[~hit]
        offset += int(size)
    return slots


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard of ``history`` (digest, place, keep_id, group_size; digests
    distinct): the hash function and its slots. A null keep_id is kept as such."""

    def build(key, group: pd.DataFrame) -> pd.DataFrame:
        words = _matrix(group["digest"])
        sizes, bits, slots = build_hash(words)
        order = np.argsort(slots)
        ids = group["keep_id"].to_numpy(dtype=object)[order]
        known = np.array([x is not None and x == x for x in ids], dtype=bool)
        values = np.array([int(x) if k else 0 for x, k in zip(ids, known)], dtype="<i8")
        return pd.DataFrame([{
            "shard": int(key[0]), "salt": 0, "sizes": np.array(sizes, "<i8").tobytes(),
            "bits": np.packbits(bits).tobytes(), "digests": words[order].tobytes(),
            "ids": values.tobytes() + known.tobytes(),
            "counts": group["group_size"].to_numpy("<i8")[order].tobytes()}])

    keyed = history.withColumn("shard", F.col("place") % F.lit(shards)).select(
        "shard", "digest", F.col("keep_id").cast("string").alias("keep_id"), "group_size")
    return keyed.groupBy("shard").applyInPandas(build, _INDEX)


def _lookup(rows: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    out = rows[["doc_id", "digest", "n_chars", "place"]].reset_index(drop=True)
    member = np.zeros(len(out), bool)
    keep = np.full(len(out), None, object)
    count = np.full(len(out), None, object)
    if len(index) and len(out):
        shard, words = index.iloc[0], _matrix(out["digest"])
        sizes = np.frombuffer(shard["sizes"], "<i8")
        bits = np.unpackbits(np.frombuffer(shard["bits"], np.uint8), count=int(sizes.sum())).astype(bool)
        digests = np.frombuffer(shard["digests"], "<u8").reshape(-1, 4)
        n = len(digests)
        ids, known = np.frombuffer(shard["ids"], "<i8", n), np.frombuffer(shard["ids"], bool, n, 8 * n)
        counts = np.frombuffer(shard["counts"], "<i8")
        slots = find_slots(words, sizes, bits)
        member = (slots >= 0) & (digests[slots] == words).all(axis=1)
        keep[member] = [int(i) if k else None for i, k in zip(ids[slots[member]], known[slots[member]])]
        count[member] = counts[slots[member]]
    out["member"], out["keep_id"], out["group_size"] = member, keep, count
    for name in ("doc_id", "keep_id", "group_size"):
        out[name] = out[name].astype("Int64")
    return out


def lookup(rows: DataFrame, index: DataFrame, hot: DataFrame, shards: int) -> DataFrame:
    """Every row with member, and for members the keep_id and group_size of their slot.

    Rows of a ``hot`` digest are dealt by their number over several groups, each with its
    own copy of the shard. There are at most HOT_DIGESTS hot ones.
    """
    copies = hot.groupBy((F.col("place") % F.lit(shards)).alias("hot_shard")).agg(F.max("pieces").alias("pieces"))
    spread = (index.drop("salt").join(F.broadcast(copies), F.col("shard") == F.col("hot_shard"), "left")
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)))
              .drop("hot_shard", "pieces"))
    salted = (rows.join(F.broadcast(hot.drop("place")), F.col("digest") == F.col("hot_digest"), "left")
              .withColumn("shard", F.col("place") % F.lit(shards))
              .withColumn("salt", F.pmod(F.xxhash64("row"), F.coalesce("pieces", F.lit(1))).cast("int"))
              .drop("hot_digest", "pieces", "row"))

    def find(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _lookup(left, right)

    text = [F.col(c) if c != "doc_id" else F.col(c).cast("string") for c in salted.columns]
    return (salted.select(text).groupBy("shard", "salt")
            .cogroup(spread.groupBy("shard", "salt")).applyInPandas(find, _FOUND))


def dedup(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, member.

    ``history`` has distinct digests with their keep_id (see ``classes``); rows with such
    a digest repeat a known text and point at its locator. Without one, the digests of one
    half of the rows, by a hash of their number, are the history, and ``member`` tells
    whether a row's digest is among them. All other rows are grouped among themselves.

    Null and empty texts, and texts of white space only, are equal. Among texts of the
    same length a null doc_id is chosen only if there is no other; keep_id is then null,
    which its row matches. Rows that repeat doc_id and text are kept or dropped alike. An empty table
    gives no rows; other columns are not read.
    """
    rows = stored(digest_rows(docs).withColumn("row", F.monotonically_increasing_id()), "digests")
    total = rows.count()
    limit = max(HOT_ROWS, -(-total // HOT_DIGESTS))
    hot = stored(hot_digests(rows, limit), "hot")

    def indexed(known: DataFrame) -> tuple[DataFrame, int]:
        shards = max(LEAST_SHARDS, -(-max(known.count(), total) // SHARD_KEYS))
        return stored(build_index(known, shards), "hash"), shards

    if history is not None:
        found = stored(lookup(rows, *_with(indexed(history), hot)), "found")
        members, others = found.where("member"), found.where(~F.col("member"))
    else:
        second = F.pmod(F.xxhash64("row"), F.lit(2)) == 1
        known = stored(classes(rows.where(~second)), "known")
        asked = lookup(rows.where(second), *_with(indexed(known), hot))
        asked = stored(asked.withColumn("row", F.monotonically_increasing_id()), "asked")
        every = stored(merged(known, classes(asked.where("member"))), "history")
        names = ["doc_id", "digest", "n_chars", "place", "row"]
        repeats = rows.where(~second).select(names).unionByName(asked.where("member").select(names))
        members = lookup(repeats, *_with(indexed(every), hot))
        others = asked.where(~F.col("member"))
    others = others.drop("keep_id", "group_size")
    own = classes(others).drop("place", "n_chars")
    grouped = others.join(own, "digest")
    names = ["doc_id", "keep_id", "group_size", "digest", "member"]
    return members.select(names).unionByName(grouped.select(names)).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "member")


def _with(index: tuple[DataFrame, int], hot: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    return index[0], hot, index[1]
