"""SimHash near-dedup by anchor-point covering.

Bits are cut into parts; with P parts and at most d differing bits, some part differs in
at most d // P bits. In each part the words of a covering code are the anchors: Hamming
blocks, which are perfect (every value lies within one bit of exactly one code word),
and free bits, which are their own code. A fingerprint is at home at the nearest anchor
of each part and is replicated to every anchor that could be home to a fingerprint within
the part's threshold. Comparing homes with replicas at each anchor therefore meets every
pair within d bits.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcart.llm.common import give_back, stored, text_hash
from loomcart.session import remove_path, scratch_path

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Each part as (Hamming block lengths, free bits); the lengths sum to 64.
PARTS = (((15,), 6), ((15,), 6), ((15,), 7))
HOT_HOMES = 4096  # homes at an anchor that are compared by one group
HOT_ANCHORS = 100_000  # at most so many anchors are split, which bounds their broadcast
PAIRS_AT_ONCE = 2_000_000
_A2Z = bytes(range(65, 91))
_LOWER = bytes.maketrans(_A2Z, _A2Z.lower())


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of one text; zero without words."""
    found = text.translate(_LOWER).split()  # bytes.split cuts at 20 and 09-0D only
    n = len(found)
    if not n:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle_words, n)
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(64, np.int64), n - k + 1
    for at in range(0, total, 65536):
        a, b = starts[at:min(at + 65536, total)].tolist(), ends[k - 1 + at:].tolist()
        hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(a, b)], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist()))


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_hash and fp (the fingerprint as a signed long) of every row, from the
    whole text."""

    def of(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            values = np.array([fingerprint(t.as_py(), shingle_words) for t in texts], dtype="<u8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(values.view("<i8"), pa.int64())],
                names=["doc_id", "text_hash", "fp"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce("text", F.lit("")).alias("text"), text_hash(F.col("text")).alias("text_hash"))
    return narrow.mapInArrow(give_back(of), "doc_id long, text_hash long, fp long")


def _decode_block(value: np.ndarray, length: int) -> np.ndarray:
    """Nearest Hamming code word: the syndrome names the bit to flip."""
    syndrome = np.zeros_like(value)
    for bit in range(length):
        syndrome ^= np.where((value >> np.uint64(bit)) & np.uint64(1), np.uint64(bit + 1), np.uint64(0))
    flip = np.where(syndrome > 0, np.uint64(1) << (np.maximum(syndrome, 1) - np.uint64(1)), np.uint64(0))
    return value ^ flip


def nearest_anchor(value: np.ndarray, blocks) -> np.ndarray:
    """The anchor of each part value; bits above the blocks are free and stay."""
    out, shift = value.copy(), 0
    for length in blocks:
        mask = np.uint64((1 << length) - 1) << np.uint64(shift)
        block = _decode_block((value & mask) >> np.uint64(shift), length)
        out = (out & ~mask) | (block << np.uint64(shift))
        shift += length
    return out


def anchors(fps: np.ndarray, parts=PARTS, max_bits: int = MAX_BITS):
    """(row, key, home) of every fingerprint's anchors; keys hold the part's number."""
    threshold, low = max_bits // len(parts), 0
    rows, keys, homes = [], [], []
    index = np.arange(len(fps))
    for number, (blocks, free) in enumerate(parts):
        width = sum(blocks) + free
        value = (fps >> np.uint64(low)) & np.uint64((1 << width) - 1)
        low += width
        reach = [nearest_anchor(value, blocks)]
        for flips in range(1, threshold + 1):
            for bits in combinations(range(width), flips):
                mask = np.uint64(sum(1 << b for b in bits))
                reach.append(nearest_anchor(value ^ mask, blocks))
        found = np.sort(np.stack(reach, axis=1), axis=1)
        first = np.ones(found.shape, bool)
        first[:, 1:] = found[:, 1:] != found[:, :-1]
        at = np.nonzero(first)
        tag = np.uint64(number) << np.uint64(56)
        rows += [index, at[0]]
        keys += [reach[0] | tag, found[at] | tag]
        homes += [np.ones(len(fps), bool), np.zeros(len(at[0]), bool)]
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def replicas(classes: DataFrame, parts=PARTS, max_bits: int = MAX_BITS) -> DataFrame:
    """key, fp, home: a row for each fingerprint at home in a part, and one for each
    anchor it is replicated to (its own home included)."""

    def of(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fps = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).view("<u8")
                row, key, home = anchors(fps, parts, max_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view("<i8")), pa.array(fps[row].view("<i8")), pa.array(home)],
                    names=["key", "fp", "home"])

    return classes.select("fp").mapInArrow(of, "key long, fp long, home boolean")


def _spanning(a: np.ndarray, b: np.ndarray):
    """Edges from every end of the links a-b to the least value of its component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[other], nodes[label[other]]


def _compare(homes: np.ndarray, home_group: np.ndarray, fps: np.ndarray, group: np.ndarray, max_bits: int):
    """Spanning edges of the links between rows and homes of the same group. Both sides
    are sorted by group; a bounded number of pairs is compared at once."""
    first = np.searchsorted(home_group, group, "left")
    count = np.searchsorted(home_group, group, "right") - first
    total = np.concatenate(([0], np.cumsum(count)))
    at = 0
    while at < len(fps):
        # At least one row: its pairs are as many as a split anchor has homes.
        to = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS_AT_ONCE, "right")) - 1)
        n = count[at:to]
        row = np.repeat(np.arange(at, to), n)
        home = np.arange(total[to] - total[at]) - np.repeat(total[at:to] - total[at], n) + first[row]
        near = (np.bitwise_count(fps[row] ^ homes[home]) <= max_bits) & (fps[row] != homes[home])
        if near.any():
            yield _spanning(fps[row[near]], homes[home[near]])
        at = to


def links(classes: DataFrame, total: int, parts=PARTS, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (fp, root) that join the fingerprints just as all links within ``max_bits`` do.

    Rows of an anchor reach one task sorted, homes first. The homes of an anchor with many
    are dealt over several groups, and its other rows go to each; a task holds one group's
    homes and lets the other rows pass by. What it emits are spanning edges of each run of
    comparisons: as many as fingerprints, not as pairs.
    """
    every = stored(replicas(classes, parts, max_bits), "replicas")
    limit = max(HOT_HOMES, -(-total * len(parts) // HOT_ANCHORS))
    hot = (every.where("home").groupBy("key").count().where(F.col("count") > limit)
           .select("key", F.ceil(F.col("count") / limit).cast("int").alias("pieces")))
    pieces = F.coalesce("pieces", F.lit(1))
    dealt = (every.join(F.broadcast(hot), "key", "left").withColumn(
        "piece", F.explode(F.when(F.col("home"), F.array(F.pmod(F.xxhash64("fp"), pieces).cast("int")))
                           .otherwise(F.sequence(F.lit(0), pieces - 1)))))
    laid = (dealt.select("key", "piece", "home", "fp").repartition("key", "piece")
            .sortWithinPartitions("key", "piece", F.desc("home")))

    def compare(batches):
        held, held_group = np.zeros(0, "<u8"), np.zeros(0, np.int64)
        last, number = None, 0
        for batch in batches:
            key, piece, home, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            if not len(key):
                continue
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (piece[1:] != piece[:-1])
            new[0] = last != (key[0], piece[0])
            group = number + np.cumsum(new)
            last, number = (key[-1], piece[-1]), int(group[-1])
            fp = fp.view("<u8")
            held, held_group = np.concatenate([held, fp[home]]), np.concatenate([held_group, group[home]])
            for a, b in _compare(held, held_group, fp[~home], group[~home], max_bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view("<i8")), pa.array(b.view("<i8"))], names=["fp", "root"])
            open_ = held_group == number
            held, held_group = held[open_], held_group[open_]

    return laid.mapInArrow(give_back(compare), "fp long, root long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) for every end of an edge: root is the least fp of its component.

    Large-star and small-star steps in turn: each joins a node's neighbours to the least
    one, first the larger, then the smaller ones. Edges never get more, and the number of
    rounds grows with the logarithm of the longest chain. Every round is written and read
    again.
    """
    spark = edges.sparkSession

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        both = pairs.union(pairs.select("b", "a")).toDF("u", "v") if larger else \
            pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        # Written, so that both sides of the join are shuffled for it and AQE can split a
        # node with a large share of the edges.
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
        joined = both.join(least, "u")
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b"))
        if larger:
            moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            moved = moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return moved.where("a != b").distinct()

    def save(pairs: DataFrame):
        path = scratch_path(spark, "stars")
        pairs.write.parquet(path)
        out = spark.read.schema("a long, b long").parquet(path)
        return path, out, out.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    path, pairs, state = save(edges.toDF("a", "b"))
    while True:
        next_path, pairs, next_state = save(star(star(pairs, True), False))
        remove_path(spark, path)
        if next_state == state:
            return pairs.select(F.col("a").alias("fp"), F.col("b").alias("root"))
        path, state = next_path, next_state


def near_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                parts=PARTS) -> DataFrame:
    """One row per distinct doc_id and text of ``docs``: doc_id, text_hash, fingerprint
    (hex), component_id, kept (one row of each component) and copies (rows of ``docs``).

    Fingerprints of at most ``max_bits`` differing bits are linked, and component_id is
    the smallest doc_id reachable. Null, empty and white texts have fingerprint zero,
    which is linked like any other. Null doc_ids count for no component_id; it is null
    where a component has no other. The row that stays has the component's id, and of
    several such rows the smallest text_hash. An empty table gives no rows; other columns
    are not read.
    """
    rows = stored(fingerprints(docs, shingle_words).groupBy("doc_id", "text_hash", "fp").agg(
        F.count(F.lit(1)).alias("copies")), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash"))
    classes = stored(rows.groupBy("fp").agg(first.alias("first")), "classes")
    edges = links(classes, classes.count(), parts, max_bits)
    rooted = classes.join(components(edges), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("first").alias("stays"))
    stays = rooted.join(named, "root").select("fp", "stays")
    kept = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("text_hash") == F.col("stays.text_hash"))
    return (rows.join(stays, "fp")
            .select("doc_id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("stays.doc_id").alias("component_id"), kept.alias("kept"), "copies"))
