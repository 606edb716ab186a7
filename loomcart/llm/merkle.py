"""Merkle manifest of a dataset: a digest tree for each group of rows, and one above them.

Leaves are numbered by a range sort over all rows, so a group of any size is spread over
all tasks. A level is built by one equijoin of the level with itself: every node names the
places of its siblings by slot offsets and goes there (for two children, that is the place
with its last bit flipped). Rows in slot zero then emit the parents, an eighth as many.
Each level is written once. Proofs come down the other way: a node's path is what stands
beside it, then its parent's path, so each join moves one row for each run of siblings.

Digests are SHA-256 of their inputs' lower-case hex texts, and are kept as 32 bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcart.functions.joins import lookup_join
from loomcart.llm.common import stored
from loomcart.operators.ranges import with_row_index

WIDTH = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(parts: Column) -> Column:
    """H of digests laid side by side: SHA-256 of their hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(parts)), 256))


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_digest(values: list[Column]) -> Column:
    """Digest of a row: ``-`` for null, else byte count, colon and value, of each column."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def _laid(nodes: Column) -> Column:
    """Digests of (slot, digest) pairs side by side, by slot."""
    return F.aggregate(F.array_sort(nodes), F.lit(b""), lambda all_, x: F.concat(all_, x["digest"]))


def with_siblings(level: DataFrame, width: int, carry: list[str]) -> DataFrame:
    """Adds ``before`` and ``after``: the digests beside each node in its run of ``width``.

    ``level`` has tree, idx, digest, n (nodes of the tree on this level).
    """
    slot = F.pmod("idx", F.lit(width))
    offsets = F.sequence(F.lit(1), F.lit(width - 1))
    place = F.col("idx") - slot + F.pmod(slot + F.col("offset"), F.lit(width))
    towards = (level.where("n > 1").withColumn("offset", F.explode(offsets))
               .select("tree", place.alias("idx"), F.struct(slot.alias("slot"), "digest").alias("sibling")))
    kept = ["digest", "n", *carry]
    beside = (level.join(towards, ["tree", "idx"], "left").groupBy("tree", "idx")
              .agg(*[F.first(c).alias(c) for c in kept], F.collect_list("sibling").alias("siblings")))
    return beside.select(
        "tree", "idx", *kept, _laid(F.filter("siblings", lambda x: x["slot"] < slot)).alias("before"),
        _laid(F.filter("siblings", lambda x: x["slot"] > slot)).alias("after"))


def parents(level: DataFrame, width: int) -> DataFrame:
    """The next level: one node for each run, emitted by the node in its slot zero."""
    first = level.where((F.col("n") > 1) & (F.pmod("idx", F.lit(width)) == 0))
    return first.select("tree", F.expr(f"idx div {width}").alias("idx"),
                        digest_of(F.concat("digest", "after")).alias("digest"),
                        F.expr(f"(n + {width - 1}) div {width}").alias("n"))


def build(leaves: DataFrame, width: int, carry: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Trees over ``leaves`` (tree, idx from 0, digest, n, and ``carry``).

    Returns the leaves with their ``path`` (what stands beside the node, level by level up
    to the tree's root), and the roots: tree, root.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels = [stored(with_siblings(leaves, width, list(carry)), "level")]
    while most > 1:
        most = -(-most // width)
        levels.append(stored(with_siblings(parents(levels[-1], width), width, []), "level"))
    roots = None
    for level in levels:
        done = level.where("n = 1").select("tree", F.col("digest").alias("root"))
        roots = done if roots is None else roots.unionByName(done)

    step = F.array(F.struct("before", "after"))
    none = F.array().cast("array<struct<before: binary, after: binary>>")
    paths = None
    for level in reversed(levels):
        own = level.withColumn("own", F.when(F.col("n") > 1, step).otherwise(none)).drop("before", "after")
        if paths is None:
            joined = own.withColumn("above", none)
        else:
            above = paths.select("tree", F.col("idx").alias("up"), F.col("path").alias("above"))
            joined = own.withColumn("up", F.expr(f"idx div {width}")).join(above, ["tree", "up"], "left")
        path = F.concat("own", F.when(F.col("n") > 1, F.coalesce("above", none)).otherwise(none))
        paths = joined.withColumn("path", path).drop("own", "above", "up")
    return paths, roots


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Adds idx and n: place and number of the rows of each ``tree``. ``order`` starts
    with the tree."""
    placed = with_row_index(rows, order, "place")
    trees = placed.groupBy("tree").agg(F.min("place").alias("begin"), F.count(F.lit(1)).alias("n"))
    return (lookup_join(placed, trees, ["tree"], ["place"])
            .withColumn("idx", F.col("place") - F.col("begin")).drop("place", "begin"))


def manifest(docs: DataFrame, group: str = "lang", key: str = "doc_id", fields=FIELDS, width: int = WIDTH,
             carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``key``, tree, idx, leaf, subroot, root (32 bytes each),
    path, and the columns ``carry`` computes from the row.

    A tree for each value of ``group``, null first and a group of its own; leaves by
    ``key``, nulls first, then by digest, so rows that are equal in all fields are leaves
    side by side. Null and empty values give different leaves. The subroots are the leaves
    of one more tree, whose root stands for the table; an empty table has none and gives
    no rows. Columns outside ``fields`` are not read.
    """
    carry = carry or {}
    tree = F.coalesce(F.concat(F.lit("v"), F.col(group).cast("string")), F.lit("n"))  # n sorts before v
    leaves = stored(docs.select(F.col(key).alias("key"), tree.alias("tree"),
                                leaf_digest([F.col(f) for f in fields]).alias("digest"),
                                *[c.alias(f"carry_{name}") for name, c in carry.items()]), "leaves")
    kept = ["key", *[f"carry_{name}" for name in carry]]
    order = [F.col("tree").asc(), F.col("key").asc_nulls_first(), F.col("digest").asc(),
             *[F.col(c).asc() for c in kept[1:]]]
    paths, roots = build(numbered(leaves, order), width, kept)

    tops = roots.select(F.lit("").alias("all"), F.col("tree").alias("group"), F.col("root").alias("digest"))
    top_leaves = numbered(tops.withColumnRenamed("all", "tree"), [F.col("tree").asc(), F.col("group").asc()])
    top_paths, top_roots = build(top_leaves, width, ["group"])
    above = stored(lookup_join(top_paths, top_roots, ["tree"], ["idx"]).select(
        F.col("group").alias("tree"), F.col("digest").alias("subroot"), F.col("path").alias("top"), "root"), "subroots")
    joined = lookup_join(paths, above, ["tree"], ["idx"])
    return joined.select(F.col("key").alias(key), "tree", "idx", F.col("digest").alias("leaf"), "subroot", "root",
                         F.concat("path", "top").alias("path"),
                         *[F.col(f"carry_{name}").alias(name) for name in carry])


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to along ``path``."""
    return F.aggregate(path, leaf, lambda digest, beside: digest_of(
        F.concat(beside["before"], digest, beside["after"])))


def proof_digest(path: Column) -> Column:
    """Hex digest of the siblings of a path, level by level."""
    return F.sha2(as_hex(F.aggregate(path, F.lit(b""), lambda all_, beside: F.concat(
        all_, beside["before"], beside["after"]))), 256)
