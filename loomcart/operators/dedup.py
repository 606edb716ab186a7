"""Fingerprints and duplicate removal.

Every shuffle here is preceded by a map-side reduction on the same key, so copies of
one record, however many, leave each map task as one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcart.session import cut_lineage

FINGERPRINT_FIELDS = ["event_id", "user_id", "event_type", "timestamp"]

# Keys are cut into pieces of this many windows each; at 60 s a piece is an hour and has
# at most 3.6 million instants, about 80 MB.
WINDOWS_PER_BLOCK = 60
# So many pieces side by side are composed at a time.
FAN = 32


def fingerprint(df: DataFrame, name: str = "fingerprint") -> DataFrame:
    """Adds the first 20 hex digits of SHA-256 over id, user, type and time.

    An absent field counts as empty text and a null as ``None``.
    """
    def part(field):
        text = F.col("timestamp_text" if field == "timestamp" else field).cast("string")
        return F.when(~F.col("_present")[field], F.lit("")).otherwise(
            F.coalesce(text, F.lit("None")))

    joined = F.concat_ws("|", *[part(f) for f in FINGERPRINT_FIELDS])
    return df.withColumn(name, F.substring(F.sha2(joined, 256), 1, 20))


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str],
                  copies: str | None = None) -> DataFrame:
    """The first row of every key in ``order_by`` order, optionally with the group size.

    ``order_by`` must order the rows of a key totally for the result to be repeatable.
    """
    if copies is None:
        # Spark limits each map task to one row per key ahead of the shuffle.
        in_order = Window.partitionBy(*keys).orderBy(*order_by)
        return (df.withColumn("_place", F.row_number().over(in_order))
                .filter(F.col("_place") == 1).drop("_place"))
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order_by)).alias("_first"),
        F.count(F.lit(1)).alias(copies))
    return grouped.select(
        *[F.col(k) if k in keys else F.col("_first")[k].alias(k) for k in df.columns], copies)


def dedup_batch(df: DataFrame, order_by: list[str], copies: str | None = None,
                key: str = "fingerprint") -> DataFrame:
    """Keep the first arrival of every fingerprint; the batch lies inside one window."""
    return first_per_key(df, [key], order_by, copies)


def dedup_stats(df: DataFrame, window_seconds: int = 60, key: str = "fingerprint") -> DataFrame:
    """One row: records seen, duplicates dropped, their rate, live fingerprints, window."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_processed"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates_dropped"),
        F.count(F.lit(1)).alias("window_size"),
    )
    rate = F.round(F.try_divide(F.col("duplicates_dropped") * 100.0, F.col("total_processed")), 2)
    return totals.select(
        "total_processed", "duplicates_dropped",
        F.coalesce(rate, F.lit(0.0)).alias("dedup_rate_pct"),
        "window_size", F.lit(window_seconds).alias("window_seconds"),
    )


def dedup_window(df: DataFrame, arrival_ms: str, order_by: list[str], window_seconds: int = 60,
                 key: str = "fingerprint", windows_per_block: int = WINDOWS_PER_BLOCK,
                 fan: int = FAN) -> DataFrame:
    """Replay of the sliding-window rule over a table with arrival times in milliseconds.

    A row is kept when more than ``window_seconds`` have passed since the last *kept*
    row of its key; a dropped row does not extend the window.

    Rows of a key that arrive in the same millisecond are first reduced to the earliest
    of them. What is kept after a gap longer than the window does not depend on anything
    before it, so a key's instants are cut into blocks of time and only blocks without
    such a gap at their border need to know the last instant kept before them, see
    ``_befores``. No task sees all instants of a key. Most blocks lie within one window
    and keep their first instant, which takes no Python.
    """
    window_ms = window_seconds * 1000
    width = window_ms * windows_per_block
    instants = cut_lineage(
        df.groupBy(key, F.col(arrival_ms).alias("t"))
        .agg(F.min(F.struct(*order_by)).alias("o")))
    blocks = _blocks(instants, key, window_ms, width)
    befores = _befores(blocks, key, window_ms, fan)
    # Whatever is kept of a block that one window holds and nothing reaches into is its first.
    whole = ~F.col("linked") & (F.col("last") - F.col("first") <= window_ms)
    kept = blocks.filter(whole).select(key, F.col("first").alias("t"))
    longer = blocks.filter(~whole).select(key, "block", "ts")
    longer = (longer.withColumn("before", F.lit(None).cast("bigint")) if befores is None
              else longer.join(befores, [key, "block"], "left"))
    kept = kept.unionByName(_kept_in_blocks(longer, key, window_ms, width))
    # (key, instant, order) is unique, so this join has no hot key.
    chosen = kept.join(instants, [key, "t"]).select(
        F.col(key).alias("_k"), F.col("t").alias("_t"), F.col("o").alias("_o"))
    same = ((F.col(key) == F.col("_k")) & (F.col(arrival_ms) == F.col("_t"))
            & (F.struct(*order_by) == F.col("_o")))
    return df.join(chosen, same, "left_semi")


def _blocks(instants: DataFrame, key: str, window_ms: int, width: int) -> DataFrame:
    """One row per key and block that has instants: the sorted instants ``ts``, the ``first`` and
    ``last`` of them, whether an instant of the block before reaches into it (``linked``), and whether it
    reaches into the next one (``leads``).

    Instants near a border are shown to the block beyond it too.
    """
    place = F.pmod(F.col("t"), F.lit(width))
    own = F.col("side") == 0
    sides = F.array_compact(F.array(
        F.lit(0), F.when(place >= width - window_ms, 1), F.when(place <= window_ms, -1)))
    number = F.expr(f"(t - pmod(t, {width})) div {width}").alias("block")
    shown = instants.select(key, number, "t", F.explode(sides).alias("side"))
    found = shown.groupBy(key, (F.col("block") + F.col("side")).alias("block")).agg(
        F.array_sort(F.collect_list(F.when(own, F.col("t")))).alias("ts"),
        F.max(F.when(F.col("side") == 1, F.col("t"))).alias("ahead"),
        F.min(F.when(F.col("side") == -1, F.col("t"))).alias("next"))
    first, last = F.element_at("ts", 1), F.element_at("ts", -1)
    return cut_lineage(found.filter(F.size("ts") > 0).select(
        key, "block", "ts", first.alias("first"), last.alias("last"),
        F.coalesce(first - F.col("ahead") <= window_ms, F.lit(False)).alias("linked"),
        F.coalesce(F.col("next") - last <= window_ms, F.lit(False)).alias("leads")))


def _befores(blocks: DataFrame, key: str, window_ms: int, fan: int) -> DataFrame | None:
    """The last instant kept before each linked block; None if no block is linked.

    A block is a function from the last instant kept before it to the last one kept in
    it, written as lines (start, end): if ``start`` is the first line beyond the window of
    what was kept before, the chain leaves at ``end``. Functions of ``fan`` blocks side by
    side compose to that of their parent, and so on up to one node per key; then what is
    kept before a node is handed down to its children. A node has at most about one line
    per instant of its first window, so a group holds ``fan`` times as many.
    """
    chained = blocks.filter("linked or leads").select(key, "block", "ts", "linked")
    ends = chained.agg(F.min("block"), F.max("block")).first()
    if ends[0] is None:
        return None
    key_type = blocks.schema[key].dataType.simpleString()
    function = f"`{key}` {key_type}, node bigint, starts array<bigint>, ends array<bigint>"

    def leaf(batches):
        for batch in batches:
            found = []
            for row in batch.column("ts"):
                ts = row.values.to_numpy()
                found.append(_trimmed(ts, ts[_chain_ends(ts, window_ms)], window_ms))
            yield _functions(batch, key, "node", found)

    def compose(batches):
        for batch in batches:
            found = []
            for row in batch.column("children"):
                children = _children(row)
                _, starts, ends = children[-1]
                for _, own_starts, own_ends in reversed(children[:-1]):
                    through = _leaving(starts, ends, own_ends, window_ms)
                    starts, ends = _trimmed(
                        np.append(own_starts, starts), np.append(through, ends), window_ms)
                found.append((starts, ends))
            yield _functions(batch, key, "parent", found)

    def hand_down(batches):
        for batch in batches:
            rows, nodes, befores = [], [], []
            for i, (row, at) in enumerate(zip(batch.column("children"), batch.column("before").to_pylist())):
                for node, starts, ends in _children(row):
                    rows.append(i)
                    nodes.append(node)
                    befores.append(at)
                    at = int(ends[0] if at is None else _leaving(starts, ends, np.array([at]), window_ms)[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(pa.array(rows, pa.int64())), pa.array(nodes, pa.int64()),
                 pa.array(befores, pa.int64())], names=[key, "node", "before"])

    def families(level: DataFrame) -> DataFrame:
        children = F.array_sort(F.collect_list(F.struct("node", "starts", "ends")))
        return cut_lineage(level.groupBy(key, F.expr(f"node div {fan}").alias("parent"))
                           .agg(children.alias("children")))

    # Nodes are numbered from the first chained block on.
    low, span = ends[0], ends[1] - ends[0] + 1
    numbered = chained.select(key, (F.col("block") - low).alias("node"), "ts")
    levels = [families(numbered.mapInArrow(leaf, function))]
    while span > fan:
        levels.append(families(levels[-1].mapInArrow(compose, function)))
        span = -(-span // fan)
    # The top nodes of a key have one parent, before which nothing is kept.
    known = levels.pop().withColumn("before", F.lit(None).cast("bigint"))
    handed_schema = f"`{key}` {key_type}, node bigint, before bigint"
    handed = known.mapInArrow(hand_down, handed_schema)
    while levels:
        known = levels.pop().join(handed.withColumnRenamed("node", "parent"), [key, "parent"])
        handed = known.mapInArrow(hand_down, handed_schema)
    linked = chained.filter("linked").select(key, "block")
    return handed.select(key, (F.col("node") + low).alias("block"), "before").join(linked, [key, "block"])


def _chain_ends(ts: np.ndarray, window_ms: int) -> np.ndarray:
    """For each instant: the place of the last one kept when the chain starts there."""
    jump = np.searchsorted(ts, ts + window_ms, side="right")
    jump = np.where(jump < len(ts), jump, np.arange(len(ts)))
    while True:
        twice = jump[jump]
        if np.array_equal(twice, jump):
            return jump
        jump = twice


def _trimmed(starts: np.ndarray, ends: np.ndarray, window_ms: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines that can be asked for: those in the first window and the one after it. Of
    lines in a row that leave alike the last is enough."""
    asked = np.searchsorted(starts, starts[0] + window_ms, side="right") + 1
    starts, ends = starts[:asked], ends[:asked]
    last = np.append(ends[1:] != ends[:-1], True)
    return starts[last], ends[last]


def _leaving(starts: np.ndarray, ends: np.ndarray, befores: np.ndarray, window_ms: int) -> np.ndarray:
    """The last instants kept after a node; without a line for it a chain passes unchanged."""
    line = np.searchsorted(starts, befores + window_ms, side="right")
    return np.where(line < len(starts), ends[np.minimum(line, len(starts) - 1)], befores)


def _functions(batch: pa.RecordBatch, key: str, node: str, found: list) -> pa.RecordBatch:
    """A row per node with its lines."""
    def lists(place):
        return pa.array([lines[place] for lines in found], pa.list_(pa.int64()))

    return pa.RecordBatch.from_arrays([batch.column(key), batch.column(node), lists(0), lists(1)],
                                      names=[key, "node", "starts", "ends"])


def _children(row: pa.ListScalar) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Node, starts and ends of the nodes below one parent, in order."""
    nodes, starts, ends = (row.values.field(i) for i in range(3))
    return [(node, starts[i].values.to_numpy(), ends[i].values.to_numpy())
            for i, node in enumerate(nodes.to_pylist())]


def _kept_in_blocks(blocks: DataFrame, key: str, window_ms: int, width: int) -> DataFrame:
    """Kept instants of blocks (sorted instants ``ts``), each from the last one kept before
    it, if any. The chains of all blocks in a batch are followed side by side."""
    key_type = blocks.schema[key].dataType.simpleString()
    apart = width + window_ms + 1

    def emit(batches):
        for batch in batches:
            lists = batch.column("ts")
            stops = np.cumsum(lists.value_lengths().to_numpy())
            # Blocks are laid one behind the other, so far apart that no window spans two.
            shift = np.arange(len(stops)) * apart - batch.column("block").to_numpy() * width
            of = np.repeat(np.arange(len(stops)), np.diff(stops, prepend=0))
            ts = lists.flatten().to_numpy()
            places = ts + shift[of]
            beyond = np.searchsorted(places, places + window_ms, side="right")
            before = batch.column("before")
            reach = before.fill_null(0).to_numpy() + window_ms + shift
            reach = np.maximum(reach, np.arange(len(stops)) * apart - 1)
            at = np.where(before.is_null().to_numpy(zero_copy_only=False),
                          np.append(0, stops[:-1]), np.searchsorted(places, reach, side="right"))
            kept = [np.zeros(0, dtype=np.int64)]
            while True:
                inside = at < stops
                at, stops = at[inside], stops[inside]
                if not len(at):
                    break
                kept.append(at)
                at = beyond[at]
            kept = np.concatenate(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(pa.array(of[kept])), pa.array(ts[kept])], names=[key, "t"])

    return blocks.select(key, "block", "ts", "before").mapInArrow(emit, f"`{key}` {key_type}, t bigint")


def dedup_within_watermark(df: DataFrame, event_time: str, window_seconds: int = 60,
                           key: str = "fingerprint") -> DataFrame:
    """Spark's own event-time variant: cheaper, but not the sliding rule above.

    Repeats are dropped for at least ``window_seconds`` of event time, and within one
    micro-batch also beyond it.
    """
    return (df.withWatermark(event_time, f"{window_seconds} seconds")
            .dropDuplicatesWithinWatermark([key]))
