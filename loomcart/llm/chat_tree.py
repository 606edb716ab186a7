"""Conversations as one packed sequence in which shared first turns stand once.

Turns of a conversation get running digests, so equal beginnings have equal digests and
become one node of a prefix tree. Nodes are sorted depth first and their tokens emitted
once; each node carries the position of its first token in its conversation and the
intervals of the sequence that its tokens attend to: those of its ancestors. Spark does the
sorting: the key of a node is the list of digests on its way from the root, as far as the
way is shared, so no tree, conversation or hot first turn is gathered in one task.

Template: ``[INST] text [/INST]`` for users, ``<s> text </s>`` for assistants, and
``<<SYS>> role, line feed, text <</SYS>>`` for any other role. A mark inside a text gets a
backslash behind its first character, and one more if it has some there already. Marks of
the template are token ids above the vocabulary, so they are never mixed up with text.
"""

from __future__ import annotations

import hashlib
import os
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomcart.llm.common import checked_broadcast, give_back, stored
from loomcart.session import scratch_path

# Opening and closing marks; their token ids follow the vocabulary in this order.
MARKS = ("[INST] ", " [/INST]", "<s> ", " </s>", "<<SYS>> ", " <</SYS>>")
_OPEN = {"user": 0, "assistant": 2}
_OTHER = 4
_MARK = r"([<\[])(\\*)(/?s>|<SYS>>|</SYS>>|/?INST\])"
_ESCAPE = re.compile(_MARK)
_UNESCAPE = re.compile(r"([<\[])\\(\\*)(/?s>|<SYS>>|</SYS>>|/?INST\])")
BATCH_CHARS = 500_000  # of texts that are encoded together
BATCH_NODES = 512  # nodes that are decoded together

_SPAN = "array<struct<start: bigint, length: bigint>>"
_INTERVALS = "array<struct<start: bigint, end: bigint>>"
_SCANNED = (f"part int, at bigint, node string, conversations bigint, ids array<int>, loss_from int, loss_to int, "
            f"missing int, position bigint, intervals {_INTERVALS}, stack array<struct<depth: int, start: bigint, "
            "length: bigint>>")
_NODES = (f"part int, start bigint, node string, conversations bigint, ids array<int>, loss_from int, loss_to int, "
          f"position bigint, intervals {_INTERVALS}")
_PARTS = f"part int, base bigint, carried {_SPAN}"
_REPORT = ("node string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
           "formatted_chars bigint")
_INTERVAL = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_PART_BITS = 33  # of monotonically_increasing_id()


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def content(role: str, text: str) -> tuple[int, str]:
    """The opening mark of a turn and what stands between its marks."""
    if role in _OPEN:
        return _OPEN[role], escape(text)
    line = role.replace("\\", "\\\\").replace("\n", "\\n")
    return _OTHER, escape(f"{line}\n{text}")


def parsed(mark: int, inner: str) -> tuple[str, str]:
    """Role and text of what ``content`` made."""
    plain = unescape(inner)
    if mark != _OTHER:
        return next(role for role, m in _OPEN.items() if m == mark), plain
    line, _, text = plain.partition("\n")
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], line), text


class Tokens:
    """Turns to token ids and back."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.first_mark = self.library.get_vocab_size()

    def encode(self, turns: list[tuple[str, str]]) -> list[list[int]]:
        made = [content(role, text) for role, text in turns]
        inner = self.library.encode_batch_fast([t for _, t in made], add_special_tokens=False)
        return [[self.first_mark + m, *e.ids, self.first_mark + m + 1] for (m, _), e in zip(made, inner)]

    def decode(self, ids: list[list[int]]) -> list[tuple[int, str]]:
        """Opening mark and inner text of each turn."""
        for turn in ids:
            if len(turn) < 2 or turn[0] < self.first_mark or turn[-1] != turn[0] + 1:
                raise ValueError("a turn is not closed by its mark")
        inner = self.library.decode_batch([turn[1:-1] for turn in ids], skip_special_tokens=False)
        return [(turn[0] - self.first_mark, text) for turn, text in zip(ids, inner)]

    def under_mask(self, ids: list[int], start: int, stop: int, inner: str) -> str:
        """Text of the ids from ``start`` to ``stop``; ``inner`` is that of all between marks."""
        if (start, stop) == (1, len(ids) - 1):
            return inner
        return self.library.decode(ids[start:stop], skip_special_tokens=False) if stop > start else ""


def placed_turns(conversations: DataFrame) -> DataFrame:
    """Rows sorted by conversation and turn, numbered in that order (``row``), with a digest
    of role and text in two halves. Equal turn numbers stand by role and digest."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                role.alias("role"), text.alias("text"), digest.alias("digest"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]

    def half(at: int) -> Column:
        return F.conv(F.substring("digest", at, 15), 16, 10).cast("long")

    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(sorted_rows.select(
        F.monotonically_increasing_id().alias("row"), "conv_id",
        F.coalesce(F.col("conv_id").cast("string"), F.lit("none")).alias("key"), "role", "text",
        half(1).alias("first"), half(16).alias("second")), "turns")


def _running(rows: DataFrame, values: dict[str, Column], total, join) -> DataFrame:
    """``total`` of the rows of a conversation up to and with each row, for each value.

    Each sorted partition is summed on its own; what conversations that reach over its end
    have so far is carried on, one row for each partition.
    """
    part = F.shiftright("row", _PART_BITS)
    cut = rows.withColumn("part", part)
    for name, value in values.items():
        cut = cut.withColumn(name, value)
    groups = cut.groupBy("part", "key").agg(F.max("row").alias("end"), *[total(n).alias(n) for n in values])
    ends = groups.groupBy("part").agg(F.max_by(F.struct("key", *values), "end").alias("x")).select("part", "x.*")
    by_key = Window.partitionBy("key").orderBy("part")
    carry = ends.select(F.lead("part").over(Window.orderBy("part")).alias("part"), "key",
                        *[total(n).over(by_key).alias(f"carry_{n}") for n in values])
    so_far = Window.partitionBy("part", "key").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    summed = cut
    for name in values:
        summed = summed.withColumn(name, total(name).over(so_far))
    # One row for each partition.
    joined = summed.join(F.broadcast(carry), ["part", "key"], "left")
    return joined.withColumns({n: join(F.col(n), F.coalesce(f"carry_{n}", F.lit(0))) for n in values}).drop(
        "part", *[f"carry_{n}" for n in values])


def prefixes(turns: DataFrame) -> DataFrame:
    """row, conv_id, key, depth and the digest (a, b) of the conversation up to this turn.

    The digest is the exclusive-or of each turn's digest mixed with its place, so it can be
    continued from one partition to the next.
    """
    narrow = turns.drop("role", "text")
    deep = _running(narrow, {"depth": F.lit(1).cast("long")}, F.sum, lambda x, y: x + y)
    deep = stored(deep.withColumn("depth", F.col("depth") - 1), "depths")
    mixed = {name: F.xxhash64(F.lit(seed), "depth", "first", "second") for seed, name in enumerate("ab")}
    done = _running(deep, mixed, F.bit_xor, lambda x, y: x.bitwiseXOR(y))
    return stored(done.select("row", "conv_id", "key", "depth", "a", "b"), "prefixes")


def tree(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (row of a turn with its content, path, depth, node, conversations that end
    there) and conversations (conv_id, node of the last turn).

    The path leads from the root to the node, or to the first turn that no other
    conversation shares; beyond that the depth alone is the order. Its length is bounded
    by the turns that conversations share.
    """
    node = F.concat(F.lpad(F.hex("a"), 16, "0"), F.lpad(F.hex("b"), 16, "0")).alias("node")
    last = found.groupBy("conv_id").agg(F.max_by(F.struct("a", "b"), "depth").alias("x"))
    last = stored(last.select("conv_id", "x.a", "x.b"), "last")
    shared = found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row"))
    ends = last.groupBy("a", "b").agg(F.count(F.lit(1)).alias("conversations"))
    chosen = stored(shared.join(ends, ["a", "b"], "left").join(found.select("row", "key", "depth"), "row"), "chosen")
    alone = chosen.where("n = 1").groupBy("key").agg(F.min("depth").alias("alone"))
    # Rows of one long conversation may be many; the join's other side has one row for each
    # conversation, and AQE splits what is skewed.
    on_path = found.join(alone, "key", "left").where("alone is null or depth <= alone")
    paths = on_path.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("depth", "a", "b"))).alias("path"))
    reach = F.least(F.col("depth") + 1, F.size("path")).cast("int")
    nodes = chosen.join(paths, "key").select(
        "row", F.slice("path", F.lit(1), reach).alias("path"), "depth", node,
        F.coalesce("conversations", F.lit(0)).alias("conversations"))
    return nodes, last.select("conv_id", node)


def _scan(tokenizer: str):
    """Tokens of sorted nodes, places and intervals as far as the partition knows them,
    and as its last row the stack of nodes that the next partition may hang from."""

    def scan(batches):
        part, tokens, at, stack = TaskContext.get().partitionId(), None, 0, []
        names = ("part", "at", "node", "conversations", "ids", "loss_from", "loss_to", "missing", "position",
                 "intervals", "stack")
        kinds = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.int32(),
                 pa.int32(), pa.int64(), _INTERVAL,
                 pa.list_(pa.struct([("depth", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))]

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

        def flush(rows):
            nonlocal at
            out = []
            for (depth, node, ending, role, _), ids in zip(rows, tokens.encode([(r[3], r[4]) for r in rows])):
                while stack and stack[-1][0] >= depth:
                    stack.pop()
                intervals, position = stack[-1][3:] if stack else ([], 0)
                loss = (1, len(ids) - 1) if role == "assistant" else (0, 0)
                out.append((part, at, node, ending, ids, *loss, stack[0][0] if stack else depth, position,
                            [{"start": s, "end": e} for s, e in intervals], None))
                # Own interval joins the last one where it follows it.
                own = [*intervals[:-1], (intervals[-1][0], at + len(ids))] if intervals and intervals[-1][1] == at \
                    else [*intervals, (at, at + len(ids))]
                stack.append((depth, at, len(ids), own, position + len(ids)))
                at += len(ids)
            return made(out)

        rows, held = [], 0
        for batch in batches:
            tokens = tokens or Tokens(tokenizer)
            for row in (tuple(c[i].as_py() for c in batch.columns) for i in range(batch.num_rows)):
                rows.append(row)
                held += len(row[4])
                if held > BATCH_CHARS:
                    yield flush(rows)
                    rows, held = [], 0
        if rows:
            yield flush(rows)
        if at:
            left = [{"depth": d, "start": s, "length": n} for d, s, n, _, _ in stack]
            yield made([(part, at, None, None, None, None, None, None, None, None, left)])

    return scan


def _parts(ends: list) -> list[tuple]:
    """For each partition the tokens before it and the ancestors its first node may have."""
    base, carried, out = 0, [], []
    for end in sorted(ends, key=lambda r: r.part):
        out.append((end.part, base, [(s, n) for s, n in carried]))
        depth = end.stack[0].depth
        carried = carried[:depth] + [(base + x.start, x.length) for x in end.stack]
        base += end["at"]
    return out


def _merged(intervals: Column) -> Column:
    """Intervals in order, those that touch as one."""
    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, F.lit(1), F.size(done) - 1),
                          F.array(F.struct(last["start"].alias("start"), x["end"].alias("end"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] == x["start"]), joined).otherwise(
            F.concat(done, F.array(x)))

    return F.aggregate(intervals, F.array().cast(_INTERVALS), add)


def write_packed(conversations: DataFrame, tokenizer: str, path: str) -> None:
    """Write ``conversations`` (conv_id, turn, role, text) to three tables below ``path``.

    ``nodes``: one row for each distinct beginning of a conversation, in depth-first order:
    start (place of its first token in the sequence), ids, loss_from and loss_to (which of
    them count for the loss: the texts of assistants), position (of the first token within
    its conversations), intervals (which earlier tokens it attends to besides its own).
    ``conversations``: conv_id and the node of the last turn. ``parts``: for each run of
    nodes, the nodes before it that it hangs from, so every run can be read alone.
    """
    spark = conversations.sparkSession
    turns = placed_turns(conversations)
    nodes, members = tree(prefixes(turns))
    members.write.parquet(f"{path}/conversations")
    order = [F.col("path").asc(), F.col("depth").asc()]
    full = nodes.join(turns.select("row", "role", "text"), "row")
    scanned = (full.repartitionByRange(*order).sortWithinPartitions(*order)
               .select("depth", "node", "conversations", "role", "text").mapInArrow(give_back(_scan(tokenizer)), _SCANNED))
    scanned = stored(scanned, "scanned")
    # One row for each partition, as long as a conversation is deep.
    ends = scanned.where("stack is not null").select("part", "at", "stack").collect()
    parts = spark.createDataFrame(_parts(ends), _PARTS)
    parts.write.parquet(f"{path}/parts")
    above = F.slice("carried", F.lit(1), F.col("missing"))
    before = F.transform(above, lambda x: F.struct(x["start"].alias("start"), (x["start"] + x["length"]).alias("end")))
    within = F.transform("intervals", lambda x: F.struct((x["start"] + F.col("base")).alias("start"),
                                                         (x["end"] + F.col("base")).alias("end")))
    done = scanned.where("stack is null").join(F.broadcast(parts), "part").select(
        "part", (F.col("base") + F.col("at")).alias("start"), "node", "conversations", "ids", "loss_from", "loss_to",
        (F.col("position") + F.aggregate(above, F.lit(0).cast("long"), lambda n, x: n + x["length"])).alias("position"),
        _merged(F.concat(before, within)).alias("intervals"))
    done.sortWithinPartitions("start").write.parquet(f"{path}/nodes")


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_NODES).parquet(f"{path}/nodes")


def per_token(nodes: DataFrame) -> DataFrame:
    """start, ids, position_ids, loss_mask and intervals: what a trainer takes."""
    n = F.size("ids")
    return nodes.select(
        "start", "ids", F.sequence("position", F.col("position") + n - 1).alias("position_ids"),
        F.transform(F.sequence(F.lit(0), n - 1), lambda i: ((i >= F.col("loss_from")) & (i < F.col("loss_to"))))
        .alias("loss_mask"), "intervals")


def read_conversations(spark: SparkSession, tokenizer: str, path: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from the
    files at ``path``. Digests are continued from node to node, so a shared turn is decoded
    once; positions and intervals that do not fit the tokens raise an error."""
    nodes = read_nodes(spark, path)
    carried = (spark.read.schema(_PARTS).parquet(f"{path}/parts")
               .select("part", F.explode("carried.start").alias("start")))
    # As many rows as there are parts, times the depth of a conversation.
    again = nodes.drop("part").join(checked_broadcast(carried, carried.count()), "start").withColumn("own", F.lit(False))
    rows = nodes.withColumn("own", F.lit(True)).unionByName(again)
    ordered = rows.repartition("part").sortWithinPartitions("part", "start").select(
        "part", "start", "node", F.when(F.col("own"), F.col("conversations")).otherwise(0).alias("conversations"),
        "ids", "loss_from", "loss_to", "position", "intervals")

    def read(batches):
        tokens, part, stack = None, None, []
        for batch in (whole.slice(at, BATCH_NODES) for whole in batches for at in range(0, whole.num_rows, BATCH_NODES)):
            tokens = tokens or Tokens(tokenizer)
            rows = list(zip(*(batch.column(i).to_pylist() for i in range(9))))
            out = []
            turns = tokens.decode([r[4] for r in rows])
            lost = [tokens.under_mask(r[4], r[5], r[6], inner) for r, (_, inner) in zip(rows, turns)]
            for (own, start, node, ending, ids, _, _, position, intervals), (mark, inner), loss in zip(rows, turns, lost):
                if own != part:
                    part, stack = own, []
                while stack and stack[-1][0] > position:
                    stack.pop()
                end, seen, n, every, chars, counted, shown = stack[-1] if stack else (
                    0, [], 0, hashlib.sha256(), 0, hashlib.sha256(), 0)
                if end != position or seen != [(x["start"], x["end"]) for x in intervals]:
                    raise ValueError(f"node {node} does not hang from what stands before it")
                role, text = parsed(mark, inner)
                every, counted, loss = every.copy(), counted.copy(), unescape(loss)
                every.update(f"{role}\n{text}\n".encode())
                counted.update(loss.encode())
                upto = start + len(ids)
                seen = [*seen[:-1], (seen[-1][0], upto)] if seen and seen[-1][1] == start else [*seen, (start, upto)]
                shown += len(MARKS[mark]) + len(inner) + len(MARKS[mark + 1])
                stack.append((position + len(ids), seen, n + 1, every, chars + len(loss), counted, shown))
                if ending:
                    out.append((node, n + 1, every.hexdigest(), chars + len(loss), counted.hexdigest(), shown))
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                             names=[c.split()[0] for c in _REPORT.split(", ")])

    members = spark.read.schema("conv_id long, node string").parquet(f"{path}/conversations")
    # One row for each distinct conversation; AQE splits conversations with many copies.
    return members.join(ordered.mapInArrow(give_back(read), _REPORT), "node").drop("node")


def round_trip(conversations: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Pack ``conversations`` and report them as read back, one row for each conv_id.

    Null texts and roles are empty; rows with a null conv_id are one conversation; null
    turns come first; equal turn numbers stand by role and digest of the text, repeated
    rows count as turns. An empty table gives no rows; other columns are not read.
    """
    spark = conversations.sparkSession
    path = path or scratch_path(spark, "chat")
    write_packed(conversations, tokenizer, path)
    return read_conversations(spark, tokenizer, path)
