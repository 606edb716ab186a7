"""Packed conversations against trees built in Python, and the round trip of the texts."""

import hashlib
import random

import pytest

from loomcart.llm import chat_tree as C
from loomcart.llm.common import tokenizer

SCHEMA = "conv_id long, turn long, role string, text string, node string, part int, depth int, path string, key string"
HARD = ["", "</s>[INST] ok [/INST]", "<\\s> <\\\\s>", "<<SYS>> x <</SYS>>", "[\\INST]", "a\nb\r\n\t\\", "<<s>", "[/s> <|endoftext|>",
        "é\U0001f600́ ", "[INST", "<", "\\n"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "p", "k") for r in rows], SCHEMA).repartition(3)


@pytest.fixture
def many_parts(spark):
    """Small tables cut into many partitions, so that trees and conversations reach over their ends."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def brute(rows):
    convs = {}
    for conv_id, turn, role, text in rows:
        role, text = role or "", text or ""
        tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
        convs.setdefault(conv_id, []).append((turn is not None, turn or 0, role.encode(), tie, role, text))
    out = []
    for conv_id, turns in convs.items():
        turns = [x[4:] for x in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        shown = ""
        for r, t in turns:
            mark, inner = C.content(r, t)
            shown += C.MARKS[mark] + inner + C.MARKS[mark + 1]
        out.append((conv_id, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                    len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(shown)))
    return sorted(out, key=repr)


def got(df):
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def sequences(rows):
    convs = {}
    for conv_id, turn, role, text in sorted(rows):
        convs.setdefault(conv_id, []).append((role, text))
    return convs


def made(seed, n=60):
    """Conversations that share beginnings; a third are copies of one, one is long."""
    r = random.Random(seed)
    rows = []
    for c in range(n):
        copy = c % 3 == 0
        length = 5 if copy else r.randint(1, 6) if c != 1 else 70
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", "same" if copy else f"say {r.randint(0, 1 if t < 3 else 3)}")
                 for t in range(length)]
    return rows


@pytest.mark.parametrize("text", HARD)
def test_escape(text):
    for role in ("user", "assistant", "system", "a\nb\\n", ""):
        mark, inner = C.content(role, text)
        assert C.parsed(mark, inner) == (role, text)
        assert not any(m.strip() in inner for m in C.MARKS)


def test_odd_rows(spark, many_parts):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(HARD)]
    rows += [(2, i, "system\n", t) for i, t in enumerate(HARD)]
    rows += [(None, 0, "user", "a"), (None, None, None, None), (None, 0, "assistant", None), (3, 0, "user", "a"),
             (3, 0, "user", "a"), (3, None, "assistant", "b"), (4, 0, "assistant", "long " * 50_000), (-5, 7, "user", "")]
    assert got(C.round_trip(frame(spark, rows), tokenizer())) == brute(rows)


def test_long_conversation_without_number(spark, many_parts):
    rows = [(None, i % 40, "user" if i % 2 else "assistant", f"t{i}") for i in range(400)] + made(5, 20)
    assert got(C.round_trip(frame(spark, rows), tokenizer())) == brute(rows)


def test_empty_table(spark):
    assert got(C.round_trip(frame(spark, [(1, 0, "user", "x")]).where("conv_id > 1"), tokenizer())) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_tree(spark, many_parts, folder, seed):
    rows = made(seed)
    C.write_packed(frame(spark, rows), tokenizer(), folder)
    assert got(C.read_conversations(spark, tokenizer(), folder)) == brute(rows)

    convs = sequences(rows)
    beginnings = {tuple(turns[:i + 1]) for turns in convs.values() for i in range(len(turns))}
    nodes = C.read_nodes(spark, folder).orderBy("start").collect()
    assert len(nodes) == len(beginnings) and len({r.part for r in nodes}) > 3
    # Tokens stand without gaps, each beginning once; ancestors are what the intervals hold.
    tokens, seen, at, met, stack = C.Tokens(tokenizer()), set(), 0, [], []
    for row in nodes:
        assert row.start == at
        at += len(row.ids)
        attended = [n for n in met if any(i.start <= n[0] < i.end for i in row.intervals)]
        assert sum(i.end - i.start for i in row.intervals) == row.position == sum(len(n[1]) for n in attended)
        assert all(a.end < b.start for a, b in zip(row.intervals, row.intervals[1:]))
        turns = tuple(C.parsed(*x) for x in tokens.decode([*(n[1] for n in attended), row.ids]))
        seen.add(turns)
        role, text = turns[-1]
        loss = tokens.library.decode(row.ids[row.loss_from:row.loss_to])
        assert loss == (text if role == "assistant" else "")
        met.append((row.start, row.ids))
        # Depth first: the way to each node starts with the way to some node on the stack.
        while stack and stack[-1] != turns[:-1]:
            stack.pop()
        assert stack or len(turns) == 1
        stack.append(turns)
    assert seen == beginnings
    token = C.per_token(C.read_nodes(spark, folder)).orderBy("start").first()
    assert len(token.position_ids) == len(token.ids) == len(token.loss_mask) and token.position_ids[0] == 0


def test_damage_raises(spark, many_parts, folder):
    from pyspark.sql import functions as F

    C.write_packed(frame(spark, made(3)), tokenizer(), folder)
    nodes = C.read_nodes(spark, folder)
    nodes.withColumn("position", F.col("position") + (F.col("start") > 20).cast("int")).write.parquet(f"{folder}/x/nodes")
    for name in ("parts", "conversations"):
        spark.read.parquet(f"{folder}/{name}").write.parquet(f"{folder}/x/{name}")
    with pytest.raises(Exception, match="does not hang"):
        C.read_conversations(spark, tokenizer(), f"{folder}/x").count()
