"""Manifests against trees built one by one in Python."""

import hashlib
from collections import defaultdict

import pytest
from odd import documents, empty
from pyspark.sql import functions as F

from loomcart.llm import merkle as M


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def grow(nodes, width):
    """The root, and what stands beside each of ``nodes`` level by level."""
    beside, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, place in enumerate(at):
            run = place - place % width
            beside[i].append((level[run:place], level[place + 1:run + width]))
        at = [place // width for place in at]
        level = [H(*level[i:i + width]) for i in range(0, len(level), width)]
    return level[0], beside


def brute(rows, width, group="lang"):
    groups = defaultdict(list)
    for r in rows:
        groups[getattr(r, group)].append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r.doc_id))
    names = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    trees = {g: grow([x[2] for x in sorted(groups[g])], width) for g in names}
    root, tops = grow([trees[g][0] for g in names], width)
    out = []
    for g, top in zip(names, tops):
        for (_, _, digest, doc_id), beside in zip(sorted(groups[g]), trees[g][1]):
            proof = H(*["".join(b + a) for b, a in beside + top])
            out.append((doc_id, digest, trees[g][0], root, proof))
    return sorted(out, key=repr)


def got(found):
    out = found.select("doc_id", *[M.as_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
                       M.proof_digest(F.col("path")).alias("proof"))
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("width", [2, 8])
def test_odd_rows(spark, width):
    docs = documents(spark)
    rows = docs.collect()
    found = M.manifest(docs, width=width)
    assert got(found) == brute(rows, width)
    # By source: groups of several sizes, one of them null.
    assert got(M.manifest(docs, group="source", width=width)) == brute(rows, width, "source")


@pytest.mark.parametrize("n", [1, 8, 9, 65, 600])
def test_sizes(spark, n):
    docs = documents(spark, [(i, f"t{i}", "s") for i in range(n)])
    found = M.manifest(docs)
    assert got(found) == brute(docs.collect(), 8)
    assert found.where(M.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0


def test_every_change_shows(spark):
    docs = documents(spark, [(i, f"Text {i}", "ab"[i % 2]) for i in range(70)])
    for change in ({"text": F.lower("text")}, {"n_chars": F.col("n_chars") + 1}, {"source": F.lit(None).cast("string")}):
        fields = [change.get(f, F.col(f)) for f in M.FIELDS]
        found = M.manifest(docs, carry={"now": M.leaf_digest(fields)})
        assert found.where(M.fold(F.col("now"), F.col("path")) == F.col("root")).count() == 0


def test_null_is_not_empty(spark):
    docs = documents(spark, [(1, None, "s"), (1, "", "s"), (1, "-", "s")])
    assert len({r[1] for r in got(M.manifest(docs))}) == 3


def test_empty_table(spark):
    assert got(M.manifest(empty(spark))) == []


def test_large_groups_shuffle(spark, monkeypatch):
    """Rows of a tree are looked up the same way when trees are too many to broadcast."""
    monkeypatch.setattr(M, "lookup_join", lambda *a: __import__(
        "loomcart.functions.joins", fromlist=["x"]).lookup_join(*a, limit=0))
    docs = documents(spark, [(i, f"t{i}", "s") for i in range(30)])
    assert got(M.manifest(docs)) == brute(docs.collect(), 8)
