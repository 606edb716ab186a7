import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from odd import documents, empty

from loomcart.llm import exact_dedup as E


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate({ord(c): None for c in " \t\n\x0b\x0c\r"})].append((i, t or ""))
    out = []
    for norm, members in groups.items():
        longest = max(len(t) for _, t in members)
        ids = [i for i, t in members if len(t) == longest and i is not None]
        keep = min(ids) if ids else None
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, keep, len(members), i == keep, sha) for i, _ in members]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_odd_rows(spark):
    docs = documents(spark)
    assert got(E.dedup(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark):
    assert got(E.dedup(empty(spark))) == []


def test_hot_digest_is_split(spark, monkeypatch):
    monkeypatch.setattr(E, "HOT_ROWS", 10)
    rows = [(i, "same text") for i in range(95)] + [(i, f"t{i % 40}") for i in range(95, 200)]
    assert got(E.dedup(documents(spark, [(i, t, "s") for i, t in rows]))) == brute(rows)


def test_history(spark):
    """Known texts point at the history's locator; the others group among themselves."""
    old = E.classes(E.digest_rows(documents(spark, [(1, "old one", "s"), (2, "old two", "s")])))
    new = documents(spark, [(10, "oldone", "s"), (11, "new", "s"), (12, "n e w", "s"), (13, "old two", "s")])
    out = {r.doc_id: (r.member, r.keep_id, r.kept) for r in E.dedup(new, old).collect()}
    assert out == {10: (True, 1, False), 13: (True, 2, False), 11: (False, 12, False), 12: (False, 12, True)}


@pytest.mark.parametrize("n", [0, 1, 2, 77, 5000])
def test_hash_is_minimal_and_perfect(n):
    words = np.random.default_rng(n).integers(0, 2 ** 63, (n, 4)).astype(np.uint64)
    sizes, bits, slots = E.build_hash(words)
    assert sorted(slots) == list(range(n))
    assert (E.find_slots(words, sizes, bits) == slots).all()


def test_equal_digests_in_a_shard_are_refused():
    with pytest.raises(ValueError):
        E.build_hash(np.ones((2, 4), np.uint64))


def test_random_tables(spark):
    made = random.Random(3)
    rows = [(i, "".join(made.choice("ab \n") for _ in range(made.randint(0, 5)))) for i in range(400)]
    assert got(E.dedup(documents(spark, [(i, t, "s") for i, t in rows]))) == brute(rows)


def test_groups_are_bounded(spark, monkeypatch):
    """Rows without repeats are dealt over as many groups as they need, and so are the rows
    of a hot digest whose ids are all null."""
    monkeypatch.setattr(E, "SHARD_KEYS", 20)
    monkeypatch.setattr(E, "HOT_ROWS", 25)
    plain = E._lookup
    rows = [(i, f"text {i}", "s") for i in range(2000)] + [(None, "hot", "s")] * 600

    def bounded(left, right):
        if len(left) > 100:
            raise ValueError(f"a group of {len(left)} rows")
        return plain(left, right)

    monkeypatch.setattr(E, "_lookup", bounded)
    out = got(E.dedup(documents(spark, rows)))
    assert out == brute([(i, t) for i, t, _ in rows])


def test_both_parts_work_through_the_hash(spark):
    """The longest copy may stand in either part; members are found by lookups."""
    made = random.Random(9)
    rows = [(i, " " * made.randint(0, 9) + f"t{i % 150}", "s") for i in range(600)]
    docs = documents(spark, rows)
    out = E.dedup(docs)
    assert got(out) == brute([(i, t) for i, t, _ in rows])
    assert out.where("member").count() > 500 and out.where("not member").count() > 0
