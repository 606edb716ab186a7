import pytest
from odd import documents, empty
from pyspark.sql import functions as F

from loomcart.llm import mixing as M


def brute_targets(sizes):
    """sizes by source; pours the budget and shares what overflows until nothing does."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        left = budget - sum(2 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s for s in rest if share[s] > 2 * sizes[s] + 1e-9}
        if not over:
            return {**{s: 2.0 * sizes[s] for s in capped}, **share}
        capped |= over


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(i, " ".join(["w"] * (i % 7)), f"s{i % 11}" if i % 11 else None) for i in range(900)]
    rows += [(1000 + i, " ".join(["w"] * 40), "s1") for i in range(300)]
    docs = documents(spark, rows)
    return docs, M.mix(docs).collect()


def test_targets(mixed):
    _, out = mixed
    sizes, targets = {}, {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        targets[r.source] = r.target
        assert r.source_size >= r.size
    want = brute_targets(sizes)
    assert {s: pytest.approx(t) for s, t in want.items()} == targets
    assert all(r.source_size == sizes[r.source] for r in out)


def test_taken_is_near_the_target(mixed):
    _, out = mixed
    for source in {r.source for r in out}:
        own = [r for r in out if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
    assert all(0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in out)


def test_positions_follow_the_schedule(mixed):
    """A source whose weight falls stands earlier than one whose weight rises."""
    _, out = mixed
    assert [r.position for r in out] == sorted((r.position for r in out), key=lambda p: (p is not None, p))
    for source, slope in (("s1", -0.5), ("s10", 0.0), ("s2", 0.5)):
        placed = [p for r in out if r.source == source for p in r.positions]
        words = [r.size for r in out if r.source == source for _ in r.positions]
        early = sum(w for p, w in zip(placed, words) if p <= 0.5) / sum(words)
        assert early == pytest.approx((1 - slope) / 2 + slope / 4, abs=0.05)


def test_reruns_agree(spark, mixed):
    docs, out = mixed
    again = M.mix(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id, r.taken, r.position)
    assert sorted(map(key, again), key=repr) == sorted(map(key, out), key=repr)


def test_position_inverts_demand(spark):
    row = spark.range(1).select(*[M.position_at(F.lit(w), F.lit(100.0), F.lit(a)).alias(f"p{i}")
                                  for i, (w, a) in enumerate([(0.0, -0.5), (100.0, 0.5), (50.0, 0.0), (30.0, 0.4)])]).first()
    assert list(row)[:3] == [0.0, 1.0, 0.5]
    t = row[3]
    assert 0.6 * t + 0.4 * t * t == pytest.approx(0.3)


def test_odd_rows(spark):
    out = M.mix(documents(spark)).collect()
    assert len(out) == 14
    assert all(r.taken == 0 for r in out if r.size == 0)
    assert all(r.taken <= 2 * r.size for r in out)
    assert M.mix(empty(spark)).collect() == []


def test_only_empty_texts(spark):
    out = M.mix(documents(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [(r.size, r.taken, r.copies, r.position) for r in out] == [(0, 0, 0, None)] * 2
