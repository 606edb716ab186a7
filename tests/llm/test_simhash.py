import random
import re

import numpy as np
import pytest
import xxhash
from odd import documents, empty

from loomcart.llm import simhash as S


def brute_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits=4):
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= bits:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {f: find(f) for f in fps}


def brute(rows):
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    root = brute_components([f for _, f in fps])
    ids = {}
    for i, f in fps:
        if i is not None:
            ids[root[f]] = min(ids.get(root[f], i), i)
    return sorted(((i, f"{f:016x}", ids.get(root[f])) for i, f in fps), key=repr)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect() for _ in range(r.copies)), key=repr)


def signed(f):
    return f - (1 << 64) if f >> 63 else f


def edges_of(spark, fps, **options):
    classes = spark.createDataFrame([(signed(f),) for f in sorted(set(fps))], "fp long")
    edges = S.links(classes, len(set(fps)), **options)
    found = {r.fp & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in S.components(edges).collect()}
    return edges, found


def groups(root):
    out = {}
    for f, r in root.items():
        out.setdefault(r, set()).add(f)
    return sorted(map(sorted, out.values()))


def test_odd_rows(spark):
    docs = documents(spark)
    out = S.near_groups(docs)
    assert got(out) == brute([(r.doc_id, r.text) for r in docs.collect()])
    components = [r.component_id for r in out.where("kept").collect()]
    assert len(components) == len(set(components))


def test_empty_table(spark):
    assert got(S.near_groups(empty(spark))) == []


def test_planted_copies(spark):
    made = random.Random(5)
    rows = []
    for i in range(60):
        words = [f"w{made.randint(0, 5000)}" for _ in range(made.randint(3, 300))]
        rows.append((3 * i, " ".join(words)))
        words[made.randrange(len(words))] = "changed"
        rows.append((3 * i + 1, " ".join(words)))
        rows.append((3 * i + 2, rows[-1][1].upper()))
    assert got(S.near_groups(documents(spark, [(i, t, "s") for i, t in rows]))) == brute(rows)


@pytest.mark.parametrize("parts", [S.PARTS, (((31,), 1), ((31,), 1)), (((7, 7, 7), 0), ((7, 7, 7), 0), ((7, 7), 8))])
def test_every_pair_meets_at_an_anchor(parts):
    made = np.random.default_rng(2)
    a = made.integers(0, 2 ** 63, 300).astype(np.uint64) * np.uint64(2) + made.integers(0, 2, 300).astype(np.uint64)
    b = a.copy()
    for i in range(300):
        for bit in made.choice(64, i % 5, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    row, key, home = S.anchors(a, parts)
    homes = {(r, k) for r, k, h in zip(row, key, home) if h}
    row, key, home = S.anchors(b, parts)
    reached = {r for r, k, h in zip(row, key, home) if not h and (r, k) in homes}
    assert reached == set(range(300))


@pytest.mark.parametrize("hot", [4096, 5])
def test_dense_clusters_and_chains(spark, monkeypatch, hot):
    """Many fingerprints round one centre, chains of four-bit steps, and lone ones. The
    edges stay few where links are many."""
    monkeypatch.setattr(S, "HOT_HOMES", hot)
    monkeypatch.setattr(S, "PAIRS_AT_ONCE", 3000)
    made = random.Random(8)
    fps = {0, (1 << 64) - 1}
    centre = made.getrandbits(64)
    for _ in range(300):
        fps.add(centre ^ sum(1 << b for b in made.sample(range(64), 2)))
    at = made.getrandbits(64)
    for _ in range(40):
        at ^= sum(1 << b for b in made.sample(range(64), 4))
        fps.add(at)
    fps.update(made.getrandbits(64) for _ in range(200))
    want = brute_components(fps)
    edges, found = edges_of(spark, fps)
    assert groups({f: found.get(f, f) for f in fps}) == groups(want)
    if hot > 100:
        assert edges.count() < 20 * len(fps)


def test_long_chain(spark):
    """Components converge in few rounds whatever the order of a chain's values."""
    made = random.Random(1)
    nodes = made.sample(range(10 ** 6), 200)
    edges = spark.createDataFrame(list(zip(nodes, nodes[1:])), "fp long, root long")
    assert {r.root for r in S.components(edges).collect()} == {min(nodes)}
