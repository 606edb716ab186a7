"""Periodic runs against a brute-force search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from odd import documents, empty

from loomcart.llm import periodic as P


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                found.setdefault((i, length), q)  # periods rise: the first is the smallest
            i = j + 1 if j > i else i + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def brute(doc_id, text):
    words = re.findall("[^ \t\n\x0b\x0c\r]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = [hashlib.sha256(x.encode()).hexdigest()
           for x in ("".join("%d,%d,%d\n" % r for r in runs), " ".join(kept))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_words(seed):
    made = random.Random(seed)
    for _ in range(300):
        parts = []
        for _ in range(made.randint(1, 4)):
            unit = [made.randint(0, made.choice([1, 2, 5, 50])) for _ in range(made.randint(1, 7))]
            parts += unit * made.randint(1, 8) + unit[:made.randint(0, len(unit))]
        assert P.find_runs(np.array(parts)) == brute_runs(parts)


def test_runs_within_runs():
    inner = [0] * 6 + [1]
    words = [7] + (inner * 4 + [2]) * 5 + inner
    assert P.find_runs(np.array(words)) == brute_runs(words)


def test_one_word_over_and_over():
    assert P.find_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]


def test_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    rows += [(30 + i, t) for i, t in enumerate([
        "a a a a a", "a a a a a a", "a b a b a b a b", "a b a b a b a", "x " + "a b c " * 4, "a b " * 6, "A a " * 3])]
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    want = sorted((brute(i, t) for i, t in rows if len(t or "") < 10_000), key=repr)
    out = got(P.report(P.periodic_runs(docs, P.plant)))
    assert [r for r in out if r[0] not in (7, 8)] == want
    assert len(out) == len(rows)
    long = next(r for r in P.periodic_runs(docs).collect() if r.doc_id == 7)
    assert [tuple(r) for r in long.runs] == [(0, 60_000, 977)] and long.collapsed.split()[-1] == "word976"


def test_empty_table(spark):
    assert got(P.report(P.periodic_runs(empty(spark), P.plant))) == []


def test_query(spark):
    """The registered query over a whole table; texts of over 2,000 words are left to the
    tests above, the search here being quadratic."""
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    out = {r[0]: r for r in got(entry.queries()["op13_periodic_runs"](spark, sf))}
    assert len(out) == len(rows)
    for doc_id, text in rows:
        if len((text or "").split()) <= 2000:
            assert out[doc_id] == brute(doc_id, text)
