"""Periodic runs of words: where a text says the same thing over and over.

A run is a longest stretch of consecutive words with smallest period q, at least
``LEAST_LENGTH`` words and ``LEAST_POWER`` periods long. Suffixes are put in order by
doubling the number of words they are compared by; places whose next words occur nowhere
else leave early. Then neighbours in that order are united by falling common prefix, as
Kruskal's algorithm takes edges. A class is a sorted list of places. Places a < b that
become neighbours in a class at prefix length l repeat with period b - a over b - a + l
words, and that is a run if it is long enough and the words before a and b differ. Were a
shorter period possible, a place between a and b would be in the class already.

Documents are taken one by one inside Spark's tasks; there is no shuffle.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_LENGTH = 6
LEAST_POWER = 4
# A run of period q repeats itself over length - q words: 5 words for q = 1, 6 at least else.
LEAST_PREFIX = LEAST_LENGTH - 1
HELD_CHARS = 8_000_000  # of texts that leave a task together

_WORD = re.compile("[^\x20\x09-\x0d]+")
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = ("doc_id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, "
        "collapsed string")


def _repeats(ids: np.ndarray) -> bool:
    """Whether some stretch of LEAST_PREFIX words may occur twice; never a false no."""
    n = len(ids) - LEAST_PREFIX + 1
    if n < 2:
        return False
    grams = ids[:n].astype(np.uint64)
    for k in range(1, LEAST_PREFIX):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + ids[k:k + n].astype(np.uint64)
    grams.sort()
    return bool((grams[1:] == grams[:-1]).any())


def _refined(rank: np.ndarray, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks by 2k words from ranks by k, and the places that still share theirs."""
    n = len(rank) - 1  # the last rank is 0, that of the end
    second = rank[np.minimum(places + k, n)]
    by = np.lexsort((second, rank[places]))
    places, second = places[by], second[by]
    first = rank[places]
    at = np.arange(len(places))
    group = np.maximum.accumulate(np.where(np.r_[True, first[1:] != first[:-1]], at, 0))
    fresh = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
    begin = np.maximum.accumulate(np.where(fresh, at, 0))
    refined = rank.copy()
    refined[places] = first + (begin - group)
    alone = fresh & np.r_[fresh[1:], True]
    return refined, places[~alone]


def neighbours(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of places that follow each other in the order of suffixes, and how many words
    the two suffixes share; pairs that share fewer than LEAST_PREFIX are left out."""
    n = len(ids)
    _, which, counts = np.unique(ids, return_inverse=True, return_counts=True)
    starts = np.r_[0, np.cumsum(counts)[:-1]] + 1
    rank = np.r_[starts[which], 0].astype(np.int32)
    places = np.flatnonzero(counts[which] > 1)
    ranks, k, kept = [rank], 1, places
    while len(places):
        rank, places = _refined(rank, places, k)
        ranks.append(rank)
        k *= 2
        if k <= LEAST_PREFIX:
            kept = places
    order = kept[np.argsort(rank[kept])]
    a, b = order[:-1], order[1:]
    shared = np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        same = ranks[level][np.minimum(a + shared, n)] == ranks[level][np.minimum(b + shared, n)]
        shared += same.astype(np.int64) << level
    long = shared >= LEAST_PREFIX
    return a[long], b[long], shared[long]


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period. ``ids`` are numbers
    that are equal where words are."""
    if not _repeats(ids):
        return []
    left, right, shared = neighbours(ids)
    by = np.argsort(-shared, kind="stable")
    words = ids.tolist()
    root: dict[int, int] = {}
    classes: dict[int, list[int]] = {}
    runs = []

    def find(place: int) -> int:
        top = place
        while (above := root.setdefault(top, top)) != top:
            top = above
        while root[place] != top:
            root[place], place = top, root[place]
        return top

    for a, b, prefix in zip(left[by].tolist(), right[by].tolist(), shared[by].tolist()):
        a, b = find(a), find(b)
        some, other = classes.pop(a, None) or [a], classes.pop(b, None) or [b]
        if len(some) > len(other):
            a, b, some, other = b, a, other, some
        root[a] = b
        classes[b] = other
        for place in some:
            insort(other, place)
        reach = prefix // (LEAST_POWER - 1)
        # Neighbours that come from the same class were neighbours before.
        for before, place, after in zip([-1, *some], some, [*some[1:], -1]):
            at = bisect_left(other, place)
            pairs = []
            if at and other[at - 1] != before:
                pairs.append((other[at - 1], place))
            if at + 1 < len(other) and other[at + 1] != after:
                pairs.append((place, other[at + 1]))
            for i, j in pairs:
                period = j - i
                if (period <= reach and period + prefix >= LEAST_LENGTH
                        and (i == 0 or words[i - 1] != words[j - 1])):
                    runs.append((i, period + prefix, period))
    return sorted(set(runs))


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """``words`` without those that a run holds behind its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def plant(doc_id: int | None, words: list[str]) -> list[str]:
    """The test rule of the contract: in one of ten documents, the words from some place on
    become periodic. A null doc_id leaves the words as they are."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % period] for i in range(n - a)]


def periodic_runs(docs: DataFrame, edit=None) -> DataFrame:
    """doc_id, n_words, runs and collapsed text of every row of ``docs``, from the whole text.

    ``edit(doc_id, words)`` may change the words first. Null and empty texts have no words,
    no runs and an empty collapsed text; rows that share a doc_id are taken one by one; an
    empty table gives no rows; other columns are not read. A task holds one text and its
    ranks at a time: four bytes a word for each doubling up to the longest repetition.
    """
    def found(batches):
        out, held = ([], [], [], []), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_string())):
                words = _WORD.findall(text.as_py() or "")
                if edit:
                    words = edit(doc_id, words)
                numbers: dict[str, int] = {}
                ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
                runs = find_runs(ids)
                collapsed = " ".join(collapse(words, runs))
                for column, value in zip(out, (doc_id, len(words), [dict(zip(("start", "length", "period"), r))
                                                                    for r in runs], collapsed)):
                    column.append(value)
                held += len(collapsed)
                if held > HELD_CHARS:
                    yield made(out)
                    out, held = ([], [], [], []), 0
        yield made(out)

    def made(out):
        kinds = (pa.int64(), pa.int64(), pa.list_(_RUN), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)],
                                          names=["doc_id", "n_words", "runs", "collapsed"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(found, _OUT)


def report(found: DataFrame) -> DataFrame:
    """Counts, the longest run and digests of what ``periodic_runs`` returns."""
    order = F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run")))
    longest = F.array_max(order)["run"]
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n"))))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"),
        F.col("longest.length").alias("length"), F.col("longest.period").alias("period"),
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
