import hashlib
import random
import re

from odd import documents, empty

from loomcart.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, size=13, share=20):
    windows = {}
    for item, text in items:
        w = split(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for doc_id, text in rows:
        w, hit, met = split(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    met |= owners
        named = ",".join(sorted(str(m) for m in met if m is not None))
        count = len(named.split(",")) if named else 0
        out.append((doc_id, len(w), len(hit), count, hashlib.sha256(named.encode()).hexdigest(),
                    bool(hit) and share * len(hit) >= len(w)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)


def items_of(spark, items):
    return spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, term_id int")


def test_random_texts(spark):
    made = random.Random(4)
    vocabulary = ["a", "b", "the", "zebra", "été", "7", "of"]
    items = [(i, " ".join(made.choice(vocabulary) for _ in range(made.choice([1, 3, 13, 14, 30])))) for i in range(12)]
    items += [(100, items[3][1]), (101, None), (102, ""), (103, "never seen words"), (None, "a b the")]
    rows = []
    for i in range(60):
        words = [made.choice(vocabulary + ["filler", "other"]) for _ in range(made.randint(0, 60))]
        if i % 3 == 0:
            words[5:5] = items[i % 12][1].split() if i % 2 else items[i % 12][1].upper().replace("É", "é").split()
        rows.append((i, ", ".join(words)))
    rows += [(1, rows[1][1]), (1, "another text with one id"), (None, items[2][1]), (70, None)]
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    assert got(D.contamination(docs, items_of(spark, items))) == brute(rows, items)


def test_odd_rows(spark):
    docs = documents(spark)
    items = [(1, "beta gamma delta"), (2, "word0 word1 word2 word3 word4 word5 word6 word7 word8 word9 word10 word11 word12 word13")]
    assert got(D.contamination(docs, items_of(spark, items))) == brute([(r.doc_id, r.text) for r in docs.collect()], items)


def test_empty_tables(spark):
    assert got(D.contamination(empty(spark), items_of(spark, [(1, "a b")]))) == []
    out = D.contamination(documents(spark), items_of(spark, [])).collect()
    assert len(out) == 14 and not any(r.contaminated or r.n_items for r in out)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    """Beyond the broadcast limit every join shuffles; the rows stay."""
    monkeypatch.setattr("loomcart.llm.common.BROADCAST_ROWS", 0)
    rows = [(i, "x y z one two three four" if i % 2 else "nothing here") for i in range(20)]
    items = [(1, "one two three"), (2, "three four")]
    assert got(D.contamination(documents(spark, [(i, t, "s") for i, t in rows]), items_of(spark, items))) == brute(rows, items)


def test_proximity(spark):
    """Words of a phrase may be displaced by up to the reach."""
    docs = documents(spark, [(1, "red green blue", "s"), (2, "red one green blue", "s"), (3, "blue green red", "s"),
                             (4, "red one two three green blue", "s")])
    terms = spark.createDataFrame([("red", 1), ("green", 2), ("blue", 3)], "term string, term_id int")
    index = D.build_index(docs, terms, 3)
    phrase = spark.createDataFrame([(0, 0, 1), (0, 1, 2), (0, 2, 3)], "phrase_id int, offset int, term_id int")
    ids = {r.row_id: r.doc_id for r in index.where("term_id = 0").collect()}

    def found(reach):
        return {ids[r.row_id] for r in D.lookup(index, phrase, reach).collect()}

    assert found(0) == {1}
    assert found(1) == {1, 2}
    assert found(3) == {1, 2, 4}
    assert found(4) == {1, 2, 3, 4}
