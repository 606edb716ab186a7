import zlib

import numpy as np
import pytest
from odd import documents, empty

from loomcart.llm import quality as Q

SF = "/root/testdata/sf0.01"


def labels_of(spark, rows):
    return spark.createDataFrame([(i, q, 0) for i, q in rows], "doc_id long, quality int, text int")


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return Q.scored(docs, labels).toPandas(), labels.toPandas()


def test_held_out_accuracy(scored):
    out, labels = scored
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.3)).all()
    held = out[out.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.95


def test_held_out_labels_do_not_matter(spark, scored):
    out, _ = scored
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", (Q.held_out(labels["doc_id"])).cast("int"))
    mixed = labels.where(~Q.held_out(labels["doc_id"])).union(turned.where(Q.held_out(turned["doc_id"])))
    again = Q.scored(docs, mixed).toPandas().set_index("doc_id").score
    assert np.allclose(again, out.set_index("doc_id").score.reindex(again.index), atol=1e-3)


def test_odd_rows(spark):
    good = [(100 + i, "a plain sentence about things number " + str(i), "s") for i in range(30)]
    bad = [(200 + i, "!!! ### $$$ " * 3 + str(i), "s") for i in range(30)]
    docs = documents(spark).unionByName(documents(spark, good + bad))
    labels = labels_of(spark, [(i, 1) for i, _, _ in good] + [(i, 0) for i, _, _ in bad] + [(None, 1), (5, None), (6, 0), (6, 1)])
    out = Q.scored(docs, labels).collect()
    assert len(out) == 74 and all(0 <= r.score <= 1 for r in out)
    assert not any(r.held_out for r in out if r.doc_id is None)
    assert np.mean([r.predicted == 0 for r in out if r.doc_id and r.doc_id >= 200]) > 0.8


def test_without_labels_or_documents(spark):
    none = labels_of(spark, [])
    assert {r.score for r in Q.scored(documents(spark), none).collect()} == {0.5}
    assert Q.scored(empty(spark), none).collect() == []
    one = labels_of(spark, [(i, 1) for i in range(10)])
    assert {r.score for r in Q.scored(documents(spark), one).collect()} == {1.0}


def test_vectors_are_those_of_a_plain_count(spark):
    texts = ["a b c a b", "b c d", "d d a", ""]
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    places, signs = Q.index_vectors()
    index = np.zeros((Q.WORD_SLOTS, Q.DIMS))
    np.put_along_axis(index, places, signs, axis=1)
    total = np.zeros_like(index)
    for text in texts:
        ids = Q.Slots()(text)
        for i, a in enumerate(ids):
            for j, b in enumerate(ids):
                if 0 < abs(i - j) <= Q.NEIGHBOURS:
                    total[a] += index[b]
    unit = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
    got = Q.word_vectors(docs)
    weight = got[:, -1:]
    assert np.allclose(got[:, :Q.DIMS] / weight, unit, atol=1e-5)


def test_temperature_calibrates():
    made = np.random.default_rng(0)
    x = made.normal(size=(2000, 5))
    y = (made.random(2000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = Q.Network(x, y, np.arange(2000) % 5 == 0)
    score = net.score(x)
    for low in (0.1, 0.4, 0.7):
        rows = (score >= low) & (score < low + 0.2)
        assert abs(y[rows].mean() - score[rows].mean()) < 0.1
