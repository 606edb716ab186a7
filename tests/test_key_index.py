"""The key index against a plain scan: many batches, lost and broken indexes, files read."""

import random

from pyspark.sql import functions as F

from loomcart.operators import sinks
from loomcart.operators.key_index import FOLDER, KeyIndex
from loomcart.session import folder_names, remove_path

SMALL = dict(bucket_keys=300, page_keys=32, fan=3)


def put(spark, path, numbers):
    rows = spark.createDataFrame([(f"k{n}", n) for n in numbers], "key string, n long")
    rows.coalesce(1).write.mode("append").parquet(path)


def wanted(spark, names):
    return spark.createDataFrame([(n,) for n in names], "key string")


def names(found):
    return sorted(r.key for r in found.keys.collect())


def test_many_batches(spark, folder):
    """Segments stay few, and every look-up finds what a scan finds."""
    made, held = random.Random(1), set()
    for batch in range(11):
        numbers = made.sample(range(100_000), 120)
        put(spark, folder, [n for n in numbers if n not in held])
        held.update(numbers)
        index = KeyIndex(spark, folder, "key", **SMALL)
        asked = made.sample(sorted(held), 40) + [n + 1 for n in numbers[:40]]
        found = index.lookup(wanted(spark, {f"k{n}" for n in asked}))
        assert names(found) == sorted({f"k{n}" for n in asked if n in held})
    _, segments = index.segments()
    assert len(segments) <= 6 and max(s["buckets"] for s in segments) > 1
    assert sum(s["keys"] for s in segments) == len(held)
    left = [n for n in folder_names(spark, index.path) if n.startswith("segment-")]
    assert len(left) <= 2 * len(segments) + 1


def test_a_small_batch_reads_its_own_buckets(spark, folder):
    """500 keys of which five are known: few of 128 buckets of keys are read."""
    spark.range(60_000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("n")).write.parquet(folder)
    index = KeyIndex(spark, folder, "key", bucket_keys=500)
    index.catch_up()
    _, (segment,) = index.segments()
    assert segment["buckets"] == len(segment["filled"]) == 128
    found = index.lookup(wanted(spark, [f"k{n}" for n in range(5)] + [f"strange{n}" for n in range(495)]))
    assert names(found) == [f"k{n}" for n in range(5)]
    assert 1 <= len(found.buckets_read) <= 5 + 8
    files = {f.rsplit("/", 1)[0].rsplit("bucket=", 1)[1] for f in index._read_keys(found.buckets_read, "string").inputFiles()}
    assert files == {p.rsplit("bucket=", 1)[1] for p in found.buckets_read}
    assert index.lookup(wanted(spark, ["k7"])).filters_read.__len__() == 1


def test_lost_and_outdated_indexes_are_built_again(spark, folder):
    put(spark, folder, range(100))
    index = KeyIndex(spark, folder, "key", **SMALL)
    keys = wanted(spark, ["k1", "k150", "no"])
    assert names(index.lookup(keys)) == ["k1"]
    remove_path(spark, f"{folder}/{FOLDER}")
    assert names(index.lookup(keys)) == ["k1"]
    # A batch whose run broke off after its rows were written.
    put(spark, folder, range(100, 200))
    assert names(index.lookup(keys)) == ["k1", "k150"]
    # The table is replaced: what it held before counts no more.
    spark.createDataFrame([("k150", 1)], "key string, n long").write.mode("overwrite").parquet(folder)
    assert names(index.lookup(keys)) == ["k150"]
    assert spark.read.parquet(folder).count() == 1


def test_broken_off_segments_do_not_count(spark, folder):
    put(spark, folder, range(50))
    index = KeyIndex(spark, folder, "key", **SMALL)
    index.catch_up()
    spark.createDataFrame([("stray",)], "key string").write.parquet(f"{index.path}/segment-broken/keys/bucket=0")
    assert names(index.lookup(wanted(spark, ["stray", "k3"]))) == ["k3"]
    put(spark, folder, [77])
    index.catch_up()
    assert "segment-broken" not in folder_names(spark, index.path)


def test_rewritten_files_are_adopted(spark, folder):
    put(spark, folder, range(10))
    put(spark, folder, range(10, 20))
    index = KeyIndex(spark, folder, "key", **SMALL)
    index.catch_up()
    before = index.data_files()
    rows = spark.createDataFrame(spark.read.parquet(folder).collect())
    rows.coalesce(1).write.mode("append").parquet(folder)
    for name in before:
        remove_path(spark, f"{folder}/{name}")
    index.adopt(sorted(index.data_files() - before), sorted(before))
    version, segments = index.segments()
    assert names(index.lookup(wanted(spark, ["k3", "k33"]))) == ["k3"]
    assert index.segments() == (version, segments)  # nothing was indexed again


def test_insert_ignore_leaves_the_target_alone(spark, folder):
    """The rows of the target are not needed to skip its keys."""
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "event_id string, x int")
    sinks.insert_ignore(rows, folder)
    assert sinks.insert_ignore(rows.union(spark.createDataFrame([("c", 3)], rows.schema)), folder) == {
        "inserted": 1, "skipped": 2}
    index = KeyIndex(spark, folder, "event_id")
    found = index.lookup(spark.createDataFrame([("a",), ("z",)], "event_id string"))
    assert [r.event_id for r in found.keys.collect()] == ["a"]
    assert all(FOLDER in f for f in found.keys.inputFiles())


def test_empty_table_and_no_keys(spark, folder):
    index = KeyIndex(spark, folder, "key")
    assert names(index.lookup(wanted(spark, ["a"]))) == []
    put(spark, folder, [1])
    assert names(index.lookup(wanted(spark, ["a"]).limit(0))) == []
