"""Rolling z-scores against brute force, and the global numbering they rest on."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from loomcart.operators.anomaly import check_amounts, check_batch_sizes, rolling_zscore
from loomcart.operators.ranges import with_global_rank, with_row_index


def amounts(spark, values):
    return spark.createDataFrame(list(enumerate(map(float, values))), "seq int, amount double")


def alerts(spark, values, **options):
    rows = check_amounts(amounts(spark, values), ["seq"], **options).filter("is_alert").collect()
    return [(r.seq, r["_anomaly_alert"]) for r in rows]


def test_short_history(spark):
    assert alerts(spark, [100] * 5) == []


def test_outlier(spark):
    (seq, text), = alerts(spark, [100] * 20 + [10000], window_size=50, threshold=2.0)
    assert seq == 20 and text.startswith("ANOMALY: amount=10000.00 is 4.4 std deviations from mean=")


def test_small_step_after_a_constant_series(spark):
    assert [s for s, _ in alerts(spark, [100] * 20 + [105], window_size=50)] == [20]


@pytest.mark.parametrize("n, found", [(9, 0), (10, 0), (11, 1)])
def test_eleven_values_are_needed(spark, n, found):
    assert len(alerts(spark, [100] * (n - 1) + [1e6])) == found


def test_constant_series(spark):
    assert alerts(spark, [5] * 40) == []


def brute(values, size, keys=None):
    seen, result = {}, []
    for n, v in enumerate(values):
        past = seen.setdefault(keys[n] if keys else None, [])
        past.append(v)
        window = past[-size:]
        result.append((len(window), statistics.mean(window),
                       statistics.stdev(window) if len(window) > 1 else None))
    return result


def close(a, b):
    return a == b if a is None or b is None else abs(a - b) < 1e-6


@pytest.mark.parametrize("options", [{"block_rows": 37}, {"block_rows": 1000}, {"one_block": True}])
def test_blocks_against_brute_force(spark, options):
    rnd = random.Random(3)
    values = [round(rnd.expovariate(0.02), 2) for _ in range(700)]
    rows = rolling_zscore(amounts(spark, values), "amount", ["seq"], window_size=20, **options)
    got = [(r.window_count, r.window_mean, r.window_stdev) for r in rows.orderBy("seq").collect()]
    want = brute(values, 20)
    assert len(got) == len(want)
    assert all(close(x, y) for g, w in zip(got, want) for x, y in zip(g, w))


def test_keyed_blocks_with_a_hot_key(spark):
    rnd = random.Random(4)
    values = [round(rnd.uniform(1, 99), 2) for _ in range(600)]
    keys = ["hot" if rnd.random() < 0.5 else f"k{rnd.randrange(30)}" for _ in values]
    df = spark.createDataFrame([(n, k, v) for n, (k, v) in enumerate(zip(keys, values))],
                               "seq int, k string, amount double")
    rows = rolling_zscore(df, "amount", ["seq"], keys=["k"], window_size=15, block_rows=40)
    got = [(r.window_count, r.window_mean, r.window_stdev) for r in rows.orderBy("seq").collect()]
    assert all(close(x, y) for g, w in zip(got, brute(values, 15, keys)) for x, y in zip(g, w))


def test_batch_sizes(spark):
    def run(sizes):
        df = spark.createDataFrame(list(enumerate(sizes)), "batch_id int, batch_size long")
        return [r.batch_id for r in check_batch_sizes(df).filter("is_alert").collect()]
    assert run([500] * 4) == [] and run([500] * 5) == []
    assert run([500] * 11 + [90000]) == [11]


def test_row_index_and_rank(spark):
    rnd = random.Random(5)
    # A third of the rows share one value; some have none.
    values = [7 if rnd.random() < 0.34 else rnd.choice([None, *range(40)]) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(7)
    order = [F.col("v").desc_nulls_first(), F.col("id")]
    index = {r.id: r._index for r in with_row_index(df, order).collect()}
    ordered = sorted(range(500), key=lambda i: (values[i] is not None, -(values[i] or 0), i))
    assert index == {i: n for n, i in enumerate(ordered)}

    def rank(i):
        if values[i] is None:
            return 1
        return 1 + sum(v is None or v > values[i] for v in values)
    got = {r.id: r.place for r in with_global_rank(df, "v", ["id"], "place").collect()}
    assert got == {i: rank(i) for i in range(500)}


def test_blocks_are_dealt_over_tasks(spark):
    """Blocks are small in bytes, so Spark would put all of them into one task."""
    scored = rolling_zscore(amounts(spark, [n % 7 for n in range(2000)]), "amount", ["seq"], window_size=5, block_rows=50)
    places = scored.select("seq", F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(places) > 1 and sum(r["count"] for r in places) == 2000
