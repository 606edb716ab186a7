"""How rows are dealt out to tasks."""

from pyspark.sql import functions as F

from loomcart.session import configure, spread


def test_rows_are_dealt_out_though_files_have_many_parts(spark, folder):
    """One row group is one task's work, into however many parts its file is cut."""
    path = f"{folder}-one"
    spark.range(120_000).coalesce(1).write.parquet(path)
    cut = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        table = spark.read.parquet(path)
        assert table.rdd.getNumPartitions() >= 8
        for rows in (spread(table, table.count()), spread(table, 1_000_000)):
            sizes = rows.groupBy(F.spark_partition_id()).count().collect()
            assert max(r["count"] for r in sizes) <= 2 * 120_000 / len(sizes) and len(sizes) >= 8
        assert spread(table, 1_000_000).rdd.getNumPartitions() == 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", cut)


def test_no_stage_is_too_long_to_be_compiled(spark):
    """HotSpot leaves methods above 8,000 bytes to its interpreter, also in sessions somebody else built."""
    other = spark.newSession()
    other.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    assert int(configure(other).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
