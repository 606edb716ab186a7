"""Warehouse tables and the date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              bounds: tuple | None = None, partitions: int = 8, **options) -> DataFrame:
    """A database table, read in parallel when a partition column and its bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column and bounds:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(bounds[0])).option("upperBound", str(bounds[1]))
                  .option("numPartitions", str(partitions)))
    return reader.options(**options).load()


def date_dimension(bounds: DataFrame) -> DataFrame:
    """One row per day between ``first_date`` and ``last_date`` of a one-row frame.

    day_of_week counts from 0 = Sunday.
    """
    days = bounds.select(F.explode(F.sequence("first_date", "last_date")).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.quarter("date").alias("quarter"),
        (F.dayofweek("date") - 1).alias("day_of_week"),
    )


def date_range(df: DataFrame, date_col: str) -> DataFrame:
    """The one-row frame ``date_dimension`` takes, from the dates in use."""
    day = F.to_date(F.col(date_col))
    return df.agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"))
