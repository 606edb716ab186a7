"""One layout of the events table for its several access paths.

Rows of a day are sorted along a space-filling curve: the bits of the time of day, of the
type and of the user take turns, so rows that are near in any of them tend to be near in
the files. Bloom filters of users and sessions, the dictionary of types and the statistics
of times then let a read skip row groups whichever of them it asks for. Days that hold
most rows become many files.

Small files of a folder are merged by writing new ones beside it and changing places.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from loomcart.operators.key_index import FOLDER, KeyIndex
from loomcart.session import commit_text, folder_names, path_exists, read_text, remove_path

CURVE_BITS = 8  # of each dimension
BLOOM_COLUMNS = ("user_id", "session_id")
JOURNAL = "_compaction"
MOST_FILES = 16  # of a folder before its files are merged
FILE_BYTES = 256 << 20


def curve(dimensions: list[Column], bits: int = CURVE_BITS) -> Column:
    """Place along the curve: the lowest ``bits`` of every dimension, interleaved."""
    n = len(dimensions)
    parts = [F.shiftleft(F.shiftright(d, b).bitwiseAND(F.lit(1)), b * n + i)
             for i, d in enumerate(dimensions) for b in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def _hashed(name: str) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(1 << CURVE_BITS)).cast("bigint")


def arranged(events: DataFrame, partitions: int | None = None) -> DataFrame:
    """Events with their day, range-partitioned and sorted along the curve."""
    ts = F.col("timestamp").cast("timestamp")
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    time = F.floor(seconds * (1 << CURVE_BITS) / F.lit(86_400)).cast("bigint")
    placed = events.withColumns({
        "event_date": F.to_date("timestamp"), "_curve": curve([_hashed("event_type"), _hashed("user_id"), time])})
    order = ["event_date", "_curve"]
    spread = placed.repartitionByRange(partitions, *order) if partitions else placed.repartitionByRange(*order)
    return spread.sortWithinPartitions(*order, "timestamp").drop("_curve")


def writer(events: DataFrame, row_group_bytes: int | None = None, partitions: int | None = None) -> DataFrameWriter:
    """How events are written, wherever they are: by day, along the curve, with filters."""
    out = arranged(events, partitions).write.partitionBy("event_date")
    for column in BLOOM_COLUMNS:
        out = out.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return out.option("parquet.block.size", str(row_group_bytes)) if row_group_bytes else out


def _rename(spark: SparkSession, source: str, target: str) -> None:
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    if not a.getFileSystem(spark._jsc.hadoopConfiguration()).rename(a, b):
        raise OSError(f"{source} could not be moved to {target}")


def data_files(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in folder_names(spark, folder) if not n.startswith(("_", "."))]


def compact(spark: SparkSession, table: str, folder: str = "", key: str | None = None, most_files: int = MOST_FILES,
            arrange=None) -> bool:
    """Merge the data files of ``folder`` (such as ``event_date=2024-01-01``) of a Parquet
    table, if there are more than ``most_files``; returns whether there were.

    The new files are complete before they take the old ones' place, by two renames. A run
    that breaks off between them is taken up by ``recover``. A reader that began before
    the change may miss files and fail, but gets no wrong rows; whoever reads later sees
    the new files. The key index of ``key`` goes on covering the rows. One writer at a time.
    """
    place = f"{table}/{folder}".rstrip("/")
    old = data_files(spark, place)
    if len(old) <= most_files:
        return False
    journal = f"{table}/{JOURNAL}/{uuid.uuid4().hex}"
    rows = spark.read.parquet(*[f"{place}/{n}" for n in old])
    if key and path_exists(spark, f"{table}/{FOLDER}/{key}"):
        # The index must cover the old files before it takes the new ones for them.
        KeyIndex(spark, table, key).catch_up(rows.schema[key].dataType.simpleString())
    size = sum(_bytes(spark, f"{place}/{n}") for n in old)
    files = max(1, -(-size // FILE_BYTES))
    merged = arrange(rows, files) if arrange else rows.repartition(files) if files > 1 else rows.coalesce(1)
    merged.write.parquet(f"{journal}/new")
    commit_text(spark, f"{journal}/ready", f"{folder}\n{key or ''}")
    _finish(spark, table, journal)
    return True


def _bytes(spark: SparkSession, path: str) -> int:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen()


def _finish(spark: SparkSession, table: str, journal: str) -> None:
    """Carry out a merge whose new files are complete, from wherever it stopped."""
    folder, key = read_text(spark, f"{journal}/ready").split("\n")
    place = f"{table}/{folder}".rstrip("/")
    if folder:
        if not path_exists(spark, f"{journal}/old"):
            _rename(spark, place, f"{journal}/old")
        if path_exists(spark, f"{journal}/new"):
            _rename(spark, f"{journal}/new", place)
        added, removed = data_files(spark, place), data_files(spark, f"{journal}/old")
    else:  # a table without folders stays where it is; its files change places one by one
        added = data_files(spark, f"{journal}/new") if path_exists(spark, f"{journal}/new") else []
        if not path_exists(spark, f"{journal}/list"):
            commit_text(spark, f"{journal}/list", "\n".join([*data_files(spark, place), "", *added]))
        before, _, names = read_text(spark, f"{journal}/list").partition("\n\n")
        removed, added = before.split("\n"), names.split("\n")
        spark._jvm.org.apache.hadoop.fs.Path(place).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(
            spark._jvm.org.apache.hadoop.fs.Path(f"{journal}/old"))
        for n in removed:
            if path_exists(spark, f"{place}/{n}"):
                _rename(spark, f"{place}/{n}", f"{journal}/old/{n}")
        for n in added:
            if path_exists(spark, f"{journal}/new/{n}"):
                _rename(spark, f"{journal}/new/{n}", f"{place}/{n}")
    if key and path_exists(spark, f"{table}/{FOLDER}/{key}"):
        prefix = f"{folder}/" if folder else ""
        KeyIndex(spark, table, key).adopt([prefix + n for n in added], [prefix + n for n in removed])
    remove_path(spark, journal)


def recover(spark: SparkSession, table: str) -> None:
    """Finish merges that broke off after their new files were complete; drop the others."""
    for name in folder_names(spark, f"{table}/{JOURNAL}"):
        journal = f"{table}/{JOURNAL}/{name}"
        if path_exists(spark, f"{journal}/ready"):
            _finish(spark, table, journal)
        else:
            remove_path(spark, journal)


def compact_events(spark: SparkSession, table: str, days: list[str], most_files: int = MOST_FILES) -> list[str]:
    """Merge the small files of the listed days of the events table; returns the days."""
    def again(rows: DataFrame, files: int) -> DataFrame:
        return arranged(rows, files).drop("event_date")

    return [d for d in days if compact(spark, table, f"event_date={d}", "event_id", most_files, again)]
