"""Which keys a table holds, without reading the table: hash buckets with Bloom filters.

The index lives in ``_key_index`` below the table, where readers of the table do not look.
It is a list of segments. A segment covers some data files of the table: their keys, in
folders by hash bucket, and for every bucket a Bloom filter in pages of 32,768 bits, each
for about ``PAGE_KEYS`` keys. A look-up tests the filters of the buckets that its keys fall
into, and reads the keys of those buckets only in which a filter says "maybe".

Small segments are merged into larger ones, ``FAN`` at a time, so there are few of them and
a key is rewritten a logarithmic number of times. A manifest names the segments; it is
replaced by writing its next version, so a run that breaks off leaves the last version in
force. Data files that no segment covers are indexed before a look-up. Where the index is
gone, or covers a file that is gone, it is built again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.session import commit_text, files_below, folder_names, path_exists, read_text, remove_path

FOLDER = "_key_index"
BUCKET_KEYS = 1_000_000
PAGE_KEYS = 2048  # 16 bits a key: one of 400 strange keys passes
HASHES = 4
FAN = 8  # segments of about one size that are merged
BITS = 32_768  # of a page, as Spark's bitmap functions make them
KEPT_VERSIONS = 3
INLINE_FILES = 200  # covered files that a manifest names itself


@dataclass
class Found:
    """Keys that the table holds, and what was read to learn it."""

    keys: DataFrame
    filters_read: list[str]
    buckets_read: list[str]


def _power(least: float) -> int:
    """The smallest power of two of at least ``least``."""
    n = 1
    while n < least:
        n *= 2
    return n


def _hash(key: str) -> Column:
    return F.xxhash64(F.col(key).cast("string"))


def _bucket(h: Column, buckets) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def _page(h: Column, pages) -> Column:
    return F.pmod(F.shiftright(h, 24), F.lit(pages)).cast("int")


def _positions(h: Column) -> Column:
    """Places of a key's bits within its page, from its hash and another of it."""
    other = F.xxhash64(h)
    return F.array(*[F.pmod(F.shiftright(other, 15 * i), F.lit(BITS)) for i in range(HASHES)])


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(position, F.lit(8)).cast("int")) == 1


class KeyIndex:
    """The index of one key column of the Parquet table at ``table``. One writer at a time."""

    def __init__(self, spark: SparkSession, table: str, key: str, bucket_keys: int = BUCKET_KEYS,
                 page_keys: int = PAGE_KEYS, fan: int = FAN) -> None:
        self.spark, self.table, self.key = spark, table, key
        self.path = f"{table}/{FOLDER}/{key}"
        self.bucket_keys, self.page_keys, self.fan = bucket_keys, page_keys, fan

    def segments(self) -> tuple[int, list[dict]]:
        """Version of the manifest in force, and its segments; (0, []) without one."""
        versions = [int(n[1:]) for n in folder_names(self.spark, f"{self.path}/manifest") if n.startswith("v")]
        if not versions:
            return 0, []
        return max(versions), json.loads(read_text(self.spark, f"{self.path}/manifest/v{max(versions)}"))

    def _commit(self, version: int, segments: list[dict]) -> None:
        commit_text(self.spark, f"{self.path}/manifest/v{version + 1}", json.dumps(segments))
        remove_path(self.spark, f"{self.path}/manifest/v{version + 1 - KEPT_VERSIONS}")

    def data_files(self) -> set[str]:
        """Files of the table by their path below it."""
        if not any(not n.startswith(("_", ".")) for n in folder_names(self.spark, self.table)):
            return set()
        listed = self.spark.read.schema(f"`{self.key}` string").parquet(self.table).inputFiles()
        return set(files_below(self.spark, self.table, listed))

    def _covered(self, segments: list[dict]) -> set[str]:
        named = {f for s in segments if isinstance(s["files"], list) for f in s["files"]}
        paths = [f"{self.path}/{s['id']}/{s['files']}" for s in segments if not isinstance(s["files"], list)]
        if paths:
            named |= {r[0] for r in self.spark.read.schema("value string").text(paths).collect()}
        return named

    def _named(self, segment: str, files: set[str]) -> list[str] | str:
        """How a manifest names ``files``: one by one if they are few, else by the folder of a list."""
        if len(files) <= INLINE_FILES:
            return sorted(files)
        folder = f"files-{uuid.uuid4().hex}"
        listed = self.spark.createDataFrame([(f,) for f in sorted(files)], "value string").coalesce(1)
        listed.write.text(f"{self.path}/{segment}/{folder}")
        return folder

    def _write(self, keys: DataFrame, files: set[str]) -> dict:
        """A new segment with ``keys`` (one column) and the ``files`` they stand in."""
        n = keys.count()
        own = {"id": f"segment-{uuid.uuid4().hex}", "keys": n, "buckets": _power(n / self.bucket_keys)}
        own["pages"] = _power(n / own["buckets"] / self.page_keys)
        path, h = f"{self.path}/{own['id']}", F.col("h")
        hashed = keys.withColumn("h", _hash(self.key)).withColumn("bucket", _bucket(h, own["buckets"]))
        def dealt(rows: DataFrame) -> DataFrame:
            return rows.repartition(own["buckets"], "bucket") if own["buckets"] > 1 else rows.coalesce(1)

        (dealt(hashed.select(self.key, "bucket")).sortWithinPartitions("bucket", self.key)
         .write.partitionBy("bucket").parquet(f"{path}/keys"))
        bits = hashed.select("bucket", _page(h, own["pages"]).alias("page"), F.explode(_positions(h)).alias("position"))
        # One row of 4 KB for each page leaves a map task.
        pages = bits.groupBy("bucket", "page").agg(F.bitmap_construct_agg("position").alias("bits"))
        (dealt(pages).sortWithinPartitions("bucket", "page")
         .write.partitionBy("bucket").parquet(f"{path}/filter"))
        own["files"] = self._named(own["id"], files)
        own["filled"] = [int(b.split("=")[1]) for b in folder_names(self.spark, f"{path}/keys") if b.startswith("bucket=")]
        return own

    def _keys_of(self, segment: dict, buckets: list[int] | None = None) -> list[str]:
        return [f"{self.path}/{segment['id']}/keys/bucket={b}" for b in (segment["filled"] if buckets is None else buckets)]

    def _read_keys(self, paths: list[str], key_type: str) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], f"`{self.key}` {key_type}")
        return self.spark.read.schema(f"`{self.key}` {key_type}").parquet(*paths)

    def catch_up(self, key_type: str = "string") -> list[dict]:
        """Index the data files that are not, and merge segments; returns the segments.

        An index that covers files which the table has no more is given up and built anew.
        """
        version, segments = self.segments()
        files, covered = self.data_files(), self._covered(segments)
        if covered - files:
            segments, covered = [], set()
        missing = sorted(files - covered)
        if not missing and not (segments == [] and version):
            return segments
        before = list(segments)
        if missing:
            data = (self.spark.read.schema(f"`{self.key}` {key_type}")
                    .parquet(*[f"{self.table}/{f}" for f in missing]).filter(F.col(self.key).isNotNull()))
            segments = [*segments, self._write(data, set(missing))]
        segments = self._merged(segments, key_type)
        self._commit(version, segments)
        kept = {s["id"] for s in segments} | {s["id"] for s in before}  # readers of the last version may be at work
        for name in folder_names(self.spark, self.path):
            if name.startswith("segment-") and name not in kept:
                remove_path(self.spark, f"{self.path}/{name}")
        return segments

    def _merged(self, segments: list[dict], key_type: str) -> list[dict]:
        """``segments`` with every ``fan`` of about one size as one."""
        def tier(segment: dict) -> int:
            level, size = 0, self.fan * self.page_keys
            while segment["keys"] > size:
                level, size = level + 1, size * self.fan
            return level

        while True:
            tiers: dict[int, list[dict]] = {}
            for segment in segments:
                tiers.setdefault(tier(segment), []).append(segment)
            full = next((t for t in sorted(tiers) if len(tiers[t]) >= self.fan), None)
            if full is None:
                return segments
            group = tiers[full]
            keys = self._read_keys([p for s in group for p in self._keys_of(s)], key_type)
            one = self._write(keys, self._covered(group))
            segments = [s for s in segments if s not in group] + [one]

    def adopt(self, added: list[str], removed: list[str]) -> None:
        """Tell the index that data files were rewritten with the same keys: it goes on
        covering them under their new names. To be called after the rewrite."""
        version, segments = self.segments()
        if not segments:
            return
        gone, out = set(removed), []
        for i, segment in enumerate(segments):
            lines = self._covered([segment])
            rest = (lines - gone) | (set(added) if i == 0 else set())
            if rest != lines:
                # The keys stay as they are: only the list of files is written anew.
                segment = {**segment, "files": self._named(segment["id"], rest)}
            out.append(segment)
        self._commit(version, out)

    def lookup(self, keys: DataFrame) -> Found:
        """Those of ``keys`` (distinct, not null, small enough to be broadcast or else
        shuffled by Spark) that the table holds."""
        key_type = keys.schema[self.key].dataType.simpleString()
        segments = self.catch_up(key_type)
        wanted = keys.select(self.key).withColumn("h", _hash(self.key))
        none = Found(keys.select(self.key).limit(0), [], [])
        if not segments:
            return none
        h = F.col("h")
        probes = wanted.select(self.key, "h", F.explode(F.array(*[
            F.struct(F.lit(i).alias("segment"), _bucket(h, s["buckets"]).alias("bucket"),
                     _page(h, s["pages"]).alias("page")) for i, s in enumerate(segments)])).alias("p")).select(
            self.key, "h", "p.*")
        total = sum(len(s["filled"]) for s in segments)
        if total <= 4 * len(segments):
            touched = [(i, b) for i, s in enumerate(segments) for b in s["filled"]]
        else:  # as many rows at most as there are buckets
            touched = [tuple(r) for r in probes.select("segment", "bucket").distinct().collect()]
            touched = sorted((i, b) for i, b in touched if b in set(segments[i]["filled"]))
        filters = None
        for i in sorted({i for i, _ in touched}):
            paths = [f"{self.path}/{segments[i]['id']}/filter/bucket={b}" for j, b in touched if j == i]
            rows = (self.spark.read.schema("page int, bits binary, bucket int")
                    .option("basePath", f"{self.path}/{segments[i]['id']}/filter").parquet(*paths)
                    .withColumn("segment", F.lit(i)))
            filters = rows if filters is None else filters.unionByName(rows)
        if filters is None:
            return none
        every = F.lit(True)
        places = _positions(h)
        for i in range(HASHES):
            every = every & _is_set(F.col("bits"), places[i])
        maybe = filters.join(probes, ["segment", "bucket", "page"]).filter(every)
        hit = sorted(tuple(r) for r in maybe.select("segment", "bucket").distinct().collect())
        paths = [p for i in sorted({i for i, _ in hit}) for p in self._keys_of(segments[i], [b for j, b in hit if j == i])]
        read = [f"{self.path}/{segments[i]['id']}/filter/bucket={b}" for i, b in touched]
        if not paths:
            return Found(none.keys, read, [])
        held = self._read_keys(paths, key_type).join(keys.select(self.key), self.key, "left_semi").distinct()
        return Found(held, read, paths)


def index_exists(spark: SparkSession, table: str, key: str) -> bool:
    return path_exists(spark, f"{table}/{FOLDER}/{key}/manifest")
