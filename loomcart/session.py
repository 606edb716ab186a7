"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. Shuffle parallelism is left to the caller and AQE.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The default type has no statistics, by which reads skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # HotSpot compiles no longer method: a stage whose code is longer would be interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Read when a stateful stream starts; harmless for everything else.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "loomcart", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings above; keyword arguments use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SESSION_CONF, "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
                # Checkpoints go with the rows they hold; each micro-batch makes several.
                "spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else built."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is made only for a local master with nothing configured.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="loomcart-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark)}/loomcart/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in reliable storage, so a lost executor cannot change it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it from there: later reads take the columns they
    need, and survive lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows of a task ahead of costly per-row work: a few seconds of parsing.
TASK_ROWS = 50_000


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Give every core a share of a small input, which would be read by one task.

    For inputs ahead of costly per-row work. Inputs with enough partitions stay as they are,
    unless their number of ``rows`` is given: a file is cut by bytes but read by row groups,
    so of many partitions a few may hold all rows. They are dealt out then, at most about
    ``TASK_ROWS`` to a task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if rows is not None:
        return df.repartition(max(cores, -(-rows // TASK_ROWS)))
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def remove_path(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def replace_folder(spark: SparkSession, draft: str, path: str) -> None:
    """Put the folder ``draft`` where ``path`` is or is not. Between two renames there is
    none; a folder that a reader holds open stays readable until its files are removed."""
    target, fs = _hadoop(spark, path)
    old, _ = _hadoop(spark, f"{path}-old-{uuid.uuid4().hex}")
    had = fs.exists(target)
    if had:
        fs.rename(target, old)
    elif target.getParent() is not None:
        fs.mkdirs(target.getParent())
    if not fs.rename(_hadoop(spark, draft)[0], target):
        raise OSError(f"{draft} could not be put in the place of {path}")
    if had:
        fs.delete(old, True)


def _hadoop(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder; none if there is no such folder."""
    jvm_path, fs = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jvm_path)) if fs.exists(jvm_path) else []


def files_below(spark: SparkSession, path: str, files: list[str]) -> list[str]:
    """``files``, as Spark lists them, by their path below the folder ``path``."""
    jvm_path, fs = _hadoop(spark, path)
    root = fs.makeQualified(jvm_path).toUri().getPath().rstrip("/")
    return [unquote(urlsplit(f).path)[len(root) + 1:] for f in files]


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file as a whole."""
    jvm_path, fs = _hadoop(spark, path)
    stream = fs.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def commit_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that appears as a whole or not at all, by a rename. Raises
    if there is one: somebody else was first."""
    target, fs = _hadoop(spark, path)
    draft, _ = _hadoop(spark, f"{target.getParent().toString()}/_draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(path)
