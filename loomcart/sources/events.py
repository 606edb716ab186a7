"""Raw event sources: Kafka topics, Kafka-shaped tables and JSON landing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcart.functions.variants import parse_object
from loomcart.schemas import RAW_NAMES, TEXT_FIELDS

# Total arrival order of Kafka rows: offsets order rows inside one partition only,
# so time comes first by convention.
KAFKA_ORDER = ["_kafka_timestamp", "_kafka_topic", "_kafka_partition", "_kafka_offset"]
# What names a message, whichever run reads it.
MESSAGE_KEY = ["_kafka_topic", "_kafka_partition", "_kafka_offset"]


def kafka_options(servers: str, topic: str, batch_rows: int = 500,
                  starting: str = "earliest") -> dict[str, str]:
    """Options of the Kafka source. Offsets live in the stream's checkpoint and move
    only after a batch is done, which gives at-least-once delivery."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(batch_rows),
        "failOnDataLoss": "true",
    }


def kafka_stream(spark: SparkSession, servers: str, topic: str, batch_rows: int = 500,
                 starting: str = "earliest") -> DataFrame:
    """Streaming read of a topic; needs the spark-sql-kafka package on the class path."""
    reader = spark.readStream.format("kafka")
    for key, value in kafka_options(servers, topic, batch_rows, starting).items():
        reader = reader.option(key, value)
    return reader.load()


def parse_kafka(df: DataFrame) -> DataFrame:
    """Kafka's columns to ``fields``, the message text in ``raw`` and the coordinates.

    ``fields`` is null when the value is not a JSON object in valid UTF-8.
    """
    text = df["value"].cast("string")
    return df.select(
        parse_object(text, RAW_NAMES, TEXT_FIELDS).alias("fields"),
        text.alias("raw"),
        df["offset"].alias("_kafka_offset"),
        df["partition"].alias("_kafka_partition"),
        (F.coalesce(df["topic"], F.lit("")) if "topic" in df.columns else F.lit("")).alias("_kafka_topic"),
        F.unix_millis(df["timestamp"].cast("timestamp")).alias("_kafka_timestamp"),
    )


def landing_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.load(path)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Text files with one JSON object per line."""
    return spark.read.text(path)


def parse_landing(df: DataFrame) -> DataFrame:
    """As ``parse_kafka`` for lines of text, which carry no message coordinates.

    ``_raw_sha`` stands for the line where an id has to be made.
    """
    return df.select(
        parse_object(df["value"], RAW_NAMES, TEXT_FIELDS).alias("fields"),
        df["value"].alias("raw"),
        F.sha2(df["value"], 256).alias("_raw_sha"),
        *[df[c] for c in df.columns if c != "value"],
    )


def decoded(parsed: DataFrame) -> DataFrame:
    """The rows that are objects.

    Written as an explode, which drops nulls like a filter would: a filter is pushed
    below the parse and makes Spark parse every message twice.
    """
    rest = [c for c in parsed.columns if c != "fields"]
    found = F.explode(F.array_compact(F.array("fields"))).alias("fields")
    return parsed.select(*rest, found)


def quarantined(parsed: DataFrame) -> DataFrame:
    """Messages that are no JSON object, kept whole so that nothing is lost silently."""
    return parsed.filter(F.col("fields").isNull()).drop("fields")
