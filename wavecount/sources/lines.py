"""Text lines in and out: files and topics, bounded and streaming.

Every reader returns one column ``value string``, the input of the parsers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a bounded text input."""
    return spark.read.text(path)


def read_lines_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their place: value and ``place``, which rises from line to line.

    Files follow each other by name. A file is read in splits, so the place is the
    file, the byte offset of the split and the position inside it; nothing is
    counted across tasks.
    """
    return spark.read.text(path).select("value", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line")).alias("place"))


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of a folder that keeps receiving text files."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


#: Columns that tell in which order lines of different files and splits arrived.
FILE_PLACE = ("arrived", "file", "block")
KAFKA_PLACE = ("arrived", "partition", "offset")


def stream_lines_with_place(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same lines with ``FILE_PLACE``; lines of one split follow each other in the batch that reads it."""
    return stream_lines(spark, path, max_files_per_trigger).select(
        "value", F.col("_metadata.file_modification_time").alias("arrived"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))


def kafka_source_options(servers: str, topic: str, group_id: str | None = None,
                         starting_offsets: str = "latest") -> dict[str, str]:
    """Options of the topic reader; new queries start at the latest offset."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if group_id:
        options["kafka.group.id"] = group_id
    return options


def stream_kafka_lines(spark: SparkSession, servers: str, topic: str, group_id: str | None = None,
                       starting_offsets: str = "latest", place: bool = False) -> DataFrame:
    """Record values of a topic as lines, with ``KAFKA_PLACE`` where wanted. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka")
    options = kafka_source_options(servers, topic, group_id, starting_offsets)
    places = [F.col("timestamp").alias("arrived"), F.col("partition"), F.col("offset")] if place else []
    return reader.options(**options).load().select(F.col("value").cast("string").alias("value"), *places)


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    """Options of the topic writer."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def replay_to_kafka(lines: DataFrame, servers: str, topic: str) -> None:
    """Send every line as one record without a key; each task sends its own partition."""
    options = kafka_sink_options(servers, topic)
    lines.select(F.col("value").cast("string").alias("value")).write.format("kafka").options(**options).save()


def replay_to_files(lines: DataFrame, path: str, mode: str = "append") -> None:
    """Drop every line into text files below ``path``, where ``stream_lines`` picks them up."""
    lines.select("value").write.mode(mode).text(path)
