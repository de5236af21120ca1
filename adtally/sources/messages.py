"""Message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(servers: str, topics: list[str], max_offsets: int | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_messages(spark: SparkSession, servers: str, topics: list[str],
                   max_offsets: int | None = None) -> DataFrame:
    """One or more topics as ``topic`` and text ``value``.

    Offsets live in the checkpoint of the query, never in the broker. Needs
    the Kafka package on the class path.
    """
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topics, max_offsets)).load()
    return stream.select("topic", F.col("value").cast("string").alias("value"))


def file_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Text files dropped into a folder, one message per line."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)
