"""Report files and result messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    """Result rows without a header."""
    df.write.mode("overwrite").option("header", "false").csv(path)


def append_report(flags: DataFrame, path: str, check: str) -> None:
    """Add lines of a check to the running report."""
    columns = [F.col(c).cast("string") for c in flags.columns]
    flags.select(F.concat_ws(",", F.lit(check), *columns).alias("value")).write.mode("append").text(path)


def write_hours(rows: DataFrame, path: str) -> None:
    """Raw messages (value, hour) as text, a folder for each hour; hours that are there are replaced."""
    (rows.hint("rebalance", "hour").select("value", "hour").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("hour").text(path))


def kafka_writer_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def send_batch(records: DataFrame, servers: str, topic: str) -> None:
    """Result messages to a topic. Needs the Kafka package on the class path."""
    records.select("value").write.format("kafka").options(**kafka_writer_options(servers, topic)).save()
