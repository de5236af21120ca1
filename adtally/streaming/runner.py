"""Running a stream into a table.

Every micro-batch is rolled up on its own and added to a ``Ledger``, which
merges batches as time goes by. A batch that is replayed after a failure
replaces its own part, so nothing counts twice. Nothing is forgotten either:
what a late record adds to is read from the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from adtally.sinks.ledger import Ledger, Merge

EVERY_20_SECONDS = {"processingTime": "20 seconds"}
WHAT_IS_THERE = {"availableNow": True}

Emit = Callable[[DataFrame, int], None]


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Streams started inside have operators of wide records compiled one by one.

    The JVM interprets methods of more than 8000 bytes of code, which all
    operators of a wide record together exceed. A stream keeps the settings
    that the session had when it was started.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def start(stream: DataFrame, checkpoint: str, each_batch: Emit, mode: str = "append",
          trigger: dict | None = None) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(each_batch).trigger(**(trigger or EVERY_20_SECONDS)).start()


def start_table(stream: DataFrame, rollup: Callable[[DataFrame], DataFrame], ledger: Ledger, checkpoint: str,
                trigger: dict | None = None, emit: Emit | None = None, mode: str = "append") -> StreamingQuery:
    """Add the rollup of each micro-batch to a table. ``emit`` gets what the batch changed, if anything."""
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ledger.compact(spark, batch_id)
        ledger.add(rollup(batch), batch_id)
        grown = ledger.growth(spark, batch_id) if emit else None
        if grown is not None:
            emit(grown, batch_id)

    return start(stream, checkpoint, each, mode, trigger)


def start_quarantine(parsed: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the messages that could not be read."""
    bad = parsed.where("malformed").select("value")
    return start_table(bad, lambda messages: messages, Ledger(path, Merge([])), checkpoint, trigger)
