"""Record-by-record streams: list filter, repeated clicks, click watch."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adtally.functions import time as tm
from adtally.operators import fraud, lists
from adtally.sinks import files
from adtally.sinks.ledger import Ledger, Merge
from adtally.sources import logs
from adtally.streaming import runner


class VersionedList:
    """A lookup list beside a stream.

    It is looked at again once the last look is ``max_age`` seconds old, and
    copied if its modification time has changed. Each batch notes which copy
    it used, so a batch that is repeated sees the list that it saw before,
    whatever has become of the file.
    """

    #: Batches whose notes are kept.
    KEPT = 100

    def __init__(self, path: str, store: str, max_age: float = 3600, clock: Callable[[], float] = time.time) -> None:
        self.path, self.store, self.max_age, self.clock = path, store, max_age, clock

    def at(self, spark: SparkSession, batch_id: int) -> str:
        """Where the copy for a batch lies."""
        notes, own = f"{self.store}/batches", f"{batch_id:012d}"
        known = [n for n in files.names(spark, notes) if n.isdigit()]
        if own in known:
            return self._copy(json.loads(files.read_text(spark, f"{notes}/{own}")))
        note = json.loads(files.read_text(spark, f"{notes}/{known[-1]}")) if known else None
        if note is None or self.clock() - note["looked"] >= self.max_age:
            changed = files.modified(spark, self.path)
            if note is None or note["version"] != changed:
                spark.read.text(self.path).write.mode("overwrite").text(self._copy({"version": changed}))
            note = {"version": changed, "looked": self.clock()}
        files.write_text(spark, f"{notes}/{own}", json.dumps(note))
        for name in known[:-self.KEPT]:
            files.remove(spark, f"{notes}/{name}")
        return self._copy(note)

    def _copy(self, note: dict) -> str:
        return f"{self.store}/version={note['version']}"


def filtered(path: str, every: int = 16) -> Ledger:
    """The table of a list filter: messages by the hour they came in."""
    return Ledger(path, Merge([]), every, by="hour")


def start_list_filter(messages: DataFrame, list_path: str, out: str, checkpoint: str, trigger: dict | None = None,
                      key: str = "group_id", max_age: float = 3600,
                      clock: Callable[[], float] = time.time) -> StreamingQuery:
    """Raw messages whose group is on the list, into ``filtered(out)``."""
    versions = VersionedList(list_path, f"{checkpoint}/list", max_age, clock)
    ledger = filtered(out)

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ledger.compact(spark, batch_id)
        listed = logs.read_id_list(spark, versions.at(spark, batch_id), key)
        keyed = batch.withColumn(key, F.get_json_object("value", f"$.{key}"))
        hour = tm.utc_hour(F.lit(int(clock())))
        ledger.add(lists.keep_listed(keyed, listed, key).select("value", hour.alias("hour")), batch_id)

    return runner.start(messages, f"{checkpoint}/main", each, trigger=trigger)


def once_per_click(log: DataFrame, within: str) -> DataFrame:
    """The first record of each click id; all blank ids together count as one.

    State of a click id is kept for ``within`` after its time, longer by no
    more than the stream is behind. Later repetitions count again.
    """
    timed = log.withColumn("_at", F.timestamp_seconds("conv_timestamp")).withWatermark("_at", within)
    return timed.dropDuplicatesWithinWatermark(["click_id"]).drop("_at")


def click_watch(log: DataFrame, epoch: str = "clk_timestamp", late: str = "2 minutes") -> DataFrame:
    """Clicks per ip and advertising id in the last minute, every 20 seconds."""
    keyed = fraud.traffic_keys(log, F.timestamp_seconds(epoch))
    return fraud.sliding_counts(keyed.withWatermark("ts", late) if log.isStreaming else keyed)
