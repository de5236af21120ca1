"""Stream tables with a bounded number of folders.

Each micro-batch writes one *part*. After every ``every`` batches they are
merged into a *run*, after every ``every`` runs these into a larger one, and so
on: a table holds at most ``every - 1`` runs of each size, besides the batches
since the last merge and what was merged last. Within a part rows lie by day,
(or another column) so readers open the days they want, and a day that is no
longer written to stays where it is until its run is merged into a larger one.

A *manifest* names the live runs and their days. Merging writes the new run,
then a new manifest, which appears by one rename; what the run replaces is
removed one merge later. So a reader sees either all of the old folders or the
new one, and one that is still reading keeps its files.

A batch that is delivered again replaces its own part. Only earlier batches
are merged when a batch begins, so what a batch adds to can be read again
however often the batch is repeated.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.operators.rollup import SORTED, add_up, apart, by_hash, gathered, money_sum, sum_of
from adtally.sinks import files

DAY = "dated"


class Merge(NamedTuple):
    """How rows with equal keys become one. Without keys rows are kept as they are."""

    keys: list[str]
    counts: list[str] = []
    amounts: list[str] = []
    #: Column of a visitor sketch -> name of its estimate.
    sketches: dict[str, str] = {}
    #: Of these the greatest stays.
    latest: list[str] = []
    #: Dimensions, for a table by scope that has nearly as many keys as records. Its rows may stand for both scopes,
    #: and a part is written by the tasks that added it up, if Spark merges small ones.
    together: list[str] = []

    def _measures(self) -> list[Column]:
        return [*[sum_of(c) for c in self.counts], *[money_sum(a) for a in self.amounts],
                *[F.hll_union_agg(s).alias(s) for s in self.sketches],
                *[F.max(c).alias(c) for c in self.latest]]

    def run(self, rows: DataFrame) -> DataFrame:
        """Rows of some parts as those of one."""
        if not self.together:
            return self.merged(rows)
        return add_up(gathered(rows, self.together), self.together, *self._measures(), by_day=True)

    def over_parts(self, rows: DataFrame) -> DataFrame:
        """``totals`` of rows as they lie in a table."""
        if not self.together:
            return self.totals(rows)
        return self._estimated(add_up(apart(gathered(rows, self.together)), self.together, *self._measures()))

    def merged(self, rows: DataFrame) -> DataFrame:
        if not self.keys:
            return rows
        if not self.sketches:
            # A key has a row in each part at most, so adding up before the shuffle removes little and
            # fills a task with all groups of its files.
            rows = rows.repartition(*self.keys)
        return rows.groupBy(*by_hash(*self.keys)).agg(*self._measures()).drop("_hash")

    def totals(self, rows: DataFrame) -> DataFrame:
        return self._estimated(self.merged(rows))

    def _estimated(self, out: DataFrame) -> DataFrame:
        return out.withColumns({e: F.hll_sketch_estimate(s) for s, e in self.sketches.items()}).drop(*self.sketches)


class Part(NamedTuple):
    name: str
    first: int
    #: One past the last batch.
    end: int
    #: Day folders; empty for a part without rows, [""] for a table without days.
    days: list[str]


class Manifest(NamedTuple):
    #: Batches before this one are in the runs.
    next: int
    runs: list[Part]
    #: Parts that the runs replaced.
    replaced: list[str]
    #: Seconds since 1970 when it was written.
    written: float


def _batch_name(batch_id: int) -> str:
    return f"b{batch_id:012d}"


class Ledger:
    def __init__(self, path: str, merge: Merge, every: int = 16, by: str = DAY,
                 clock: Callable[[], float] = time.time) -> None:
        if every < 2:
            raise ValueError("every must be 2 at least")
        self.path, self.merge, self.every, self.by, self.clock = path, merge, every, by, clock
        self.data, self.manifests = f"{path}/data", f"{path}/manifest"

    # ------------------------------------------------------------- folders

    def _days(self, spark: SparkSession, name: str) -> list[str]:
        inside = files.names(spark, f"{self.data}/part={name}")
        days = [n for n in inside if n.startswith(f"{self.by}=")]
        return days or [""] * any(n.endswith(".parquet") for n in inside)

    def manifest(self, spark: SparkSession, upto: int | None = None) -> Manifest:
        """The last one, or the last that says nothing of batch ``upto`` or later ones."""
        names = [n for n in files.names(spark, self.manifests) if n.isdigit() and (upto is None or int(n) <= upto)]
        if not names:
            return Manifest(0, [], [], 0.0)
        text = files.read_text(spark, f"{self.manifests}/{names[-1]}")
        held = json.loads(text)
        return Manifest(held["next"], [Part(*p) for p in held["runs"]], held["replaced"], held["written"])

    def _keep(self, spark: SparkSession, manifest: Manifest) -> None:
        files.write_text(spark, f"{self.manifests}/{manifest.next:012d}", json.dumps(manifest._asdict()))

    def parts(self, spark: SparkSession, before: int | None = None) -> list[Part]:
        """Live parts, or those of the batches earlier than ``before``."""
        manifest = self.manifest(spark, before)
        if before is None:
            names = [n.removeprefix("part=") for n in files.names(spark, self.data)]
            numbers = [int(n[1:]) for n in names if n.startswith("b") and int(n[1:]) >= manifest.next]
            numbers = [n for n in numbers if "_SUCCESS" in files.names(spark, f"{self.data}/part={_batch_name(n)}")]
        else:
            numbers = range(manifest.next, before)
        batches = [Part(_batch_name(n), n, n + 1, self._days(spark, _batch_name(n))) for n in numbers]
        return [p for p in [*manifest.runs, *batches] if p.days]

    def _read(self, spark: SparkSession, parts: list[Part], days: set[str] | None = None) -> DataFrame | None:
        paths = []
        for p in parts:
            if days is None or p.days == [""]:
                paths.append(f"{self.data}/part={p.name}")
            else:
                paths += [f"{self.data}/part={p.name}/{d}" for d in p.days if d in days]
        if not paths:
            return None
        rows = spark.read.option("basePath", self.data).parquet(*paths).drop("part")
        return rows.withColumn(DAY, F.col(DAY).cast("date")) if self.by == DAY in rows.columns else rows

    # -------------------------------------------------------------- writing

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Write the part of a batch; a batch that is repeated replaces it."""
        # A stream plans without it, but what is written here is a plan of its own.
        rows.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        self._sorts(rows.sparkSession)
        self._write(rows, _batch_name(batch_id))

    def _sorts(self, spark: SparkSession) -> None:
        if self.merge.together:
            spark.conf.set(SORTED, "true")

    def _write(self, rows: DataFrame, name: str) -> None:
        merges = rows.sparkSession.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true") == "true"
        if self.merge.together and merges:  # in the order of their days, in the tasks that added them up
            rows.write.mode("overwrite").partitionBy(self.by).parquet(f"{self.data}/part={name}")
        elif self.by in rows.columns:
            rows.hint("rebalance", self.by).write.mode("overwrite").partitionBy(self.by).parquet(f"{self.data}/part={name}")
        else:
            rows.hint("rebalance").write.mode("overwrite").parquet(f"{self.data}/part={name}")

    def compact(self, spark: SparkSession, batch_id: int) -> None:
        """Merge what falls due before ``batch_id``; doing it again changes nothing."""
        if not batch_id or batch_id % self.every:
            return
        last = self.manifest(spark)
        if last.next >= batch_id:
            return
        size = self.every
        while batch_id % (size * self.every) == 0:
            size *= self.every
        first = batch_id - size
        live = self.parts(spark, batch_id)
        # A run that begins earlier is larger and stays; should the interval have been changed, so do others.
        merged, kept = [p for p in live if p.first >= first], [p for p in live if p.first < first]
        runs = kept
        if merged:
            name = f"r{first:012d}-{batch_id:012d}"
            self._sorts(spark)
            self._write(self.merge.run(self._read(spark, merged)), name)
            runs = [*kept, Part(name, first, batch_id, self._days(spark, name))]
        gone = [p.name for p in last.runs if p not in kept] + [_batch_name(n) for n in range(last.next, batch_id)]
        self._keep(spark, Manifest(batch_id, runs, gone, self.clock()))
        for name in last.replaced:
            files.remove(spark, f"{self.data}/part={name}")
        for name in files.names(spark, self.manifests):
            if name.isdigit() and int(name) < last.next:
                files.remove(spark, f"{self.manifests}/{name}")

    # -------------------------------------------------------------- reading

    def rows(self, spark: SparkSession, days: list | None = None) -> DataFrame | None:
        """What was added, of some days if wanted, merged as far as it happens to be; None if nothing was."""
        return self._apart(self._rows(spark, days))

    def _rows(self, spark: SparkSession, days: list | None) -> DataFrame | None:
        wanted = None if days is None else {f"{self.by}={d}" for d in days}
        return self._read(spark, self.parts(spark), wanted)

    def _apart(self, rows: DataFrame | None) -> DataFrame | None:
        return rows if rows is None or not self.merge.together else apart(rows)

    def totals(self, spark: SparkSession, days: list | None = None) -> DataFrame | None:
        """A row for each key; sketches give way to their estimates."""
        rows = self._rows(spark, days)
        self._sorts(spark)
        return None if rows is None else self.merge.over_parts(rows)

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """What a batch added; None if nothing."""
        name = _batch_name(batch_id)
        return self._apart(self._read(
            spark, [p for p in [Part(name, batch_id, batch_id + 1, self._days(spark, name))] if p.days]))

    def growth(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """What a batch changed, a row for each of its keys; None if it added nothing.

        Counts and amounts are those of the batch. A unique count grows by the
        estimate after the batch less the estimate before, and by no more than
        the first of the counts. Only the days of the batch are read, and of
        these only the keys of the batch are merged.
        """
        now = self.batch(spark, batch_id)
        if now is None:
            return None
        merge = self.merge
        now = merge.merged(now)
        if not merge.sketches and not merge.latest:
            return now
        before = self._apart(
            self._read(spark, self.parts(spark, batch_id), set(self._days(spark, _batch_name(batch_id)))))
        held = [*merge.sketches, *merge.latest]
        rows = now.select(*merge.keys, *merge.counts, *merge.amounts, *held, F.lit(True).alias("_new"))
        if before is not None:
            keys = now.select(*[F.col(k).alias(f"_{k}") for k in merge.keys])
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in merge.keys])
            rows = rows.unionByName(before.join(keys, same, "left_semi").select(
                *merge.keys, *held, F.lit(False).alias("_new")), allowMissingColumns=True)
        grown = rows.groupBy(*by_hash(*merge.keys)).agg(
            *[F.max(F.when(F.col("_new"), F.col(c))).alias(c) for c in [*merge.counts, *merge.amounts]],
            *[F.hll_union_agg(F.when(~F.col("_new"), F.col(s))).alias(f"_{s}") for s in merge.sketches],
            *[F.hll_union_agg(s).alias(s) for s in merge.sketches], *[F.max(c).alias(c) for c in merge.latest])

        def size(sketch: str):
            return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0))

        return grown.select(
            *merge.keys, *merge.counts, *merge.amounts, *merge.latest,
            *[F.least(size(s) - size(f"_{s}"), F.col(merge.counts[0])).alias(e) for s, e in merge.sketches.items()])
