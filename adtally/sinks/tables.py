"""Summary tables as Parquet, one folder per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally import schemas
from adtally.operators.rollup import money_sum, sum_of
from adtally.sinks import files

BATCH = "batch_id"
Days = list[dt.date]


def to_layout(df: DataFrame, layout: T.StructType) -> DataFrame:
    """Columns in the order and types of a summary table; absent measures become 0."""
    out = []
    for f in layout.fields:
        if f.name in df.columns:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(0).cast(f.dataType).alias(f.name))
    return df.select(*out)


def register(spark: SparkSession, name: str, location: str, days: Days | None = None) -> None:
    """Make a table of day folders known by name, with its days as partitions of the catalog.

    With ``days`` only these are brought in line with the folders: what a run
    wrote is added, what it emptied is dropped. Otherwise all of them are.
    """
    if not spark.catalog.tableExists(name):
        rows = spark.read.parquet(location)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (dated) LOCATION '{location}'")
        days = None
    there = {f.removeprefix("dated=") for f in files.names(spark, location) if f.startswith("dated=")}
    known = {r[0].removeprefix("dated=") for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    wanted = there | known if days is None else {d.isoformat() for d in days}
    for verb, some in (("ADD", (there & wanted) - known), ("DROP", (known & wanted) - there)):
        if some:
            parts = [f"PARTITION (dated='{d}')" for d in sorted(some)]
            spark.sql(f"ALTER TABLE {name} {verb} {(' ' if verb == 'ADD' else ', ').join(parts)}")
    spark.catalog.refreshTable(name)


def drop_days(spark: SparkSession, name: str, days: Days) -> None:
    """Remove days of a registered table, from the catalog and from its folder."""
    location = _location(spark, name)
    for day in days:
        files.remove(spark, f"{location}/dated={day.isoformat()}")
    register(spark, name, location, days)


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def drop(spark: SparkSession, name: str) -> None:
    """Forget a table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def replace_days(df: DataFrame, path: str, days: Days | None = None) -> None:
    """Replace ``days``, or those present in ``df``; running a day again changes nothing.

    A wanted day without rows loses what an earlier run wrote for it. Rebalancing gathers the rows of a day into files of the advisory size: a
    small day becomes one file, a large one is split over many tasks.
    """
    wanted = [f"{path}/dated={day.isoformat()}" for day in sorted(set(days or ()))]
    _replace(df, path, ["dated"], wanted)


def _replace(df: DataFrame, path: str, by: list[str], wanted: list[str]) -> None:
    """Overwrite the folders that ``df`` has rows for; of the ``wanted`` patterns the other folders go.

    Which were written is seen from their files, so ``df`` is worked out once.
    """
    spark = df.sparkSession
    before = {p: files.folders(spark, p) for p in wanted}
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))
    for pattern, held in before.items():
        for folder in held:
            if files.folders(spark, folder).get(folder) == held[folder]:
                files.remove(spark, folder)


def add_batch(df: DataFrame, path: str, batch_id: int | str) -> None:
    """Add one batch of increments; replaying the batch replaces what it added before.

    The batch folder is the ledger: a measure is the sum over all batches, and
    each batch counts once however often it runs.
    """
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def add_batches(df: DataFrame, path: str, days: Days | None = None) -> None:
    """``add_batch`` for a frame holding a batch for each of ``days`` in its ``batch_id`` column.

    A batch may count on many earlier days. Its rows lie in a folder per
    ``dated`` and batch, so that readers of some days open the folders of
    these days only.
    """
    wanted = [f"{path}/dated=*/{BATCH}={day.isoformat()}" for day in sorted(set(days or ()))]
    _replace(df, path, ["dated", BATCH], wanted)


def read_increments(spark: SparkSession, path: str, keys: list[str], counts: list[str],
                    amounts: list[str] | None = None) -> DataFrame:
    """The summary an increment table stands for."""
    return spark.read.parquet(path).groupBy(*keys).agg(
        *[sum_of(c) for c in counts], *[money_sum(a) for a in amounts or []])


def read_latest(spark: SparkSession, path: str, keys: list[str], measures: list[str]) -> DataFrame:
    """The last state of every key in a table of running totals."""
    last = F.max_by(F.struct(*measures), BATCH).alias("last")
    return spark.read.parquet(path).groupBy(*keys).agg(last).select(*keys, "last.*")


def jdbc_options(url: str, table: str, rows_per_batch: int = 1000) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(rows_per_batch), "isolationLevel": "READ_COMMITTED"}


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Append to a database table in batches of 1000 rows, straight from the executors.

    Needs the database driver on the class path.
    """
    df.write.format("jdbc").options(**jdbc_options(url, table), **(properties or {})).mode("append").save()
