"""Session settings and the shared work folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

from adtally.operators.rollup import SORTED

RUNTIME_CONF = {
    # Day and hour columns mean UTC unless an offset is added explicitly.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Where one side turns out small in every partition, it is hashed and the other side is not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Set by who sorts before grouping.
    SORTED: "false",
    # State grows with the number of live grains, so keep it off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build(app: str = "adtally", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="adtally-")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for staged tables and stream checkpoints.

    It lies below ``spark.checkpoint.dir``, which every executor must be able
    to reach. Only a local session may do without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(spark: SparkSession, df, name: str):
    """Write ``df`` to the shared folder and read it back.

    Unlike a cached frame the staged table survives the loss of an executor,
    so the steps that follow never recompute what went into it.
    """
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


TARGET_BYTES = 256 * 1024 * 1024


def partitions_for(input_bytes: int, cores: int) -> int:
    """Shuffle partitions for an input of this size: one per 256 MB, at least one per core.

    Adaptive execution merges what turns out too small. It cannot split an
    aggregation's partitions, so the number must be large enough up front.
    """
    return max(cores, -(-input_bytes // TARGET_BYTES))


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    wanted = partitions_for(input_bytes, spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def total_bytes(spark: SparkSession, patterns: list[str]) -> int:
    """Bytes below the files and folders that match."""
    total = 0
    for pattern in patterns:
        path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in system.globStatus(path) or []:
            total += system.getContentSummary(found.getPath()).getLength()
    return total
