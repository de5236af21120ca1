"""Filtering a log by a lookup list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_listed(log: DataFrame, ids: DataFrame, key: str = "group_id") -> DataFrame:
    """Records whose key is on the list.

    No broadcast hint: Spark knows the size of the list file, broadcasts a
    small one and shuffles a large one, splitting hot keys on the way.
    """
    wanted = ids.select(F.col(key).cast("string").alias("_id"))
    return log.join(wanted, F.col(key).cast("string") == F.col("_id"), "left_semi")
