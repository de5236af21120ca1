"""Shared pieces of the daily summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally import grains
from adtally.functions import time as tm
from adtally.functions.measures import money, money_units


def with_days(df: DataFrame, epoch: str, offset: str = "timezone", prefix: str = "dated") -> DataFrame:
    """Add the day of a record in both scopes."""
    return df.withColumns({
        f"{prefix}_adx": tm.local_day(epoch, offset),
        f"{prefix}_gmt": tm.utc_day(epoch),
    })


def scope_keys(scope: str, dims: list[str], day: str = "dated") -> list[Column]:
    """Grouping columns of a frame from ``with_days`` for one scope."""
    return [F.col(f"{day}_{scope}").alias("dated") if k == "dated" else F.col(k) for k in grains.keys(scope, dims)]


def money_sum(amount: str, name: str | None = None) -> Column:
    return money(F.sum(money_units(amount))).alias(name or amount)


def sum_of(count: str, name: str | None = None) -> Column:
    return F.sum(count).cast("long").alias(name or count)


def fan_out(df: DataFrame, epoch: str, offset: str = "timezone") -> DataFrame:
    """Every record once per scope, with its day and, for ``adx``, its offset.

    One pass over the input then feeds both scopes; the rows meet again in
    the map-side half of the aggregation, before anything is shuffled.
    """
    both = F.array(
        F.struct(F.lit("adx").alias("scope"), F.col(offset).cast("double").alias("timezone"),
                 tm.local_epoch(epoch, offset).alias("scope_epoch")),
        F.struct(F.lit("gmt").alias("scope"), F.lit(None).cast("double").alias("timezone"),
                 F.col(epoch).cast("long").alias("scope_epoch")),
    )
    rest = [c for c in df.columns if c != offset]
    return df.select(*rest, F.explode(both).alias("_s")).select(*rest, "_s.*")


SCOPE = ["scope", "timezone", "dated"]


def by_scope(log: DataFrame, epoch: str, offset: str = "timezone", keep_epoch: bool = False) -> DataFrame:
    """``fan_out`` with the day of each row."""
    rows = fan_out(log, epoch, offset).withColumn("dated", tm.utc_day("scope_epoch"))
    return rows if keep_epoch else rows.drop("scope_epoch")


#: Scope of a row that stands for a row of each: the local day of its records is their UTC day.
BOTH = "both"


def by_scope_once(log: DataFrame, epoch: str, until: Column, offset: str = "timezone") -> DataFrame:
    """``by_scope`` up to an epoch, but records with one day in both scopes are one row, of scope ``BOTH``."""
    rest = [c for c in log.columns if c not in (epoch, offset)]

    def day(of: Column) -> Column:
        return F.when(of <= until, tm.utc_day(of))

    dated = log.select(*rest, F.col(offset).cast("double").alias("timezone"),
                       day(tm.local_epoch(epoch, offset)).alias("_adx"), day(F.col(epoch).cast("long")).alias("_gmt"))

    def row(scope: str, zone: Column, on: str) -> Column:
        return F.struct(F.lit(scope).alias("scope"), zone.alias("timezone"), F.col(on).alias("dated"))

    zone = F.col("timezone")
    rows = F.when(F.col("_adx") == F.col("_gmt"), F.array(row(BOTH, zone, "_gmt"))).otherwise(
        F.array(row("adx", zone, "_adx"), row("gmt", F.lit(None).cast("double"), "_gmt")))
    return dated.select(*rest, F.explode(rows).alias("_s")).select(*rest, "_s.*").where(F.col("dated").isNotNull())


def apart(rows: DataFrame) -> DataFrame:
    """A row of each scope for every row of scope ``BOTH``."""
    scope = F.col("scope")
    scopes = F.when(scope == BOTH, F.array(F.lit("adx"), F.lit("gmt"))).otherwise(F.array(scope))
    split = rows.select(*[c for c in rows.columns if c != "scope"], F.explode(scopes).alias("scope"))
    zone = F.when(scope != "gmt", F.col("timezone")).alias("timezone")
    return split.select(*[zone if c == "timezone" else c for c in rows.columns])


_TEXT, _ODD = "_text", "_odd"
#: Between the dimensions of a row, the unit separator.
_BETWEEN = "\x1f"


def packed(rows: DataFrame, dims: list[str]) -> DataFrame:
    """``dims`` as one text, which is half as large in a shuffle and is copied at one go wherever a row is.

    Where a dimension is null or holds a separator they are kept as they are, beside the text.
    """
    texts = [F.col(d).cast("string") for d in dims]
    odd = F.coalesce(F.contains(F.concat(*texts), F.lit(_BETWEEN)), F.lit(True))
    return rows.select(*[c for c in rows.columns if c not in dims], F.concat_ws(_BETWEEN, *texts).alias(_TEXT),
                       F.when(odd, F.struct(*dims)).alias(_ODD))


def unpacked(rows: DataFrame, dims: list[str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in rows.schema[_ODD].dataType.fields}
    # Split in a step of its own, or it is for every dimension.
    split = rows.withColumn(_TEXT, F.split(_TEXT, _BETWEEN))
    return split.withColumns({d: F.when(F.col(_ODD).isNull(), F.get(F.col(_TEXT), F.lit(i)).cast(kinds[d])).otherwise(
        F.col(_ODD)[d]) for i, d in enumerate(dims)}).drop(_TEXT, _ODD)


def gathered(rows: DataFrame, dims: list[str], parts: int | None = None) -> DataFrame:
    """``packed``, with rows of the same dimensions in the same task."""
    return packed(rows, dims).repartition(*([parts] if parts else []), _TEXT)


def add_up(rows: DataFrame, dims: list[str], *measures: Column, by_day: bool = False) -> DataFrame:
    """``gathered`` rows by scope and dimensions, with ``by_day`` in the order of their days.

    Rows are sorted once, by the hash of their dimensions, and then added up
    one after the other: with ``SORTED`` set, a sketch is neither kept beside
    others nor written and read again between two halves of an aggregation.
    The offset is a text meanwhile. As a number it would be made a new one for
    grouping, which Spark does not know to be in order.
    """
    zone = (F.col("timezone") + F.lit(0.0)).cast("string")  # no -0.0
    hashed = rows.withColumns({"timezone": zone, "_hash": F.xxhash64(_TEXT)})
    order = ["dated", "_hash"] if by_day else ["_hash", "dated"]
    order += [_TEXT, _ODD, "scope", "timezone"]
    out = hashed.sortWithinPartitions(*order).groupBy(*order).agg(*measures)
    kept = [c for c in out.columns if c not in order]
    return unpacked(out, dims).select("scope", F.col("timezone").cast("double").alias("timezone"), "dated", *dims, *kept)


#: Lets a sorted input be aggregated without hashing and in one step.
SORTED = "spark.sql.execution.replaceHashWithSortAgg"


def by_hash(*keys: Column | str) -> list[Column | str]:
    """Grouping columns with their hash, ``_hash``, before them.

    Sketches are aggregated by sorting as soon as a task holds more than a few
    groups. The sort compares the first column as a number and the others only
    where that is equal, so the hash takes the place of a dozen comparisons of
    texts. Groups are those of ``keys``, however many share a hash.
    """
    return [F.xxhash64(*keys).alias("_hash"), *keys]


def of_scope(counts: DataFrame, scope: str, dims: list[str]) -> DataFrame:
    """One scope of a ``by_scope`` rollup as a summary with its row key."""
    rows = counts.where(F.col("scope") == scope).drop("scope", *([] if scope == "adx" else ["timezone"]))
    return grains.with_row_key(rows, scope, dims)
