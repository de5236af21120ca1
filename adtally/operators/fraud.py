"""Suspicious traffic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adtally.functions import time as tm
from adtally.functions.identity import advertising_id

REASONS = ["E001", "E002", "E003", "E004"]


def hourly_counts(log: DataFrame, keys: list[str], epoch: str = "clk_timestamp",
                  more_than: int | None = None) -> DataFrame:
    """Records per hour and key, optionally only where there are more than a threshold."""
    counts = log.groupBy(tm.hour_index(epoch).alias("hour_index"), *keys).agg(F.count("*").alias("cnt"))
    if more_than is not None:
        counts = counts.where(F.col("cnt") > more_than)
    return counts.select(tm.hour_label("hour_index").alias("hour"), *keys, "cnt")


# What hourly counts are kept by: one or two columns each.
HOT_KEYS = {"ip": ["ip"], "adid": ["gaid", "idfa"], "aff": ["aff_id", "aff_pub"]}


def hourly_counts_by_kind(log: DataFrame, extra: list[str] | None = None, epoch: str = "clk_timestamp") -> DataFrame:
    """``hourly_counts`` by ip, advertising ids and affiliate in one pass over the log.

    A log from hour folders is counted by the ``hour`` of its folder.
    """
    filed = "hour" in log.columns
    def entry(kind: str, keys: list[str]) -> Column:
        parts = [F.col(k).cast("string") for k in keys] + [F.lit("")] * (2 - len(keys))
        return F.struct(F.lit(kind).alias("kind"), parts[0].alias("key_1"), parts[1].alias("key_2"))

    kinds = F.array(*[entry(kind, keys) for kind, keys in HOT_KEYS.items()])
    index = F.col("hour") if filed else tm.hour_index(epoch)
    keyed = log.select(index.alias("hour_index"), *(extra or []), F.explode(kinds).alias("k"))
    keyed = keyed.select("hour_index", "k.*", *(extra or []))
    counts = keyed.groupBy("hour_index", "kind", "key_1", "key_2", *(extra or [])).agg(F.count("*").alias("cnt"))
    hour = F.col("hour_index").cast("string") if filed else tm.hour_label("hour_index")
    return counts.withColumn("hour", hour).drop("hour_index")


def ip_profile(conversions: DataFrame) -> DataFrame:
    """Valid and invalid conversions of every ip that has an invalid one."""
    kind = F.col("invalid_type")
    counts = conversions.groupBy("ip").agg(
        F.count("*").alias("total_cnt"),
        F.count_if(kind == "").alias("valid_cnt"),
        *[F.count_if(kind == r).alias(f"{r.lower()}_cnt") for r in REASONS],
    )
    ratio = F.floor(F.col("valid_cnt") / F.col("total_cnt") * 10000 + 0.5) / F.lit(10000.0)
    return counts.where("total_cnt != valid_cnt").withColumn("valid_ratio", ratio)


def repeated_invalid(conversions: DataFrame) -> DataFrame:
    """Click times of invalid conversions that follow an earlier one of the same ip and reason.

    The first time of an ip and reason is a grouped minimum that is joined
    back, so no task holds all the times of one ip: a blank ip may have one
    for every second of the whole period, and its join can be split.
    """
    invalid = conversions.where("invalid_type != ''")
    first = invalid.groupBy("ip", "invalid_type").agg(F.min("clk_timestamp").alias("first"))
    seconds = invalid.select("ip", "invalid_type", "clk_timestamp").distinct()
    later = seconds.join(first, ["ip", "invalid_type"]).where(F.col("clk_timestamp") > F.col("first"))
    return later.select("ip", "clk_timestamp").distinct()


def repeated_click_times(conversions: DataFrame) -> DataFrame:
    """One line per ip and day: its suspicious click times in order.

    The array holds distinct seconds of one day, 86,400 at most.
    """
    times = F.array_sort(F.collect_list("clk_timestamp")).cast("array<string>")
    return repeated_invalid(conversions).groupBy("ip", tm.utc_day("clk_timestamp").alias("dated")).agg(
        F.array_join(times, ",").alias("clk_times"))


def clicks_around(probes: DataFrame, clicks: DataFrame, key: str, radius: int) -> DataFrame:
    """Clicks of the probe's key within ``radius`` seconds of each probe.

    ``probes`` holds distinct (key, clk_timestamp). Joining each probe with
    the clicks around it would emit a pair per match. Instead clicks are
    counted per second, cut into slices of time, and every probe leaves two
    markers per slice it touches: one just before its interval and one at the
    end. The difference of the running click count at the two markers is the
    number of clicks in between. A slice of one key holds at most one click
    row and a few markers per second, so a hot key is split into small groups.
    """
    width = max(3600, 2 * radius)
    lo, hi = F.col("clk_timestamp") - radius, F.col("clk_timestamp") + radius
    slices = F.sequence(F.floor(lo / width), F.floor(hi / width))
    pieces = probes.select(key, F.col("clk_timestamp").alias("probe"), lo.alias("lo"), hi.alias("hi"),
                           F.explode(slices).alias("slice"))
    marks = F.array(
        F.struct((F.greatest("lo", F.col("slice") * width) - 1).alias("at"), F.lit(-1).alias("sign")),
        F.struct(F.least("hi", F.col("slice") * width + (width - 1)).alias("at"), F.lit(1).alias("sign")),
    )
    markers = pieces.select(key, "slice", "probe", F.explode(marks).alias("m")).select(
        key, "slice", "probe", F.col("m.at").cast("long").alias("at"), F.col("m.sign").alias("sign"),
        F.lit(0).cast("long").alias("clicks"))
    per_second = clicks.groupBy(
        key, F.floor(F.col("clk_timestamp") / width).alias("slice"), F.col("clk_timestamp").cast("long").alias("at"),
    ).agg(F.count("*").alias("clicks"))
    # Only slices some probe looks at go into the window.
    watched = pieces.select(key, "slice").distinct()
    per_second = per_second.join(watched, [key, "slice"], "left_semi").select(
        key, "slice", F.lit(None).cast("long").alias("probe"), "at", F.lit(0).alias("sign"), "clicks")
    running = F.sum("clicks").over(
        Window.partitionBy(key, "slice").orderBy("at").rangeBetween(Window.unboundedPreceding, 0))
    counted = per_second.unionByName(markers.withColumn("probe", F.col("probe").cast("long"))).withColumn(
        "running", running)
    return counted.where("sign != 0").groupBy(key, F.col("probe").alias("clk_timestamp")).agg(
        F.sum(F.col("sign") * F.col("running")).cast("long").alias("click_cnt"))


def clicks_around_invalid(conversions: DataFrame, clicks: DataFrame, radius_minutes: int = 10) -> DataFrame:
    """Clicks of the same ip around each repeated invalid conversion."""
    probes = repeated_invalid(conversions.where("ip != ''"))
    return clicks_around(probes, clicks.where("ip != ''"), "ip", 60 * radius_minutes)


KIND_IP = "10001"
KIND_DEVICE = "10002"


def traffic_keys(log: DataFrame, time: Column) -> DataFrame:
    """Every click once under its ip and once under its advertising id."""
    pair = F.array(
        F.struct(F.lit(KIND_IP).alias("kind"), F.coalesce("ip", F.lit("")).alias("key")),
        F.struct(F.lit(KIND_DEVICE).alias("kind"), advertising_id("gaid", "idfa").alias("key")),
    )
    return log.select(time.alias("ts"), F.explode(pair).alias("p")).select("ts", "p.*")


def sliding_counts(keyed: DataFrame, width: str = "60 seconds", step: str = "20 seconds") -> DataFrame:
    """Clicks per key in a sliding window; works on tables and on streams."""
    counts = keyed.groupBy(F.window("ts", width, step), "kind", "key").agg(F.count("*").alias("cnt"))
    return counts.select(F.unix_seconds("window.start").alias("window_start"), "kind", "key", "cnt")
