"""Demand and supply summaries of the bid exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally import grains, schemas
from adtally.functions.identity import device_key, first_filled
from adtally.functions.text import or_default
from adtally.operators.rollup import SCOPE, by_scope, money_sum, scope_keys, with_days

HASHED_IDS = ["dpidsha1", "dpidmd5", "didsha1", "didmd5", "macsha1", "macmd5"]
PLAIN_IDS = ["ip", "ua", "hwv"]


def _flat(log: DataFrame, publisher_domain: Column, inventory_domain: Column, app_bundle: Column,
          epoch: Column, tagid: Column, connection_type: Column, *extra: Column) -> DataFrame:
    flat = log.select(
        F.col("tz").alias("timezone"), epoch.alias("epoch"), "demand",
        F.col("cid").alias("campaign_id"), F.col("crid").alias("creative_id"), "supply",
        publisher_domain.alias("publisher_domain"), inventory_domain.alias("inventory_domain"),
        app_bundle.alias("app_bundle"), tagid.alias("tagid"),
        F.col("geo.cc").alias("country_code"), F.col("geo.pgeonid").alias("province_geonameid"),
        F.col("geo.cgeonid").alias("city_geonameid"), F.col("device.make").alias("device_make"),
        F.col("device.model").alias("device_model"), F.col("device.os").alias("os"),
        F.col("device.carrier").alias("carrier"), connection_type.alias("connection_type"),
        F.col("uagrp").alias("age_group"), F.col("user.gender").alias("gender"),
        F.col("dcostcur").alias("demand_currency"), F.col("srevenuecur").alias("supply_currency"),
        device_key([f"device.{h}" for h in HASHED_IDS], [f"device.{p}" for p in PLAIN_IDS]).alias("uv"),
        or_default("dcost", 0.0).alias("cost"),
        # Revenue arrives as text; what is no number adds nothing.
        F.coalesce(F.col("srevenue").try_cast("double"), F.lit(0.0)).alias("revenue"),
        *extra,
    )
    flat = flat.na.fill(schemas.DEMAND_DEFAULTS)
    return flat.withColumn("epoch", F.coalesce("epoch", F.lit(0)))


def flatten(log: DataFrame) -> DataFrame:
    """The batch form: the first filled domain of app and site."""
    flat = _flat(
        log,
        first_filled("app.publisher.domain", "site.publisher.domain"),
        first_filled("app.domain", "site.domain"),
        F.col("app.bundle"),
        F.col("clickts"),
        F.col("tagid"),
        F.col("device.connectiontype"),
    )
    return with_days(flat, "epoch")


def flatten_stream(log: DataFrame, topic: str = "topic") -> DataFrame:
    """The stream form.

    A record with an app object ignores its site even where the app's domain
    is blank. The topic, whose name ends in ``clks`` or ``imps``, tells clicks
    from impressions. Missing values differ from the batch form: "0" for the
    tag id, an empty text for the connection type.
    """
    has_app = F.col("app").isNotNull()
    is_click = F.endswith(F.col(topic), F.lit("clks"))

    def domain(path: str) -> Column:
        chosen = F.when(has_app, F.col(f"app.{path}")).otherwise(F.col(f"site.{path}"))
        return or_default(chosen, "")

    return _flat(
        log, domain("publisher.domain"), domain("domain"), or_default("app.bundle", ""),
        F.when(is_click, F.col("clickts")).otherwise(F.col("pixelts")),
        or_default("tagid", "0"),
        or_default(F.col("device.connectiontype").cast("string"), ""),
        F.when(is_click, F.lit("clks")).otherwise(F.lit("imps")).alias("kind"),
    )


def demand_rows(flat: DataFrame) -> DataFrame:
    return flat.withColumnRenamed("demand_currency", "currency")


def supply_rows(flat: DataFrame) -> DataFrame:
    return flat.withColumnRenamed("supply_currency", "currency")


def together(flat: DataFrame, *more: str, parts: int | None = None) -> DataFrame:
    """Records of the same dimensions in the same task, the only shuffle of a summary that follows.

    Most groups have one or two records, so adding up before the shuffle
    removes next to nothing and fills a task with all groups of its file; and
    a distinct count would shuffle them twice, in both scopes. ``parts`` is
    the number of tasks; a task holds all its groups.
    """
    return flat.repartition(*([parts] if parts else []), *grains.DEMAND, *more)


def daily(flat: DataFrame, scope: str, parts: int | None = None) -> DataFrame:
    day = f"dated_{scope}"
    rows = demand_rows(flat).select("timezone", day, *grains.DEMAND, "uv", "cost")
    out = together(rows, day, parts=parts).groupBy(*scope_keys(scope, grains.DEMAND)).agg(
        F.count("*").alias("clks"), F.count_distinct("uv").alias("uniq_clks"), money_sum("cost"))
    return grains.with_row_key(out, scope, grains.DEMAND)


def daily_by_scope(flat: DataFrame, parts: int | None = None) -> DataFrame:
    """``daily`` of both scopes in one pass."""
    rows = together(demand_rows(flat).select("timezone", "epoch", *grains.DEMAND, "uv", "cost"), parts=parts)
    return by_scope(rows, "epoch").groupBy(*SCOPE, *grains.DEMAND).agg(
        F.count("*").alias("clks"), F.count_distinct("uv").alias("uniq_clks"), money_sum("cost"))


def supply_daily(flat: DataFrame, scope: str = "gmt") -> DataFrame:
    out = supply_rows(flat).groupBy(*scope_keys(scope, grains.SUPPLY)).agg(
        F.count("*").alias("clks"), money_sum("revenue"))
    return grains.with_row_key(out, scope, grains.SUPPLY)
