"""Impression and impression-click summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally import grains, schemas
from adtally.functions.identity import visitor
from adtally.functions.text import first_as_int, last_as_int, last_or_zero, or_default
from adtally.operators.rollup import SCOPE, by_scope, scope_keys, with_days

# Column of the summary -> field of the nested option object.
OPTION_FIELDS = {
    "country_code": "country_code", "device_type": "devicetype", "make": "make", "model": "model", "os": "os",
    "carrier": "carrier", "connection_type": "connectiontype", "age_group": "agegroup", "gender": "gender",
}
ID_FIELDS = ["ip", "ua", "gaid", "idfa"]
TOP = ["publisher_id", "inventory_id", "plcmt_id", "campaign_id", "delivery_id", "ad_id"]


def flatten(log: DataFrame) -> DataFrame:
    """Nested option fields as columns; regions stay text, "0" when missing."""
    flat = log.select(
        "timezone", "request_unix", *TOP,
        *[F.col(f"option.{src}").alias(name) for name, src in OPTION_FIELDS.items()],
        F.get("option.region_ids", F.lit(0)).alias("province_geoname_id"),
        last_or_zero("option.region_ids").alias("city_geoname_id"),
        *[F.col(f"option.{c}").alias(c) for c in ID_FIELDS],
    ).na.fill(schemas.IMPRESSION_DEFAULTS)
    dated = with_days(flat, "request_unix").withColumn("visitor", visitor(*ID_FIELDS))
    return dated.withColumns({d: _known_day(d) for d in ("dated_adx", "dated_gmt")}).drop(*ID_FIELDS)


def _known_day(day: str) -> Column:
    """A record without a time counts on the default day in both scopes."""
    return F.coalesce(F.col(day), F.lit(schemas.NO_DAY).cast("date"))


def flatten_stream(log: DataFrame) -> DataFrame:
    """The stream form: records without an option object do not count, regions are numbers."""
    return log.where(F.col("option").isNotNull()).select(
        "timezone", "request_unix", *TOP,
        *[or_default(f"option.{src}", "").alias(name) for name, src in OPTION_FIELDS.items()],
        first_as_int("option.region_ids").alias("province_geoname_id"),
        last_as_int("option.region_ids").alias("city_geoname_id"),
    )


def daily(flat: DataFrame, scope: str, kind: str = "imp") -> DataFrame:
    """Gross and unique count; ``kind`` "clk" counts clicks on impressions."""
    out = flat.groupBy(*scope_keys(scope, grains.IMPRESSION)).agg(
        F.count("*").alias(f"gross_{kind}_cnt"), F.count_distinct("visitor").alias(f"uniq_{kind}_cnt"))
    return grains.with_row_key(out, scope, grains.IMPRESSION)


def daily_by_scope(flat: DataFrame, kind: str = "imp") -> DataFrame:
    """``daily`` of both scopes in one pass."""
    rows = by_scope(flat, "request_unix").withColumn("dated", _known_day("dated"))
    return rows.groupBy(*SCOPE, *grains.IMPRESSION).agg(
        F.count("*").alias(f"gross_{kind}_cnt"), F.count_distinct("visitor").alias(f"uniq_{kind}_cnt"))
