"""Dimensions of every summary table.

A summary exists in two scopes: ``adx`` counts by the advertiser's local day
and also carries the offset, ``gmt`` counts by UTC day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from adtally.functions.measures import row_key

SCOPES = ("adx", "gmt")

SUMMARY = ["campaign_id", "group_id", "aff_id", "aff_pub", "algorithm"]

CLICK = [
    "campaign_id", "group_id", "aff_id", "aff_pub", "country_code", "province_geoname_id", "city_geoname_id",
    "os", "device_type", "device_make", "device_model", "algorithm",
]

CONVERSION = [
    "campaign_id", "group_id", "aff_id", "aff_pub", "income", "income_currency", "payout", "payout_currency",
    "algorithm",
]

INVALID_CONVERSION = ["campaign_id", "group_id", "aff_id", "aff_pub", "invalid_type", "algorithm"]

EVENT = ["campaign_id", "group_id", "aff_id", "aff_pub", "event_value", "currency", "algorithm"]

IMPRESSION = [
    "publisher_id", "inventory_id", "plcmt_id", "campaign_id", "delivery_id", "ad_id", "country_code",
    "province_geoname_id", "city_geoname_id", "device_type", "make", "model", "os", "carrier", "connection_type",
    "age_group", "gender",
]

DEMAND = [
    "demand", "campaign_id", "creative_id", "supply", "publisher_domain", "inventory_domain", "app_bundle", "tagid",
    "country_code", "province_geonameid", "city_geonameid", "device_make", "device_model", "os", "carrier",
    "connection_type", "age_group", "gender", "currency",
]

SUPPLY = ["supply", "publisher_domain", "inventory_domain", "app_bundle", "tagid", "currency"]


def keys(scope: str, dims: list[str]) -> list[str]:
    """Key columns of a summary, in the order the row key uses."""
    if scope not in SCOPES:
        raise ValueError(f"unknown scope {scope!r}")
    return (["timezone"] if scope == "adx" else []) + ["dated"] + dims


def with_row_key(df: DataFrame, scope: str, dims: list[str]) -> DataFrame:
    return df.withColumn("unionk", row_key(keys(scope, dims)))
