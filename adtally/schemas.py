"""Record layouts of the logs, their default values and the summary tables."""

from __future__ import annotations

from pyspark.sql import types as T

from adtally import grains
from adtally.functions.measures import RETENTION_DAYS, retention_name


_PLAIN = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "date": T.DateType(),
}


def _type(name: str) -> T.DataType:
    if name.startswith("decimal"):
        precision, scale = name[len("decimal("):-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _PLAIN[name]


def _struct(flat: str, **nested: T.DataType) -> T.StructType:
    """A layout from "name type" pairs and nested fields; needs no session."""
    pairs = [p.split() for p in flat.split(", ") if p]
    fields = [T.StructField(n, _type(t)) for n, t in pairs]
    return T.StructType(fields + [T.StructField(n, t) for n, t in nested.items()])


CLICK = _struct(
    "timezone float, clk_timestamp int, campaign_id int, group_id int, aff_id int, aff_pub string, "
    "country_code string, province_geoname_id int, city_geoname_id int, os string, device_type string, "
    "device_make string, device_model string, algorithm int, ip string, ua string, gaid string, idfa string, "
    "adid string")

CONVERSION = _struct(
    "click_id string, clk_timestamp int, conv_timestamp int, timezone float, campaign_id int, group_id int, "
    "aff_id int, aff_pub string, income float, income_currency string, payout float, payout_currency string, "
    "algorithm int, invalid_type string, forwarded int, net_profit double, tac double, ip string, gaid string, "
    "idfa string, carrier string")

EVENT = _struct(
    "timezone float, campaign_id int, group_id int, aff_id int, aff_pub string, event_value int, "
    "install_timestamp int, event_timestamp int, order_amount double, order_currency string, algorithm int, kpi int, "
    "click_id string")

# The earlier event record names the visitor by its identifiers.
EVENT_WITH_IDS = _struct(
    "timezone float, campaign_id int, group_id int, aff_id int, aff_pub string, event_value int, "
    "install_timestamp int, event_timestamp int, order_amount double, order_currency string, algorithm int, kpi int, "
    "ip string, ua string, gaid string, idfa string, adid string")

IMPRESSION = _struct(
    "timezone float, request_unix int, publisher_id int, inventory_id int, plcmt_id int, campaign_id int, "
    "delivery_id int, ad_id int",
    option=_struct(
        "country_code string, devicetype string, make string, model string, os string, carrier string, "
        "connectiontype string, agegroup string, gender string, ip string, ua string, gaid string, idfa string",
        region_ids=T.ArrayType(T.StringType()),
        stdplcmts=T.MapType(T.StringType(), T.IntegerType())))

_PUBLISHER = _struct("domain string")
DEMAND = _struct(
    "tz double, demand string, cid string, crid string, dcost double, dcostcur string, srevenue string, "
    "srevenuecur string, supply string, tagid string, uagrp string, clickts bigint, pixelts bigint",
    site=_struct("domain string", publisher=_PUBLISHER),
    app=_struct("domain string, bundle string", publisher=_PUBLISHER),
    geo=_struct("cc string, pgeonid int, cgeonid int"),
    device=_struct(
        "ip string, ua string, hwv string, make string, model string, os string, carrier string, "
        "connectiontype int, didsha1 string, didmd5 string, dpidsha1 string, dpidmd5 string, macsha1 string, "
        "macmd5 string"),
    user=_struct("gender string"))

CLICK_FRAUD = _struct("clk_timestamp int, aff_id int, aff_pub string, ip string, gaid string, idfa string")
CONVERSION_FRAUD = _struct(
    "clk_timestamp int, campaign_id int, aff_id int, aff_pub string, ip string, gaid string, idfa string, "
    "invalid_type string")
EVENT_FRAUD = _struct(
    "clk_timestamp int, event_value int, aff_id int, aff_pub string, ip string, gaid string, idfa string")


def defaults(schema: T.StructType) -> dict:
    """Fill values of the flat columns: 0 for numbers, empty for text."""
    out: dict = {}
    for field in schema.fields:
        if isinstance(field.dataType, T.NumericType):
            out[field.name] = 0
        elif isinstance(field.dataType, T.StringType):
            out[field.name] = ""
    return out


# The impression summaries keep regions as text, so their default is "0".
IMPRESSION_DEFAULTS = {
    "timezone": 0, "publisher_id": 0, "inventory_id": 0, "plcmt_id": 0, "campaign_id": 0, "delivery_id": 0,
    "ad_id": 0, "country_code": "", "province_geoname_id": "0", "city_geoname_id": "0", "device_type": "",
    "make": "", "model": "", "os": "", "carrier": "", "connection_type": "", "age_group": "", "gender": "",
    "ip": "", "ua": "", "gaid": "", "idfa": "",
}

DEMAND_DEFAULTS = {
    "timezone": 0, "demand": "", "campaign_id": "", "creative_id": "", "supply": "", "publisher_domain": "",
    "inventory_domain": "", "app_bundle": "", "tagid": "", "country_code": "", "province_geonameid": 0,
    "city_geonameid": 0, "device_make": "", "device_model": "", "os": "", "carrier": "", "connection_type": 0,
    "age_group": "", "gender": "", "demand_currency": "", "supply_currency": "", "uv": "",
}

NO_DAY = "1970-01-01"

# ---------------------------------------------------------------- summaries

_TYPES = {
    "timezone": "decimal(3,1)", "dated": "date", "aff_pub": "string", "income": "decimal(7,2)",
    "payout": "decimal(7,2)", "campaign_id": "int", "group_id": "int", "aff_id": "int", "algorithm": "int",
    "event_value": "int", "publisher_id": "int", "inventory_id": "int", "plcmt_id": "int", "delivery_id": "int",
    "ad_id": "int", "province_geonameid": "int", "city_geonameid": "int",
}
MONEY = "decimal(14,4)"
EVENT_MONEY = "decimal(12,4)"

WIDE_COUNTS = [
    "gross_clk_cnt", "uniq_clk_cnt", "gross_conv_cnt", "valid_conv_cnt", "notify_conv_cnt", "kpi_event_cnt",
]
WIDE_MONEY = ["net_profit", "tac"]


def _counts(*names: str) -> dict[str, str]:
    return {n: "bigint" for n in names}


def _table(scope: str, dims: list[str], measures: dict[str, str], **types: str) -> T.StructType:
    named = {**_TYPES, **types}
    cols = [(k, named.get(k, "string")) for k in grains.keys(scope, dims)]
    cols += [("unionk", "string"), *measures.items()]
    return _struct(", ".join(f"{n} {t}" for n, t in cols))


def _summary_tables() -> dict[str, T.StructType]:
    tables = {}
    for scope in grains.SCOPES:
        tables[f"{scope}_daily_summary"] = _table(
            scope, grains.SUMMARY, {**_counts(*WIDE_COUNTS), **{m: MONEY for m in WIDE_MONEY}})
        tables[f"{scope}_clk_daily_summary"] = _table(
            scope, grains.CLICK, _counts("gross_cnt", "uniq_cnt"),
            province_geoname_id="int", city_geoname_id="int")
        tables[f"{scope}_conv_daily_summary"] = _table(
            scope, grains.CONVERSION,
            {**_counts("gross_cnt", "valid_cnt", "notify_cnt"), "net_profit": MONEY, "tac": MONEY})
        tables[f"{scope}_event_daily_summary"] = _table(
            scope, grains.EVENT,
            {**_counts("gross_cnt", "uniq_cnt", *map(retention_name, RETENTION_DAYS)), "total_amount": EVENT_MONEY})
        tables[f"{scope}_impression_daily_summary"] = _table(
            scope, grains.IMPRESSION, _counts("gross_imp_cnt", "uniq_imp_cnt", "gross_clk_cnt", "uniq_clk_cnt"))
        tables[f"{scope}_demand_daily_summary"] = _table(
            scope, grains.DEMAND, {**_counts("clks", "uniq_clks"), "cost": MONEY},
            campaign_id="string", connection_type="int")
    tables["adx_invalid_conv_daily_summary"] = _table(
        "adx", grains.INVALID_CONVERSION, _counts("invalid_cnt"))
    tables["gmt_supply_daily_summary"] = _table("gmt", grains.SUPPLY, {**_counts("clks"), "revenue": MONEY})
    return tables


SUMMARY_TABLES = _summary_tables()
