"""The given star-schema tables in the shape of the advertising logs.

``events`` stands for the click, conversion, event and impression logs,
``lineitem`` with ``supplier`` and ``part`` for the demand log. All columns are
computed row by row from the tables. Campaigns, groups, affiliates, publishers,
ips and device ids become more as the tables grow; a third of the traffic comes
from four hot ips and one hot affiliate, and some fields are absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
# What the demand log is made of.
LINEITEM_SCHEMA = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz")

# The ten offsets in use (fixed values).
OFFSETS = [0.0, 5.5, 5.0, -4.0, -5.0, 8.0, -7.0, -8.0, 3.0, 1.0]
KPI_CODES = [0, 1, 2, 7, 91, 92, 97, 915, 930, -1, 803]
# First day of the demand log.
DEMAND_START = 1522540800
DEMAND_DAYS = 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _epoch(ts: str) -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def _text(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def k() -> Column:
    return F.col("k")


def j() -> Column:
    """A coarser number than ``k``, for what does not grow."""
    return F.col("k") % 12


def user() -> Column:
    return F.col("user_id")


def base(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "user_id", "event_type", "value", _epoch("ts").alias("epoch"),
        F.get_json_object("props", "$.k").cast("int").alias("k"))


def _common() -> dict[str, Column]:
    return {
        "timezone": _pick(OFFSETS, user() % 10),
        "campaign_id": _per(user(), 8), "group_id": _per(user(), 40) * 3 + j() % 3,
        "aff_id": F.when(k() % 3 == 1, 1).otherwise(_per(user(), 10)),
        "aff_pub": _absent(k() % 25 == 3, _text("pub", j() % 3)),
        "algorithm": j() % 2,
    }


def _ids() -> dict[str, Column]:
    return {
        "ip": F.when(k() % 3 == 0, _text("10.0.0.", user() % 4)).otherwise(
            F.concat_ws(".", F.lit("10"), 1 + user() % 200, _per(F.col("event_id"), 250) % 250,
                        F.col("event_id") % 250)),
        "ua": _absent(k() % 19 == 5, _text("ua", k() % 3)),
        "gaid": F.when(user() % 4 == 0, "{gaid}").when(
            user() % 2 == 0, _text("g", user() * 100 + k())).otherwise(_absent(user() % 8 == 3, F.lit(""))),
        "idfa": F.when(user() % 4 == 2, "").when(k() % 3 < 2, "i0").otherwise(_text("i", user())),
        "adid": F.lit(""),
    }


def _click_id() -> Column:
    return F.when(k() % 20 == 0, "").otherwise(F.concat(user().cast("string"), F.lit("-"), k().cast("string")))


def _invalid_type() -> Column:
    return F.when(F.col("event_type") == "error", _text("E00", 1 + k() % 5)).otherwise("")


def _install() -> Column:
    days = (user() * 37 + k() * 11) % 44 - 2
    return F.col("epoch") - days * 86400 - (k() % 3) * 10000


def _per(number: Column, size: int) -> Column:
    """Which group of ``size`` numbers in a row a number belongs to."""
    return F.floor(number / size)


def _absent(where: Column, value: Column) -> Column:
    return F.when(~where, value)


def _select(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in columns.items()])


def click_log(events: DataFrame) -> DataFrame:
    return _select(base(events), {
        **_common(), **_ids(),
        "clk_timestamp": F.col("epoch"),
        "country_code": _pick(["IN", "US", "SG", "CN"], j() % 4),
        "province_geoname_id": 1000 + j() % 6, "city_geoname_id": 2000 + j() % 6,
        "os": _absent(k() % 23 == 7, _pick(["Android", "iOS"], j() % 2)),
        "device_type": _pick(["Mobile", "Tablet"], j() % 2),
        "device_make": _text("make", j() % 4), "device_model": _text("model", j() % 6),
    })


def conversion_log(events: DataFrame) -> DataFrame:
    ids = _ids()
    return _select(base(events), {
        **_common(),
        "click_id": _click_id(), "clk_timestamp": F.col("epoch") - (k() % 7) * 60, "conv_timestamp": F.col("epoch"),
        "income": (k() % 4) * F.lit(0.5), "income_currency": _pick(["USD", "EUR"], k() % 2),
        "payout": (k() % 3) * F.lit(0.25), "payout_currency": _pick(["USD", "INR"], k() % 2),
        "invalid_type": _invalid_type(), "forwarded": k() % 2,
        "net_profit": F.col("value") / 10,
        "tac": F.when(k() % 5 == 0, k() / F.lit(1000000.0)).otherwise(F.col("value") / 20),
        **{c: ids[c] for c in ("ip", "gaid", "idfa")},
        "carrier": _text("carrier", k() % 3),
    })


def event_log(events: DataFrame) -> DataFrame:
    return _select(base(events), {
        **_common(), **_ids(),
        "event_value": k() % 4, "install_timestamp": _install(), "event_timestamp": F.col("epoch"),
        "order_amount": F.col("value"), "order_currency": _pick(["USDX", "EURX", "INRX"], k() % 3),
        "kpi": _pick(KPI_CODES, k() % 11), "click_id": _click_id(),
    })


def impression_log(events: DataFrame) -> DataFrame:
    ids = _ids()
    regions = (
        F.when(j() % 5 == 0, F.array().cast("array<string>"))
        .when(j() % 5 == 1, F.array((1000 + j() % 6).cast("string")))
        .when(j() % 5 == 2, F.array(F.lit("x7"), (2000 + j() % 6).cast("string")))
        .otherwise(F.array((1000 + j() % 6).cast("string"), (2000 + j() % 6).cast("string")))
    )
    option = F.struct(
        _pick(["IN", "US", "SG", "CN"], j() % 4).alias("country_code"),
        regions.alias("region_ids"),
        _pick(["Mobile", "Tablet"], j() % 2).alias("devicetype"),
        _text("make", j() % 4).alias("make"), _text("model", j() % 6).alias("model"),
        _pick(["Android", "iOS"], j() % 2).alias("os"), _text("carrier", j() % 3).alias("carrier"),
        _pick(["wifi", "cell"], j() % 2).alias("connectiontype"), _text("a", j() % 4).alias("agegroup"),
        _pick(["m", "f"], j() % 2).alias("gender"),
        *[ids[c].alias(c) for c in ("ip", "ua", "gaid", "idfa")],
    )
    return _select(base(events), {
        "timezone": _pick(OFFSETS, user() % 10), "request_unix": F.col("epoch"),
        "publisher_id": _per(user(), 6), "inventory_id": j() % 6, "plcmt_id": j() % 3, "campaign_id": _per(user(), 8),
        "delivery_id": j() % 4, "ad_id": j() % 6,
        "option": F.when(k() % 13 != 0, option),
    })


def demand_log(lineitem: DataFrame, supplier: DataFrame, part: DataFrame) -> DataFrame:
    """Left to Spark whether supplier and part are broadcast; both grow with the data."""
    line = F.col("l_linenumber")
    order = F.col("l_orderkey")
    nation = F.col("s_nationkey")
    rows = (
        lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                        "l_returnflag", "l_shipdate")
        .join(supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
        .join(part.select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey")
    )
    ship_day = F.floor(_epoch("l_shipdate") / 86400)
    epoch = F.lit(DEMAND_START) + (ship_day % DEMAND_DAYS) * 86400 + (order * 7919 + line * 3571) % 86400
    app_domain = F.when(F.col("l_partkey") % 5 == 0, "").otherwise(_text("app", line % 2))
    hashed = {
        "didsha1": F.when(order % 5 == 0, _text("s", order)).otherwise(""),
        "didmd5": F.when(order % 7 == 0, _text("d", order)),
        "dpidsha1": F.when(order % 2 == 0, _text("h", order)).otherwise(""),
        "dpidmd5": F.when(order % 3 == 0, _text("p", order)),
        "macsha1": F.lit(""),
        "macmd5": F.when(order % 11 == 0, _text("m", order)),
    }
    return _select(rows, {
        "tz": _pick(OFFSETS, nation % 5), "demand": F.col("l_returnflag"), "cid": _text("b", _per(F.col("l_partkey"), 100)),
        "crid": _text("cr", line % 2), "dcost": F.col("l_extendedprice"),
        "dcostcur": _pick(["USD", "EUR"], line % 2),
        "srevenue": F.when(line == 7, "n/a").otherwise(
            F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".25"))),
        "srevenuecur": _pick(["USD", "EUR"], line % 2), "supply": _text("s", _per(F.col("l_suppkey"), 25)),
        "tagid": _text("t", line % 2), "uagrp": _text("u", line % 2), "clickts": epoch, "pixelts": epoch,
        "site": F.struct(
            F.lit("site").alias("domain"), F.struct(F.lit("sitepub").alias("domain")).alias("publisher")),
        "app": F.when(line % 3 != 0, F.struct(
            app_domain.alias("domain"), _text("bundle", line % 2).alias("bundle"),
            F.struct(app_domain.alias("domain")).alias("publisher"))),
        "geo": F.when(nation % 5 != 4, F.struct(
            _text("C", nation % 5).alias("cc"), (nation % 5 * 10).alias("pgeonid"),
            (nation % 5 * 100).alias("cgeonid"))),
        "device": F.struct(
            F.concat_ws(".", F.lit("10.0"), _per(order, 250), order % 250).alias("ip"), _text("ua", order % 3).alias("ua"), F.lit("hw").alias("hwv"),
            _text("make", line % 2).alias("make"), _text("model", line % 2).alias("model"),
            _pick(["Android", "iOS"], line % 2).alias("os"), F.lit("carrier").alias("carrier"),
            (line % 2).alias("connectiontype"), *[c.alias(n) for n, c in hashed.items()]),
        "user": F.struct(_pick(["m", "f"], line % 2).alias("gender")),
    })


def group_list(supplier: DataFrame) -> DataFrame:
    """A lookup list of group ids: twice the nations that have a supplier, so many even numbers."""
    return supplier.select((F.col("s_nationkey") * 2).cast("string").alias("group_id")).distinct()


def as_messages(log: DataFrame, topic: Column | None = None) -> DataFrame:
    """Records as JSON text, the way a message stream delivers them."""
    value = F.to_json(F.struct(*log.columns)).alias("value")
    return log.select(value) if topic is None else log.select(topic.alias("topic"), value)
