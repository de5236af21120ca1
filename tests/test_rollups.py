import datetime as dt

import pytest
from pyspark.sql import functions as F

from adtally import grains, schemas
from adtally.operators import click, conversion, demand, event, impression
from adtally.operators.rollup import of_scope
from adtally.sources import logs
from tests.conftest import values

MIDNIGHT = int(dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc).timestamp())
D9, D10 = dt.date(2024, 1, 9), dt.date(2024, 1, 10)


def records(spark, schema, rows):
    """Records from dicts; every other field is missing and then filled."""
    names = schema.fieldNames()
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
    return logs.filled(df, schema)


def clicks(spark, rows):
    return records(spark, schemas.CLICK, rows)


def test_click_days_differ_by_scope(spark):
    log = clicks(spark, [
        {"timezone": -8.0, "clk_timestamp": MIDNIGHT, "ip": "a"},
        {"timezone": -8.0, "clk_timestamp": MIDNIGHT, "ip": "a"},
        {"timezone": -8.0, "clk_timestamp": MIDNIGHT, "ip": "b"},
        {"timezone": 5.5, "clk_timestamp": MIDNIGHT, "ip": "a"},
    ])
    projected = click.project(log)
    adx = click.daily(projected, "adx")
    assert values(adx, "timezone", "dated", "gross_cnt", "uniq_cnt") == [(-8.0, D9, 3, 2), (5.5, D10, 1, 1)]
    gmt = click.daily(projected, "gmt")
    assert values(gmt, "dated", "gross_cnt", "uniq_cnt") == [(D10, 4, 2)]
    both = click.daily_by_scope(log)
    for scope, direct in (("adx", adx), ("gmt", gmt)):
        again = of_scope(both, scope, grains.CLICK).select(*direct.columns)
        assert values(again) == values(direct)
        staged = click.daily_from_visits(click.visits(projected), scope)
        assert values(staged) == values(direct)


def test_visitor_collision(spark):
    log = clicks(spark, [{"ip": "ab", "ua": "c"}, {"ip": "a", "ua": "bc"}])
    assert values(click.daily(click.project(log), "gmt"), "uniq_cnt") == [(1,)]
    assert values(click.daily_two_step(log, "gmt"), "uniq_cnt") == [(2,)]


def test_coarse_uniques_add_up(spark):
    log = clicks(spark, [{"ip": "a", "os": "x"}, {"ip": "a", "os": "y"}])
    fine = click.daily(click.project(log), "gmt")
    assert values(click.summary(fine, "gmt"), "gross_clk_cnt", "uniq_clk_cnt") == [(2, 2)]


def test_sketches_stay_within_their_error(spark):
    log = spark.range(60000).select(
        F.lit(0.0).alias("timezone"), (F.col("id") % 2).cast("int").alias("aff_id"), F.lit(0).alias("clk_timestamp"),
        (F.col("id") % 20000).cast("string").alias("ip"))
    for field in schemas.CLICK.fields:
        if field.name not in log.columns:
            log = log.withColumn(field.name, F.lit(None).cast(field.dataType))
    log = logs.filled(log, schemas.CLICK)
    fine = click.approx_daily(click.project(log), "gmt")
    merged = click.merge_sketches(fine, ["dated"]).first()
    assert merged.gross_cnt == 60000
    assert abs(merged.uniq_cnt - 20000) <= 0.049 * 20000
    blank = click.approx_daily(click.project(clicks(spark, [{}, {}])), "gmt")
    assert values(blank, "gross_cnt", "uniq_cnt") == [(2, 1)]


def conversions(spark, rows):
    return records(spark, schemas.CONVERSION, rows)


CONVERSIONS = [
    {"click_id": "a", "conv_timestamp": MIDNIGHT + 5, "invalid_type": "E001", "net_profit": 1.0, "forwarded": 1},
    {"click_id": "a", "conv_timestamp": MIDNIGHT + 1, "net_profit": 2.0, "tac": 0.5, "forwarded": 1},
    {"click_id": "", "conv_timestamp": MIDNIGHT + 2, "invalid_type": "E005"},
    {"click_id": None, "conv_timestamp": MIDNIGHT + 3, "net_profit": 9.0},
    {"click_id": "b", "conv_timestamp": MIDNIGHT + 4, "net_profit": 4.0},
]


def test_conversion_dedup_keeps_the_earliest(spark):
    unique = conversion.dedup(conversions(spark, CONVERSIONS))
    assert values(unique, "click_id", "conv_timestamp", "invalid_type") == [
        ("", MIDNIGHT + 2, "E005"), ("a", MIDNIGHT + 1, ""), ("b", MIDNIGHT + 4, "")]


def test_conversion_measures(spark):
    unique = conversion.dedup(conversions(spark, CONVERSIONS))
    fine = conversion.daily(conversion.project(unique), "gmt")
    assert values(fine, "gross_cnt", "valid_cnt", "notify_cnt", "net_profit", "tac") == [(3, 2, 1, 6.0, 0.5)]
    coarse = conversion.summary(fine, "gmt")
    assert values(coarse, "gross_conv_cnt", "valid_conv_cnt", "notify_conv_cnt") == [(3, 2, 1)]
    invalid = conversion.invalid_daily(conversion.project(unique))
    assert values(invalid, "invalid_type", "invalid_cnt") == [("E005", 1)]
    by_reason = conversion.counts_by_reason(unique)
    assert values(of_scope(conversion.over_reasons(by_reason, grains.CONVERSION), "gmt", grains.CONVERSION)
                  .select(*fine.columns)) == values(fine)
    assert values(conversion.invalid_by_reason(by_reason), "invalid_type", "invalid_cnt") == [("E005", 1)]


def test_conversion_counts_once_per_click(spark):
    once = conversion.daily_once_per_click(conversions(spark, CONVERSIONS), "gmt")
    # "a" is valid in one record and notified in both; its earliest record gives the amounts.
    assert values(once, "gross_cnt", "valid_cnt", "notify_cnt", "net_profit", "tac") == [(3, 3, 1, 6.0, 0.5)]


def test_dedup_windows_of_a_backfill_stay_apart(spark):
    log = conversions(spark, [
        {"click_id": "a", "conv_timestamp": MIDNIGHT - 3 * 86400},
        {"click_id": "a", "conv_timestamp": MIDNIGHT},
    ])
    days = [D10 - dt.timedelta(days=k) for k in range(5)]
    unique = conversion.dedup(conversion.per_target_day(log, days), ["target_day"])
    fine = conversion.counts_by_reason(unique).where("dated = target_day and scope = 'gmt'")
    # Three days apart, so neither is in the window of the other's day.
    assert values(fine, "dated", "gross_cnt") == [(dt.date(2024, 1, 7), 1), (D10, 1)]


def events(spark, rows):
    return records(spark, schemas.EVENT, rows)


def test_event_counts_retention_and_kpi(spark):
    event_at = MIDNIGHT + 3600
    log = events(spark, [
        {"click_id": "a", "event_timestamp": event_at, "install_timestamp": event_at - 86400, "kpi": 92,
         "order_amount": 1.5, "order_currency": "USDX"},
        {"click_id": "a", "event_timestamp": event_at, "install_timestamp": event_at - 86400, "kpi": 92,
         "order_amount": 2.5, "order_currency": "USDX"},
        {"click_id": "a", "event_timestamp": event_at, "install_timestamp": event_at - 40 * 86400, "kpi": 1,
         "order_currency": "USDX"},
    ])
    fine = event.fine(event.project(log), "gmt")
    counts = event.daily(fine, "gmt")
    # "a" counts once per fine row, so twice in all.
    assert values(counts, "dated", "currency", "gross_cnt", "uniq_cnt", "total_amount") == [(D10, "USD", 3, 2, 4.0)]
    kept = event.retention(fine, "gmt")
    assert values(kept, "dated", *event.RETENTION) == [(D9, 0, 1, 1, 1, 1)]
    assert values(event.kpi(fine, "gmt"), "dated", "kpi_event_cnt") == [(D9, 1), (D10, 1)]


def test_event_before_install_counts_everywhere(spark):
    log = events(spark, [{"click_id": "a", "event_timestamp": MIDNIGHT, "install_timestamp": MIDNIGHT + 2 * 86400}])
    fine = event.fine(event.project(log), "gmt")
    assert values(fine, "retent_days") == [(-2,)]
    assert values(event.retention(fine, "gmt"), *event.RETENTION) == [(1, 1, 1, 1, 1)]


def test_extended_kpi(spark):
    rows = [{"click_id": "a", "event_timestamp": MIDNIGHT, "install_timestamp": MIDNIGHT - 2 * 86400,
             "order_amount": 2.25, "kpi": k, "aff_id": i} for i, k in enumerate([7, -7, 803, -803, 10, 802])]
    out = event.kpi_extended(event.fine(event.project(events(spark, rows)), "gmt"), "gmt")
    day8 = dt.date(2024, 1, 8)
    assert values(out, "aff_id", "dated", "kpi_value") == [
        (0, D10, 2.25), (1, D10, -2.25), (2, day8, 1.0), (3, D10, -1.0)]


IMPRESSIONS = [
    {"publisher_id": 1, "request_unix": MIDNIGHT, "option": {"region_ids": ["5", "6"], "ip": "a", "os": "x"}},
    {"publisher_id": 2, "request_unix": MIDNIGHT, "option": {"region_ids": ["7"], "ip": "a"}},
    {"publisher_id": 3, "request_unix": MIDNIGHT, "option": {"region_ids": [], "ip": "a"}},
    {"publisher_id": 4, "request_unix": MIDNIGHT, "option": {"region_ids": ["x", "y"], "ip": "a"}},
    {"publisher_id": 5, "request_unix": MIDNIGHT, "option": None},
    {"publisher_id": 6, "request_unix": None, "option": {"region_ids": None}},
]


def impressions(spark):
    names = schemas.IMPRESSION.fieldNames()
    option = schemas.IMPRESSION["option"].dataType.fieldNames()

    def nested(o):
        return None if o is None else tuple(o.get(n) for n in option)

    rows = [tuple(nested(r["option"]) if n == "option" else r.get(n) for n in names) for r in IMPRESSIONS]
    return spark.createDataFrame(rows, schemas.IMPRESSION)


def test_impressions_batch(spark):
    flat = impression.flatten(impressions(spark))
    assert values(flat, "publisher_id", "province_geoname_id", "city_geoname_id") == [
        (1, "5", "6"), (2, "7", "7"), (3, "0", "0"), (4, "x", "y"), (5, "0", "0"), (6, "0", "0")]
    daily = impression.daily(flat, "gmt")
    assert (6, dt.date(1970, 1, 1), 1, 1) in values(daily, "publisher_id", "dated", "gross_imp_cnt", "uniq_imp_cnt")
    assert daily.count() == 6


def test_impressions_stream_form(spark):
    flat = impression.flatten_stream(impressions(spark))
    assert values(flat, "publisher_id", "province_geoname_id", "city_geoname_id") == [
        (1, 5, 6), (2, 7, 7), (3, 0, 0), (4, 0, 0), (6, 0, 0)]


def demands(spark, rows):
    def nested(value, layout):
        if value is None:
            return None
        return tuple(nested(value.get(f.name), f.dataType) if hasattr(f.dataType, "fields") else value.get(f.name)
                     for f in layout.fields)

    return spark.createDataFrame([nested(r, schemas.DEMAND) for r in rows], schemas.DEMAND)


APP_BLANK = {"tz": 0.0, "clickts": MIDNIGHT, "pixelts": MIDNIGHT + 86400, "dcost": 1.5, "srevenue": "2.5",
             "app": {"domain": "", "bundle": "b", "publisher": {"domain": ""}},
             "site": {"domain": "s", "publisher": {"domain": "sp"}},
             "device": {"ip": "i", "ua": "u", "hwv": "h"}}
APP_ABSENT = {**APP_BLANK, "app": None, "srevenue": "n/a", "device": {"macmd5": "m", "ip": "i"}}


def test_domain_choice_differs_between_batch_and_stream(spark):
    log = demands(spark, [APP_BLANK, APP_ABSENT]).withColumn("topic", F.lit("x_clks"))
    batch = demand.flatten(log)
    assert values(batch, "inventory_domain", "publisher_domain", "uv") == [("s", "sp", "iuh"), ("s", "sp", "m")]
    stream = demand.flatten_stream(log)
    assert values(stream, "inventory_domain", "publisher_domain") == [("", ""), ("s", "sp")]


def test_topic_picks_the_time(spark):
    log = demands(spark, [APP_BLANK])
    for topic, kind, epoch in (("x_clks", "clks", MIDNIGHT), ("x_imps", "imps", MIDNIGHT + 86400)):
        flat = demand.flatten_stream(log.withColumn("topic", F.lit(topic)))
        assert values(flat, "kind", "epoch") == [(kind, epoch)]


def test_supply_ignores_text_revenue(spark):
    log = demands(spark, [APP_BLANK, APP_BLANK, APP_ABSENT])
    out = demand.supply_daily(demand.flatten(log))
    assert values(out, "app_bundle", "clks", "revenue") == [("", 1, 0.0), ("b", 2, 5.0)]
    cost = demand.daily(demand.flatten(log), "adx")
    assert values(cost, "app_bundle", "clks", "uniq_clks", "cost") == [("", 1, 1, 1.5), ("b", 2, 1, 3.0)]


def test_unknown_scope():
    with pytest.raises(ValueError):
        grains.keys("utc", [])
