import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adtally import grains
from adtally.functions import identity, measures, sqlnames, text
from adtally.functions import time as tm

DAY = dt.date(2024, 1, 10)
MIDNIGHT = int(dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc).timestamp())


def one(spark, column, layout="x int", row=(0,)):
    return spark.createDataFrame([row], layout).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("offset, epoch, day", [
    (-8.0, MIDNIGHT, dt.date(2024, 1, 9)),
    (0.0, MIDNIGHT, DAY),
    (0.0, MIDNIGHT - 1, dt.date(2024, 1, 9)),
    (5.5, MIDNIGHT - 19800, DAY),
    (5.5, MIDNIGHT - 19801, dt.date(2024, 1, 9)),
    (8.0, MIDNIGHT + 16 * 3600, dt.date(2024, 1, 11)),
    (0.0, -1, dt.date(1969, 12, 31)),
])
def test_local_day(spark, offset, epoch, day):
    assert one(spark, tm.local_day("e", "o"), "e int, o float", (epoch, offset)) == day


def test_hours(spark):
    assert one(spark, tm.utc_hour("e"), "e int", (MIDNIGHT + 3 * 3600 + 59,)) == "2024011003"


@pytest.mark.parametrize("offset, name", [
    (5.5, "GMT+5:30"), (0.0, "GMT+0:00"), (-4.0, "GMT-4:00"), (-3.5, "GMT-3:30"), (8.0, "GMT+8:00"),
])
def test_zone_name(spark, offset, name):
    assert one(spark, tm.zone_name("o"), "o float", (offset,)) == name


def test_time_left(spark):
    now = MIDNIGHT + 3600 + 61
    assert one(spark, tm.millis_left_in_day("e", "o"), "e long, o float", (now * 1000, 1.0)) == (86400 - 7261) * 1000
    assert one(spark, tm.seconds_left_in_day("e", "o"), "e long, o float", (now, 1.0)) == 86400 - 7260


def test_parse_timestamp(spark):
    assert one(spark, tm.parse_timestamp("s"), "s string", ("2024-01-10 01:00:00",)) == MIDNIGHT + 3600
    assert one(spark, tm.parse_timestamp("s"), "s string", ("junk",)) is None


def test_date_arguments():
    today = dt.date(2024, 1, 10)
    assert tm.day_after(-1, today) == dt.date(2024, 1, 9)
    assert tm.days_back(dt.date(2024, 1, 7), today) == 3
    with pytest.raises(ValueError):
        tm.days_back(today, today)
    assert tm.day_range(dt.date(2024, 1, 8), dt.date(2024, 1, 9), today) == [dt.date(2024, 1, 8), dt.date(2024, 1, 9)]
    with pytest.raises(ValueError):
        tm.day_range(dt.date(2024, 1, 9), dt.date(2024, 1, 8), today)


@pytest.mark.parametrize("value, out", [
    (None, ""), ("", ""), ("  ", ""), ("NULL", ""), ("null", ""), (" null", " null"), ("x", "x"),
])
def test_blank_to_empty(spark, value, out):
    assert one(spark, text.blank_to_empty("s"), "s string", (value,)) == out


def test_text_mod(spark):
    assert one(spark, text.text_mod("s", 7), "s string", ("abc",)) == sum(b"abc") % 7
    # the low byte of é is 0xe9, which is negative as a signed byte
    assert one(spark, text.text_mod("s", 1000), "s string", ("é",)) == 0xE9 - 256
    assert one(spark, text.int_mod("x", 4), "x int", (-7,)) == -3
    assert one(spark, text.text_mod("s", 7), "s string", ("",)) == 0


def test_arrays(spark):
    layout = "a array<string>"
    assert one(spark, text.last_or_zero("a"), layout, (["1", "2"],)) == "2"
    assert one(spark, text.last_or_zero("a"), layout, ([],)) == "0"
    assert one(spark, text.last_or_zero("a"), layout, (None,)) == "0"
    assert one(spark, text.first_as_int("a"), layout, (["7", "8"],)) == 7
    assert one(spark, text.first_as_int("a"), layout, (["x"],)) == 0
    assert one(spark, text.last_as_int("a"), layout, ([],)) == 0


def test_identity(spark):
    layout = "a string, b string, c string"
    assert one(spark, identity.visitor("a", "b", "c"), layout, ("x", None, "z")) == "xz"
    assert one(spark, identity.first_filled("a", "b"), layout, ("", "d", None)) == "d"
    assert one(spark, identity.first_filled("a", "c"), layout, ("", "d", None)) == ""
    assert one(spark, identity.device_key(["a"], ["b", "c"]), layout, ("", "ip", None)) == "ip"
    assert one(spark, identity.device_key(["a"], ["b", "c"]), layout, ("h", "ip", None)) == "h"
    assert one(spark, identity.advertising_id("a", "b"), layout, ("{gaid}", "i", None)) == "i"
    assert one(spark, identity.advertising_id("a", "b"), layout, ("g", "i", None)) == "g"
    assert one(spark, identity.advertising_id("a", "b"), layout, ("{gaid}", "{idfa}", None)) == ""


@pytest.mark.parametrize("seconds, days, flags", [
    (-86401, -1, (1, 1, 1, 1, 1)), (-1, 0, (1, 1, 1, 1, 1)), (86399, 0, (1, 1, 1, 1, 1)),
    (86400, 1, (0, 1, 1, 1, 1)), (2 * 86400, 2, (0, 0, 1, 1, 1)), (7 * 86400, 7, (0, 0, 0, 1, 1)),
    (15 * 86400, 15, (0, 0, 0, 0, 1)), (30 * 86400 - 1, 29, (0, 0, 0, 0, 1)), (30 * 86400, 30, (0, 0, 0, 0, 0)),
])
def test_retention(spark, seconds, days, flags):
    row = (MIDNIGHT + seconds, MIDNIGHT)
    assert one(spark, measures.retention_days("e", "i"), "e int, i int", row) == days
    got = tuple(one(spark, measures.retained_within("e", "i", n), "e int, i int", row)
                for n in measures.RETENTION_DAYS)
    assert got == flags
    counts = measures.retention_counts(F.lit(days), F.lit(1))
    assert tuple(one(spark, c) for c in counts) == flags


@pytest.mark.parametrize("code, days, out", [
    (0, 0, 0), (1, 0, 9), (2, 0, 4), (10, 0, 0), (91, 0, 4), (91, 1, 0), (92, 1, 4), (97, 6, 4), (97, 7, 0),
    (915, 14, 4), (930, 29, 4), (930, 30, 0), (7, 0, 0), (-1, 0, 0), (803, 2, 0),
])
def test_kpi(spark, code, days, out):
    value = measures.kpi_count(F.lit(code), F.lit(days), F.lit(9), F.lit(4))
    assert one(spark, value) == out


@pytest.mark.parametrize("code, days, out", [
    (0, 0, 0), (1, 0, 9.0), (-1, 0, -9.0), (2, 0, 4.0), (-2, 0, -4.0), (7, 0, 1.25), (-7, 0, -1.25),
    (-91, 0, -4.0), (801, 0, 4.0), (803, 2, 4.0), (803, 3, 0), (-803, 2, -4.0), (900, 99, 0), (800, -1, 0),
])
def test_kpi_extended(spark, code, days, out):
    units = measures.kpi_amount_units(F.lit(code), F.lit(days), F.lit(9), F.lit(4), F.lit(1.25))
    assert float(one(spark, units)) == out


def test_kpi_day(spark):
    def day(code):
        return one(spark, measures.kpi_day(F.lit(code), F.lit("event"), F.lit("install")))

    assert [day(c) for c in (-803, 1, 7, 10, 91, 803)] == ["event", "event", "event", None, "install", "install"]


def test_row_key(spark):
    row = (5.5, DAY, 1, 2, 3, "p", 0)
    layout = "timezone float, dated date, campaign_id int, group_id int, aff_id int, aff_pub string, algorithm int"
    key = measures.row_key(grains.keys("adx", grains.SUMMARY))
    expected = hashlib.md5(b"5.5||2024-01-10||1||2||3||p||0||").hexdigest()
    assert one(spark, key, layout, row) == expected


def test_money_is_order_independent(spark):
    amounts = [0.1, 0.2, 0.3, 1e6, -1e6, 12.3456]
    for order in (amounts, amounts[::-1]):
        df = spark.createDataFrame([(a,) for a in order], "a double")
        assert df.select(measures.money(F.sum(measures.money_units("a"))).alias("v")).first()["v"] == Decimal("12.9456")
    assert one(spark, measures.money_units("a"), "a double", (None,)) == 0


def test_small_amounts_add_up(spark):
    total = spark.range(100_000).select(measures.money(F.sum(measures.money_units(F.lit(0.00004)))).alias("v"))
    assert total.first()["v"] == 4


def test_sql_functions_match_the_columns(spark):
    sqlnames.register(spark)
    row = spark.sql("""
        SELECT getFormatDate(1704844800 + 5.5 * 3600) AS d, getFormatDateToHour(1704844800L) AS h,
               uvGenerator('a', NULL, 'c', '', 'e') AS u, retentDays(0, 86401) AS r,
               getLast(array('x', 'y')) AS l, getLast(array()) AS l0, domainSelect('', 'b') AS dom,
               uvSelect('', NULL, '', '', '', 'm', 'i', 'u', 'h') AS uv,
               uvSelect('', '', '', '', '', '', 'i', 'u', 'h') AS ip,
               getMod(-7, 4) AS m, hasNotChar('{gaid}', '{') AS c""").first()
    assert tuple(row) == ("2024-01-10", "2024011000", "ace", -1, "y", "0", "b", "m", "iuh", -3, False)
