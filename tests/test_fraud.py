import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from adtally.operators import fraud, lists
from tests.conftest import values

CONV = "ip string, invalid_type string, clk_timestamp int"
CLICK = "ip string, clk_timestamp int"


def test_threshold_is_exclusive(frame):
    rows = [("five", 7200 + i) for i in range(5)] + [("six", 7200 + i) for i in range(6)]
    counts = fraud.hourly_counts(frame(rows, CLICK), ["ip"], more_than=5)
    assert values(counts) == [("1970010102", "six", 6)]
    assert values(fraud.hourly_counts(frame(rows, CLICK), ["ip"]), "ip", "cnt") == [("five", 5), ("six", 6)]


def test_ip_profile(frame):
    rows = [("a", "", 1), ("a", "", 2), ("a", "E001", 3), ("b", "", 4), ("c", "E005", 5), ("c", "E004", 6)]
    profile = fraud.ip_profile(frame(rows, CONV))
    assert values(profile) == [("a", 3, 2, 1, 0, 0, 0, 0.6667), ("c", 2, 0, 0, 0, 0, 1, 0.0)]


def repeated(rows):
    """Brute force: later distinct seconds of the same ip and reason."""
    seen = defaultdict(set)
    for ip, kind, at in rows:
        if kind:
            seen[ip, kind].add(at)
    return {(ip, at) for (ip, _), times in seen.items() for at in times if at > min(times)}


def test_first_invalid_conversion_does_not_count(frame):
    rows = [("a", "E001", 5), ("a", "E001", 5), ("a", "E002", 9), ("b", "E001", 7), ("b", "E001", 3), ("b", "", 1)]
    assert set(values(fraud.repeated_invalid(frame(rows, CONV)))) == repeated(rows) == {("b", 7)}
    more = rows + [("b", "E001", 11), ("b", "E002", 3)]
    assert values(fraud.repeated_click_times(frame(more, CONV)), "ip", "clk_times") == [("b", "7,11")]
    days = more + [("b", "E001", 86400 + 5)]
    assert values(fraud.repeated_click_times(frame(days, CONV)), "ip", "clk_times") == [("b", "7,11"), ("b", "86405")]


@pytest.mark.parametrize("radius", [1, 10, 45, 90])
def test_click_radius_against_brute_force(frame, radius):
    rng = random.Random(radius)
    # One ip holds a third of everything, in bursts on few seconds.
    ips = ["hot"] * 10 + [f"ip{i}" for i in range(20)] + [""]
    conv = [(rng.choice(ips), rng.choice(["", "E001", "E002"]), rng.randrange(0, 20000)) for _ in range(300)]
    click = [(rng.choice(ips), rng.randrange(0, 20000) // 7 * 7) for _ in range(3000)]
    per_ip = defaultdict(list)
    for ip, at in click:
        per_ip[ip].append(at)
    expected = {
        (ip, at, sum(abs(c - at) <= radius * 60 for c in per_ip[ip])) for ip, at in repeated(conv) if ip
    }
    got = fraud.clicks_around_invalid(frame(conv, CONV), frame(click, CLICK), radius)
    assert set(values(got, "ip", "clk_timestamp", "click_cnt")) == expected
    assert got.count() == len(expected)


def test_click_radius_edges(frame):
    conv = [("a", "E001", 0), ("a", "E001", 7200)]
    click = [("a", 7200 - 600), ("a", 7200 - 601), ("a", 7200 + 600), ("a", 7200 + 601), ("a", 7200), ("b", 7200)]
    assert values(fraud.clicks_around_invalid(frame(conv, CONV), frame(click, CLICK))) == [("a", 7200, 3)]
    assert values(fraud.clicks_around_invalid(frame(conv, CONV), frame([("b", 1)], CLICK))) == [("a", 7200, 0)]


def test_click_radius_makes_no_pairs(frame):
    probes = frame([("a", 0)], "ip string, clk_timestamp int")
    got = fraud.clicks_around(probes, frame([("a", 1)], CLICK), "ip", 600)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" not in plan and "Cartesian" not in plan and plan.count("Join") == 1


def test_sliding_window_against_brute_force(spark, frame):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.choice(["g1", "{gaid}", None]), "i1", rng.randrange(0, 400)) for _ in range(200)]
    log = frame(rows, "ip string, gaid string, idfa string, at int")
    got = fraud.sliding_counts(fraud.traffic_keys(log, F.timestamp_seconds("at")))
    expected = Counter()
    for ip, gaid, idfa, at in rows:
        device = gaid if gaid and "{" not in gaid else idfa
        for start in range(at // 20 * 20 - 40, at // 20 * 20 + 1, 20):
            expected[start, "10001", ip] += 1
            expected[start, "10002", device] += 1
    assert values(got) == sorted((*k, n) for k, n in expected.items())


def test_list_filter(spark, frame, tmp_path):
    log = frame([(1, "a"), (2, "b"), (3, "c"), (1, "d")], "group_id int, x string")
    listed = frame([("1",), ("1",), ("3",)], "group_id string")
    assert values(lists.keep_listed(log, listed)) == [(1, "a"), (1, "d"), (3, "c")]
