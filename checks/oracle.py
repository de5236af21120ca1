"""For every registered query the same result as a DuckDB statement."""

from __future__ import annotations

from checks.logs_sql import (BASE, CLICK_LOG, CONVERSION_LOG, EVENT_LOG, IMPRESSION_LOG, cut, day, demand_log,
                             money_sum, rounded, units)

SUMMARY = ["campaign_id", "group_id", "aff_id", "aff_pub", "algorithm"]
CLICK = ["campaign_id", "group_id", "aff_id", "aff_pub", "country_code", "province_geoname_id", "city_geoname_id",
         "os", "device_type", "device_make", "device_model", "algorithm"]
CONV = ["campaign_id", "group_id", "aff_id", "aff_pub", "income", "income_currency", "payout", "payout_currency",
        "algorithm"]
INVALID = ["campaign_id", "group_id", "aff_id", "aff_pub", "invalid_type", "algorithm"]
EVENT = ["campaign_id", "group_id", "aff_id", "aff_pub", "event_value", "currency", "algorithm"]
IMP = ["publisher_id", "inventory_id", "plcmt_id", "campaign_id", "delivery_id", "ad_id", "country_code",
       "province_geoname_id", "city_geoname_id", "device_type", "make", "model", "os", "carrier", "connection_type",
       "age_group", "gender"]
DEMAND = ["demand", "campaign_id", "creative_id", "supply", "publisher_domain", "inventory_domain", "app_bundle",
          "tagid", "country_code", "province_geonameid", "city_geonameid", "device_make", "device_model", "os",
          "carrier", "connection_type", "age_group", "gender", "currency"]
SUPPLY = ["supply", "publisher_domain", "inventory_domain", "app_bundle", "tagid", "currency"]
RETENTION = ["in1_retention_cnt", "in2_retention_cnt", "in7_retention_cnt", "in15_retention_cnt",
             "in30_retention_cnt"]
SPANS = [1, 2, 7, 15, 30]

ORACLE: dict[str, str] = {}


def keys(scope: str, dims: list[str]) -> list[str]:
    return (["timezone"] if scope == "adx" else []) + ["dated", *dims]


def commas(names: list[str]) -> str:
    return ", ".join(names)


def row_key(names: list[str]) -> str:
    formats = {"timezone": "%.1f", "income": "%.2f", "payout": "%.2f"}
    parts = [f"printf('{formats[n]}', {n})" if n in formats else f"CAST({n} AS VARCHAR)" for n in names]
    return "md5(" + " || '||' || ".join(parts) + " || '||') AS unionk"


def local(epoch: str, scope: str) -> str:
    return cut(f"{epoch} + timezone * 3600") if scope == "adx" else epoch


def dated(epoch: str, scope: str, name: str = "dated") -> str:
    return f"{day(local(epoch, scope))} AS {name}"


def grouped(source: str, names: list[str], measures: str, where: str = "") -> str:
    return f"SELECT {commas(names)}, {measures} FROM {source} {where} GROUP BY {commas(names)}"


def keyed(select: str, names: list[str]) -> str:
    return f"SELECT *, {row_key(names)} FROM ({select})"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ------------------------------------------------------------------- clicks

VISITOR = "ip || ua || gaid || idfa || adid"


def click_days(scope: str) -> str:
    return f"(SELECT *, {dated('clk_timestamp', scope)} FROM click_log)"


def click_fine(scope: str, source: str | None = None) -> str:
    return grouped(source or click_days(scope), keys(scope, CLICK),
                   f"count(*) AS gross_cnt, count(DISTINCT {VISITOR}) AS uniq_cnt")


def click_coarse(scope: str, source: str | None = None) -> str:
    return grouped(f"({click_fine(scope, source)})", keys(scope, SUMMARY),
                   "CAST(sum(gross_cnt) AS BIGINT) AS gross_clk_cnt, CAST(sum(uniq_cnt) AS BIGINT) AS uniq_clk_cnt")


CLICKS = with_(BASE, CLICK_LOG)
for s in ("adx", "gmt"):
    ORACLE[f"click_daily_{s}"] = CLICKS + keyed(click_fine(s), keys(s, CLICK))
    ORACLE[f"click_daily_from_visits_{s}"] = ORACLE[f"click_daily_{s}"]
    ORACLE[f"click_summary_{s}"] = CLICKS + keyed(click_coarse(s), keys(s, SUMMARY))
    ORACLE[f"click_uniq_two_step_{s}"] = CLICKS + keyed(
        grouped(click_days(s), keys(s, CLICK),
                "count(*) AS gross_cnt, count(DISTINCT (ip, ua, gaid, idfa, adid)) AS uniq_cnt"), keys(s, CLICK))

ORACLE["uniq_approx"] = CLICKS + grouped(
    click_days("gmt"), ["dated", "campaign_id"],
    f"count(*) AS gross_cnt, count(DISTINCT {VISITOR}) AS exact_uniq_cnt, CAST(1 AS BIGINT) AS within_bound")

ORACLE["uniq_reach_bound"] = CLICKS + f"""
SELECT aff_id, count(*) AS gross_cnt, count(DISTINCT {VISITOR}) AS exact_uniq_cnt, CAST(1 AS BIGINT) AS within_bound
FROM click_log GROUP BY aff_id"""

ORACLE["local_day_three_file_window"] = CLICKS + f"""
SELECT timezone, CAST(d AS VARCHAR) AS dated, count(*) AS gross_cnt,
       count(*) FILTER (WHERE f - d = -1) AS day_before_cnt, count(*) FILTER (WHERE f - d = 0) AS same_day_cnt,
       count(*) FILTER (WHERE f - d = 1) AS day_after_cnt
FROM (SELECT timezone, CAST({day(local('clk_timestamp', 'adx'))} AS DATE) AS d,
             CAST({day('clk_timestamp')} AS DATE) AS f FROM click_log)
GROUP BY timezone, d"""

ORACLE["group_list_filter"] = CLICKS + """
SELECT group_id, clk_timestamp, campaign_id, ip, ua FROM click_log
WHERE group_id IN (SELECT s_nationkey * 2 FROM supplier)"""

# -------------------------------------------------------------- conversions

FIRST_BY = ["conv_timestamp", "timezone", "campaign_id", "group_id", "aff_id", "aff_pub", "income",
            "income_currency", "payout", "payout_currency", "algorithm", "invalid_type", "forwarded", "net_profit",
            "tac"]
DEDUP = f"""conv AS (
  SELECT click_id, {commas(FIRST_BY)} FROM (
    SELECT *, row_number() OVER (PARTITION BY click_id ORDER BY {commas(FIRST_BY)}) AS rn FROM conv_log)
  WHERE rn = 1)"""
CONVERSIONS = with_(BASE, CONVERSION_LOG, DEDUP)

MONEY = f"{money_sum('net_profit')} AS net_profit, {money_sum('tac')} AS tac"
CONV_COUNTS = ("count(*) AS gross_cnt, count(*) FILTER (WHERE invalid_type = '') AS valid_cnt, "
               "count(*) FILTER (WHERE forwarded = 1) AS notify_cnt")


def conv_days(scope: str, source: str = "conv") -> str:
    return f"(SELECT *, {dated('conv_timestamp', scope)} FROM {source})"


def conv_fine(scope: str) -> str:
    return grouped(conv_days(scope), keys(scope, CONV), f"{CONV_COUNTS}, {MONEY}")


def conv_coarse(scope: str) -> str:
    return grouped(conv_days(scope), keys(scope, SUMMARY),
                   CONV_COUNTS.replace("_cnt", "_conv_cnt") + f", {MONEY}")


ORACLE["conv_dedup"] = CONVERSIONS + f"SELECT click_id, {commas(FIRST_BY)} FROM conv"
ORACLE["conv_detail_records"] = CONVERSIONS + """
SELECT concat_ws('<;>', click_id, group_id, campaign_id, aff_id, CASE WHEN aff_pub = '' THEN '0' ELSE aff_pub END,
                 invalid_type, printf('%.1f', income),
                 income_currency, rtrim(printf('%.2f', payout), '0') || CASE WHEN payout = 0 THEN '0' ELSE '' END,
                 payout_currency, forwarded, ip, gaid, idfa, carrier, clk_timestamp, conv_timestamp) AS value
FROM conv_log"""
for s in ("adx", "gmt"):
    ORACLE[f"conv_daily_{s}"] = CONVERSIONS + keyed(conv_fine(s), keys(s, CONV))
    ORACLE[f"conv_summary_{s}"] = CONVERSIONS + keyed(conv_coarse(s), keys(s, SUMMARY))
    names = keys(s, CONV)
    ORACLE[f"conv_once_counts_{s}"] = CONVERSIONS + keyed(f"""
SELECT {commas(names)}, count(*) AS gross_cnt, CAST(sum(valid) AS BIGINT) AS valid_cnt,
       CAST(sum(notified) AS BIGINT) AS notify_cnt, {MONEY}
FROM (SELECT *, row_number() OVER (PARTITION BY {commas(names)}, click_id
                                   ORDER BY conv_timestamp, net_profit, tac) AS rn,
             max(CAST(invalid_type = '' AS INTEGER)) OVER (PARTITION BY {commas(names)}, click_id) AS valid,
             max(CAST(forwarded = 1 AS INTEGER)) OVER (PARTITION BY {commas(names)}, click_id) AS notified
      FROM {conv_days(s, 'conv_log')})
WHERE rn = 1 GROUP BY {commas(names)}""", names)
ORACLE["conv_invalid_adx"] = CONVERSIONS + keyed(
    grouped(conv_days("adx"), keys("adx", INVALID), "count(*) AS invalid_cnt", "WHERE invalid_type <> ''"),
    keys("adx", INVALID))

# ------------------------------------------------------------------- events


def event_fine_cte(scope: str) -> str:
    zone = ["timezone"] if scope == "adx" else []
    names = ["retent_days", "kpi", *zone, "install_day", "event_day", *EVENT]
    rows = f"""(SELECT *, CAST(trunc((event_timestamp - install_timestamp) / 86400.0) AS BIGINT) AS retent_days,
        {dated('install_timestamp', scope, 'install_day')}, {dated('event_timestamp', scope, 'event_day')}
        FROM event_log)"""
    return f"fine_{scope} AS (" + grouped(
        rows, names, "count(*) AS gross_cnt, count(DISTINCT click_id) AS uniq_cnt, "
        f"sum({units('order_amount')}) AS amount_units") + ")"


def retained(span: int) -> str:
    return f"CASE WHEN retent_days < {span} THEN uniq_cnt ELSE 0 END"


KPI = f"""CASE WHEN kpi = 1 THEN gross_cnt WHEN kpi = 2 THEN uniq_cnt WHEN kpi = 91 THEN {retained(1)}
  WHEN kpi = 92 THEN {retained(2)} WHEN kpi = 97 THEN {retained(7)} WHEN kpi = 915 THEN {retained(15)}
  WHEN kpi = 930 THEN {retained(30)} ELSE 0 END"""
KPI_X = f"""CAST(sign(kpi) AS DECIMAL(1,0)) * CASE WHEN abs(kpi) = 7 THEN amount_units
  WHEN abs(kpi) > 800 AND abs(kpi) < 900 THEN CASE WHEN abs(kpi) = 801 + retent_days THEN uniq_cnt ELSE 0 END
  ELSE ({KPI.replace('kpi =', 'abs(kpi) =')}) END"""
KPI_DAY = "CASE WHEN kpi < 10 THEN event_day WHEN kpi > 10 THEN install_day END"


def events(scope: str, *more: str) -> str:
    return with_(BASE, EVENT_LOG, event_fine_cte(scope), *more)


def event_kpi(scope: str) -> str:
    return grouped(f"(SELECT *, {KPI_DAY} AS dated, {KPI} AS value FROM fine_{scope})", keys(scope, SUMMARY),
                   "CAST(sum(value) AS BIGINT) AS kpi_event_cnt", "WHERE value <> 0 AND dated IS NOT NULL")


for s in ("adx", "gmt"):
    names = keys(s, EVENT)
    zone = ["timezone"] if s == "adx" else []
    ORACLE[f"event_pvuv_{s}"] = events(s) + keyed(grouped(
        f"(SELECT *, event_day AS dated FROM fine_{s})", names,
        "CAST(sum(gross_cnt) AS BIGINT) AS gross_cnt, CAST(sum(uniq_cnt) AS BIGINT) AS uniq_cnt, "
        f"{rounded('sum(amount_units)')} AS total_amount"), names)
    ORACLE[f"event_retention_{s}"] = events(s) + keyed(grouped(
        f"(SELECT *, install_day AS dated FROM fine_{s} WHERE retent_days < 30)", names,
        commas([f"CAST(sum({retained(n)}) AS BIGINT) AS {r}" for n, r in zip(SPANS, RETENTION)])), names)
    ORACLE[f"event_kpi_{s}"] = events(s) + keyed(event_kpi(s), keys(s, SUMMARY))
    ORACLE[f"event_kpi_extended_{s}"] = events(s) + keyed(grouped(
        f"(SELECT *, {KPI_DAY} AS dated, {KPI_X} AS value FROM fine_{s})", keys(s, SUMMARY),
        f"{rounded('sum(value)')} AS kpi_value", "WHERE value <> 0 AND dated IS NOT NULL"),
        keys(s, SUMMARY))
    head = (["printf('%.1f', timezone)"] if s == "adx" else [])
    tail = commas(EVENT)
    ORACLE[f"event_records_{s}"] = events(s) + f"""
SELECT 'counts' AS record_type, concat_ws('<;>', {commas([*head, 'event_day', tail])}, gross_cnt, uniq_cnt,
       printf('%.4f', {rounded('amount_units')})) AS value FROM fine_{s}
UNION ALL
SELECT 'kpi', concat_ws('<;>', {commas([*head, KPI_DAY, tail])}, printf('%.4f', {rounded(KPI_X)}))
FROM fine_{s} WHERE ({KPI_X}) <> 0 AND kpi <> 10
UNION ALL
SELECT 'retention', concat_ws('<;>', {commas([*head, 'install_day', tail])}, {commas([retained(n) for n in SPANS])})
FROM fine_{s} WHERE ({retained(30)}) <> 0"""

# ------------------------------------------------- impressions, demand, supply

IMPRESSIONS = with_(BASE, IMPRESSION_LOG)
DEMANDS = with_(demand_log(stream=False))
for s in ("adx", "gmt"):
    for query, kind in (("impression_daily", "imp"), ("impression_click_daily", "clk")):
        ORACLE[f"{query}_{s}"] = IMPRESSIONS + keyed(grouped(
            f"(SELECT *, {dated('request_unix', s)} FROM imp_log)", keys(s, IMP),
            f"count(*) AS gross_{kind}_cnt, count(DISTINCT visitor) AS uniq_{kind}_cnt"), keys(s, IMP))
    ORACLE[f"demand_daily_{s}"] = DEMANDS + keyed(grouped(
        f"(SELECT *, {dated('epoch', s)} FROM demand_log)", keys(s, DEMAND),
        f"count(*) AS clks, count(DISTINCT uv) AS uniq_clks, {money_sum('cost')} AS cost"), keys(s, DEMAND))
ORACLE["supply_daily_gmt"] = DEMANDS + keyed(grouped(
    f"(SELECT *, {dated('epoch', 'gmt')} FROM demand_log)", keys("gmt", SUPPLY),
    f"count(*) AS clks, {money_sum('revenue')} AS revenue"), keys("gmt", SUPPLY))

# ------------------------------------------------------- merging and checking

WIDE = ["gross_clk_cnt", "uniq_clk_cnt", "gross_conv_cnt", "valid_conv_cnt", "notify_conv_cnt", "kpi_event_cnt"]


def wide_cte(scope: str) -> str:
    names = keys(scope, SUMMARY)
    return f"""clk AS ({click_coarse(scope)}), cnv AS ({conv_coarse(scope)}), kp AS ({event_kpi(scope)}),
wide AS (
  SELECT {commas(names)}, {commas([f'coalesce({c}, 0) AS {c}' for c in WIDE])},
         coalesce(net_profit, 0.0) AS net_profit, coalesce(tac, 0.0) AS tac
  FROM clk FULL JOIN cnv USING ({commas(names)}) FULL JOIN kp USING ({commas(names)})),
damaged AS (
  SELECT *, 0 AS bad FROM wide WHERE day(CAST(dated AS DATE)) % 7 <> 0
  UNION ALL
  SELECT * REPLACE (gross_clk_cnt + 1 AS gross_clk_cnt, valid_conv_cnt + 1 AS valid_conv_cnt,
                    kpi_event_cnt + 1 AS kpi_event_cnt), 1 FROM wide WHERE day(CAST(dated AS DATE)) % 7 = 0)"""


def everything(scope: str) -> str:
    return with_(BASE, CLICK_LOG, CONVERSION_LOG, DEDUP, EVENT_LOG, event_fine_cte(scope), wide_cte(scope))


def checked(scope: str, detail: str, pairs: list[tuple[str, str, str]], join: str = "JOIN") -> str:
    by = (["timezone"] if scope == "adx" else []) + ["dated"]
    left = commas([f"sum({d}) AS d_{f}" for f, d, _ in pairs])
    right = commas([f"sum({w}) AS s_{f}" for f, _, w in pairs])
    flags = commas([f"coalesce(CAST(d_{f} = s_{f} AS BIGINT), 0) AS {f}_flag" for f, _, _ in pairs])
    return everything(scope) + f"""SELECT {commas(by)}, {flags}
FROM (SELECT {commas(by)}, {left} FROM ({detail}) GROUP BY {commas(by)})
{join} (SELECT {commas(by)}, {right} FROM damaged GROUP BY {commas(by)}) USING ({commas(by)})"""


CONV_PAIRS = [(f"{m}_conv", f"{m}_cnt", f"{m}_conv_cnt") for m in ("gross", "valid", "notify")]
CLICK_PAIRS = [("gross_clk", "gross_cnt", "gross_clk_cnt")]
for s in ("adx", "gmt"):
    ORACLE[f"wide_daily_summary_{s}"] = everything(s) + keyed("SELECT * FROM wide", keys(s, SUMMARY))
    ORACLE[f"reconcile_click_{s}"] = checked(s, click_fine(s), CLICK_PAIRS)
    ORACLE[f"reconcile_conv_{s}"] = checked(s, conv_fine(s), CONV_PAIRS)
    ORACLE[f"reconcile_event_{s}"] = checked(s, event_kpi(s), [("kpi_event", "kpi_event_cnt", "kpi_event_cnt")])
ORACLE["reconcile_click_missing_days"] = checked("gmt", click_fine("gmt"), CLICK_PAIRS, "FULL JOIN")

RUNS = with_(
    BASE, CLICK_LOG,
    "early_log AS (SELECT * FROM click_log WHERE (clk_timestamp // 3600) % 24 < 12)",
    "older AS (" + click_coarse("gmt", f"(SELECT *, {dated('clk_timestamp', 'gmt')} FROM early_log)") + ")",
    "newer AS (" + click_coarse("gmt") + ")",
    "late_log AS (SELECT * FROM click_log WHERE (clk_timestamp // 3600) % 24 >= 12)",
    "later AS (" + click_coarse("gmt", f"(SELECT *, {dated('clk_timestamp', 'gmt')} FROM late_log)") + ")")
GMT_KEYS = keys("gmt", SUMMARY)
ORACLE["upsert_replace"] = RUNS + f"""SELECT * FROM older o WHERE NOT EXISTS (
  SELECT 1 FROM later n WHERE {' AND '.join(f'n.{k} = o.{k}' for k in GMT_KEYS)})
UNION ALL SELECT * FROM later"""
BOTH = "(SELECT * FROM older UNION ALL SELECT * FROM newer)"
ORACLE["upsert_increment"] = RUNS + grouped(BOTH, GMT_KEYS, commas(
    [f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("gross_clk_cnt", "uniq_clk_cnt")]))
ORACLE["upsert_greatest"] = RUNS + grouped(BOTH, GMT_KEYS, commas(
    [f"max({c}) AS {c}" for c in ("gross_clk_cnt", "uniq_clk_cnt")]))

# -------------------------------------------------------------------- fraud


def hour(epoch: str) -> str:
    return f"strftime(make_timestamp(({epoch}) * 1000000), '%Y%m%d%H')"


def hourly(log: str, epoch: str, by: list[str], having: str = "") -> str:
    return f"""SELECT {hour(epoch)} AS hour, {commas(by)}, count(*) AS cnt FROM {log}
GROUP BY 1, {commas(by)} {having}"""


EVENTS = with_(BASE, EVENT_LOG)
for name, by in (("ip", ["ip"]), ("adid", ["gaid", "idfa"]), ("aff", ["aff_id", "aff_pub"])):
    ORACLE[f"fraud_hourly_click_{name}"] = CLICKS + hourly("click_log", "clk_timestamp", by, "HAVING count(*) > 5")
    ORACLE[f"fraud_hourly_event_{name}"] = EVENTS + hourly("event_log", "event_timestamp", [*by, "event_value"])

ORACLE["fraud_ip_profile"] = CONVERSIONS + f"""
SELECT ip, count(*) AS total_cnt, count(*) FILTER (WHERE invalid_type = '') AS valid_cnt,
       {commas([f"count(*) FILTER (WHERE invalid_type = 'E00{i}') AS e00{i}_cnt" for i in (1, 2, 3, 4)])},
       floor(count(*) FILTER (WHERE invalid_type = '') / count(*) * 10000 + 0.5) / 10000.0::DOUBLE AS valid_ratio
FROM conv_log GROUP BY ip HAVING count(*) <> count(*) FILTER (WHERE invalid_type = '')"""

REPEATED = """seconds AS (
  SELECT DISTINCT ip, invalid_type, clk_timestamp FROM conv_log WHERE invalid_type <> ''),
repeated AS (
  SELECT DISTINCT ip, clk_timestamp FROM (
    SELECT *, row_number() OVER (PARTITION BY ip, invalid_type ORDER BY clk_timestamp) AS rn FROM seconds)
  WHERE rn > 1)"""
ORACLE["fraud_ip_click_times"] = with_(BASE, CONVERSION_LOG, REPEATED) + """
SELECT ip, CAST(DATE '1970-01-01' + CAST(clk_timestamp // 86400 AS INTEGER) AS VARCHAR) AS dated,
       string_agg(CAST(clk_timestamp AS VARCHAR), ',' ORDER BY clk_timestamp) AS clk_times
FROM repeated GROUP BY ALL"""
ORACLE["fraud_click_radius"] = with_(BASE, CONVERSION_LOG, CLICK_LOG, REPEATED) + """
SELECT r.ip, r.clk_timestamp, count(c.ip) AS click_cnt
FROM repeated r LEFT JOIN click_log c
  ON c.ip = r.ip AND c.clk_timestamp BETWEEN r.clk_timestamp - 600 AND r.clk_timestamp + 600
WHERE r.ip <> '' GROUP BY r.ip, r.clk_timestamp"""

ORACLE["fraud_sliding_window"] = CLICKS + """
SELECT (clk_timestamp // 20 - n) * 20 AS window_start, kind, key, count(*) AS cnt
FROM (SELECT clk_timestamp, '10001' AS kind, ip AS key FROM click_log
      UNION ALL
      SELECT clk_timestamp, '10002', CASE WHEN NOT contains(gaid, '{') THEN gaid ELSE idfa END FROM click_log),
     (VALUES (0), (1), (2)) w(n)
GROUP BY 1, 2, 3"""
ORACLE["stream_sliding_window"] = ORACLE["fraud_sliding_window"]

# ------------------------------------------------------------------ scalars

ORACLE["scalar_helpers"] = CLICKS + f"""
SELECT clk_timestamp, timezone, ip, ua, gaid, idfa, {hour('clk_timestamp')} AS hour,
       CAST(list_sum(list_transform(string_split(ip, ''), lambda x: ascii(x))) AS BIGINT) % 7 AS ip_mod,
       clk_timestamp % 10 AS ts_mod, CAST(NOT contains(gaid, '{{') AS BIGINT) AS plain_gaid,
       CASE WHEN gaid = '{{gaid}}' THEN '' ELSE gaid END AS gaid_text,
       string_split(ip, '.')[-1] AS ip_last, CAST(string_split(ip, '.')[1] AS BIGINT) AS ip_first,
       CASE WHEN gaid <> '' THEN gaid ELSE idfa END AS any_id,
       CASE WHEN NOT contains(gaid, '{{') THEN gaid ELSE idfa END AS ad_id,
       CASE WHEN gaid <> '' THEN gaid ELSE ip || ua END AS device,
       0::BIGINT AS in1, 1::BIGINT AS in2, CAST(-1 AS BIGINT) AS days_before,
       clk_timestamp - clk_timestamp % 86400 + 3723 AS parsed,
       'GMT' || CASE WHEN timezone >= 0 THEN '+' ELSE '' END || CAST(trunc(timezone) AS INTEGER) || ':'
         || CASE WHEN timezone <> trunc(timezone) THEN '30' ELSE '00' END AS zone,
       86400000 - (clk_timestamp * 1000 + {cut('timezone * 3600000')}) % 86400000 AS millis_left,
       86400 - ({local('clk_timestamp', 'adx')} % 86400) // 60 * 60 AS seconds_left
FROM click_log"""

ORACLE["sql_functions"] = CLICKS + f"""
SELECT {day(local('clk_timestamp', 'adx'))} AS local_day, {hour('clk_timestamp')} AS hour, {VISITOR} AS visitor,
       CAST(-2 AS BIGINT) AS days, string_split(ip, '.')[-1] AS ip_last,
       CASE WHEN gaid <> '' THEN gaid ELSE idfa END AS domain, clk_timestamp % 1000 % 7 AS modulus,
       CAST(NOT contains(gaid, '{{') AS BIGINT) AS plain_gaid
FROM click_log"""

ORACLE["malformed_quarantine"] = """
SELECT CAST(event_type IN ('signup', 'purchase') AS BIGINT) AS malformed,
       CASE WHEN event_type = 'signup' THEN '' ELSE event_type END AS event_type, count(*) AS cnt
FROM events GROUP BY 1, 2"""

# ------------------------------------------------------------------ streams


def both_scopes(select) -> str:
    """A statement per scope, with the scope and a 0 offset for gmt."""
    return "\nUNION ALL\n".join(select(s) for s in ("adx", "gmt"))


def scoped(scope: str, source: str, epoch: str, names: list[str], measures: str) -> str:
    zone = "timezone" if scope == "adx" else "0.0::DOUBLE"
    rows = (f"(SELECT * EXCLUDE (timezone), '{scope}' AS scope, {zone} AS timezone, "
            f"{dated(epoch, scope)} FROM {source})")
    return grouped(rows, ["scope", "timezone", "dated", *names], measures)


ORACLE["stream_click"] = CLICKS + both_scopes(
    lambda s: scoped(s, "click_log", "clk_timestamp", CLICK, "count(*) AS gross_cnt"))
ORACLE["stream_click_restarted"] = ORACLE["stream_click"]
ORACLE["stream_click_uniq"] = CLICKS + both_scopes(
    lambda s: scoped(s, "click_log", "clk_timestamp", CLICK,
                     f"count(*) AS gross_cnt, count(DISTINCT {VISITOR}) AS uniq_cnt"))
ORACLE["stream_conv"] = CONVERSIONS + both_scopes(
    lambda s: scoped(s, "conv_log", "conv_timestamp", CONV, f"{CONV_COUNTS}, {MONEY}"))
ORACLE["click_daily_by_scope"] = ORACLE["stream_click_uniq"]
ORACLE["click_daily_from_files"] = ORACLE["stream_click_uniq"]
ORACLE["conv_daily_by_scope"] = CONVERSIONS + both_scopes(
    lambda s: scoped(s, "conv", "conv_timestamp", CONV, f"{CONV_COUNTS}, {MONEY}"))
FILED = f"""filed AS (
  SELECT *, CAST({day('conv_timestamp')} AS DATE) + CAST(CASE WHEN conv_timestamp % 9 = 0 THEN 1
    WHEN conv_timestamp % 31 = 0 THEN 2 ELSE 0 END AS INTEGER) AS file_day FROM conv_log),
aimed AS (SELECT *, CAST(CAST(file_day + o AS DATE) AS VARCHAR) AS target FROM filed, (VALUES (-1), (0), (1)) t(o)),
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target, click_id ORDER BY {commas(FIRST_BY)}) AS rn
  FROM aimed) WHERE rn = 1)"""
ORACLE["conv_daily_from_files"] = with_(BASE, CONVERSION_LOG, FILED) + both_scopes(lambda s: scoped(
    s, f"(SELECT * FROM once WHERE {day(local('conv_timestamp', s))} = target)", "conv_timestamp", CONV,
    f"{CONV_COUNTS}, {MONEY}"))
ORACLE["daily_quarantine"] = CLICKS + f"""
SELECT dated, count(*) FILTER (WHERE clk_timestamp % 7 <> 0) AS counted_cnt,
       count(*) FILTER (WHERE clk_timestamp % 7 = 0 OR clk_timestamp % 11 = 0) AS bad_cnt,
       count(*) FILTER (WHERE clk_timestamp % 7 <> 0 AND clk_timestamp % 11 = 0) AS dated_bad_cnt
FROM (SELECT *, {dated('clk_timestamp', 'gmt')} FROM click_log) GROUP BY dated"""
ORACLE["stream_conv_summary"] = CONVERSIONS + both_scopes(
    lambda s: scoped(s, "conv_log", "conv_timestamp", SUMMARY, f"{CONV_COUNTS}, {MONEY}"))
ORACLE["stream_conv_invalid"] = CONVERSIONS + scoped(
    "adx", "(SELECT * FROM conv_log WHERE invalid_type <> '')", "conv_timestamp", INVALID,
    "count(*) AS invalid_cnt")
ORACLE["stream_conv_detail"] = ORACLE["conv_detail_records"].replace(
    "SELECT concat_ws(", "SELECT value, count(*) AS cnt FROM (SELECT concat_ws(") + ") GROUP BY value"


def stream_event(scope: str) -> str:
    rows = f"""(SELECT *, CAST(trunc((event_timestamp - install_timestamp) / 86400.0) AS BIGINT) AS retent_days,
        {dated('install_timestamp', scope, 'install_day')} FROM event_log)"""
    return scoped(scope, rows, "event_timestamp", ["retent_days", "kpi", "install_day", *EVENT],
                  "count(*) AS gross_cnt, count(DISTINCT click_id) AS uniq_cnt, "
                  f"{money_sum('order_amount')} AS total_amount")


ORACLE["stream_event"] = EVENTS + both_scopes(stream_event)


def event_id_days(scope: str) -> str:
    zone = "timezone" if scope == "adx" else "0.0::DOUBLE"
    flags = commas([f"CASE WHEN event_timestamp - install_timestamp < {n} * 86400 THEN 1 ELSE 0 END AS {r}"
                    for n, r in zip(SPANS, RETENTION)])
    rows = "\nUNION ALL\n".join(f"""SELECT '{scope}' AS scope, '{role}' AS role, {zone} AS tz, {commas(EVENT)},
        event_timestamp, kpi, {units('order_amount')} AS amount, ip || '_' || gaid || '_' || idfa AS visitor,
        {dated('event_timestamp', scope, 'event_day')}, {dated(epoch, scope)}, {flags} FROM event_log"""
                                for role, epoch in (("event", "event_timestamp"), ("conv", "install_timestamp")))
    by = commas(["scope", "role", "tz", "event_day", "dated", *EVENT])
    sums = commas([f"sum({r}) AS {r}" for r in RETENTION])
    per_day = f"""SELECT {by}, count(*) AS gross, count(DISTINCT visitor) AS uniq, sum(amount) AS amount,
        arg_max(kpi, event_timestamp * 10000 + kpi) AS code, {sums} FROM ({rows}) GROUP BY {by}"""
    kpi = """CASE code WHEN 1 THEN gross WHEN 2 THEN uniq WHEN 91 THEN in1_retention_cnt WHEN 92 THEN
        in2_retention_cnt WHEN 97 THEN in7_retention_cnt WHEN 915 THEN in15_retention_cnt
        WHEN 930 THEN in30_retention_cnt ELSE 0 END"""
    return f"""SELECT *, CASE WHEN (role = 'event' AND code < 10) OR (role = 'conv' AND code > 10)
        THEN {kpi} ELSE 0 END AS shown_kpi FROM ({per_day})"""


def stream_event_old(scope: str) -> str:
    event = "CASE WHEN role = 'event' THEN {0} ELSE 0 END"
    conv = "CASE WHEN role = 'conv' THEN {0} ELSE 0 END"
    return f"""SELECT scope, tz AS timezone, dated, {commas(EVENT)},
        CAST(sum({event.format('gross')}) AS BIGINT) AS gross_cnt,
        CAST(sum({event.format('uniq')}) AS BIGINT) AS uniq_cnt,
        CAST(sum(shown_kpi) AS BIGINT) AS kpi_event_cnt,
        {commas([f"CAST(sum({conv.format(r)}) AS BIGINT) AS {r}" for r in RETENTION])},
        {rounded(f"sum({event.format('amount')})")} AS total_amount
        FROM ({event_id_days(scope)})
        WHERE role = 'event' OR shown_kpi <> 0 OR in30_retention_cnt <> 0
        GROUP BY scope, tz, dated, {commas(EVENT)}"""


ORACLE["stream_event_old"] = EVENTS + both_scopes(stream_event_old)


def event_id_messages(scope: str) -> str:
    head = commas((["printf('%.1f', tz)"] if scope == "adx" else []) + ["dated", *EVENT])
    kinds = [("shown_kpi <> 0", "shown_kpi"),
             ("role = 'event'", f"gross, uniq, printf('%.4f', {rounded('amount')})"),
             ("role = 'conv' AND in30_retention_cnt <> 0", commas(RETENTION))]
    return "\nUNION ALL\n".join(
        f"SELECT concat_ws('<;>', {head}, {tail}) AS value FROM ({event_id_days(scope)}) WHERE {where}"
        for where, tail in kinds)


ORACLE["event_id_result_records"] = EVENTS + (
    f"SELECT value, count(*) AS cnt FROM ({both_scopes(event_id_messages)}) GROUP BY value")

STREAM_IMP = """CASE WHEN province_geoname_id = 'x7' THEN 0 ELSE CAST(province_geoname_id AS BIGINT) END
    AS province_geoname_id, CAST(city_geoname_id AS BIGINT) AS city_geoname_id"""
for query, kind in (("stream_impression", "imp"), ("stream_imp_click", "clk")):
    ORACLE[query] = IMPRESSIONS + both_scopes(lambda s, kind=kind: scoped(
        s, f"(SELECT * EXCLUDE (province_geoname_id, city_geoname_id), {STREAM_IMP} FROM imp_log WHERE has_option)",
        "request_unix", IMP, f"count(*) AS gross_{kind}_cnt"))

KIND = "(SELECT *, CASE WHEN demand = 'R' THEN 'imps' ELSE 'clks' END AS kind FROM demand_log)"
STREAM_DEMANDS = with_(demand_log(stream=True))
ORACLE["stream_demand"] = STREAM_DEMANDS + both_scopes(lambda s: scoped(
    s, KIND, "epoch", ["kind", *DEMAND],
    f"count(*) AS gross_cnt, count(DISTINCT uv) AS uniq_cnt, {money_sum('cost')} AS cost"))
ORACLE["stream_supply"] = STREAM_DEMANDS + grouped(
    f"(SELECT *, {dated('epoch', 'gmt')} FROM {KIND})", ["kind", "dated", *SUPPLY],
    f"count(*) AS gross_cnt, {money_sum('revenue')} AS revenue")
ORACLE["event_fine_by_scope"] = ORACLE["stream_event"]
ORACLE["impression_daily_by_scope"] = IMPRESSIONS + both_scopes(lambda s: scoped(
    s, "imp_log", "request_unix", IMP, "count(*) AS gross_imp_cnt, count(DISTINCT visitor) AS uniq_imp_cnt"))
ORACLE["demand_daily_by_scope"] = DEMANDS + both_scopes(lambda s: scoped(
    s, "demand_log", "epoch", DEMAND,
    f"count(*) AS clks, count(DISTINCT uv) AS uniq_clks, {money_sum('cost')} AS cost"))


ORACLE["stream_growth"] = f"SELECT * EXCLUDE (unionk) FROM ({ORACLE['click_daily_gmt']})"

# ---------------------------------------------------------- result messages

KEY_FORMATS = {"timezone": "%.1f", "income": "%.2f", "payout": "%.2f"}
AMOUNT_FORMATS = {"cost": "%.4f", "net_profit": "%.4f", "tac": "%.4f", "revenue": "%.4f"}


def messages(scope: str, rows: str, dims: list[str], tail: list[str], lead: str = "") -> str:
    formats = {**KEY_FORMATS, **AMOUNT_FORMATS}
    names = [*keys(scope, dims), *tail]
    parts = [f"printf('{formats[n]}', CAST({n} AS DOUBLE))" if n in formats else n for n in names]
    return f"SELECT {lead}concat_ws('<;>', {commas(parts)}) AS value FROM ({rows})"


ORACLE["click_result_records"] = CLICKS + both_scopes(lambda s: messages(
    s, scoped(s, "click_log", "clk_timestamp", CLICK, "count(*) AS gross_cnt"), CLICK, ["gross_cnt"],
    "'click<;>' || "))

CONV_TAIL = ["gross_cnt", "valid_cnt", "notify_cnt", "net_profit", "tac"]


def conv_messages(scope: str) -> str:
    fine = scoped(scope, "conv_log", "conv_timestamp", CONV, f"{CONV_COUNTS}, 0.0 AS net_profit, 0.0 AS tac")
    coarse = scoped(scope, "conv_log", "conv_timestamp", SUMMARY, f"{CONV_COUNTS}, {MONEY}")
    return messages(scope, fine, CONV, CONV_TAIL) + "\nUNION ALL\n" + messages(scope, coarse, SUMMARY, CONV_TAIL)


ORACLE["conv_result_records"] = CONVERSIONS + both_scopes(conv_messages) + "\nUNION ALL\n" + messages(
    "adx", scoped("adx", "(SELECT * FROM conv_log WHERE invalid_type <> '')", "conv_timestamp", INVALID,
                  "count(*) AS gross_cnt, 0 AS valid_cnt, 0 AS notify_cnt, 0.0 AS net_profit, 0.0 AS tac"),
    INVALID, CONV_TAIL)
ORACLE["demand_result_records"] = STREAM_DEMANDS + messages(
    "gmt", grouped(f"(SELECT *, {dated('epoch', 'gmt')} FROM {KIND})", ["kind", "dated", *SUPPLY],
                   f"count(*) AS gross_cnt, 0 AS uniq_cnt, {money_sum('revenue')} AS revenue"),
    SUPPLY, ["gross_cnt", "uniq_cnt", "revenue"], "kind || '<;>' || ")

# ---------------------------------------------------------- written and read back

ORACLE["rerun_replaces_days"] = RUNS + "SELECT * FROM newer"
ORACLE["replayed_batch_adds_once"] = ORACLE["upsert_increment"]

# ---------------------------------------------------------- hourly counts in one pass

HOT_KEYS = {"ip": ("ip", "''"), "adid": ("gaid", "idfa"), "aff": ("CAST(aff_id AS VARCHAR)", "aff_pub")}


def hourly_kinds(log: str, epoch: str, extra: str = "", having: str = "") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {hour(epoch)} AS hour, '{kind}' AS kind, {one} AS key_1, {two} AS key_2, {extra} count(*) AS cnt "
        f"FROM {log} GROUP BY ALL {having}" for kind, (one, two) in HOT_KEYS.items())


ORACLE["fraud_hourly_click_kinds"] = CLICKS + hourly_kinds("click_log", "clk_timestamp", having="HAVING count(*) > 5")
ORACLE["fraud_hourly_event_kinds"] = EVENTS + hourly_kinds("event_log", "event_timestamp", "event_value,")
ORACLE["fraud_hourly_click_files"] = CLICKS + f"""
SELECT * FROM ({hourly_kinds("(SELECT * REPLACE (clk_timestamp + CASE WHEN clk_timestamp % 5 = 0 THEN 3600 ELSE 0 END AS clk_timestamp) FROM click_log)",
                             "clk_timestamp", having="HAVING count(*) > 5")})
WHERE left(hour, 8) > (SELECT left({hour('min(clk_timestamp)')}, 8) FROM click_log)
  AND left(hour, 8) <= (SELECT left({hour('max(clk_timestamp)')}, 8) FROM click_log)"""
ORACLE["fraud_reports_csv"] = ORACLE["fraud_hourly_click_kinds"]
ORACLE["reconcile_report"] = "\nUNION ALL\n".join(
    f"SELECT concat_ws(',', '{s}_click', *COLUMNS(*)) AS value FROM ({ORACLE[f'reconcile_click_{s}']})"
    for s in ("adx", "gmt"))

# ---------------------------------------------------------- messages of unique counts

ORACLE["click_unique_result_records"] = CLICKS + both_scopes(lambda s: messages(
    s, scoped(s, "click_log", "clk_timestamp", CLICK, f"count(*) AS gross_cnt, count(DISTINCT {VISITOR}) AS uniq_cnt"),
    CLICK, ["gross_cnt", "uniq_cnt"]))
ORACLE["impression_result_records"] = IMPRESSIONS + both_scopes(lambda s: messages(s, scoped(
    s, f"(SELECT * EXCLUDE (province_geoname_id, city_geoname_id), {STREAM_IMP} FROM imp_log WHERE has_option)",
    "request_unix", IMP, "count(*) AS gross_imp_cnt"), IMP, ["gross_imp_cnt"], "'impress<;>' || "))
ORACLE["demand_unique_result_records"] = STREAM_DEMANDS + both_scopes(lambda s: messages(
    s, scoped(s, KIND, "epoch", ["kind", *DEMAND],
              f"count(*) AS gross_cnt, count(DISTINCT uv) AS uniq_cnt, {money_sum('cost')} AS cost"),
    DEMAND, ["gross_cnt", "uniq_cnt", "cost"], "kind || '<;>' || "))

# ---------------------------------------------------------- streams beside other inputs

ORACLE["registered_rerun"] = CLICKS + f"""
SELECT * FROM ({click_coarse('gmt')}) WHERE dated < (SELECT max({day('clk_timestamp')}) FROM click_log)"""
ORACLE["stream_conv_once"] = CONVERSIONS + "SELECT DISTINCT click_id, CAST(1 AS BIGINT) AS gross_cnt FROM conv_log"
ORACLE["stream_list_filter"] = CLICKS + """
SELECT group_id, count(*) AS cnt FROM click_log
WHERE group_id IN (SELECT s_nationkey * 2 + clk_timestamp % 2 FROM supplier) GROUP BY group_id"""
