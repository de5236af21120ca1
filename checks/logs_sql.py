"""The sample logs as SQL: the same columns ``adtally.sources.sample`` computes."""

from __future__ import annotations

OFFSETS = "[0.0,5.5,5.0,-4.0,-5.0,8.0,-7.0,-8.0,3.0,1.0]::DOUBLE[]"


def day(epoch: str) -> str:
    return f"CAST(DATE '1970-01-01' + CAST(floor(({epoch}) / 86400) AS INTEGER) AS VARCHAR)"


def cut(seconds: str) -> str:
    return f"CAST(trunc({seconds}) AS BIGINT)"


def units(amount: str) -> str:
    return f"CAST(({amount}) AS DECIMAL(28,10))"


def money_sum(amount: str) -> str:
    return rounded(f"sum({units(amount)})")


def rounded(total: str) -> str:
    return f"CAST(round(CAST({total} AS DECIMAL(38,10)), 4) AS DOUBLE)"


def pick(values: str, index: str) -> str:
    return f"({values})[CAST({index} AS BIGINT) + 1]"


BASE = """base AS (
  SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000000 AS epoch,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) % 12 AS j
  FROM events)"""

COMMON = f"""{pick(OFFSETS, 'user_id % 10')} AS timezone, user_id // 8 AS campaign_id,
         user_id // 40 * 3 + j % 3 AS group_id, CASE WHEN k % 3 = 1 THEN 1 ELSE user_id // 10 END AS aff_id,
         CASE WHEN k % 25 = 3 THEN '' ELSE 'pub' || (j % 3) END AS aff_pub, j % 2 AS algorithm"""

IDS = """CASE WHEN k % 3 = 0 THEN '10.0.0.' || (user_id % 4)
              ELSE concat_ws('.', 10, 1 + user_id % 200, event_id // 250 % 250, event_id % 250) END AS ip,
         CASE WHEN k % 19 = 5 THEN '' ELSE 'ua' || (k % 3) END AS ua,
         CASE WHEN user_id % 4 = 0 THEN '{gaid}' WHEN user_id % 2 = 0 THEN 'g' || (user_id * 100 + k)
              ELSE '' END AS gaid,
         CASE WHEN user_id % 4 = 2 THEN '' WHEN k % 3 < 2 THEN 'i0' ELSE 'i' || user_id END AS idfa, '' AS adid"""

CLICK_ID = "CASE WHEN k % 20 = 0 THEN '' ELSE user_id || '-' || k END AS click_id"

CLICK_LOG = f"""click_log AS (
  SELECT {COMMON}, {IDS}, epoch AS clk_timestamp,
         {pick("['IN','US','SG','CN']", 'j % 4')} AS country_code, 1000 + j % 6 AS province_geoname_id,
         2000 + j % 6 AS city_geoname_id,
         CASE WHEN k % 23 = 7 THEN '' ELSE {pick("['Android','iOS']", 'j % 2')} END AS os,
         {pick("['Mobile','Tablet']", 'j % 2')} AS device_type, 'make' || (j % 4) AS device_make,
         'model' || (j % 6) AS device_model
  FROM base)"""

CONVERSION_LOG = f"""conv_log AS (
  SELECT {COMMON}, {IDS}, {CLICK_ID}, epoch - (k % 7) * 60 AS clk_timestamp, epoch AS conv_timestamp,
         (k % 4) * 0.5::DOUBLE AS income, {pick("['USD','EUR']", 'k % 2')} AS income_currency,
         (k % 3) * 0.25::DOUBLE AS payout, {pick("['USD','INR']", 'k % 2')} AS payout_currency,
         CASE WHEN event_type = 'error' THEN 'E00' || (1 + k % 5) ELSE '' END AS invalid_type,
         k % 2 AS forwarded, value / 10 AS net_profit, CASE WHEN k % 5 = 0 THEN k / 1000000.0::DOUBLE ELSE value / 20 END AS tac, 'carrier' || (k % 3) AS carrier
  FROM base)"""

EVENT_LOG = f"""event_log AS (
  SELECT {COMMON}, {IDS}, {CLICK_ID}, k % 4 AS event_value, epoch AS event_timestamp,
         epoch - ((user_id * 37 + k * 11) % 44 - 2) * 86400 - (k % 3) * 10000 AS install_timestamp,
         value AS order_amount, substring({pick("['USDX','EURX','INRX']", 'k % 3')}, 1, 3) AS currency,
         {pick('[0,1,2,7,91,92,97,915,930,-1,803]::BIGINT[]', 'k % 11')} AS kpi
  FROM base)"""

IMPRESSION_LOG = f"""imp_raw AS (
  SELECT {pick(OFFSETS, 'user_id % 10')} AS timezone, epoch AS request_unix, k % 13 <> 0 AS has_option, j,
         user_id // 6 AS publisher_id, j % 6 AS inventory_id, j % 3 AS plcmt_id, user_id // 8 AS campaign_id,
         j % 4 AS delivery_id, j % 6 AS ad_id, {IDS}
  FROM base),
imp_log AS (
  SELECT timezone, request_unix, has_option, publisher_id, inventory_id, plcmt_id, campaign_id, delivery_id, ad_id,
         CASE WHEN has_option THEN {pick("['IN','US','SG','CN']", 'j % 4')} ELSE '' END AS country_code,
         CASE WHEN NOT has_option OR j % 5 = 0 THEN '0' WHEN j % 5 = 2 THEN 'x7'
              ELSE CAST(1000 + j % 6 AS VARCHAR) END AS province_geoname_id,
         CASE WHEN NOT has_option OR j % 5 = 0 THEN '0' WHEN j % 5 = 1 THEN CAST(1000 + j % 6 AS VARCHAR)
              ELSE CAST(2000 + j % 6 AS VARCHAR) END AS city_geoname_id,
         CASE WHEN has_option THEN {pick("['Mobile','Tablet']", 'j % 2')} ELSE '' END AS device_type,
         CASE WHEN has_option THEN 'make' || (j % 4) ELSE '' END AS make,
         CASE WHEN has_option THEN 'model' || (j % 6) ELSE '' END AS model,
         CASE WHEN has_option THEN {pick("['Android','iOS']", 'j % 2')} ELSE '' END AS os,
         CASE WHEN has_option THEN 'carrier' || (j % 3) ELSE '' END AS carrier,
         CASE WHEN has_option THEN {pick("['wifi','cell']", 'j % 2')} ELSE '' END AS connection_type,
         CASE WHEN has_option THEN 'a' || (j % 4) ELSE '' END AS age_group,
         CASE WHEN has_option THEN {pick("['m','f']", 'j % 2')} ELSE '' END AS gender,
         CASE WHEN has_option THEN ip || ua || gaid || idfa ELSE '' END AS visitor
  FROM imp_raw)"""


def demand_log(stream: bool) -> str:
    """``stream`` picks the domain rule of the stream: a record with an app ignores its site."""
    app_domain = "CASE WHEN l_partkey % 5 = 0 THEN '' ELSE 'app' || (line % 2) END"
    if stream:
        publisher = f"CASE WHEN line % 3 <> 0 THEN {app_domain} ELSE 'sitepub' END"
        inventory = f"CASE WHEN line % 3 <> 0 THEN {app_domain} ELSE 'site' END"
    else:
        publisher = f"CASE WHEN line % 3 <> 0 AND l_partkey % 5 <> 0 THEN {app_domain} ELSE 'sitepub' END"
        inventory = f"CASE WHEN line % 3 <> 0 AND l_partkey % 5 <> 0 THEN {app_domain} ELSE 'site' END"
    return f"""demand_rows AS (
  SELECT *, CAST(l_linenumber AS BIGINT) AS line, l_orderkey AS ord, CAST(s_nationkey % 5 AS BIGINT) AS n5,
         1522540800 + ((epoch_us(l_shipdate) // 1000000 // 86400) % 30) * 86400
           + (l_orderkey * 7919 + l_linenumber * 3571) % 86400 AS epoch
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey),
demand_log AS (
  SELECT {pick(OFFSETS, 'n5')} AS timezone, epoch, l_returnflag AS demand, 'b' || (l_partkey // 100) AS campaign_id,
         'cr' || (line % 2) AS creative_id, 's' || (l_suppkey // 25) AS supply, {publisher} AS publisher_domain,
         {inventory} AS inventory_domain,
         CASE WHEN line % 3 <> 0 THEN 'bundle' || (line % 2) ELSE '' END AS app_bundle, 't' || (line % 2) AS tagid,
         CASE WHEN n5 <> 4 THEN 'C' || n5 ELSE '' END AS country_code,
         CASE WHEN n5 <> 4 THEN n5 * 10 ELSE 0 END AS province_geonameid,
         CASE WHEN n5 <> 4 THEN n5 * 100 ELSE 0 END AS city_geonameid, 'make' || (line % 2) AS device_make,
         'model' || (line % 2) AS device_model, {pick("['Android','iOS']", 'line % 2')} AS os, 'carrier' AS carrier,
         {"CAST(line % 2 AS VARCHAR)" if stream else "line % 2"} AS connection_type, 'u' || (line % 2) AS age_group,
         {pick("['m','f']", 'line % 2')} AS gender, {pick("['USD','EUR']", 'line % 2')} AS currency,
         CASE WHEN ord % 2 = 0 THEN 'h' || ord WHEN ord % 3 = 0 THEN 'p' || ord
              WHEN ord % 5 = 0 THEN 's' || ord WHEN ord % 7 = 0 THEN 'd' || ord
              WHEN ord % 11 = 0 THEN 'm' || ord
              ELSE '10.0.' || (ord // 250) || '.' || (ord % 250) || 'ua' || (ord % 3) || 'hw' END AS uv,
         l_extendedprice AS cost,
         CASE WHEN line = 7 THEN 0.0 ELSE CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) + 0.25 END AS revenue
  FROM demand_rows)"""
