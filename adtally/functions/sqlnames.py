"""The scalar helpers as SQL functions, for callers that keep their SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

# name -> (parameters, result type, body)
SQL_FUNCTIONS = {
    "getFormatDate": (
        "epoch DOUBLE", "STRING",
        "CAST(date_from_unix_date(CAST(floor(CAST(epoch AS BIGINT) / 86400) AS INT)) AS STRING)"),
    "getFormatDateToHour": (
        "epoch BIGINT", "STRING",
        "concat(replace(CAST(date_from_unix_date(CAST(floor(epoch / 86400) AS INT)) AS STRING), '-', ''),"
        " lpad(CAST(floor(pmod(epoch, 86400) / 3600) AS STRING), 2, '0'))"),
    "uvGenerator": (
        "ip STRING, ua STRING, gaid STRING, idfa STRING, adid STRING", "STRING",
        "concat(coalesce(ip, ''), coalesce(ua, ''), coalesce(gaid, ''), coalesce(idfa, ''), coalesce(adid, ''))"),
    "retentDays": ("event INT, install INT", "INT", "CAST((event - install) DIV 86400 AS INT)"),
    "getLast": ("items ARRAY<STRING>", "STRING", "coalesce(try_element_at(items, -1), '0')"),
    "domainSelect": ("a STRING, b STRING", "STRING", "coalesce(nullif(a, ''), nullif(b, ''), '')"),
    "uvSelect": (
        "a STRING, b STRING, c STRING, d STRING, e STRING, f STRING, ip STRING, ua STRING, hwv STRING", "STRING",
        "coalesce(nullif(a, ''), nullif(b, ''), nullif(c, ''), nullif(d, ''), nullif(e, ''), nullif(f, ''),"
        " concat(coalesce(ip, ''), coalesce(ua, ''), coalesce(hwv, '')))"),
    "getMod": ("value INT, modulus INT", "INT", "value % modulus"),
    "hasNotChar": ("text STRING, part STRING", "BOOLEAN", "NOT contains(text, part)"),
}


def register(spark: SparkSession) -> list[str]:
    for name, (params, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {result} RETURN {body}")
    return sorted(SQL_FUNCTIONS)
