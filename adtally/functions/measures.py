"""Money, keys, retention and KPI expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Amounts are added with ten decimals and rounded to the four of a table when they are written.
MONEY_TYPE = "decimal(28,10)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_units(amount: Column | str) -> Column:
    """An amount as a decimal, so that sums are exact and do not depend on the order rows arrive in.

    Prices may be far below the four decimals of the summary tables; only
    what is written is rounded to those.
    """
    return F.coalesce(_col(amount).cast(MONEY_TYPE), F.lit(0).cast(MONEY_TYPE))


def money(total: Column | str) -> Column:
    """A sum of amounts, not rounded yet."""
    return _col(total).cast("decimal(38,10)")


# Formats inside a row key; every other column enters as plain text.
KEY_FORMATS = {"timezone": "%.1f", "income": "%.2f", "payout": "%.2f"}


def _key_part(name: str) -> Column:
    if name in KEY_FORMATS:
        return F.format_string(KEY_FORMATS[name], F.col(name).cast("double"))
    return F.col(name).cast("string")


def row_key(names: list[str]) -> Column:
    """md5 of the key columns, each followed by a double bar."""
    return F.md5(F.concat(*[F.concat(_key_part(n), F.lit("||")) for n in names]))


RETENTION_DAYS = (1, 2, 7, 15, 30)


def retention_days(event: Column | str, install: Column | str) -> Column:
    """Whole days from install to event, cut toward zero."""
    return ((_col(event) - _col(install)) / 86400).cast("int")


def retained_within(event: Column | str, install: Column | str, days: int) -> Column:
    return F.when(_col(event) - _col(install) < days * 86400, 1).otherwise(0)


def retention_counts(days: Column | str, count: Column | str) -> list[Column]:
    """The count again for every retention span the row still falls into."""
    return [
        F.when(_col(days) < n, _col(count)).otherwise(F.lit(0)).cast("long").alias(retention_name(n))
        for n in RETENTION_DAYS
    ]


def retention_name(days: int) -> str:
    return f"in{days}_retention_cnt"


# What a KPI code counts (fixed values).
KPI_GROSS = 1
KPI_UNIQUE = 2
KPI_AMOUNT = 7
KPI_RETENTION = {91: 1, 92: 2, 97: 7, 915: 15, 930: 30}
KPI_DAY_BASE = 801
# Codes below this count on the day of the event, above it on the install day.
KPI_INSTALL_CODE = 10


def kpi_count(code: Column, days: Column, gross: Column, uniq: Column) -> Column:
    out = F.when(code == KPI_GROSS, gross).when(code == KPI_UNIQUE, uniq)
    for kpi, span in KPI_RETENTION.items():
        out = out.when((code == kpi) & (days < span), uniq)
    return out.otherwise(F.lit(0)).cast("long")


def kpi_amount_units(code: Column, days: Column, gross: Column, uniq: Column, amount_units: Column) -> Column:
    """KPI of a signed code, as an amount so that counts and amounts share a column."""
    size = F.abs(code)
    out = (
        F.when(size == KPI_AMOUNT, amount_units)
        .when((size > 800) & (size < 900), F.when(size == days + KPI_DAY_BASE, uniq).otherwise(F.lit(0)))
        .otherwise(kpi_count(size, days, gross, uniq))
    ).cast(MONEY_TYPE)
    return F.when(code < 0, -out).when(code > 0, out).otherwise(F.lit(0)).cast(MONEY_TYPE)


def kpi_day(code: Column, event_day: Column, install_day: Column) -> Column:
    return F.when(code < KPI_INSTALL_CODE, event_day).when(code > KPI_INSTALL_CODE, install_day)
