"""Days, hours and offsets from epoch seconds.

Every log carries whole epoch seconds and an offset in hours. Days are taken
by integer arithmetic rather than timestamp formatting, so a day is a four
byte grouping key and no result depends on the session zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400
# Offsets run from -12 to +14 hours, so a local day lies within this many
# seconds of the UTC day with the same date.
MAX_OFFSET = 14 * 3600


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_day(epoch: Column | str) -> Column:
    return F.date_from_unix_date(F.floor(_col(epoch) / DAY).cast("int"))


def local_epoch(epoch: Column | str, offset: Column | str) -> Column:
    """Epoch seconds moved by an offset in hours, cut to whole seconds."""
    return (_col(epoch) + _col(offset) * 3600).cast("long")


def local_day(epoch: Column | str, offset: Column | str) -> Column:
    return utc_day(local_epoch(epoch, offset))


def hour_index(epoch: Column | str) -> Column:
    return F.floor(_col(epoch) / 3600)


def hour_label(index: Column | str) -> Column:
    """``yyyyMMddHH`` for an hour index."""
    index = _col(index)
    day = F.date_from_unix_date(F.floor(index / 24).cast("int"))
    hour = F.pmod(index, F.lit(24)).cast("string")
    return F.concat(F.regexp_replace(day.cast("string"), "-", ""), F.lpad(hour, 2, "0"))


def utc_hour(epoch: Column | str) -> Column:
    return hour_label(hour_index(epoch))


def parse_timestamp(text: Column | str) -> Column:
    """Epoch seconds of a ``yyyy-MM-dd HH:mm:ss`` text read as UTC."""
    stamp = F.try_to_timestamp(_col(text), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.unix_seconds(stamp)


def zone_name(offset: Column | str) -> Column:
    """``GMT+5:30`` for 5.5 hours."""
    offset = _col(offset).cast("double")
    hours = offset.cast("int")
    minutes = F.abs((offset - hours) * 60).cast("int").cast("string")
    return F.concat(
        F.when(offset >= 0, "GMT+").otherwise("GMT"), hours.cast("string"), F.lit(":"),
        F.when(F.length(minutes) < 2, F.concat(F.lit("0"), minutes)).otherwise(minutes),
    )


def millis_left_in_day(epoch_millis: Column | str, offset: Column | str) -> Column:
    shifted = _col(epoch_millis) + (_col(offset) * 3600000).cast("long")
    return F.lit(DAY * 1000) - shifted % F.lit(DAY * 1000)


def seconds_left_in_day(epoch: Column | str, offset: Column | str) -> Column:
    """Seconds to the end of the local day, counted from the running minute."""
    into_day = F.pmod(local_epoch(epoch, offset), F.lit(DAY))
    return F.lit(DAY) - (into_day - into_day % 60)


# Driver-side date arguments of the jobs.

def day_after(offset: int, today: dt.date | None = None) -> dt.date:
    return (today or dt.datetime.now(dt.timezone.utc).date()) + dt.timedelta(days=offset)


def days_back(day: dt.date, today: dt.date | None = None) -> int:
    """How many days ago ``day`` was; only finished days are allowed."""
    back = (day_after(0, today) - day).days
    if back < 1:
        raise ValueError(f"{day} is not over yet")
    return back


def day_range(first: dt.date, last: dt.date, today: dt.date | None = None) -> list[dt.date]:
    days_back(last, today)
    if first > last:
        raise ValueError(f"{first} lies after {last}")
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def epoch_window(days: list[dt.date]) -> tuple[int, int]:
    """Epoch bounds holding every record whose UTC or local day is in ``days``."""
    origin = dt.date(1970, 1, 1)
    low = (min(days) - origin).days * DAY - MAX_OFFSET
    high = ((max(days) - origin).days + 1) * DAY + MAX_OFFSET
    return low, high
