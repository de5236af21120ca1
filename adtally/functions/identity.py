"""Who a record belongs to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def visitor(*ids: Column | str) -> Column:
    """All identifiers put together, missing ones as empty text."""
    return F.concat(*[_text(i) for i in ids])


def first_filled(*candidates: Column | str) -> Column:
    """First candidate that is neither null nor empty, else empty text."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in candidates], F.lit(""))


def device_key(hashed: list[Column | str], plain: list[Column | str]) -> Column:
    """First filled hashed id; without any, the plain ids put together."""
    return F.coalesce(*[F.nullif(_col(h), F.lit("")) for h in hashed], visitor(*plain))


def advertising_id(gaid: Column | str, idfa: Column | str) -> Column:
    """The gaid, or the idfa where the gaid is missing (null) or an unfilled macro. An empty gaid is one."""
    usable = [F.when(~F.contains(_col(c), F.lit("{")), _col(c)) for c in (gaid, idfa)]
    return F.coalesce(*usable, F.lit(""))


def sketch_key(key: Column | str) -> Column:
    """A key as a sketch takes it: sketches skip empty text, which here is a visitor like any other."""
    return F.concat(F.lit(":"), _text(key))
