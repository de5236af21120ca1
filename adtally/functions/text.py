"""Text and array helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_empty(text: Column | str) -> Column:
    """Null, whitespace and the word null all become the empty text."""
    text = _col(text)
    junk = text.isNull() | (F.trim(text) == "") | (F.lower(text) == "null")
    return F.when(junk, F.lit("")).otherwise(text)


def lacks(text: Column | str, part: Column | str) -> Column:
    part = part if isinstance(part, Column) else F.lit(part)
    return ~F.contains(_col(text), part)


def int_mod(value: Column | str, modulus: int) -> Column:
    return _col(value) % F.lit(modulus)


def text_mod(text: Column | str, modulus: int) -> Column:
    """Sum of the characters' low bytes (signed) modulo ``modulus``."""
    chars = F.filter(F.split(_col(text), ""), lambda c: c != "")
    low_bytes = F.transform(chars, lambda c: F.pmod(F.ascii(c) + 128, F.lit(256)) - 128)
    return F.aggregate(low_bytes, F.lit(0), lambda total, b: total + b) % F.lit(modulus)


def last_or_zero(items: Column | str) -> Column:
    """Last element of a text array, "0" when there is none."""
    return F.coalesce(F.try_element_at(_col(items), F.lit(-1)), F.lit("0"))


def first_as_int(items: Column | str) -> Column:
    return F.coalesce(F.get(_col(items), F.lit(0)).try_cast("int"), F.lit(0))


def last_as_int(items: Column | str) -> Column:
    return F.coalesce(F.try_element_at(_col(items), F.lit(-1)).try_cast("int"), F.lit(0))


def currency_code(text: Column | str) -> Column:
    return F.substring(_col(text), 1, 3)


def or_default(value: Column | str, default) -> Column:
    """A possibly missing nested field with its default."""
    return F.coalesce(_col(value), F.lit(default))
