"""Log files: JSON lines, day windows, malformed records and lookup lists."""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally import schemas
from adtally.functions import time as tm

CORRUPT = "_corrupt_record"


def read_json(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """JSON lines with a declared layout; other fields are dropped, absent ones null."""
    return spark.read.schema(schema).json(paths)


def filled(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Replace missing flat fields by their defaults, so no key is ever null."""
    return df.na.fill(schemas.defaults(schema))


def window_paths(pattern: str, days: list[dt.date]) -> list[str]:
    """File patterns holding the local days ``days``: the days and both neighbours.

    ``pattern`` has one ``{day}`` place for ``yyyyMMdd``.
    """
    wanted = {d + dt.timedelta(days=k) for d in days for k in (-1, 0, 1)}
    return [pattern.format(day=d.strftime("%Y%m%d")) + "*" for d in sorted(wanted)]


def present(spark: SparkSession, patterns: list[str]) -> list[str]:
    """The patterns that match some file; the day after the last may not have begun."""
    out = []
    for pattern in patterns:
        path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path):
            out.append(pattern)
    return out


def day_files(spark: SparkSession, pattern: str, days: list[dt.date], schema: T.StructType,
              keep_bad: bool = False) -> DataFrame:
    """Records of the files of ``days`` and of the days beside them, each with the day its file is named by.

    Only files of these days are listed. ``file_day`` comes from the name, so
    a record that was written late is where the log has it. With ``keep_bad``
    a line that does not fit the layout is kept in ``_corrupt_record``.
    """
    paths = present(spark, window_paths(pattern, days))
    if not paths:
        raise FileNotFoundError(f"no log files match {pattern} for the wanted days")
    layout = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]) if keep_bad else schema
    before = pattern.split("{day}")[0].rsplit("/", 1)[-1]
    named = F.regexp_extract(F.col("_metadata.file_path"), rf"/\Q{before}\E([0-9]{{8}})", 1)
    return read_json(spark, paths, layout).withColumn("file_day", F.to_date(named, "yyyyMMdd"))


def _fields(log: DataFrame) -> list[str]:
    return [c for c in log.columns if c not in (CORRUPT, "file_day")]


def bad_lines(log: DataFrame) -> DataFrame:
    """Lines that do not fit the layout, by file day, with what could be read from them.

    All fields are asked for: the reader checks no others.
    """
    return log.where(F.col(CORRUPT).isNotNull()).select(
        "file_day", F.struct(*_fields(log)).alias("record"), F.col(CORRUPT).alias("value"))


def watch_bad_lines(log: DataFrame, lines: Observation) -> DataFrame:
    """``log`` without its corrupt lines' text; whoever reads it counts them as ``bad``."""
    seen = log.observe(lines, F.count_if(F.col(CORRUPT).isNotNull()).alias("bad"),
                       F.bit_xor(F.xxhash64(*_fields(log))).alias("all_fields"))
    return seen.drop(CORRUPT)


def hour_folders(spark: SparkSession, base: str, days: list[dt.date], schema: T.StructType) -> DataFrame:
    """Records below ``base`` in folders ``hour=yyyyMMddHH``, of every hour of ``days``, with their ``hour``.

    The filter is on the folder, so files of other hours are not opened.
    """
    layout = T.StructType([*schema.fields, T.StructField("hour", T.LongType())])
    hours = [int(f"{d:%Y%m%d}{h:02d}") for d in sorted(days) for h in range(24)]
    return read_json(spark, base, layout).where(F.col("hour").isin(hours))


def in_file_window(df: DataFrame, days: list[dt.date], file_day: str = "file_day") -> DataFrame:
    """The same window over a table partitioned by the day of the file."""
    low = min(days) - dt.timedelta(days=1)
    high = max(days) + dt.timedelta(days=1)
    return df.where(F.col(file_day).between(F.lit(low), F.lit(high)))


def near_days(df: DataFrame, days: list[dt.date], epoch: str) -> DataFrame:
    """Bounds on the raw epoch column.

    They are implied by the exact day filter on a derived column, but only a
    filter on the stored column reaches the Parquet row group statistics.
    """
    low, high = tm.epoch_window(days)
    return df.where((F.col(epoch) >= low) & (F.col(epoch) < high))


def on_days(df: DataFrame, days: list[dt.date] | None, column: str = "dated") -> DataFrame:
    return df if days is None else df.where(F.col(column).isin(list(days)))


def _loose(schema: T.DataType) -> T.DataType:
    """The layout with every scalar read as text."""
    if isinstance(schema, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType)) for f in schema.fields])
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(_loose(schema.elementType))
    if isinstance(schema, T.MapType):
        return T.MapType(T.StringType(), _loose(schema.valueType))
    return T.StringType()


def _tight(value: Column, wanted: T.DataType) -> Column:
    """Cast text leaves to their types, null where the text does not fit."""
    if isinstance(wanted, T.StructType):
        inner = F.struct(*[_tight(value[f.name], f.dataType).alias(f.name) for f in wanted.fields])
        return F.when(value.isNotNull(), inner)
    if isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda x: _tight(x, wanted.elementType))
    if isinstance(wanted, T.MapType):
        return F.transform_values(value, lambda _, x: _tight(x, wanted.valueType))
    if isinstance(wanted, T.StringType):
        return value
    return value.try_cast(wanted)


def _misfits(value: Column, wanted: T.StructType) -> list[Column]:
    """Number fields holding text that is not a number."""
    out = []
    for f in wanted.fields:
        leaf = value[f.name]
        if isinstance(f.dataType, T.StructType):
            out += _misfits(leaf, f.dataType)
        elif not isinstance(f.dataType, (T.StringType, T.ArrayType, T.MapType)):
            out.append(leaf.isNotNull() & leaf.try_cast(f.dataType).isNull())
    return out


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _unbounded(value: Column, wanted: T.StructType) -> list[Column]:
    """Doubles that a message writes as no finite number."""
    out = []
    for f in wanted.fields:
        if isinstance(f.dataType, T.StructType):
            out += _unbounded(value[f.name], f.dataType)
        elif isinstance(f.dataType, T.DoubleType):
            out.append(F.coalesce(F.abs(value[f.name]) > sys.float_info.max, F.lit(False)))
    return out


def _typed_record(text: str, schema: T.StructType, loose: Column) -> Column:
    """The record read with its types; where it does not fit them, the casts of ``loose``, its scalars as text.

    Both readings agree wherever the first succeeds, but for doubles that are
    not finite. ``CORRUPT`` is filled where neither can be read.
    """
    def cast(r: Column) -> Column:
        bad = _any([r[CORRUPT].isNotNull(), *_misfits(r, schema)])
        return F.struct(*[_tight(r[f.name], f.dataType).alias(f.name) for f in schema.fields],
                        F.when(bad, F.col(text)).alias(CORRUPT))

    typed = F.from_json(text, T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]),
                        {"columnNameOfCorruptRecord": CORRUPT})
    # As elements of arrays both are read once, the second only for the messages that need it.
    return F.transform(F.array(typed), lambda r: F.when(
        ~_any([r[CORRUPT].isNotNull(), *_unbounded(r, schema)]), r).otherwise(
            F.get(F.transform(F.array(loose), cast), F.lit(0))))


def parse_messages(messages: DataFrame, schema: T.StructType, text: str = "value",
                   keep: list[str] | None = None, typed_first: bool = False) -> DataFrame:
    """Stream messages to records.

    Messages may quote their numbers. Every scalar is therefore read as text
    and then cast. The column ``malformed`` marks messages that are no JSON
    object or hold a number field that is not a number; ``good`` and
    ``quarantined`` split on it.

    ``typed_first`` gives the same records sooner where most messages do not
    quote their numbers: only those that do are read as text. The layout must
    hold no floats, which lose digits one way and not the other.
    """
    loose = T.StructType([*_loose(schema).fields, T.StructField(CORRUPT, T.StringType())])
    record = F.from_json(text, loose, {"columnNameOfCorruptRecord": CORRUPT})
    if typed_first:
        raw = messages.select(*(keep or []), text, F.explode(_typed_record(text, schema, record)).alias("_r"))
        misfit = ~F.startswith(F.ltrim(F.col(text)), F.lit("{")) | F.col(f"_r.{CORRUPT}").isNotNull()
        return raw.select(*(keep or []), F.col(text), F.coalesce(misfit, F.lit(True)).alias("malformed"),
                          *[F.col("_r")[f.name].alias(f.name) for f in schema.fields])
    # As the output of a generator the record is parsed once. A plain column
    # would be inlined into the filters on it and parsed again for every field.
    raw = messages.select(*(keep or []), text, F.explode(F.array(record)).alias("_r"))
    misfit = ~F.startswith(F.ltrim(F.col(text)), F.lit("{")) | F.col(f"_r.{CORRUPT}").isNotNull()
    for m in _misfits(F.col("_r"), schema):
        misfit = misfit | m
    return raw.select(
        *(keep or []),
        F.col(text),
        F.coalesce(misfit, F.lit(True)).alias("malformed"),
        *[_tight(F.col("_r")[f.name], f.dataType).alias(f.name) for f in schema.fields],
    )


def good(parsed: DataFrame, schema: T.StructType, keep_missing: Sequence[str] = (), text: str = "value") -> DataFrame:
    """Readable records with defaults for missing fields, but for those in ``keep_missing``."""
    rows = parsed.where(~F.col("malformed")).drop("malformed", text)
    kept = {f"_{c}": F.col(c) for c in keep_missing}
    out = filled(rows.withColumns(kept) if kept else rows, schema)
    return out.withColumns({c: F.col(f"_{c}") for c in keep_missing}).drop(*kept) if kept else out


def quarantined(parsed: DataFrame, text: str = "value") -> DataFrame:
    return parsed.where("malformed").select(text)


def read_id_list(spark: SparkSession, path: str, name: str = "group_id") -> DataFrame:
    """A lookup list with one id per line."""
    return spark.read.text(path).select(F.trim("value").alias(name)).where(F.col(name) != "")


def read_summary(spark: SparkSession, path: str, days: list[dt.date] | None = None,
                 timezone: float | None = None) -> DataFrame:
    """A summary table, by day and offset if wanted."""
    df = on_days(spark.read.parquet(path), days)
    return df if timezone is None else df.where(F.col("timezone") == F.lit(timezone))
