"""Scalar expressions. All are built-in, and bad text gives NULL instead of a failed job."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placewell.functions.ordering import quoted


def with_default(col: Column, value: str) -> Column:
    return F.coalesce(col, F.lit(value))


def first_timestamp(typed: Column, text: Column) -> Column:
    """The typed timestamp where there is one, else the parsed text."""
    return F.coalesce(typed.cast("timestamp_ntz"), parse_timestamp(text))


def parse_timestamp(text: Column) -> Column:
    """Text to wall-clock timestamp, independent of the session time zone."""
    return text.try_cast("timestamp_ntz")


def month_of_timestamp(ts: Column) -> Column:
    """First instant of the month, as a timestamp."""
    # date_trunc would return an instant and pass through the session time zone
    return F.trunc(ts.cast("date"), "MONTH").cast("timestamp_ntz")


def month_of_date(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "MONTH")


def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def shift_zone(ts: Column, source: str, target: str) -> Column:
    """Wall-clock time in ``source`` shown as wall-clock time in ``target``."""
    return F.convert_timezone(F.lit(source), F.lit(target), ts)


def in_year(ts: Column, year: int) -> Column:
    """Year test as a half-open range, which reaches the Parquet scan (a text prefix does not)."""
    low, high = (F.lit(f"{y:04d}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
    return (ts >= low) & (ts < high)


def list_part(col: Column, position: int, dtype: str = "string", separator: str = ",") -> Column:
    """One part of a delimited string; NULL where it is missing or not of the type."""
    return F.split_part(col, F.lit(separator), F.lit(position)).try_cast(dtype)


def delimited_count(col: Column, separator: str = ",") -> Column:
    """Separators + 1, and 0 for a NULL or blank list."""
    text = F.trim(col)
    return F.when(
        col.isNull() | (text == ""), F.lit(0)
    ).otherwise(F.regexp_count(text, F.lit(re.escape(separator))) + 1)


def split_list(col: Column, separator: str = ",") -> Column:
    return F.split(col, re.escape(separator), -1)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, NULL where the denominator is 0 or NULL."""
    return F.when(denominator != 0, numerator / denominator)


def whole_number(col: Column) -> Column:
    """Number to integer, halves away from zero (a plain cast would cut them off)."""
    return F.round(col, 0).try_cast("bigint")


def contains_text(col: Column, part: str) -> Column:
    """Case-insensitive substring test."""
    return F.contains(F.lower(col), F.lit(part.lower()))


def not_null(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys))


def flatten_struct(df: DataFrame) -> DataFrame:
    """Nested structs to top-level columns with dotted names; arrays stay as they are."""
    def leaves(struct: T.StructType, path: tuple[str, ...]):
        for field in struct.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield F.col(".".join(quoted(p) for p in here)).alias(".".join(here))

    return df.select(*leaves(df.schema, ()))
