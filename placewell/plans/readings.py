"""Live readings: typed rows out of the raw variants, and the latest row per place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placewell.functions.scalars import (
    in_year, list_part, safe_ratio, shift_zone, whole_number,
)
from placewell.operators.profiling import newest_first
from placewell.operators.ranking import latest_per_key
from placewell.sources.compaction import variants_text
from placewell.sources.tables import create_view

# Year and zones of the readings.
READING_YEAR = 2026
SOURCE_ZONE = "UTC"
LOCAL_ZONE = "America/New_York"
REPORT_ZONE = "America/Los_Angeles"

# The instant a reading was taken (UTC). Local time repeats an hour in autumn, so
# "latest" goes by this column.
INSTANT = "event_time_utc"


def field(name: str, dtype: str, raw: str = "raw_data") -> Column:
    """One field of a variant; names are case sensitive, bad values give NULL."""
    return F.try_variant_get(raw, f"$.{name}", dtype)


# column -> field of the record and the type it is read as; whole numbers are read as
# doubles first, so that they can be rounded
FIELDS = {
    "business_id": ("BUSINESS_ID", "string"),
    "coord": ("coord", "string"),
    "city": ("city", "string"),
    "road_class": ("frc", "string"),
    "data_confidence": ("confidence", "double"),
    "is_closed": ("roadClosure", "boolean"),
    "current_speed": ("currentSpeed", "double"),
    "free_flow_speed": ("freeFlowSpeed", "double"),
    "current_travel_time": ("currentTravelTime", "double"),
    "free_flow_travel_time": ("freeFlowTravelTime", "double"),
    INSTANT: ("timestamp", "timestamp_ntz"),
}


def reading_fields(raw: DataFrame, year: int | None = READING_YEAR,
                   require_metric: bool = False) -> DataFrame:
    """Fields of the readings of one year that have a key. Works on batches and on streams.

    The projection only takes fields out of the variant: in this form Spark moves all of
    them into the Parquet scan and does not load the rest of the record.
    A reading whose time cannot be read has no place in the order and is left out, in
    batches and streams alike. ``require_metric`` drops the rows of failed polls, which
    have no speed.
    """
    if year is not None and "payload_year" in raw.columns:
        # the partition prunes files; the range below decides
        raw = raw.where(F.col("payload_year") == str(year))
    fields = raw.select(*[field(f, dtype).alias(c) for c, (f, dtype) in FIELDS.items()])
    kept = fields.where(F.col("business_id").isNotNull() & F.col(INSTANT).isNotNull())
    if year is not None:
        kept = kept.where(in_year(F.col(INSTANT), year))
    if require_metric:
        kept = kept.where(F.col("current_speed").isNotNull())
    return kept


def typed_columns(fields: DataFrame) -> DataFrame:
    """Place, whole speeds and times, speed ratio and local time out of the fields."""
    return fields.select(
        "business_id",
        list_part(F.col("coord"), 1, "double").alias("lat"),
        list_part(F.col("coord"), 2, "double").alias("lon"),
        "city", "road_class", "data_confidence", "is_closed",
        *[whole_number(F.col(c)).alias(c) for c in (
            "current_speed", "free_flow_speed", "current_travel_time", "free_flow_travel_time")],
        safe_ratio(F.col("current_speed"), F.col("free_flow_speed")).alias("speed_ratio"),
        INSTANT,
        shift_zone(F.col(INSTANT), SOURCE_ZONE, LOCAL_ZONE).alias("event_time"),
    )


def readings_typed(raw: DataFrame, year: int | None = READING_YEAR,
                   require_metric: bool = False) -> DataFrame:
    """All typed readings of one year."""
    return typed_columns(reading_fields(raw, year, require_metric))


def readings_latest(raw: DataFrame, year: int | None = READING_YEAR,
                    require_metric: bool = False) -> DataFrame:
    """The latest reading of each place. Only the rows kept are worked out further."""
    fields = reading_fields(raw, year, require_metric)
    return typed_columns(latest_per_key(fields, "business_id", INSTANT)).drop(INSTANT)


def latest_report(latest: DataFrame) -> DataFrame:
    """Places by their latest reading, newest first, with the rounded ratio."""
    ordered = newest_first(latest, "event_time", ties=[F.col("business_id")])
    return ordered.select(
        "business_id", "current_speed",
        F.round("speed_ratio", 2).alias("friction_index"),
        shift_zone(F.col("event_time"), LOCAL_ZONE, REPORT_ZONE).alias("latest_pulse_pst"),
    )


def register_views(raw: DataFrame, year: int | None = READING_YEAR) -> None:
    """The two views over rows at hand; ``open_views`` is for stored tables."""
    readings_typed(raw, year).createOrReplaceTempView("readings_final")
    readings_latest(raw, year).createOrReplaceTempView("readings_latest")


def open_views(spark: SparkSession, target: str, year: int | None = READING_YEAR,
               database: str | None = None, names: tuple[str, str] = ("readings_final", "readings_latest")) -> None:
    """The two views over a stored table of variants, in this session or in a database.

    They are stored as text: each query sees the batches that are published by then,
    whether these lie in their own folders or in segments.
    """
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    rows = variants_text(spark, target)
    for name, text in zip(names, (typed_text(rows, year), latest_text(rows, year)), strict=True):
        create_view(spark, f"{database}.{name}" if database else name, text, database is None)


def fields_text(rows: str, year: int | None) -> str:
    """``reading_fields`` as SQL over the query ``rows``."""
    fields = ", ".join(f"try_variant_get(raw_data, '$.{f}', '{dtype}') AS {c}" for c, (f, dtype) in FIELDS.items())
    pruned = kept = ""
    if year is not None:
        pruned = f"WHERE payload_year = '{year}'"
        kept = (f"AND {INSTANT} >= TIMESTAMP_NTZ '{year:04d}-01-01' "
                f"AND {INSTANT} < TIMESTAMP_NTZ '{year + 1:04d}-01-01'")
    return (f"SELECT * FROM (SELECT {fields} FROM ({rows}) {pruned}) "
            f"WHERE business_id IS NOT NULL AND {INSTANT} IS NOT NULL {kept}")


def columns_text(fields: str, *more: str) -> str:
    """``typed_columns`` as SQL over the query ``fields``."""
    whole = [f"try_cast(round({c}, 0) AS BIGINT) AS {c}" for c in (
        "current_speed", "free_flow_speed", "current_travel_time", "free_flow_travel_time")]
    columns = [
        "business_id", "try_cast(split_part(coord, ',', 1) AS DOUBLE) AS lat",
        "try_cast(split_part(coord, ',', 2) AS DOUBLE) AS lon", "city", "road_class", "data_confidence", "is_closed",
        *whole, "CASE WHEN free_flow_speed <> 0 THEN current_speed / free_flow_speed END AS speed_ratio", *more,
        f"convert_timezone('{SOURCE_ZONE}', '{LOCAL_ZONE}', {INSTANT}) AS event_time"]
    return f"SELECT {', '.join(columns)} FROM ({fields})"


def typed_text(rows: str, year: int | None = READING_YEAR) -> str:
    """``readings_typed`` as SQL over the query ``rows``."""
    return columns_text(fields_text(rows, year), INSTANT)


def latest_text(rows: str, year: int | None = READING_YEAR) -> str:
    """``readings_latest`` as SQL over the query ``rows``."""
    ties = ", ".join(f"{c} DESC NULLS LAST" for c in FIELDS if c not in ("business_id", INSTANT))
    ranked = (f"SELECT *, row_number() OVER (PARTITION BY business_id ORDER BY {INSTANT} DESC NULLS FIRST, {ties}) "
              f"AS rank_in_key FROM ({fields_text(rows, year)})")
    return columns_text(f"SELECT * FROM ({ranked}) WHERE rank_in_key = 1")
