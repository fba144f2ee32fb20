"""Check-in lists: one row per list, and one row per event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewell.functions.scalars import (
    delimited_count, month_of_date, not_null, parse_timestamp,
)
from placewell.operators.joins import explode_list
from placewell.operators.ranking import distinct_keys


def checkin_summary(raw: DataFrame) -> DataFrame:
    """Distinct trimmed lists per place, with the number of entries they seem to hold."""
    lists = not_null(raw, "business_id").select("business_id", F.trim("date").alias("checkin_raw"))
    return distinct_keys(lists, "business_id", "checkin_raw").withColumn(
        "checkin_count_est", delimited_count(F.col("checkin_raw"))
    )


def checkin_times(raw: DataFrame) -> DataFrame:
    """Place and time of each entry. Text that is no time gives a NULL time."""
    entries = explode_list(not_null(raw, "business_id", "date"), "date", "entry")
    return entries.select("business_id", parse_timestamp(F.col("entry")).alias("checkin_time"))


def distinct_times(times: DataFrame) -> DataFrame:
    """Each place and time once.

    Repeats within a map task are dropped before the shuffle, which spreads by place
    and time: a place with most of the events is not one task.
    """
    return distinct_keys(times, "business_id", "checkin_time")


def with_days(times: DataFrame) -> DataFrame:
    day = F.col("checkin_time").cast("date")
    return times.withColumns({"checkin_date": day, "checkin_month": month_of_date(day)})


def checkin_events(raw: DataFrame) -> DataFrame:
    """One row per place and check-in time, with its day and month."""
    return with_days(distinct_times(checkin_times(raw)))


def checkin_rejects(raw: DataFrame) -> DataFrame:
    """One row: lists, entries in them, and how many of these are no time."""
    entries = explode_list(not_null(raw, "business_id", "date"), "date", "entry")
    read = parse_timestamp(F.col("entry"))
    lists = raw.agg(
        F.count(F.lit(1)).alias("list_count"),
        F.count_if(F.col("business_id").isNull()).alias("lists_without_place"),
        F.count_if(F.col("date").isNull()).alias("missing_lists"))
    found = entries.agg(F.count(F.lit(1)).alias("entry_count"), F.count_if(read.isNull()).alias("rejected_entries"))
    both = lists.unionByName(found, allowMissingColumns=True)  # one row each, NULL where the other counts
    return both.agg(*(F.coalesce(F.max(c), F.lit(0)).alias(c) for c in both.columns))
