"""Counts, profiles, trends and reports. All aggregations combine on the map side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewell.functions.ordering import asc, desc
from placewell.functions.scalars import minute_of, month_of_date, parse_timestamp


def null_profile(df: DataFrame, columns: Sequence[str],
                 timestamp_text: Sequence[str] = ()) -> DataFrame:
    """Row count and missing values per column in one pass.

    ``timestamp_text`` names text columns that later become timestamps; their values
    that cannot be parsed are counted as ``rejected_<column>``.
    """
    measures = [F.count(F.lit(1)).alias("total_rows")]
    measures += [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns]
    measures += [
        F.count_if(F.col(c).isNotNull() & parse_timestamp(F.col(c)).isNull()).alias(f"rejected_{c}")
        for c in timestamp_text
    ]
    return df.agg(*measures)


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per named frame. For Parquet scans only the file footers are read."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def monthly_trend(df: DataFrame, month: str, measure: str,
                  count_as: str = "review_count", mean_as: str = "avg_stars") -> DataFrame:
    """Rows and mean of ``measure`` by month."""
    return df.groupBy(month).agg(
        F.count(F.lit(1)).alias(count_as), F.avg(measure).alias(mean_as)
    )


def minute_buckets(df: DataFrame, ts: str, newest: int | None = 20) -> DataFrame:
    """Rows per minute, newest minute first."""
    counts = df.groupBy(minute_of(F.col(ts)).alias("time_bucket")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return newest_first(counts, "time_bucket", newest)


def newest_first(df: DataFrame, ts: str, limit: int | None = None,
                 ties: Sequence[Column] = ()) -> DataFrame:
    """Newest rows first; with ``limit`` a top-k, without a full sort."""
    ordered = df.orderBy(desc(ts), *ties)
    return ordered if limit is None else ordered.limit(limit)


def preview(df: DataFrame, key: str, n: int) -> DataFrame:
    """First ``n`` rows by ``key``."""
    return df.orderBy(asc(key)).limit(n)


def category_state_summary(df: DataFrame, category: str, state: str, stars: str,
                           reviews: str) -> DataFrame:
    """Places, mean stars and reviews by class and state."""
    return df.groupBy(category, state).agg(
        F.count(F.lit(1)).alias("entity_count"),
        F.avg(stars).alias("avg_stars"),
        F.sum(reviews).alias("total_reviews"),
    )


def activity_by_month(df: DataFrame, key: str, day: str) -> DataFrame:
    """Events per key and month."""
    return df.groupBy(key, month_of_date(F.col(day).cast("date")).alias("activity_month")).agg(
        F.count(F.lit(1)).alias("event_count")
    )
