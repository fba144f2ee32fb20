"""Clean reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placewell.functions.scalars import first_timestamp, month_of_timestamp, not_null
from placewell.operators.ranking import keep_newest


def stamped_reviews(raw: DataFrame) -> DataFrame:
    """Raw reviews that have their keys, with one time, under the names of the clean table."""
    return not_null(raw, "review_id", "user_id", "business_id").select(
        "review_id", "user_id", "business_id",
        F.col("stars").alias("review_stars"),
        "useful", "funny", "cool",
        F.col("text").alias("review_text"),
        first_timestamp(F.col("date_ts"), F.col("date")).alias("review_timestamp"),
    )


def newest_reviews(stamped: DataFrame) -> DataFrame:
    return keep_newest(stamped, ["review_id"], "review_timestamp")


def review_clean(raw: DataFrame) -> DataFrame:
    """One row per review, the newest, with the date parts of its time."""
    return with_date_parts(newest_reviews(stamped_reviews(raw)))


def with_date_parts(df: DataFrame, ts: str = "review_timestamp", prefix: str = "review") -> DataFrame:
    """Date, month (as a timestamp) and year of ``ts``."""
    when = F.col(ts)
    return df.withColumns({
        f"{prefix}_date": when.cast("date"),
        f"{prefix}_month": month_of_timestamp(when),
        f"{prefix}_year": F.year(when),
    })
