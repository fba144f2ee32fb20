"""Checks around a refresh: raw null profiles, counts before and after, and the monthly trend."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame

from placewell.operators.profiling import monthly_trend, null_profile, row_counts
from placewell.plans.checkins import checkin_rejects

# The columns profiled in the raw tables.
PLACE_PROFILE = ("business_id", "name", "address", "city", "state", "postal_code", "categories")
REVIEW_PROFILE = ("review_id", "user_id", "business_id", "stars", "date", "date_ts", "text")


def place_profile(raw: DataFrame) -> DataFrame:
    return null_profile(raw, PLACE_PROFILE)


def review_profile(raw: DataFrame) -> DataFrame:
    """Missing values, and dates that cannot be read."""
    return null_profile(raw, REVIEW_PROFILE, ["date"])


def review_trend(clean: DataFrame) -> DataFrame:
    """Reviews and mean stars by month."""
    return monthly_trend(clean, "review_month", "review_stars")


def report(places: DataFrame, reviews: DataFrame, clean: Mapping[str, DataFrame],
           checkins: DataFrame | None = None) -> Iterator[tuple[str, DataFrame]]:
    """All checks, each with a title."""
    yield "places: missing values", place_profile(places)
    yield "reviews: missing values", review_profile(reviews)
    if checkins is not None:
        yield "check-ins: missing and unreadable values", checkin_rejects(checkins)
    yield "rows", row_counts({"raw places": places, "raw reviews": reviews, **clean})
    yield "reviews by month", review_trend(clean["review_clean"]).orderBy("review_month")
