"""Clean places and the best ones of a region."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewell.functions.classify import PLACE_RULES, Rules, classify
from placewell.functions.ordering import asc, desc
from placewell.functions.scalars import contains_text, not_null, with_default
from placewell.operators.joins import attach_latest, only_keys_of
from placewell.operators.ranking import keep_first, latest_per_key, top_n
from placewell.plans.readings import INSTANT, READING_YEAR, reading_fields, typed_columns

# The region and the classes of the regional ranking.
REGION_CITY = "philadel"
REGION_STATE = "PA"
REGION_CLASSES = (
    "Food & Restaurants",
    "Beauty & Personal Care",
    "Health & Medical",
    "Retail & Shopping",
    "Home Services",
)
REGION_TOP = 5
DRIVER_ROWS = 1_000  # so many ranked places at most are held by the driver


def named_places(raw: DataFrame) -> DataFrame:
    """Raw places that have a key, under the names of the clean table."""
    return not_null(raw, "business_id").select(
        "business_id",
        F.col("name").alias("business_name"),
        "address", "city", "state", "postal_code", "latitude", "longitude",
        F.col("stars").alias("business_stars"),
        "review_count", "is_open", "categories", "attributes", "hours",
    )


def best_places(named: DataFrame) -> DataFrame:
    """One row per place: the best rated, then the most reviewed, then the first by name."""
    return keep_first(
        named, ["business_id"],
        [desc("business_stars"), desc("review_count"), asc("business_name")],
    )


def classified(best: DataFrame, rules: Rules = PLACE_RULES) -> DataFrame:
    """Places with their class.

    The class is taken from the raw list, so a missing list reads "Unknown" while its
    class is the default one.
    """
    return classify(best, "categories", "primary_category", rules).withColumn(
        "categories", with_default(F.col("categories"), "Unknown")
    )


def entity_clean(raw: DataFrame, rules: Rules = PLACE_RULES) -> DataFrame:
    """The best row of each place. Classes are assigned after the duplicates are gone."""
    return classified(best_places(named_places(raw)), rules)


def in_region(df: DataFrame, city: Column, city_part: str, state: Column, state_code,
              category: Column, classes: Sequence[str]) -> DataFrame:
    """Rows of one region and some classes; the equality and the list reach the scan."""
    return df.where(
        contains_text(city, city_part) & (state == F.lit(state_code)) & category.isin(*classes)
    )


def regional_top(clean: DataFrame, city_part: str = REGION_CITY, state: str = REGION_STATE,
                 classes: Sequence[str] = REGION_CLASSES, n: int = REGION_TOP) -> DataFrame:
    """The best ``n`` places per class in one region: at most ``n * len(classes)`` rows."""
    local = in_region(
        clean, F.col("city"), city_part, F.col("state"), state, F.col("primary_category"), classes
    ).select(
        "business_id", "business_name", "address", "city", "state", "postal_code",
        "latitude", "longitude", "primary_category", "business_stars", "review_count",
    )
    return top_n(
        local, ["primary_category"],
        [desc("business_stars"), desc("review_count"), asc("business_name")],
        n, "rank_in_category",
    )


def regional_top_with_latest(clean: DataFrame, raw_readings: DataFrame, year: int | None = READING_YEAR,
                             classes: Sequence[str] = REGION_CLASSES, n: int = REGION_TOP,
                             **region) -> DataFrame:
    """The best places of a region with their latest reading, where there is one.

    The number of classes bounds the places. Up to DRIVER_ROWS of them are worked out first,
    and their keys go into the scan of the readings as a filter; beyond that the readings
    are cut to the wanted places by a join before any is ranked.
    """
    best = regional_top(clean, classes=classes, n=n, **region)
    rows = n * len(classes)
    fields = reading_fields(raw_readings, year)
    if rows <= DRIVER_ROWS:
        held = best.collect()
        best = best.sparkSession.createDataFrame(held, best.schema)
        mine = fields.where(F.col("business_id").isin([r.business_id for r in held]))
    else:
        mine = only_keys_of(fields, best, "business_id", rows)
    latest = typed_columns(latest_per_key(mine, "business_id", INSTANT)).drop(INSTANT, "city")
    return attach_latest(best, latest, "business_id", rows)
