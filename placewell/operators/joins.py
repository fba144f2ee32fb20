"""Lateral explode and the two lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewell.functions.scalars import split_list

# A side is broadcast only when its number of rows is known beforehand and at most this.
BROADCAST_ROWS = 100_000


def explode_list(df: DataFrame, column: str, item: str, separator: str = ",") -> DataFrame:
    """One row per non-blank part of a delimited string, trimmed. NULL gives no row."""
    return (
        df.withColumn(item, F.explode(split_list(F.col(column), separator)))
        .withColumn(item, F.trim(F.col(item)))
        .where(F.col(item) != "")
    )


def small_side(df: DataFrame, max_rows: int | None) -> DataFrame:
    """``df`` with a broadcast hint if its bound allows one.

    Without a bound the choice is Spark's, which measures the side first.
    """
    if max_rows is not None and max_rows <= BROADCAST_ROWS:
        return F.broadcast(df)
    return df


def point_keys(spark: SparkSession, points: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Polled points and their keys, paired by position up to the shorter list."""
    pairs = list(zip(points, keys))
    return spark.createDataFrame(pairs, "coord string, business_id string")


def attach_key(df: DataFrame, lookup: DataFrame, on: str, lookup_rows: int | None = None,
               how: str = "inner") -> DataFrame:
    """Join a lookup of at most ``lookup_rows`` rows on a column of the same name."""
    return df.join(small_side(lookup, lookup_rows), on, how)


def attach_latest(entities: DataFrame, latest: DataFrame, key: str,
                  latest_rows: int | None = None) -> DataFrame:
    """Entities with their latest reading, where they have one.

    Both sides hold one row per key, so no key can be hot here.
    """
    return entities.join(small_side(latest, latest_rows), key, "left")


def only_keys_of(df: DataFrame, entities: DataFrame, key: str,
                 entity_rows: int | None = None) -> DataFrame:
    """Rows whose key occurs in ``entities``: cuts a large log before it is ranked."""
    return df.join(small_side(entities.select(key).distinct(), entity_rows), key, "left_semi")
