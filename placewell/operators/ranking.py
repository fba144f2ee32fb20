"""Deduplication and best-n per group.

``row_number() <= n`` is cut twice by Spark: each map task keeps at most n rows per
key before the shuffle, and the reducers finish the job. A key that holds a third
of all rows thus sends at most n rows per map task, so none of these needs salting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from placewell.functions.ordering import asc, desc, tie_columns

_RANK = "_rank_in_key"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
               ties: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: the first in ``order``, then in ``ties`` (default: all columns)."""
    if ties is None:
        ties = [asc(c) for c in tie_columns(df, keys)]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .where(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def keep_newest(df: DataFrame, keys: Sequence[str], ts: str,
                ties: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: the one with the largest ``ts``; a NULL ``ts`` counts as the largest."""
    return keep_first(df, keys, [desc(ts)], ties)


def latest_per_key(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Current row per key.

    Ties on ``ts`` go to the largest of the remaining columns, in schema order: the
    same choice as ``max(struct(ts, ...))``, which the streaming form uses.
    """
    ties = [F.col(c).desc_nulls_last() for c in tie_columns(df, (key, ts))]
    return keep_newest(df, [key], ts, ties)


def top_n(df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int,
          rank: str = "rank", ties: Sequence[Column] | None = None) -> DataFrame:
    """The first ``n`` rows of each group, with their rank as a column."""
    if ties is None:
        ties = [asc(c) for c in tie_columns(df, groups)]
    window = Window.partitionBy(*groups).orderBy(*order, *ties)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Exact deduplication when all outputs are functions of the keys.

    A hash aggregation with map-side partials; no sort, unlike a ranked window.
    """
    return df.select(*keys).distinct()
