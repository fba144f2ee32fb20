"""The raw-to-clean refresh: of whole tables, or of the keys that new batches hold."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewell.operators.profiling import row_counts
from placewell.plans.checkins import (
    checkin_events, checkin_summary, checkin_times, distinct_times, with_days,
)
from placewell.plans.places import (
    best_places, classified, entity_clean, named_places, regional_top,
)
from placewell.plans.reviews import (
    newest_reviews, review_clean, stamped_reviews, with_date_parts,
)
from placewell.sources.buckets import (
    BUCKETS, last_commit, merge_changes, read_buckets, remove_old_buckets,
)
from placewell.sources.ingest import BATCH, published_rows, published_upto
from placewell.sources.tables import RETAIN, replace_table

Rows = Callable[[DataFrame], DataFrame]
# table -> its raw table, its key, what a raw row becomes, which rows of a key stay, and the clean columns
KEYED: dict[str, tuple[str, str, Rows, Rows, Rows]] = {
    "entity_clean": ("places", "business_id", named_places, best_places, classified),
    "review_clean": ("reviews", "review_id", stamped_reviews, newest_reviews, with_date_parts),
    "checkin_events": ("checkins", "business_id", checkin_times, distinct_times, with_days),
}


def refresh(places: DataFrame, reviews: DataFrame, checkins: DataFrame, location: str,
            checkin_lists: bool = False) -> DataFrame:
    """Rebuild the clean tables in a folder and return their row counts.

    ``checkin_lists`` adds the table of check-in lists, which nothing else reads.

    Places come first; once they are stored, the tables that follow them run side by
    side, and Spark shares its executors between them.
    """
    stored = {"entity_clean": replace_table(entity_clean(places), location, "entity_clean")}
    rest = {
        "regional_top": lambda: regional_top(stored["entity_clean"]),
        "checkin_events": lambda: checkin_events(checkins),
        "review_clean": lambda: review_clean(reviews),
    }
    if checkin_lists:
        rest["checkin_summary"] = lambda: checkin_summary(checkins)
    with ThreadPoolExecutor(len(rest)) as pool:
        jobs = {
            name: pool.submit(lambda n=name, b=build: replace_table(b(), location, n))
            for name, build in rest.items()
        }
        stored |= {name: job.result() for name, job in jobs.items()}
    return row_counts(stored)


def refresh_changed(spark: SparkSession, raw: Mapping[str, str], location: str, buckets: int = BUCKETS,
                    retain: timedelta = RETAIN) -> dict[str, int]:
    """Take the batches that came since the last refresh into the clean tables.

    ``raw`` names the folders of the raw tables ``places``, ``reviews`` and ``checkins``.
    Only buckets that hold keys of new rows are read and written; their number is returned
    for each table. The result is that of a refresh of everything, because the rows that
    stay of a key can be found from those that stayed before and the new ones.
    """
    done = {}
    for name, (source, key, shape, choose, _) in KEYED.items():
        home = f"{location}/{name}"
        upto, before = published_upto(spark, raw[source]), last_commit(spark, home)[2]
        if upto is None or upto <= before:
            done[name] = 0
            continue
        # what is published meanwhile waits for the next refresh
        rows = published_rows(spark, raw[source], before).where(F.col(BATCH) <= upto).drop(BATCH)
        done[name] = len(merge_changes(home, key, shape(rows), upto, choose, buckets))
        remove_old_buckets(spark, home, retain)
    return done


def changed_tables(spark: SparkSession, location: str) -> dict[str, DataFrame]:
    """The clean tables that ``refresh_changed`` keeps, and the regional ranking on them."""
    stored = {name: read_buckets(spark, f"{location}/{name}") for name in KEYED}
    found = {name: KEYED[name][4](rows) for name, rows in stored.items() if rows is not None}
    if "entity_clean" in found:
        found["regional_top"] = regional_top(found["entity_clean"])
    return found
