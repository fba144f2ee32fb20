"""Tables in buckets of their key, of which a refresh rewrites only those with changed keys.

Rows lie in ``data/version=V/bucket=B``. A commit is a folder ``log/version=V`` with one
row per bucket: the version that holds it, and the raw batch that the table has come to.
Readers open the folders that the newest commit names; a refresh that stops early leaves
folders that no commit names.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placewell.functions.ordering import quoted
from placewell.sources.tables import RETAIN, VERSION, _now, delete_folder, list_folders

BUCKETS = 64
BUCKET = "bucket"
LOG = "bucket int, held_in string, buckets int, upto bigint, version string"


def last_commit(spark: SparkSession, home: str) -> tuple[dict[int, str], int, int]:
    """Version of each bucket, number of buckets, and the raw batch of the newest commit."""
    rows = _commits(spark, home)
    newest = max((r.version for r in rows), default=None)
    mine = [r for r in rows if r.version == newest]
    held = {r.bucket: r.held_in for r in mine if r.held_in is not None}
    return held, mine[0].buckets if mine else BUCKETS, mine[0].upto if mine else -1


def _commits(spark: SparkSession, home: str) -> list:
    # one row per bucket and commit; commits go after a while
    try:
        return spark.read.schema(LOG).parquet(f"{home}/log").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def read_buckets(spark: SparkSession, home: str, wanted: set[int] | None = None,
                 schema: T.StructType | None = None) -> DataFrame | None:
    """Rows of the newest commit, of the wanted buckets only; None if it has none of them.

    The ``schema`` is that of the bucket written last, if none is given: columns may be
    added and types widened from one refresh to the next.
    """
    held, _, _ = last_commit(spark, home)
    places = {b: f"{home}/data/version={v}/{BUCKET}={b}" for b, v in sorted(held.items())}
    if schema is None and places:
        schema = spark.read.parquet(places[max(held, key=held.get)]).schema
    chosen = [place for b, place in places.items() if wanted is None or b in wanted]
    return spark.read.schema(schema).parquet(*chosen) if chosen else None


def merge_changes(home: str, key: str, new: DataFrame, upto: int,
                  merge: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> set[int]:
    """Merge new rows into the table and return the buckets that were rewritten.

    ``merge`` makes the table's rows of stored and new ones of the same keys; merging in
    parts must give what merging all at once does. ``buckets`` counts at the first commit.
    One refresh of a table runs at a time.
    """
    spark = new.sparkSession
    held, number, _ = last_commit(spark, home)
    number = number if held else buckets
    place = F.pmod(F.xxhash64(quoted(key)), F.lit(number)).cast("int")
    # at most as many rows as buckets
    changed = {r[0] for r in new.select(place).distinct().collect()}
    if changed:
        old = read_buckets(spark, home, changed, new.schema)
        rows = merge(old.unionByName(new) if old is not None else new)
        version = _now().strftime(VERSION)
        # a bucket is written by as many tasks as its size asks for, so that none has to spill
        rows.withColumn(BUCKET, place).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(
            f"{home}/data/version={version}")
        # a bucket may be left without rows
        written = {int(n.removeprefix(f"{BUCKET}=")) for n in list_folders(spark, f"{home}/data/version={version}")
                   if n.startswith(f"{BUCKET}=")}
        held = {b: v for b, v in held.items() if b not in changed} | {b: version for b in written}
    else:
        version = _now().strftime(VERSION)
    entries = [(b, v, number, upto) for b, v in sorted(held.items())] or [(-1, None, number, upto)]
    spark.createDataFrame(entries, "bucket int, held_in string, buckets int, upto bigint").coalesce(1).write.parquet(
        f"{home}/log/version={version}")
    return changed


def remove_old_buckets(spark: SparkSession, home: str, retain: timedelta = RETAIN) -> None:
    """Delete what no commit names that was the newest one at some time within ``retain``."""
    limit = (_now() - retain).strftime(VERSION)
    rows = _commits(spark, home)
    current = max((r.version for r in rows if r.version <= limit), default="")
    used = {(r.held_in, r.bucket) for r in rows if r.version >= current}
    for folder in list_folders(spark, f"{home}/data"):
        version = folder.removeprefix("version=")
        if version >= (current or limit):
            continue
        parts = list_folders(spark, f"{home}/data/{folder}")
        kept = [p for p in parts if (version, int(p.removeprefix(f"{BUCKET}="))) in used]
        for part in parts if kept else ():
            if part not in kept:
                delete_folder(spark, f"{home}/data/{folder}/{part}")
        if not kept:
            delete_folder(spark, f"{home}/data/{folder}")
    for folder in list_folders(spark, f"{home}/log"):
        if folder.removeprefix("version=") < current:
            delete_folder(spark, f"{home}/log/{folder}")
