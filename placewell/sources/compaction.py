"""Few large files in place of the many small ones that frequent loads leave behind.

A closed range of published batches is written again as one segment. The entry in
``segment_log`` switches all readers over at once: rows of batches up to the newest
segment's number come from segments, later ones from the batches' own folders. What was
open before the switch goes on reading the old folders, which ``vacuum`` deletes later.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewell.sources.ingest import (
    BATCH, HISTORY_SCHEMA, SEGMENT_LOG, SOURCE_FILE, YEAR, load_history, published_rows, segment_ends,
    stored_schema,
)
from placewell.sources.tables import delete_folder, list_folders, qualified

RETAIN = timedelta(days=1)


def compact(spark: SparkSession, target: str, leave: int = 1, least: int = 2,
            sort_by: Sequence[str] = ()) -> int | None:
    """Write the batches since the last segment as one, and return the number of its last batch.

    The newest ``leave`` batches stay as they are; with fewer than ``least`` others nothing
    is done and None returned. ``sort_by`` orders the rows within files, so that filters on
    these columns skip row groups. One compaction of a table runs at a time, beside loads
    and readers; a job that stops early leaves a folder that nobody reads.
    """
    if leave < 1:
        raise ValueError("the newest batch may still be unknown to the load's checkpoint")
    schema = stored_schema(spark, target)
    if schema is None:
        raise ValueError(f"{target} has no stored schema yet: load into it once more")
    high = max(segment_ends(spark, target), default=-1)
    batches = sorted(r.batch_id for r in load_history(spark, target).where(
        F.col("batch_id") > high).select("batch_id").distinct().collect())
    closed = batches[:-leave]
    if len(closed) < least:
        return None
    upto = closed[-1]
    rows = published_rows(spark, target, high).where(F.col(BATCH) <= upto)
    parts = [YEAR] if YEAR in rows.columns else []
    rows = rows.hint("rebalance", *parts)
    if sort_by:
        rows = rows.sortWithinPartitions(*parts, *sort_by)
    rows.write.mode("overwrite").partitionBy(*parts).parquet(f"{target}/segments/high={upto}")
    load_history(spark, target).where((F.col("batch_id") > high) & (F.col("batch_id") <= upto)).coalesce(
        1).write.mode("overwrite").parquet(f"{target}/history_segments/high={upto}")
    _commit(spark, target, high + 1, upto)
    return upto


def _commit(spark: SparkSession, target: str, low: int, high: int) -> None:
    spark.createDataFrame([(low, high, _now())], SEGMENT_LOG).coalesce(1).write.mode("append").parquet(
        f"{target}/segment_log")


def _now() -> datetime:
    return datetime.now(timezone.utc)


def vacuum(spark: SparkSession, target: str, retain: timedelta = RETAIN) -> int:
    """Delete what segments replaced ``retain`` ago or earlier; returns the number of folders.

    One folder of rows stays in any case: views look into it for the columns.
    """
    log = spark.read.schema(SEGMENT_LOG).parquet(f"{target}/segment_log").collect() if segment_ends(
        spark, target) else []
    limit = (_now() - retain).timestamp()
    high = max((r.high for r in log if r.committed_at.timestamp() <= limit), default=-1)
    committed = {r.high for r in log}
    gone = 0
    for part, key in (("data", "batch_id="), ("history", "batch_id="), ("segments", "high="),
                      ("history_segments", "high=")):
        found = sorted((int(n.removeprefix(key)), n) for n in list_folders(spark, f"{target}/{part}") if n.startswith(key))
        if part == "data":
            found = found[:-1]
        for number, name in found:
            # a segment that is not in the log was cut off before its commit
            if number <= high and (key == "batch_id=" or number not in committed):
                delete_folder(spark, f"{target}/{part}/{name}")
                gone += 1
    return gone


def prepare_views(spark: SparkSession, target: str) -> None:
    """Give a table of variants an empty first segment, so that views can name the folder."""
    if segment_ends(spark, target):
        return
    schema = stored_schema(spark, target)
    fields = [f for f in schema.fields if f.name != YEAR]
    empty = spark.range(0).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields],
        F.lit(None).cast("string").alias(SOURCE_FILE), F.lit(None).cast("bigint").alias(BATCH))
    empty.coalesce(1).write.mode("overwrite").parquet(
        f"{target}/segments/high=-1/{YEAR}=__HIVE_DEFAULT_PARTITION__")
    spark.createDataFrame([], HISTORY_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{target}/history_segments/high=-1")
    _commit(spark, target, 0, -1)


def variants_text(spark: SparkSession, target: str) -> str:
    """SQL for the published rows of a table of variants at the time of the query.

    The log is named once, so that both parts see the same state of it, and before the
    rows, so that what it names is complete.
    """
    prepare_views(spark, target)
    home = qualified(spark, target)
    columns = f"raw_data, CAST({YEAR} AS STRING) AS {YEAR}"
    return f"""
        WITH published AS (SELECT max(batch_id) AS last FROM parquet.`{home}/history`),
        log AS (SELECT high FROM parquet.`{home}/segment_log`)
        SELECT {columns} FROM parquet.`{home}/segments` WHERE high IN (SELECT high FROM log)
        UNION ALL
        SELECT {columns} FROM parquet.`{home}/data`
        WHERE batch_id > (SELECT max(high) FROM log) AND batch_id <= (SELECT last FROM published)"""
