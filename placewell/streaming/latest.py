"""Latest row per key over arriving files."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from placewell.functions.ordering import quoted
from placewell.operators.ranking import latest_per_key
from placewell.sources.ingest import BATCH, HISTORY_SCHEMA, published_rows, published_upto


def latest_state(stream: DataFrame, key: str, ts: str) -> DataFrame:
    """Latest row per key of a stream; rows without ``ts`` are left out.

    ``max`` over a struct that starts with the time. Each map task sends one row per key,
    and the state holds one row per key, however long the log grows.
    """
    rest = [c for c in stream.columns if c not in (key, ts)]
    newest = F.max(F.struct(*[F.col(quoted(c)) for c in (ts, *rest)])).alias("newest")
    return stream.where(F.col(quoted(ts)).isNotNull()).groupBy(key).agg(newest).select(
        *[F.col(quoted(c)) if c == key else F.col(f"newest.{quoted(c)}") for c in stream.columns]
    )


def run_latest_state(stream: DataFrame, key: str, ts: str, target: str,
                     interval: str | None = None) -> StreamingQuery:
    """Keep the changed keys of each trigger under ``target``.

    Only keys that changed are written. A trigger that is run again overwrites its own
    folder. Without an ``interval`` the query takes what is there and ends.
    """

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{target}/changes/batch_id={batch_id}")

    return _start(latest_state(stream, key, ts).writeStream.outputMode("update"), write, target, interval)


def follow_latest(spark: SparkSession, raw: str, target: str, key: str, ts: str,
                  fields: Callable[[DataFrame], DataFrame],
                  interval: str | None = None) -> StreamingQuery:
    """The same changes, driven by the batches that an ingest publishes in ``raw``.

    The stream is the load history: a new file in it says that a batch is complete and
    checked. Which batches are new is told by the number that the last trigger came to,
    so that it does not matter whether they lie in their own folders or in segments by
    now. The latest row per key of the new batches alone is added; no state is kept.
    """
    published = spark.readStream.schema(HISTORY_SCHEMA).option(
        "maxFilesPerTrigger", 1000).parquet(f"{raw}/history")

    def write(history: DataFrame, batch_id: int) -> None:
        done = _followed(spark, target, batch_id)
        upto = published_upto(spark, raw)
        if upto is not None and upto > done:
            rows = published_rows(spark, raw, done).where(F.col(BATCH) <= upto).drop(BATCH)
            latest_per_key(fields(rows), key, ts).write.mode("overwrite").parquet(
                f"{target}/changes/batch_id={batch_id}")
            spark.range(upto, upto + 1, 1, 1).write.mode("overwrite").parquet(
                f"{target}/followed/trigger={batch_id}")

    return _start(published.writeStream, write, target, interval)


def _followed(spark: SparkSession, target: str, trigger: int) -> int:
    """The batch that the triggers before this one came to."""
    try:
        log = spark.read.schema("id bigint, trigger int").parquet(f"{target}/followed")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    found = log.where(F.col("trigger") < trigger).agg(F.max("id")).first()[0]
    return -1 if found is None else found


def _start(writer: DataStreamWriter, write: Callable[[DataFrame, int], None], target: str,
           interval: str | None) -> StreamingQuery:
    return (
        writer.foreachBatch(write)
        .option("checkpointLocation", os.path.join(target, "_checkpoint"))
        .trigger(**({"processingTime": interval} if interval else {"availableNow": True}))
        .start()
    )


def read_latest_state(spark: SparkSession, target: str, key: str, ts: str) -> DataFrame:
    """Current row per key, from the last base and the changed keys since then."""
    changes = spark.read.parquet(f"{target}/changes")
    base = last_base(spark, target)
    if base is not None:
        changes = changes.where(F.col("batch_id") > base).unionByName(
            spark.read.parquet(f"{target}/base/batch_id={base}").withColumn("batch_id", F.lit(base)))
    return latest_per_key(changes.drop("batch_id"), key, ts)


def fold_changes(spark: SparkSession, target: str, key: str, ts: str) -> int:
    """Fold the changes so far into a new base, so that readers need not go through them.

    The base counts once its number is in ``base_log``, which is written last; a job cut
    off before that changes nothing. Call it now and then while no other fold runs.
    """
    try:
        changes = spark.read.parquet(f"{target}/changes").select("batch_id")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1  # nothing has been written yet
    # the newest batch may still be written
    upto = changes.agg(F.max("batch_id") - 1).first()[0]
    base = last_base(spark, target)
    if upto is None or upto < 0 or (base is not None and upto <= base):
        return base if base is not None else -1
    rows = spark.read.parquet(f"{target}/changes").where(F.col("batch_id") <= upto)
    if base is not None:
        rows = rows.where(F.col("batch_id") > base).drop("batch_id").unionByName(
            spark.read.parquet(f"{target}/base/batch_id={base}"))
    latest_per_key(rows.drop("batch_id"), key, ts).write.mode("overwrite").parquet(
        f"{target}/base/batch_id={upto}")
    spark.range(upto, upto + 1, 1, 1).write.mode("append").parquet(f"{target}/base_log")
    return upto


def last_base(spark: SparkSession, target: str) -> int | None:
    try:
        log = spark.read.schema("id bigint").parquet(f"{target}/base_log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return log.agg(F.max("id")).first()[0]
