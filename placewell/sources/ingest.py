"""Load each new Parquet file into a raw table once, and skip files with errors whole.

A stream of file events drives the load; its checkpoint remembers the files seen. A
micro-batch is one batch job over the new files:

1. read them with the table's schema (names match in any case, absent columns are
   NULL, further ones are dropped) and write the rows to ``data/batch_id=N``;
2. compare rows written per file with the rows that the file's footer promises; a file
   that came short has a damaged block or a column of another type;
3. only if a file came short: write the batch again without it;
4. publish the batch by writing its load history to ``history/batch_id=N``.

Readers see published batches only. A batch that is run again after a failure
overwrites its own folders, so each row arrives once. The status of a file is
``loaded``, ``no_rows`` (empty), ``skipped`` (with errors) or ``missing`` (replaced or
removed before it was read); ``first_error`` says what is wrong with a skipped file. An
empty file is skipped if its footer has a column that no row could be read from.

Many small batches are rewritten as few large segments by ``compaction``; a segment
replaces all batches up to its number at the moment it is entered in ``segment_log``.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from placewell.functions.ordering import quoted
from placewell.sources.files import stream_files

SOURCE_FILE = "source_file"
VARIANT_DDL = "ingestion_time timestamp_ntz, raw_data variant, payload_year string"
# narrow to wide; Parquet files of the narrow types can be read as the wide ones
WIDENING = (
    [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()],
    [T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType()],
    [T.FloatType(), T.DoubleType()],
)
HISTORY_SCHEMA = (
    "file_name string, file_size bigint, modified_at timestamp, file_rows bigint, "
    "row_count bigint, status string, first_error string, last_load_time timestamp, batch_id bigint"
)
SEGMENT_LOG = "low int, high int, committed_at timestamp"
YEAR = "payload_year"
BATCH = "batch"


def ingest_table(spark: SparkSession, source: str, target: str, schema: T.StructType,
                 pattern: str = "*.parquet", max_files: int = 1000,
                 interval: str | None = None, archive: str | None = None) -> StreamingQuery:
    """Load all files not loaded before. The first run is the backfill of old files.

    Without an ``interval`` the call ends when the files at hand are loaded; with one, the
    query goes on looking for new files. The table's own schema is stored beside it: at the
    first load it is ``schema``, later ones may add columns and widen types (``wider``).
    Loaded files move to ``archive``, if one is named (``stream_files``).
    """
    schema = _pin(spark, target, schema)

    def read(paths: list[str]) -> DataFrame:
        return _reader(spark).schema(schema).parquet(*paths).select(
            *[F.col(quoted(n)) for n in schema.fieldNames()],
            F.col("_metadata.file_path").alias(SOURCE_FILE),
        )

    return _run(spark, source, target, pattern, max_files, interval, read, [], schema, archive)


def ingest_variant(spark: SparkSession, source: str, target: str, time_field: str,
                   pattern: str = "*.parquet", max_files: int = 1000,
                   interval: str | None = None, archive: str | None = None) -> StreamingQuery:
    """Load each record whole as one variant, whatever its columns, with its load time.

    The year of the record's own time is kept as a partition, so that a reader of one
    year opens that year's files only.
    """

    def read(paths: list[str]) -> DataFrame:
        return reduce(DataFrame.unionAll, [
            df.select(
                F.current_timestamp().cast("timestamp_ntz").alias("ingestion_time"),
                as_variant(df).alias("raw_data"),
                F.col("_metadata.file_path").alias(SOURCE_FILE),
            )
            for df in _by_schema(spark, paths)
        ]).withColumn(
            YEAR,
            F.substring(F.try_variant_get("raw_data", f"$.{time_field}", "string"), 1, 4),
        )

    _pin(spark, target, T.StructType.fromDDL(VARIANT_DDL))
    return _run(
        spark, source, target, pattern, max_files, interval, read, [YEAR], archive=archive)


def as_variant(df: DataFrame) -> Column:
    """All columns of a record as one variant object."""
    return F.to_variant_object(F.struct(*[F.col(quoted(c)) for c in df.columns]))


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """Rows of all published batches, with the table's stored schema."""
    rows = published_rows(spark, target)
    if rows is None:
        raise FileNotFoundError(f"nothing is loaded in {target}")
    return rows.drop(BATCH)


def published_rows(spark: SparkSession, target: str, after: int = -1) -> DataFrame | None:
    """Rows of the published batches after a number, with the number of each row's batch.

    None if nothing is published. Batches run one after the other, so only the newest can
    be unpublished: a bound on ``batch_id`` prunes it, as it prunes those that segments
    hold. The history is read first, then the log, then the folders: what they name is
    complete by then.
    """
    last = published_upto(spark, target)
    ends = segment_ends(spark, target)
    if last is None:
        return None
    high = ends[-1] if ends else -1
    pinned = stored_schema(spark, target)
    if pinned is None:  # a table loaded before schemas were stored has none, and no segments
        data = spark.read.parquet(f"{target}/data").where(
            (F.col("batch_id") <= last) & (F.col("batch_id") > after))
        return data.withColumn(BATCH, F.col("batch_id").cast("bigint")).drop("batch_id")
    # the partition column of variants comes last; names stand once
    names = [f for f in pinned.fields if f.name != YEAR] + [T.StructField(SOURCE_FILE, T.StringType())]
    parts = [f for f in pinned.fields if f.name == YEAR]
    # names are columns here, whatever signs they hold
    shown = [F.col(quoted(f.name)) for f in names + parts]
    found = _files(spark, f"{target}/data", [*names, T.StructField("batch_id", T.IntegerType()), *parts])
    rows = found.where((F.col("batch_id") <= last) & (F.col("batch_id") > max(high, after))).select(
        *shown, F.col("batch_id").cast("bigint").alias(BATCH))
    held = [e for e in ends if e > max(after, -1)]
    if held:
        whole = [*names, T.StructField(BATCH, T.LongType()), T.StructField("high", T.IntegerType()), *parts]
        segments = _files(spark, f"{target}/segments", whole).where(F.col("high").isin(held))
        if after >= 0:
            segments = segments.where(F.col(BATCH) > after)
        rows = segments.select(*shown, BATCH).unionByName(rows)
    return rows


def _files(spark: SparkSession, place: str, fields: list[T.StructField]) -> DataFrame:
    schema = T.StructType(fields)
    try:
        return spark.read.schema(schema).parquet(place)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # every file of every batch was missing
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def published_upto(spark: SparkSession, target: str) -> int | None:
    """Number of the newest published batch; batches in segments may have no other trace."""
    newest = _history(spark, f"{target}/history").agg(F.max("batch_id")).first()[0]
    found = [n for n in (newest, *segment_ends(spark, target)[-1:]) if n is not None and n >= 0]
    return max(found) if found else None


def segment_ends(spark: SparkSession, target: str) -> list[int]:
    """Last batch of each committed segment, in order; one of -1 holds nothing."""
    try:
        log = spark.read.schema(SEGMENT_LOG).parquet(f"{target}/segment_log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted({r.high for r in log.collect()})


def _history(spark: SparkSession, place: str, more: str = "") -> DataFrame:
    try:
        return spark.read.schema(HISTORY_SCHEMA + more).parquet(place)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], HISTORY_SCHEMA + more)


def load_history(spark: SparkSession, target: str, within: str | None = None) -> DataFrame:
    """Load history per file, newest first; ``within`` is an interval such as ``14 days``."""
    ends = segment_ends(spark, target)
    history = _history(spark, f"{target}/history")
    if ends:
        old = _history(spark, f"{target}/history_segments", ", high int")
        history = history.where(F.col("batch_id") > ends[-1]).unionByName(
            old.where(F.col("high").isin(ends)).drop("high"))
    if within:
        history = history.where(F.col("last_load_time") >= F.expr(f"current_timestamp() - interval {within}"))
    return history.orderBy(F.col("last_load_time").desc_nulls_first(), "file_name")


def stored_schema(spark: SparkSession, target: str) -> T.StructType | None:
    """The schema that all batches of a table are read with."""
    try:
        kept = spark.read.schema("version bigint, json string").parquet(f"{target}/schema")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = kept.agg(F.max_by("json", "version")).first()[0]
    return T.StructType.fromJson(json.loads(newest)) if newest else None


def _pin(spark: SparkSession, target: str, schema: T.StructType) -> T.StructType:
    """Store what ``schema`` adds to the table's schema, and return the whole."""
    old = stored_schema(spark, target)
    new = wider(old, schema) if old is not None else schema
    if new != old:
        version = time.time_ns()  # one load of a table runs at a time
        spark.createDataFrame([(version, new.json())], "version bigint, json string").coalesce(1).write.mode(
            "append").parquet(f"{target}/schema")
    return new


def wider(old: T.DataType, new: T.DataType) -> T.DataType:
    """Both types in one that Parquet files of either can be read with.

    Columns and members of structs are united by name in any case. Whole numbers widen to
    larger ones, and up to 32 bits to double; float widens to double. Of other types that
    differ the old one stays, and files that do not fit it are skipped.
    """
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        added = {f.name.lower(): f for f in new.fields}
        fields = [
            T.StructField(f.name, wider(f.dataType, added[f.name.lower()].dataType)
                          if f.name.lower() in added else f.dataType)
            for f in old.fields
        ]
        held = {f.name.lower() for f in old.fields}
        return T.StructType(fields + [f for f in new.fields if f.name.lower() not in held])
    for order in WIDENING:
        if old in order and new in order:
            return max(old, new, key=order.index)
    return old


def _reader(spark: SparkSession):
    return spark.read.option("ignoreCorruptFiles", "true")


def _run(spark: SparkSession, source: str, target: str, pattern: str, max_files: int,
         interval: str | None, read: Callable[[list[str]], DataFrame],
         partitions: list[str], schema: T.StructType | None = None,
         archive: str | None = None) -> StreamingQuery:
    def load(files: DataFrame, batch_id: int) -> None:
        _load_batch(spark, files, batch_id, target, read, partitions, schema)

    query = (
        stream_files(spark, source, pattern, max_files, archive=archive)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", os.path.join(target, "_checkpoint"))
        .trigger(**({"processingTime": interval} if interval else {"availableNow": True}))
        .start()
    )
    if not interval:
        query.awaitTermination()
    return query


def _load_batch(spark: SparkSession, files: DataFrame, batch_id: int, target: str,
                read: Callable[[list[str]], DataFrame], partitions: list[str],
                schema: T.StructType | None = None) -> None:
    # one row per file, at most maxFilesPerTrigger of them; so are the counts below
    events = files.collect()
    listed = {e.file_name: e.path for e in events}
    if not events or _is_published(spark, target, batch_id, set(listed)):
        return
    paths = _still_there(spark, listed)
    data = f"{target}/data/batch_id={batch_id}"

    def write(rows: DataFrame) -> dict[str, int]:
        rows.write.mode("overwrite").partitionBy(*partitions).parquet(data)
        written = spark.read.schema(f"{SOURCE_FILE} string").parquet(data)
        return _rows_per_file(written, F.col(SOURCE_FILE))

    # no column is selected, so the footers alone answer this
    promised = _rows_per_file(
        _reader(spark).schema("_none string").parquet(*paths.values()),
        F.col("_metadata.file_path")) if paths else {}
    # Files that would end the scan are left out: tasks of a failed write may go on for a
    # while, and would do so in the folder that the next attempt clears and writes.
    unfit = _clashing(spark, paths, schema)
    try:
        fit = [p for n, p in paths.items() if n not in unfit]
        landed = write(read(fit)) if fit else {}
    except (PySparkException, Py4JJavaError):
        with ThreadPoolExecutor(16) as pool:
            found = pool.map(lambda n: misfit(spark, paths[n], schema), paths)
        more = {n for n, reason in zip(paths, found, strict=True) if reason} - unfit
        if not more:
            raise
        unfit |= more
        rest = [p for n, p in paths.items() if n not in unfit]
        landed = write(read(rest)) if rest else {}
    status = {n: "loaded" for n in promised} | {n: "missing" for n in listed if n not in paths}
    # a read that failed once may have been a passing fault; ask again before rejecting
    for name in paths:
        if name not in promised:
            status[name] = _status_without_rows(spark, paths[name], schema)
        elif name in unfit or landed.get(name, 0) < promised[name] and not _reads_whole(
                read, paths[name], promised[name]):
            status[name] = "skipped"
    if landed != promised:
        # an empty file adds nothing, but one of nested values would end the scan
        kept = [p for n, p in paths.items() if status[n] == "loaded"]
        landed = write(read(kept) if kept else read(list(paths.values())).limit(0))
    if landed != {n: rows for n, rows in promised.items() if status[n] == "loaded"}:
        raise OSError(f"batch {batch_id}: files changed or became unreadable during the load")

    bad = [n for n in paths if status[n] == "skipped"]
    with ThreadPoolExecutor(16) as pool:
        reasons = dict(zip(bad, pool.map(lambda n: first_error(spark, paths[n], schema), bad)))
    spark.createDataFrame(
        [(e.file_name, e.length, e.modificationTime, promised.get(e.file_name, 0),
          landed.get(e.file_name, 0), status[e.file_name], reasons.get(e.file_name)) for e in events],
        "file_name string, file_size bigint, modified_at timestamp, file_rows bigint, "
        "row_count bigint, status string, first_error string",
    ).withColumn("last_load_time", F.current_timestamp()).coalesce(1).write.mode(
        "overwrite").parquet(f"{target}/history/batch_id={batch_id}")


def first_error(spark: SparkSession, path: str, schema: T.StructType | None) -> str:
    """Why a file cannot be loaded: its first column of another type, or of damaged blocks."""
    found = misfit(spark, path, schema)
    if found:
        return found
    for name in spark.read.parquet(path).columns:
        try:
            # the JSON length makes the scan read the whole column
            spark.read.parquet(path).agg(F.sum(F.length(F.to_json(F.struct(quoted(name)))))).collect()
        except (PySparkException, Py4JJavaError):
            return f"column {name}: damaged"
    return "unreadable with the table's schema"


def misfit(spark: SparkSession, path: str, schema: T.StructType | None) -> str | None:
    """What a file's footer says against the table's schema, if anything."""
    try:
        own = spark.read.parquet(path).schema
    except (PySparkException, Py4JJavaError):
        return "no readable footer"
    held = {f.name.lower(): f.dataType for f in own.fields}
    for wanted in schema.fields if schema else ():
        there = held.get(wanted.name.lower(), wanted.dataType)
        if wider(wanted.dataType, there) != wider(there, wanted.dataType):
            return f"column {wanted.name}: {there.simpleString()} instead of {wanted.dataType.simpleString()}"
    return None


def _clashing(spark: SparkSession, paths: dict[str, str], schema: T.StructType | None) -> set[str]:
    """Files that end a scan: a list or struct where the table has a plain value, or the reverse.

    Other misfits do not, nor do files without a readable footer. One job merges the
    footers of all files; only if they do not merge, or clash, is each looked at.
    """

    def clashing(some: list[str], **options: str) -> bool | None:
        try:
            return clash(schema, _reader(spark).options(**options).parquet(*some).schema)
        except (PySparkException, Py4JJavaError):
            return None

    if schema is None or not paths or clashing(list(paths.values()), mergeSchema="true") is False:
        return set()
    with ThreadPoolExecutor(16) as pool:
        found = pool.map(lambda p: clashing([p]), paths.values())
    return {n for n, bad in zip(paths, found, strict=True) if bad}


def shape(kind: T.DataType) -> type | None:
    """The sort of nested type; None for all plain ones."""
    return type(kind) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else None


def family(kind: T.DataType) -> type | None:
    """Parquet readers give no type as one of another family, but for the bytes of long decimals.

    None is the family of numbers and times, of which they give some as others.
    """
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType, T.BinaryType)):
        return T.StringType
    return type(kind) if isinstance(kind, (T.BooleanType, T.VariantType)) else shape(kind)


def clash(wanted: T.DataType, there: T.DataType,
          sort: Callable[[T.DataType], type | None] = shape) -> bool:
    """Whether some value is nested in one type and plain, or nested otherwise, in the other.

    With another ``sort``: whether some value is of different sorts in the two types.
    """
    if sort(wanted) is not sort(there):
        return True
    if isinstance(wanted, T.StructType):
        held = {f.name.lower(): f.dataType for f in there.fields}
        return any(clash(f.dataType, held[f.name.lower()], sort)
                   for f in wanted.fields if f.name.lower() in held)
    if isinstance(wanted, T.ArrayType):
        return clash(wanted.elementType, there.elementType, sort)
    if isinstance(wanted, T.MapType):
        return clash(wanted.keyType, there.keyType, sort) or clash(wanted.valueType, there.valueType, sort)
    return False


def _is_published(spark: SparkSession, target: str, batch_id: int, files: set[str]) -> bool:
    """True if a batch is run again although it had been published."""
    try:
        history = spark.read.schema("file_name string").parquet(f"{target}/history/batch_id={batch_id}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    if {r.file_name for r in history.collect()} != files:
        raise OSError(f"batch {batch_id} of {target} holds other files: its checkpoint is not its own")
    return True


def _still_there(spark: SparkSession, paths: dict[str, str]) -> dict[str, str]:
    """The listed files that still exist: a rerun of the landing replaces its files."""

    def exists(*some: str) -> bool:
        try:
            _reader(spark).schema("_none string").parquet(*some)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    if exists(*paths.values()):
        return paths
    with ThreadPoolExecutor(16) as pool:
        found = pool.map(exists, paths.values())
    return {n: p for (n, p), there in zip(paths.items(), found) if there}


def _status_without_rows(spark: SparkSession, path: str, schema: T.StructType | None) -> str:
    """An empty file, one of columns that hold other values, or one whose footer cannot be read."""
    try:
        found = spark.read.parquet(path)
        rows = found.count()
    except (PySparkException, Py4JJavaError):
        return "skipped"
    if rows:
        raise OSError(f"{path} was unreadable for a moment")
    return "skipped" if schema is not None and clash(schema, found.schema, family) else "no_rows"


def _rows_per_file(df: DataFrame, path: Column) -> dict[str, int]:
    counts = df.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("n"))
    return {r.path: r.n for r in counts.collect()}


def _reads_whole(read: Callable[[list[str]], DataFrame], path: str, expected: int) -> bool:
    # the JSON length makes the scan read every column
    rows = read([path])
    counted = rows.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.length(F.to_json(F.struct("*")))).alias("width"))
    return counted.first().n == expected


def _by_schema(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """The files as few DataFrames, each of one schema.

    Columns may come and go between files: merging handles that. Where the same column
    has types that do not merge (whole numbers in one file, fractions in the next), the
    files are grouped by their own schema, found from one footer each.
    """
    try:
        return [_reader(spark).option("mergeSchema", "true").parquet(*paths)]
    except (PySparkException, Py4JJavaError) as error:
        if "UNABLE_TO_INFER_SCHEMA" in str(error):
            # no file can be read, or none is there any more
            return [_reader(spark).schema("_none string").parquet(*paths)]
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise

    def footer(path: str) -> str | None:
        try:
            return _reader(spark).parquet(path).schema.json()
        except AnalysisException:
            return None

    with ThreadPoolExecutor(16) as pool:
        schemas = dict(zip(paths, pool.map(footer, paths)))
    groups: dict[str, list[str]] = {}
    for path, schema in schemas.items():
        if schema is not None:
            groups.setdefault(schema, []).append(path)
    return [
        _reader(spark).schema(T.StructType.fromJson(json.loads(s))).parquet(*group)
        for s, group in groups.items()
    ]
