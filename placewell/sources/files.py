"""Listings of stored files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_COLUMNS = ("path", "length", "modificationTime")


def list_files(spark: SparkSession, location: str, pattern: str | None = None) -> DataFrame:
    """Path, length and time of all files under ``location``; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(location).select(*FILE_COLUMNS)


def stream_files(spark: SparkSession, location: str, pattern: str | None = None,
                 max_files: int = 1000, max_age: str = "36500d", archive: str | None = None) -> DataFrame:
    """A stream with one row per new file: the file events that drive the ingest.

    Spark's default forgets files more than a week older than the newest one seen, which
    would drop a late copy that kept its date. ``max_age`` therefore defaults to
    everything. Each trigger lists the folder: ``archive`` names a folder outside of it that
    files move to once their batch is done, so that a listing has the files still to be
    loaded, however many there were before.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", max_age)
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    # the name as other scans report it, which differs from the path where that has spaces
    return reader.load(location).select(
        *FILE_COLUMNS, F.col("_metadata.file_path").alias("file_name"))
