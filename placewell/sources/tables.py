"""Replace a table with a query result, without a moment in which it is missing.

A table is a folder. Each refresh writes ``data/version=V`` and then commits it by
writing ``log/version=V``; readers take the newest committed version, in this session or
in any later one. A job that stops before the commit leaves the old version in place.
Views look the newest version up when they are queried. A version is deleted once it has
been out of date for a while, so whoever still reads it can finish.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from placewell.functions.ordering import quoted

VERSION = "v%Y%m%d%H%M%S%f"  # the letter keeps the number a text when Spark infers partition values
RETAIN = timedelta(days=1)


def replace_table(df: DataFrame, location: str, name: str, retain: timedelta = RETAIN) -> DataFrame:
    """Write ``df`` as the new version of the table and return the stored rows.

    One refresh of a table runs at a time. Versions that were replaced ``retain`` ago or
    earlier are deleted, and so are those of jobs that stopped before their commit.
    """
    spark = df.sparkSession
    version = _now().strftime(VERSION)
    home = f"{location}/{name}"
    df.write.parquet(f"{home}/data/version={version}")
    spark.range(0, 1, 1, 1).write.parquet(f"{home}/log/version={version}")
    remove_old_versions(spark, location, name, retain)
    return stored_table(spark, location, name)


def remove_old_versions(spark: SparkSession, location: str, name: str, retain: timedelta = RETAIN) -> None:
    """Delete what no reader of the last ``retain`` can have opened.

    That is each version before the last one that had been committed by then; versions
    that were never committed go with them, but not those that may still be written.
    """
    home = f"{location}/{name}"
    limit = (_now() - retain).strftime(VERSION)
    committed = _committed(spark, home)
    then = [v for v in committed if v <= limit]
    for part in ("log", "data"):
        for folder in list_folders(spark, f"{home}/{part}"):
            if then and folder.removeprefix("version=") < then[-1]:
                delete_folder(spark, f"{home}/{part}/{folder}")


def _now() -> datetime:
    return datetime.now(timezone.utc)


def stored_table(spark: SparkSession, location: str, name: str) -> DataFrame:
    """The newest committed version."""
    return spark.read.parquet(_newest(spark, location, name))


def open_tables(spark: SparkSession, location: str, database: str | None = None) -> list[str]:
    """Views of all committed tables of a location, in this session or in a database.

    A view is stored as text and takes the version that is newest when it is queried. Open
    the tables again when a refresh has changed their columns.
    """
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = [n for n in list_folders(spark, location) if _committed(spark, f"{location}/{n}")]
    for name in names:
        columns = [quoted(c) for c in stored_table(spark, location, name).columns]
        home = qualified(spark, f"{location}/{name}")
        # Versions of other columns may lie beside the newest; Spark looks at one file, if not told otherwise.
        plain = set(map(quoted, spark.read.parquet(f"{home}/data").columns)) >= set(columns)
        merge = "" if plain else "WITH (mergeSchema = true)"
        create_view(spark, f"{database}.{name}" if database else name, f"""
            WITH newest AS (SELECT max(version) AS version FROM parquet.`{home}/log`)
            SELECT {", ".join(columns)} FROM parquet.`{home}/data` {merge}
            WHERE version = (SELECT version FROM newest)""", database is None)
    return names


def create_view(spark: SparkSession, name: str, text: str, temporary: bool) -> None:
    """A view that is worked out, and whose files are listed, anew in each query."""
    spark.sql(f"CREATE OR REPLACE {'TEMPORARY ' if temporary else ''}VIEW {name} AS {text}")


def qualified(spark: SparkSession, place: str) -> str:
    """The folder's full name, which does not depend on the session's working folder."""
    path = _path(spark, place)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _newest(spark: SparkSession, location: str, name: str) -> str:
    versions = _committed(spark, f"{location}/{name}")
    if not versions:
        raise FileNotFoundError(f"no version of {name} is committed in {location}")
    return qualified(spark, f"{location}/{name}/data/version={versions[-1]}")


def _committed(spark: SparkSession, home: str) -> list[str]:
    """Versions whose log entry is complete, oldest first: those of the last ``retain`` or so."""
    try:
        log = spark.read.schema("id bigint, version string").parquet(f"{home}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(r.version for r in log.select("version").distinct().collect())


# Spark lists and deletes no folders by itself; its Hadoop file systems do, on any store.

def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def list_folders(spark: SparkSession, place: str) -> list[str]:
    """Names of the folders in a place; none if there is no such place."""
    path = _path(spark, place)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()) if files.exists(path) else []


def delete_folder(spark: SparkSession, place: str) -> None:
    path = _path(spark, place)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
