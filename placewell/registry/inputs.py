"""Bindings of the given tables to the shapes that the transforms expect.

Where an expression reads the same in Spark SQL and in the checking SQL it is stated
once, here, and used by both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewell.session import scratch_dir

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels, which are missing for most."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


# part -> place: several parts share a brand and a name, which makes the duplicates
PLACE_COLUMNS = {
    "business_id": "CASE WHEN p_size > 1 THEN concat(p_brand, '-', p_name) END",
    "name": "p_type",
    "address": "CAST(p_partkey AS STRING)",
    "city": "CASE WHEN p_size <= 25 THEN 'Philadelphia' WHEN p_size <= 35 "
            "THEN 'North PHILADELPHIA' ELSE 'Pittsburgh' END",
    "state": "CASE WHEN p_type = 'SMALL' THEN 'NJ' ELSE 'PA' END",
    "postal_code": "CAST(p_size AS STRING)",
    "latitude": "CAST(p_size AS DOUBLE)",
    "longitude": "CAST(-p_size AS DOUBLE)",
    "stars": "CASE WHEN p_size < 49 THEN CAST(p_size AS DOUBLE) / 10 END",
    "review_count": "CAST(p_size AS BIGINT) * 3",
    "is_open": "CAST(1 AS BIGINT)",
    "categories": "CASE WHEN p_name LIKE '%ring' THEN 'Barbers, Hair Salons' "
                  "WHEN p_name LIKE '%bolt' THEN 'AUTO Repair' "
                  "WHEN p_name LIKE '%plate' THEN 'Nail Studios, Spas' "
                  "WHEN p_name LIKE '%rod' THEN 'Plumbing, Contractors' "
                  "WHEN p_name LIKE '%gear' THEN 'Gyms' "
                  "WHEN p_name LIKE '%gizmo' THEN 'Department stores' "
                  "WHEN p_name LIKE '%widget' THEN 'Dentists, Medical Centers' END",
}


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [f"{e} AS {c}" for c, e in PLACE_COLUMNS.items()]
    return table(spark, sf_dir, "part").selectExpr(
        *columns, "named_struct('brand', p_brand) AS attributes",
        "CAST(NULL AS STRUCT<Monday: STRING>) AS hours",
    )


# lineitem -> review: the table repeats a quarter of its (order, line) pairs
REVIEW_COLUMNS = {
    "review_id": "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))",
    "user_id": "CAST(l_suppkey AS STRING)",
    "business_id": "CAST(nullif(l_partkey, 0) AS STRING)",
    "stars": "l_quantity",
    "useful": "CAST(l_linenumber AS BIGINT)",
    "funny": "CAST(l_suppkey AS BIGINT)",
    "cool": "CAST(l_partkey AS BIGINT)",
    "text": "concat(l_returnflag, ' ', l_linestatus)",
    "date_ts": "CASE WHEN l_linestatus = 'O' THEN l_shipdate END",
}


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [f"{e} AS {c}" for c, e in REVIEW_COLUMNS.items()]
    return table(spark, sf_dir, "lineitem").selectExpr(
        *columns, "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') AS date"
    )


def checkins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of hours: repeats, a blank entry, a trailing comma, a blank list, a NULL one."""
    hour = "date_format(ts{}, 'yyyy-MM-dd HH:00:00')"
    now, later = hour.format(""), hour.format(" + INTERVAL 1 HOUR")
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS business_id",
        f"""CASE event_type
            WHEN 'view' THEN concat({now}, ', ', {later}, ', ', {now})
            WHEN 'click' THEN concat(' ', {now}, ', ,', {later}, ', ')
            WHEN 'signup' THEN concat({now}, ',')
            WHEN 'error' THEN '  ' END AS date""",
    )


# events -> reading payload; the typed columns follow from these
PAYLOAD_COLUMNS = {
    "BUSINESS_ID": "CASE WHEN event_type <> 'error' THEN CAST(user_id AS STRING) END",
    "city": "'Philadelphia'",
    "frc": "event_type",
    "confidence": "value / 1000",
    "roadClosure": "value > 500",
    "currentSpeed": "value",
    "currentTravelTime": "event_id",
}


def reading_records(spark: SparkSession, sf_dir: str, of_places: bool = False) -> DataFrame:
    """One reading per event, of its user, or of the place with the event's number."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    events = table(spark, sf_dir, "events")
    columns = dict(PAYLOAD_COLUMNS)
    if of_places:
        events = events.join(table(spark, sf_dir, "part"), F.col("event_id") == F.col("p_partkey"), "left")
        columns["BUSINESS_ID"] = PLACE_COLUMNS["business_id"]
    return events.select(
        *[F.expr(e).alias(c) for c, e in columns.items()],
        k.alias("freeFlowSpeed"),
        F.when(F.col("event_type") == "click", F.col("value").cast("string"))
        .otherwise(F.concat_ws(",", "value", "event_id")).alias("coord"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )


def readings(spark: SparkSession, sf_dir: str, of_places: bool = False) -> DataFrame:
    """A stored raw table with one variant per event."""
    raw = scratch_dir(spark, "readings")
    reading_records(spark, sf_dir, of_places).select(
        F.to_variant_object(F.struct("*")).alias("raw_data")).write.parquet(raw)
    return spark.read.parquet(raw)
