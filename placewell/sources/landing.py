"""JSON lines in, Parquet out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placewell.functions.scalars import flatten_struct, parse_timestamp
from placewell.sources.datasets import DATASETS


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                    timestamps: Mapping[str, str] | None = None,
                    sampling_ratio: float | None = None, rescue: str | None = None) -> DataFrame:
    """Scan JSON lines with a declared or an inferred schema.

    Inference reads the input once more; ``sampling_ratio`` below 1 shortens that pass.
    Fields that are only outside the sample get no column then; ``rescue`` names a column
    that keeps them (see ``other_fields``). With a declared schema a value of the wrong
    type becomes NULL and a bad line a row of NULLs.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif sampling_ratio is not None:
        reader = reader.option("samplingRatio", sampling_ratio)
    if rescue:
        known = schema if isinstance(schema, T.StructType) else (
            T.StructType.fromDDL(schema) if schema else reader.json(path).schema)
        lines = spark.read.text(path).where(F.trim("value") != "")
        df = lines.select(F.from_json("value", known).alias("known"),
                          other_fields(F.col("value"), known).alias("rest")).select(
            "known.*", F.col("rest").alias(rescue))
    else:
        df = reader.json(path)
    for text, name in (timestamps or {}).items():
        df = df.withColumn(name, parse_timestamp(F.col(text)))
    return df


def other_fields(text: Column, known: T.StructType) -> Column:
    """A variant object of the fields that ``known`` does not have; NULL if there are none.

    Fields inside known structs count, under dotted names. A value that is null counts as
    a field.
    """
    kind = "map<string,variant>"
    nothing = F.from_json(F.lit("{}"), kind)

    def unknown(part: Column, struct: T.StructType, path: str) -> list[Column]:
        names = F.array(*[F.lit(n) for n in struct.names]).cast("array<string>")
        found = F.map_filter(F.from_json(part, kind), lambda k, _: ~F.array_contains(names, k))
        out = [F.coalesce(F.transform_keys(found, lambda k, _: F.concat(F.lit(path), k)), nothing)]
        for field in struct.fields:
            if isinstance(field.dataType, T.StructType) and "'" not in field.name:
                inner = F.get_json_object(part, f"$['{field.name}']")
                out += unknown(inner, field.dataType, f"{path}{field.name}.")
        return out

    found = F.map_concat(*unknown(text, known, ""))
    return F.when(F.size(found) > 0, F.to_variant_object(found))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet sink; a rerun replaces the previous output."""
    df.write.mode(mode).parquet(path)


def land_dataset(spark: SparkSession, name: str, source: str, target: str,
                 sampling_ratio: float | None = None) -> None:
    """Land one of the known datasets as Parquet."""
    dataset = DATASETS[name]
    df = read_json_lines(spark, source, dataset.json_schema, dataset.timestamps, sampling_ratio)
    df = df.withColumns({
        c: F.col(c).cast(t) for c, t in dataset.types.items() if c in df.columns})
    write_parquet(df, target)


# Field names of a landed reading.
PAYLOAD_FIELD = "flowSegmentData"
KEY_FIELD = "BUSINESS_ID"
TIME_FIELD = "timestamp"


def shape_readings(polls: DataFrame, city: str, payload: str = PAYLOAD_FIELD) -> DataFrame:
    """Flat reading rows from polled responses.

    ``polls`` has ``coord``, ``business_id``, ``polled_at`` (UTC wall clock) and the parsed
    ``response``. A response without the payload object still gives a row: its metrics
    are NULL and its key, place and time are set.
    """
    response = polls.schema["response"].dataType
    found = isinstance(response, T.StructType) and payload in response.fieldNames()
    nested = (
        found and isinstance(response[payload].dataType, T.StructType)
    )
    metrics = [F.col(f"response.{payload}.*")] if nested else []
    rows = polls.select(
        *metrics,
        F.col("coord"),
        F.lit(city).alias("city"),
        F.col("business_id").alias(KEY_FIELD),
        F.date_format("polled_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(TIME_FIELD),
        "polled_at",
    )
    return flatten_struct(rows)


def land_readings(polls: DataFrame, target: str, city: str, payload: str = PAYLOAD_FIELD) -> None:
    """Append readings to Parquet folders ``year=/month=/day=`` (not zero-padded).

    The rebalance hint spreads a day that holds most rows over several writers and
    merges the rows of small days, so neither huge tasks nor tiny files arise.
    """
    days = ["year", "month", "day"]
    rows = shape_readings(polls, city, payload)
    (
        rows.withColumns({
            "year": F.year("polled_at"),
            "month": F.month("polled_at"),
            "day": F.dayofmonth("polled_at"),
        })
        .drop("polled_at")
        .hint("rebalance", *days)
        .write.mode("append").partitionBy(*days).parquet(target)
    )
