"""The continuous form gives what the batch form gives, however the files arrive."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from placewell.operators.ranking import latest_per_key
from placewell.plans.readings import INSTANT, reading_fields, readings_latest, typed_columns
from placewell.sources import ingest
from placewell.streaming.latest import (
    fold_changes, follow_latest, last_base, read_latest_state, run_latest_state,
)

SCHEMA = "key string, ts timestamp_ntz, a bigint, b string"
START = datetime(2026, 1, 1)


def rows(n):
    # late rows, and ties on the time that only the other columns decide
    return [(f"k{i % 7}", START + timedelta(minutes=(i * 37) % 50), (i * 11) % 5 or None, f"b{i % 3}")
            for i in range(n)]


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stream_equals_batch_over_split_files(spark, folder):
    data = rows(200)
    for part, end in enumerate((60, 61, 150, 200)):
        begin = (0, 60, 61, 150)[part]
        spark.createDataFrame(data[begin:end], SCHEMA).write.parquet(f"{folder}/in/p{part}")
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
        run_latest_state(stream, "key", "ts", f"{folder}/out").awaitTermination()
        batch = latest_per_key(spark.createDataFrame(data[:end], SCHEMA), "key", "ts")
        state = read_latest_state(spark, f"{folder}/out", "key", "ts").select(batch.columns)
        assert collected(state) == collected(batch)


def test_only_changed_keys_are_written(spark, folder):
    for part, row in enumerate([("a", START, 1, "x"), ("b", START, 1, "x")]):
        spark.createDataFrame([row], SCHEMA).write.parquet(f"{folder}/in/p{part}")
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
        run_latest_state(stream, "key", "ts", f"{folder}/out").awaitTermination()
    changes = spark.read.parquet(f"{folder}/out/changes").groupBy("batch_id").count()
    assert [r["count"] for r in changes.orderBy("batch_id").collect()] == [1, 1]


def reading(key, minute, speed):
    when = (START + timedelta(minutes=minute)).isoformat()
    return json.dumps({"BUSINESS_ID": key, "timestamp": when, "currentSpeed": speed, "freeFlowSpeed": 50})


def test_following_an_ingest_gives_the_latest_readings(spark, folder):
    for part, records in enumerate([
        [reading("p1", 0, 10), reading("p2", 5, 20)],
        [reading("p1", 20, 30), reading("p2", 1, 40)],
        [reading("p3", 2, 50)],
    ]):
        frame = spark.createDataFrame([(r,) for r in records], "text string").select(F.from_json(
            "text", "BUSINESS_ID STRING, timestamp STRING, currentSpeed BIGINT, freeFlowSpeed BIGINT"
        ).alias("r")).select("r.*")
        frame.write.parquet(f"{folder}/in/p{part}")
        ingest.ingest_variant(spark, f"{folder}/in", f"{folder}/raw", "timestamp")
        for _ in range(2):
            follow_latest(spark, f"{folder}/raw", f"{folder}/out", "business_id", INSTANT,
                          reading_fields).awaitTermination()
        followed = typed_columns(read_latest_state(spark, f"{folder}/out", "business_id", INSTANT))
        batch = readings_latest(ingest.read_table(spark, f"{folder}/raw"))
        assert collected(followed.select(batch.columns)) == collected(batch)
    assert {(r.business_id, r.current_speed) for r in batch.collect()} == {
        ("p1", 30), ("p2", 20), ("p3", 50)}


def test_latest_over_a_stream_of_variants(spark, folder):
    raw = spark.createDataFrame([(reading("p1", m, m),) for m in (3, 9, 6)], "text string")
    raw.select(F.parse_json("text").alias("raw_data")).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("raw_data variant").parquet(f"{folder}/in")
    run_latest_state(reading_fields(stream), "business_id", INSTANT, f"{folder}/out").awaitTermination()
    state = typed_columns(read_latest_state(spark, f"{folder}/out", "business_id", INSTANT))
    assert [r.current_speed for r in state.collect()] == [9]


def test_folding_keeps_the_state_and_skips_old_changes(spark, folder):
    data = rows(120)
    bases = []
    for part in range(4):
        chunk = data[part * 30:(part + 1) * 30]
        spark.createDataFrame(chunk, SCHEMA).write.parquet(f"{folder}/in/p{part}")
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
        run_latest_state(stream, "key", "ts", f"{folder}/out").awaitTermination()
        if part != 1:
            bases.append(fold_changes(spark, f"{folder}/out", "key", "ts"))
            assert fold_changes(spark, f"{folder}/out", "key", "ts") == bases[-1]
        batch = latest_per_key(spark.createDataFrame(data[:(part + 1) * 30], SCHEMA), "key", "ts")
        state = read_latest_state(spark, f"{folder}/out", "key", "ts").select(batch.columns)
        assert collected(state) == collected(batch)
    assert bases == [-1, 1, 2] and last_base(spark, f"{folder}/out") == 2
    plan = read_latest_state(spark, f"{folder}/out", "key", "ts")._jdf.queryExecution().toString()
    assert "(batch_id#" in plan and "> 2)" in plan
