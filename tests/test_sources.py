"""Landing, ingest, listings and stored tables."""

import json
import os
import re
import tempfile
from datetime import datetime, timedelta, timezone
from types import SimpleNamespace

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from placewell.plans.readings import open_views, readings_latest, readings_typed
from placewell.session import scratch_dir
from placewell.sources import compaction, files, ingest, landing, tables
from placewell.sources.datasets import DATASETS
from placewell.sources.tables import open_tables, replace_table, stored_table

SCHEMA = "id bigint, name string"


def lines(folder, name, *records):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records)
    return f"{folder}/{name}"


def drop(spark, path, rows, schema=SCHEMA, files_=1):
    df = spark.createDataFrame(rows, schema)
    df = df.coalesce(1) if files_ == 1 else df.repartition(files_)
    df.write.mode("append").parquet(path)


def schema_of(spark, ddl=SCHEMA):
    return spark.createDataFrame([], ddl).schema


def load(spark, folder, ddl=SCHEMA, **options):
    ingest.ingest_table(spark, f"{folder}/in", f"{folder}/raw", schema_of(spark, ddl), **options)
    return sorted(tuple(r)[:-1] for r in ingest.read_table(spark, f"{folder}/raw").collect())


def statuses(spark, folder):
    return sorted((r.status, r.file_rows, r.row_count)
                  for r in ingest.load_history(spark, f"{folder}/raw").collect())


# --- landing ---------------------------------------------------------------


@pytest.mark.parametrize("name", DATASETS)
def test_land_each_dataset(spark, folder, name):
    record = {"business_id": "b", "review_id": "r", "user_id": "u", "stars": 4.5, "useful": 1,
              "text": "t", "date": "2020-01-02 03:04:05", "name": "n", "hours": {"Monday": "9-5"},
              "compliment_count": 2}
    source = lines(folder, "in.json", record)
    for _ in range(2):
        landing.land_dataset(spark, name, source, f"{folder}/out")
    landed = spark.read.parquet(f"{folder}/out")
    assert landed.count() == 1
    if DATASETS[name].ddl:
        assert landed.schema == DATASETS[name].table_schema
    else:
        assert landed.first().hours.Monday == "9-5"
    if "date_ts" in landed.columns:
        assert str(landed.first().date_ts) == "2020-01-02 03:04:05"


def test_declared_schema_is_permissive(spark, folder):
    source = lines(folder, "in.json", {"id": "x", "name": "wrong type"}, "{broken", {"id": 3})
    df = landing.read_json_lines(spark, source, SCHEMA)
    assert sorted((tuple(r) for r in df.collect()), key=repr) == [
        (3, None), (None, "wrong type"), (None, None)]


def test_inferred_schema_widens_numbers(spark, folder):
    source = lines(folder, "in.json", {"x": 1, "n": {"a": 1}}, {"x": 2.5, "n": {"a": 2}})
    df = landing.read_json_lines(spark, source)
    assert dict(df.dtypes) == {"x": "double", "n": "struct<a:bigint>"}


def polls(spark, folder, *responses):
    source = lines(folder, "polls.json", *[
        {"coord": f"{i},0", "business_id": f"p{i}", "polled_at": "2026-03-06 21:05:30", "response": r}
        for i, r in enumerate(responses)])
    return landing.read_json_lines(spark, source, timestamps={"polled_at": "polled_at"})


def test_fields_outside_the_sample_are_kept_beside_the_columns(spark, folder):
    rare = {"id": 7, "s": {"a": 1, "new": {"x": [1, None]}}, "odd 'name'": None, "more": "y"}
    source = lines(folder, "in.json", *([{"id": n, "s": {"a": n}} for n in range(10_000)]), rare, "{bad", "", {"id": "text"})
    df = landing.read_json_lines(spark, source, sampling_ratio=0.01, rescue="rest")
    assert df.drop("_corrupt_record").dtypes == [("id", "bigint"), ("s", "struct<a:bigint>"), ("rest", "variant")]
    found = df.where("rest IS NOT NULL").select("id", "s.a", F.to_json("rest").alias("rest")).collect()
    assert [(r.id, r.a, json.loads(r.rest)) for r in found] == [
        (7, 1, {"s.new": {"x": [1, None]}, "odd 'name'": None, "more": "y"})]
    assert df.count() == 10_003
    same = landing.read_json_lines(spark, source, "id BIGINT, s STRUCT<a: BIGINT>")
    assert df.select("id", "s").exceptAll(same).isEmpty() and same.count() == 10_003


def test_land_readings_flattens_and_keeps_failed_polls(spark, folder):
    frame = polls(
        spark, folder,
        {"flowSegmentData": {"currentSpeed": 30, "coordinates": {"coordinate": [{"lat": 1.0}]}}},
        {"error": "quota"},
    )
    landing.land_readings(frame, f"{folder}/out", "X")
    landing.land_readings(frame, f"{folder}/out", "X")
    landed = spark.read.parquet(f"{folder}/out")
    assert landed.count() == 4
    assert set(landed.columns) == {
        "currentSpeed", "coordinates.coordinate", "coord", "city", "BUSINESS_ID", "timestamp",
        "year", "month", "day"}
    rows = {r.BUSINESS_ID: r for r in landed.collect()}
    assert rows["p1"].currentSpeed is None and rows["p0"].currentSpeed == 30
    assert rows["p1"].timestamp == "2026-03-06T21:05:30.000000"
    assert os.path.isdir(f"{folder}/out/year=2026/month=3/day=6")


def test_land_readings_when_all_polls_failed(spark, folder):
    landing.land_readings(polls(spark, folder, {"error": "quota"}), f"{folder}/out", "X")
    assert set(spark.read.parquet(f"{folder}/out").columns) == {
        "coord", "city", "BUSINESS_ID", "timestamp", "year", "month", "day"}


# --- ingest ----------------------------------------------------------------


def test_each_file_is_loaded_once(spark, folder):
    drop(spark, f"{folder}/in/a", [(1, "a")])
    assert load(spark, folder) == [(1, "a")]
    drop(spark, f"{folder}/in/b c", [(2, "b")])
    assert load(spark, folder) == [(1, "a"), (2, "b")]
    assert load(spark, folder) == [(1, "a"), (2, "b")]
    # the same rows in a new file are new rows
    drop(spark, f"{folder}/in/a", [(1, "a")])
    assert load(spark, folder) == [(1, "a"), (1, "a"), (2, "b")]
    assert statuses(spark, folder) == [("loaded", 1, 1)] * 3


def test_old_files_that_arrive_late_are_loaded(spark, folder):
    drop(spark, f"{folder}/in/new", [(1, "new")])
    load(spark, folder)
    drop(spark, f"{folder}/in/old", [(2, "old")])
    for name in os.listdir(f"{folder}/in/old"):
        os.utime(f"{folder}/in/old/{name}", (1e9, 1e9))
    assert load(spark, folder) == [(1, "new"), (2, "old")]


def test_small_batches_load_everything(spark, folder):
    drop(spark, f"{folder}/in", [(i, "x") for i in range(40)], files_=8)
    assert len(load(spark, folder, max_files=3)) == 40
    assert len(os.listdir(f"{folder}/raw/history")) >= 3


def test_columns_match_by_name_in_any_case(spark, folder):
    drop(spark, f"{folder}/in", [("a", 1)], "NAME string, Id bigint")
    drop(spark, f"{folder}/in", [(2, True)], "ID bigint, extra boolean")
    assert load(spark, folder) == [(1, "a"), (2, None)]


def test_bad_files_are_skipped_whole(spark, folder):
    drop(spark, f"{folder}/in/good", [(1, "a"), (2, "b")])
    drop(spark, f"{folder}/in/wrong", [("x", "c")], "id string, name string")
    drop(spark, f"{folder}/in/none", [])
    with open(f"{folder}/in/junk.parquet", "wb") as out:
        out.write(b"no parquet here" * 9)
    assert load(spark, folder) == [(1, "a"), (2, "b")]
    found = statuses(spark, folder)
    assert found == [("loaded", 2, 2), ("no_rows", 0, 0), ("skipped", 0, 0), ("skipped", 1, 0)]


def test_a_file_damaged_in_the_middle_gives_no_row(spark, folder):
    spark.range(20000).selectExpr("id", "uuid() AS name").coalesce(1).write.option(
        "parquet.block.size", 100000).parquet(f"{folder}/in/bad")
    name = next(n for n in os.listdir(f"{folder}/in/bad") if n.endswith(".parquet"))
    path = f"{folder}/in/bad/{name}"
    content = bytearray(open(path, "rb").read())
    middle = int(len(content) * 0.7)
    content[middle:middle + 4000] = os.urandom(4000)
    open(path, "wb").write(content)
    os.remove(f"{folder}/in/bad/.{name}.crc")
    drop(spark, f"{folder}/in/good", [(1, "a")])
    assert load(spark, folder) == [(1, "a")]
    expected = [("loaded", 1, 1), ("skipped", 20000, 0)]
    assert statuses(spark, folder) == expected
    ingest.ingest_variant(spark, f"{folder}/in", f"{folder}/variants", "time")
    assert ingest.read_table(spark, f"{folder}/variants").count() == 1
    history = ingest.load_history(spark, f"{folder}/variants").collect()
    assert sorted((r.status, r.file_rows, r.row_count) for r in history) == expected


def test_only_bad_files(spark, folder):
    drop(spark, f"{folder}/in/wrong", [("x", "c")], "id string, name string")
    assert load(spark, folder) == []
    drop(spark, f"{folder}/in/good", [(1, "a")])
    assert load(spark, folder) == [(1, "a")]


def test_nothing_to_load(spark, folder):
    os.makedirs(f"{folder}/in")
    with pytest.raises(FileNotFoundError):
        load(spark, folder)
    assert ingest.load_history(spark, f"{folder}/raw").count() == 0


def test_a_batch_cut_off_before_publishing_is_not_read_and_then_redone(spark, folder, monkeypatch):
    drop(spark, f"{folder}/in", [(1, "a")])
    load(spark, folder)
    drop(spark, f"{folder}/in", [(2, "b")])
    counted = ingest._rows_per_file
    monkeypatch.setattr(ingest, "_rows_per_file", lambda df, path: (
        counted(df, path) if "_metadata" in str(path) else 1 / 0))
    with pytest.raises(Exception, match="division"):
        load(spark, folder)
    monkeypatch.undo()
    assert os.path.isdir(f"{folder}/raw/data/batch_id=1")
    assert ingest.read_table(spark, f"{folder}/raw").count() == 1
    assert load(spark, folder) == [(1, "a"), (2, "b")]


def events(spark, folder, *extra):
    listed = files.list_files(spark, f"{folder}/in", "*.parquet").select("*", "_metadata.file_path")
    listed = listed.withColumnRenamed("file_path", "file_name")
    for path in extra:
        listed = listed.union(listed.limit(1).withColumns(
            {"path": F.lit(path), "file_name": F.lit(path)}))
    return listed


def load_batch(spark, folder, listed, batch_id=0):
    ingest._load_batch(spark, listed, batch_id, f"{folder}/raw", lambda paths: (
        ingest._reader(spark).schema(SCHEMA).parquet(*paths).select(
            "id", "name", F.col("_metadata.file_path").alias("source_file"))), [])


def test_files_replaced_before_the_load_are_noted(spark, folder):
    drop(spark, f"{folder}/in", [(1, "a")])
    gone = f"file:{folder}/in/gone.parquet"
    load_batch(spark, folder, events(spark, folder, gone))
    assert ingest.read_table(spark, f"{folder}/raw").count() == 1
    assert statuses(spark, folder) == [("loaded", 1, 1), ("missing", 0, 0)]


def test_a_published_batch_is_left_alone(spark, folder):
    drop(spark, f"{folder}/in", [(1, "a")])
    load_batch(spark, folder, events(spark, folder))
    before = os.listdir(f"{folder}/raw/data/batch_id=0")
    load_batch(spark, folder, events(spark, folder))
    assert os.listdir(f"{folder}/raw/data/batch_id=0") == before
    drop(spark, f"{folder}/in", [(2, "b")])
    with pytest.raises(OSError, match="other files"):
        load_batch(spark, folder, events(spark, folder))


def test_history_within(spark, folder):
    drop(spark, f"{folder}/in", [(1, "a")])
    load(spark, folder)
    assert ingest.load_history(spark, f"{folder}/raw", "1 hour").count() == 1
    assert ingest.load_history(spark, f"{folder}/raw", "0 seconds").count() == 0


def test_variants_take_any_columns_and_types(spark, folder):
    when = "2026-03-06T21:05:30"
    drop(spark, f"{folder}/in/a", [("p1", 30, when)], "BUSINESS_ID string, currentSpeed bigint, timestamp string")
    drop(spark, f"{folder}/in/b", [("p2", 30.5, when)], "BUSINESS_ID string, currentSpeed double, timestamp string")
    drop(spark, f"{folder}/in/c", [("p3", when, "2025")], "BUSINESS_ID string, timestamp string, frc string")
    drop(spark, f"{folder}/in/d", [("p4", "2025-01-01")], "BUSINESS_ID string, timestamp string")
    with open(f"{folder}/in/junk.parquet", "wb") as out:
        out.write(b"no parquet here" * 9)
    ingest.ingest_variant(spark, f"{folder}/in", f"{folder}/raw", "timestamp")
    raw = ingest.read_table(spark, f"{folder}/raw")
    assert dict(raw.dtypes)["raw_data"] == "variant"
    assert raw.where("ingestion_time IS NULL").count() == 0
    typed = readings_typed(raw, 2026)
    assert sorted((r.business_id, r.current_speed) for r in typed.collect()) == [
        ("p1", 30), ("p2", 31), ("p3", None)]
    assert readings_typed(raw, 2025).count() == 1
    assert {s for s, *_ in statuses(spark, folder)} == {"loaded", "skipped"}


def test_variants_from_junk_alone(spark, folder):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/junk.parquet", "wb") as out:
        out.write(b"no parquet here" * 9)
    ingest.ingest_variant(spark, f"{folder}/in", f"{folder}/raw", "timestamp")
    assert statuses(spark, folder) == [("skipped", 0, 0)]
    drop(spark, f"{folder}/in/a", [("p1", "2026-01-02")], "BUSINESS_ID string, timestamp string")
    ingest.ingest_variant(spark, f"{folder}/in", f"{folder}/raw", "timestamp")
    assert readings_typed(ingest.read_table(spark, f"{folder}/raw")).count() == 1


# --- listings and tables ---------------------------------------------------


def test_list_files(spark, folder):
    drop(spark, f"{folder}/in/a/b", [(1, "a")])
    listed = files.list_files(spark, folder, "*.parquet").collect()
    assert len(listed) == 1 and listed[0].length > 0 and listed[0].path.endswith(".parquet")


def test_replace_table(spark, folder):
    first = replace_table(spark.range(3), folder, "t")
    assert first.count() == 3
    replace_table(stored_table(spark, folder, "t").where("id > 0"), folder, "t")
    assert (first.count(), stored_table(spark, folder, "t").count()) == (3, 2)
    for n in (4, 5):
        replace_table(spark.range(n), folder, "t")
    replace_table(spark.range(7), folder, "t__x")
    assert first.count() == 3 and stored_table(spark, folder, "t").count() == 5


def test_versions_go_when_they_have_been_out_of_date_for_a_while(spark, folder, monkeypatch):
    start = datetime(2026, 3, 1, tzinfo=timezone.utc)
    opened = []
    for hour, kept in ((0, 1), (10, 2), (20, 3), (30, 4), (40, 4), (100, 2)):
        monkeypatch.setattr(tables, "_now", lambda: start + timedelta(hours=hour))
        spark.range(9).write.parquet(f"{folder}/t/data/version=v20260228{hour:03d}")  # never committed
        replace_table(spark.range(hour), folder, "t")
        opened.append(stored_table(spark, folder, "t"))
        names = [n for n in os.listdir(f"{folder}/t/log") if n.startswith("version=")]
        assert len(names) == kept
        assert stored_table(spark, folder, "t").count() == hour
    assert opened[-2].count() == 40  # replaced just now
    assert not [n for n in os.listdir(f"{folder}/t/data") if "20260228" in n]


def test_tables_open_as_views(spark, folder, database):
    replace_table(spark.range(3), folder, "opened")
    assert open_tables(spark, folder) == ["opened"]
    assert open_tables(spark, folder, database) == ["opened"]
    assert spark.table("opened").count() == spark.table(f"{database}.opened").count() == 3
    with pytest.raises(FileNotFoundError):
        stored_table(spark, folder, "other")


def test_views_take_the_newest_version_when_they_are_queried(spark, folder, database):
    replace_table(spark.range(3), folder, "late")
    open_tables(spark, folder)
    open_tables(spark, folder, database)
    for n in (4, 5, 6):
        replace_table(spark.range(n), folder, "late", retain=timedelta(0))
        for name in ("late", f"{database}.late"):
            assert spark.table(name).count() == n
        assert spark.newSession().table(f"{database}.late").count() == n
    plan = spark.table("late")
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*version#\d+ = Subquery", text)  # other versions are not read
    # a refresh with one more column, while the old version is still there
    replace_table(spark.range(7).withColumn("more", F.lit("x")), folder, "late")
    assert spark.table("late").count() == 7
    open_tables(spark, folder)
    assert spark.table("late").where("more = 'x'").count() == 7


def test_a_failed_refresh_leaves_the_table_as_it_was(spark, folder):
    replace_table(spark.range(3), folder, "t")
    with pytest.raises(Exception, match="no good"):
        replace_table(spark.range(3).select(F.raise_error(F.lit("no good")).alias("id")), folder, "t")
    # rows written, but not committed
    spark.range(9).write.parquet(f"{folder}/t/data/version=v9")
    assert stored_table(spark, folder, "t").count() == 3


def test_schema_is_kept_and_widened(spark, folder):
    def load(df):
        df.write.mode("append").parquet(f"{folder}/drops")
        ingest.ingest_table(spark, f"{folder}/drops", f"{folder}/raw", df.schema)

    load(spark.sql("SELECT 1 AS a, named_struct('x', 'p') AS s"))
    load(spark.sql("SELECT 2L AS a, named_struct('x', 'q', 'y', 'r') AS s, 'new' AS b"))
    load(spark.sql("SELECT 'text' AS a, named_struct('x', 'z') AS s, 'bad' AS b"))
    rows = ingest.read_table(spark, f"{folder}/raw")
    assert rows.schema["a"].dataType.simpleString() == "bigint"
    assert {(r.a, r.s.x, r.s.y, r.b) for r in rows.collect()} == {(1, "p", None, None), (2, "q", "r", "new")}
    assert {r.status for r in ingest.load_history(spark, f"{folder}/raw").collect()} == {"loaded", "skipped"}


def test_only_bad_files_give_an_empty_table(spark, folder):
    os.makedirs(f"{folder}/drops")
    with open(f"{folder}/drops/bad.parquet", "w") as out:
        out.write("no parquet")
    ingest.ingest_table(spark, f"{folder}/drops", f"{folder}/raw", spark.range(1).schema)
    ingest.ingest_variant(spark, f"{folder}/drops", f"{folder}/variants", "t")
    assert ingest.read_table(spark, f"{folder}/raw").count() == 0
    assert ingest.read_table(spark, f"{folder}/variants").count() == 0


@pytest.mark.parametrize("master, shared, starts", [
    ("spark://host:7077", "hdfs:///work", "hdfs:///work/"), ("local[2]", "/mnt/work", "/mnt/work/"),
    ("local[2]", None, tempfile.gettempdir()),
])
def test_scratch_lies_in_the_shared_folder(master, shared, starts):
    session = SimpleNamespace(
        conf={"spark.checkpoint.dir": shared}, sparkContext=SimpleNamespace(master=master))
    made = {scratch_dir(session, "x") for _ in range(3)}
    assert len(made) == 3 and all(m.startswith(starts) for m in made)


def test_a_cluster_needs_a_shared_folder():
    session = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session, "x")


def test_places_land_with_fixed_types(spark, folder):
    os.makedirs(folder)
    for name, stars in (("a", 4), ("b", 4.5)):
        with open(f"{folder}/{name}.json", "w") as out:
            out.write(json.dumps({"business_id": name, "stars": stars}))
        landing.land_dataset(spark, "business", f"{folder}/{name}.json", f"{folder}/{name}")
        assert dict(spark.read.parquet(f"{folder}/{name}").dtypes)["stars"] == "double"


# --- compaction ------------------------------------------------------------


def batches(spark, folder, *numbers, ddl=SCHEMA):
    for n in numbers:
        drop(spark, f"{folder}/in/{n:03d}", [(n, "x")], ddl)
        load(spark, folder, ddl)


def names(folder, part):
    return sorted(n for n in os.listdir(f"{folder}/raw/{part}") if "=" in n)


def test_batches_become_a_segment_and_readers_notice_nothing(spark, folder, monkeypatch):
    target = f"{folder}/raw"
    batches(spark, folder, *range(5))
    assert compaction.compact(spark, target, leave=5) is None
    opened = ingest.read_table(spark, target)
    before = statuses(spark, folder)
    assert compaction.compact(spark, target, sort_by=["id"]) == 3
    assert compaction.vacuum(spark, target) == 0  # too early
    assert sorted(r.id for r in opened.collect()) == [0, 1, 2, 3, 4]
    assert load(spark, folder)[-1] == (4, "x") and statuses(spark, folder) == before
    batches(spark, folder, 5, 6)
    # a compaction that stops before its commit
    monkeypatch.setattr(compaction, "_commit", lambda *a: None)
    assert compaction.compact(spark, target) == 5
    monkeypatch.undo()
    batches(spark, folder, 7)
    assert compaction.compact(spark, target) == 6
    assert compaction.compact(spark, target) is None
    assert compaction.vacuum(spark, target, timedelta(0)) > 0
    assert names(folder, "segments") == ["high=3", "high=6"]
    assert names(folder, "data") == names(folder, "history") == ["batch_id=7"]
    assert load(spark, folder) == [(n, "x") for n in range(8)]
    assert sorted(r.batch_id for r in ingest.load_history(spark, target).collect()) == list(range(8))
    # a wider type and a new column after all that
    drop(spark, f"{folder}/in/new", [(2**40, "x", 1.5)], f"{SCHEMA}, more double")
    ingest.ingest_table(spark, f"{folder}/in", target, schema_of(spark, f"{SCHEMA}, more double"))
    assert {(r.id, r.more) for r in ingest.read_table(spark, target).collect()} >= {(0, None), (2**40, 1.5)}
    with pytest.raises(ValueError):
        compaction.compact(spark, target, leave=0)
    with pytest.raises(ValueError):
        compaction.compact(spark, f"{folder}/none")


def test_many_small_batches_become_few_files(spark, folder):
    for n in range(12):
        spark.createDataFrame([(n, "x")], SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{n:03d}")
    load(spark, folder, max_files=1)
    target = f"{folder}/raw"
    assert len(names(folder, "data")) == 12
    opened = ingest.read_table(spark, target)
    assert compaction.compact(spark, target) == 10
    assert opened.count() == 12
    compaction.vacuum(spark, target, timedelta(0))
    files_ = [f for _, _, found in os.walk(target) for f in found if f.endswith(".parquet") and "checkpoint" not in f]
    assert len(files_) < 12
    assert load(spark, folder) == [(n, "x") for n in range(12)]


def test_segments_without_rows(spark, folder):
    os.makedirs(f"{folder}/in")
    for n in range(3):
        with open(f"{folder}/in/{n}.parquet", "w") as out:
            out.write("no parquet")
        load(spark, folder)
    target = f"{folder}/raw"
    assert compaction.compact(spark, target) == 1
    compaction.vacuum(spark, target, timedelta(0))
    assert load(spark, folder) == [] and len(statuses(spark, folder)) == 3


def test_views_see_batches_that_come_later(spark, folder, database):
    target = f"{folder}/raw"

    def reading(n, year=2026):
        drop(spark, f"{folder}/in/{n}", [(f"p{n % 2}", f"{year}-03-06T21:0{n}:00", float(n), "1.5,x")],
             "BUSINESS_ID string, timestamp string, currentSpeed double, coord string")
        ingest.ingest_variant(spark, f"{folder}/in", target, "timestamp")

    reading(0)
    views = [f"late_{n}_{database}" for n in ("final", "latest")]
    open_views(spark, target, names=views)
    open_views(spark, target, database=database)
    both = [views, [f"{database}.{n}" for n in ("readings_final", "readings_latest")]]
    for step in range(1, 6):
        reading(step, 2025 if step == 4 else 2026)
        if step == 2:
            compaction.compact(spark, target)
        if step == 5:
            compaction.compact(spark, target)
            compaction.vacuum(spark, target, timedelta(0))
        raw = ingest.read_table(spark, target)
        for final, latest in both:
            for view, frame in ((final, readings_typed(raw)), (latest, readings_latest(raw))):
                shown = spark.newSession().table(view) if "." in view else spark.table(view)
                assert shown.dtypes == frame.dtypes
                assert sorted(map(tuple, shown.collect()), key=str) == sorted(map(tuple, frame.collect()), key=str)
    assert spark.table(views[0]).count() == 5 and spark.table(views[1]).count() == 2
    # a batch that is being written is not seen
    reading(6)
    assert spark.table(views[0]).count() == 6
    os.rename(f"{target}/history/batch_id=6", f"{folder}/hidden")
    assert spark.table(views[0]).count() == 5
    found = spark.table(views[0])
    found.collect()
    text = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*batch_id#\d+ > .*ubquery", text)
    assert "ReadSchema: struct<raw_data:struct<" in text  # the fields, not the variant


def test_the_reason_is_kept_for_each_rejected_file(spark, folder):
    drop(spark, f"{folder}/in/a", [(1, "x")])
    drop(spark, f"{folder}/in/b", [("1", "x")], "ID string, name string")
    drop(spark, f"{folder}/in/c", [(1, [5])], "id bigint, name array<int>")
    with open(f"{folder}/in/d.parquet", "w") as out:
        out.write("no parquet")
    load(spark, folder)
    found = {r.file_name.split("/in/")[1][0]: (r.status, r.first_error)
             for r in ingest.load_history(spark, f"{folder}/raw").collect()}
    assert found == {
        "a": ("loaded", None), "b": ("skipped", "column id: string instead of bigint"),
        "c": ("skipped", "column name: array<int> instead of string"), "d": ("skipped", "no readable footer")}


def test_a_nested_value_does_not_end_the_write_of_its_batch(spark, folder, monkeypatch):
    drop(spark, f"{folder}/in/a", [(1, "x", [1])], "id bigint, name string, more array<int>")
    drop(spark, f"{folder}/in/b", [(1, [5], [1])], "id bigint, NAME array<int>, more array<int>")
    drop(spark, f"{folder}/in/c", [(1, "y", None)], "id int, name string, more string")
    failed = []
    write = DataFrameWriter.parquet

    def watched(*args, **options):
        try:
            return write(*args, **options)
        except Exception as error:
            failed.append(error)
            raise

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    load(spark, folder, "id bigint, name string, more array<int>")
    assert not failed
    found = {r.file_name.split("/in/")[1][0]: (r.status, r.row_count)
             for r in ingest.load_history(spark, f"{folder}/raw").collect()}
    assert found == {"a": ("loaded", 1), "b": ("skipped", 0), "c": ("skipped", 0)}


def test_an_empty_file_is_judged_by_its_footer_and_does_not_end_a_write(spark, folder):
    drop(spark, f"{folder}/in/a", [(1, "x", (2, "y"), b"z")], "id bigint, name string, s struct<m: int, n: string>, b binary")
    drop(spark, f"{folder}/in/b", [(1, ["x"])], "id bigint, name array<string>")
    for kind, ddl in (("c", "id bigint, name array<string>"), ("d", "id string"), ("e", "id bigint, s struct<m: string>"),
                      ("f", "ID int, s struct<N: string, m: int>, b string, more boolean")):
        drop(spark, f"{folder}/in/{kind}", [], ddl)
    assert load(spark, folder, "id bigint, name string, s struct<m: int, n: string>, b binary") == [(1, "x", (2, "y"), b"z")]
    found = {r.file_name.split("/in/")[1][0]: (r.status, r.row_count, r.first_error)
             for r in ingest.load_history(spark, f"{folder}/raw").collect()}
    nested = ("skipped", 0, "column name: array<string> instead of string")
    assert found == {
        "a": ("loaded", 1, None), "b": nested, "c": nested, "d": ("skipped", 0, "column id: string instead of bigint"),
        "e": ("skipped", 0, "column s: struct<m:string> instead of struct<m:int,n:string>"), "f": ("no_rows", 0, None)}


def test_loaded_files_are_archived_and_late_ones_still_load(spark, folder):
    def landed():
        return sorted(f for _, _, found in os.walk(f"{folder}/in") for f in found if f.endswith(".parquet"))

    for n in range(20):
        drop(spark, f"{folder}/in", [(n, "x")])
    options = {"archive": f"{folder}/done", "max_files": 10}
    load(spark, folder, **options)
    drop(spark, f"{folder}/in", [(20, "x")])
    load(spark, folder, **options)
    left = landed()
    assert len(left) <= 11  # those of the last batches only
    drop(spark, f"{folder}/in", [(21, "late")])
    for f in set(landed()) - set(left):
        os.utime(f"{folder}/in/{f}", (10**9, 10**9))  # a copy that kept an old date
    assert load(spark, folder, **options) == [(n, "x") for n in range(21)] + [(21, "late")]
    assert [s for s, _, _ in statuses(spark, folder)] == ["loaded"] * 22
    kept = [f for _, _, found in os.walk(f"{folder}/done") for f in found if f.endswith(".parquet")]
    assert len(kept) + len(landed()) == 22
