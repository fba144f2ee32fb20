"""Refresh of changed keys: equal to a refresh of everything, and only their buckets are touched."""

import os
from datetime import datetime, timedelta, timezone

import pytest

from placewell.plans.places import entity_clean
from placewell.plans.refresh import changed_tables, refresh_changed
from placewell.sources import buckets, ingest, tables

PLACE = ("business_id string, name string, address string, city string, state string, postal_code string, latitude double, "
         "longitude double, stars double, review_count bigint, is_open bigint, categories string, attributes string, hours string")
FOLDERS = ("places", "reviews", "checkins")


def place(key, stars, name="n", categories=None):
    return (key, name, "a", "Philadelphia", "PA", "1", 1.0, 2.0, stars, 3, 1, categories, None, None)


def load(spark, folder, number, *rows, ddl=PLACE):
    df = spark.createDataFrame(rows, ddl)
    df.coalesce(1).write.parquet(f"{folder}/in/{number}")
    ingest.ingest_table(spark, f"{folder}/in", f"{folder}/raw/places", df.schema)


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


def refresh(spark, folder, **options):
    raw = {n: f"{folder}/raw/{n}" for n in FOLDERS}
    return refresh_changed(spark, raw, f"{folder}/clean", **options)["entity_clean"]


def test_a_refresh_of_changed_keys_equals_one_of_everything(spark, folder):
    steps = [
        [place(f"p{k}", float(k % 5), categories="Pizza" if k % 2 else None) for k in range(40)],
        [place("p3", 9.0), place("p3", 9.0, "earlier"), place("new", 1.0)],
        [place("p4", None), place("p5", 0.5)], [place(None, 1.0)],
    ]
    numbers = []
    for number, rows in enumerate(steps):
        load(spark, folder, number, *rows)
        before = buckets.last_commit(spark, f"{folder}/clean/entity_clean")[0]
        numbers.append(refresh(spark, folder, buckets=16))
        whole = entity_clean(ingest.read_table(spark, f"{folder}/raw/places"))
        found = changed_tables(spark, f"{folder}/clean")
        assert collected(found["entity_clean"].select(whole.columns)) == collected(whole)
        assert "review_clean" not in found and found["regional_top"].count() > 0
        after = buckets.last_commit(spark, f"{folder}/clean/entity_clean")[0]
        assert sum(before.get(b) != v for b, v in after.items()) == numbers[-1]
    assert numbers[0] > 10 and 1 <= numbers[1] <= 2 and 1 <= numbers[2] <= 2 and numbers[3] == 0
    assert refresh(spark, folder) == 0


def test_only_buckets_of_changed_keys_are_read(spark, folder, monkeypatch):
    load(spark, folder, 0, *[place(f"p{k}", 1.0) for k in range(60)])
    refresh(spark, folder, buckets=32)
    load(spark, folder, 1, place("p7", 5.0))
    seen = []
    read = buckets.read_buckets
    monkeypatch.setattr(buckets, "read_buckets", lambda *a: seen.append(read(*a)) or seen[-1])
    assert refresh(spark, folder) == 1
    assert len(seen) == 1 and len({os.path.dirname(f) for f in seen[0].inputFiles()}) == 1


def test_a_refresh_that_stops_leaves_the_table_as_it_was(spark, folder, monkeypatch):
    load(spark, folder, 0, place("p", 1.0))
    refresh(spark, folder)
    load(spark, folder, 1, place("p", 2.0), place("q", 2.0))
    with monkeypatch.context() as patch:
        patch.setattr(buckets, "list_folders", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh(spark, folder)
    assert [r.business_stars for r in changed_tables(spark, f"{folder}/clean")["entity_clean"].collect()] == [1.0]
    refresh(spark, folder)
    assert changed_tables(spark, f"{folder}/clean")["entity_clean"].count() == 2


def test_a_large_bucket_is_written_by_several_tasks(spark, folder, monkeypatch):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    home = f"{folder}/table"
    rows = spark.range(0, 200_000, 1, 8).selectExpr("id", "md5(CAST(id AS STRING)) AS name")
    spark.conf.set(size, "256k")
    try:
        for half in (rows.where("id % 2 = 0"), rows.where("id % 2 = 1")):
            buckets.merge_changes(home, "id", half, 0, lambda df: df.distinct(), 2)
    finally:
        spark.conf.set(size, before)
    stored = buckets.read_buckets(spark, home)
    assert len(stored.inputFiles()) > 4 and len({os.path.dirname(f) for f in stored.inputFiles()}) == 2
    assert stored.exceptAll(rows).isEmpty() and stored.count() == 200_000


def test_old_buckets_go_and_new_columns_come(spark, folder, monkeypatch):
    start = datetime(2026, 3, 1, tzinfo=timezone.utc)
    home = f"{folder}/clean/entity_clean"
    for hour in (0, 1, 2, 40, 80):
        for module in (tables, buckets):
            monkeypatch.setattr(module, "_now", lambda: start + timedelta(hours=hour))
        load(spark, folder, hour, place("p" if hour else "q", float(hour)))
        refresh(spark, folder, buckets=4)
        opened = changed_tables(spark, f"{folder}/clean")["entity_clean"]
        assert sorted(r.business_stars for r in opened.collect())[-1] == hour
    assert len([n for n in os.listdir(f"{home}/log") if "=" in n]) == 2
    assert len([n for n in os.listdir(f"{home}/data") if "=" in n]) == 3  # q, and p before and after
    assert opened.count() == 2
