"""Physical plans: what is pushed to the scan, what is cut before a shuffle, what is broadcast."""

import re

import pytest

from placewell.registry.queries import QUERIES
from placewell.operators import joins
from placewell.plans import places
from placewell.plans.readings import readings_typed
from placewell.registry import inputs
from placewell.sources import ingest

SF_DIR = "/root/testdata/sf0.001"
WRITES_FIRST = {
    "json_inferred_ingest", "json_schema_ingest", "parquet_overwrite", "land_nested_json",
    "incremental_ingest", "ingest_backfill", "ingest_by_name", "ingest_skip_bad_files",
    "load_history", "variant_landing", "stream_latest_state", "medallion_refresh",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def planned(spark, name):
    return plan(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_FIRST))
def test_no_python_and_no_cross_join(spark, name):
    text = planned(spark, name)
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", text)


@pytest.mark.parametrize("name", [
    "dedup_best_row", "dedup_newest_row", "latest_per_key", "top_n_per_group", "entity_clean",
    "review_clean", "readings_latest", "regional_top_entities", "top_n_with_latest",
])
def test_ranks_are_cut_before_the_shuffle(spark, name):
    text = planned(spark, name)
    partial = text.index("Partial", text.index("WindowGroupLimit"))
    assert "Final" in text and partial
    # plans print from the result to the scan: Final, Exchange, Partial
    first = text.index("Final")
    assert first < text.index("Exchange hashpartitioning", first) < text.index("Partial", first)


@pytest.mark.parametrize("name, filters", [
    ("year_prefix_filter", ["GreaterThanOrEqual(o_orderdate,1997-01-01", "LessThan(o_orderdate,1998-01-01"]),
    ("region_category_filter", ["EqualTo(c_nationkey,7)", "In(c_mktsegment,"]),
    ("limit_preview", []),
])
def test_filters_reach_the_scan(spark, name, filters):
    text = planned(spark, name)
    assert all(f in text for f in filters)


@pytest.mark.parametrize("name, columns", [
    ("explode_delimited", {"doc_id", "text"}),
    ("minute_buckets", {"ts"}),
    ("activity_by_month", {"o_custkey", "o_orderdate"}),
    ("category_state_summary", {"c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"}),
    ("row_counts", set()),
])
def test_scans_read_only_what_is_needed(spark, name, columns):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", planned(spark, name))
    assert schemas and all({c.split(":")[0] for c in s.split(",") if c} == columns for s in schemas)


def test_variant_fields_are_read_by_the_scan(spark):
    text = plan(readings_typed(inputs.readings(spark, SF_DIR), 2024))
    assert "try_variant_get" not in text
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(raw_data", text)


def test_keys_of_ranked_places_reach_the_scan_of_readings(spark):
    clean = places.entity_clean(inputs.places(spark, SF_DIR))
    text = plan(places.regional_top_with_latest(clean, inputs.readings(spark, SF_DIR, of_places=True), 2024))
    assert re.search(r"PushedFilters: \[[^]]*In\(raw_data\S* ?\[", text) or "In(raw_data" in text
    assert text.count("Scan parquet") == 1 or text.count("FileScan parquet") == 1  # places were ranked before


def test_a_year_of_raw_readings_opens_its_own_files(spark, folder):
    for year in (2025, 2026):
        spark.createDataFrame(
            [("p", f"{year}-01-02T00:00:00")], "BUSINESS_ID string, timestamp string"
        ).write.parquet(f"{folder}/in/{year}")
    ingest.ingest_variant(spark, f"{folder}/in", f"{folder}/raw", "timestamp")
    typed = readings_typed(ingest.read_table(spark, f"{folder}/raw"), 2026)
    assert re.search(r"PartitionFilters: \[[^]]*payload_year#\d+ = 2026", plan(typed))
    assert typed.count() == 1


def test_dated_folders_are_written_by_balanced_tasks(spark, folder):
    days = ["year", "month", "day"]
    df = spark.createDataFrame([(2026, 1, 2)], "year int, month int, day int").hint("rebalance", *days)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(df)


def test_exact_deduplication_does_not_sort(spark):
    for name in ("dedup_exact", "checkin_events", "checkin_summary"):
        text = planned(spark, name)
        assert "Sort" not in text and text.count("HashAggregate") >= 2


def test_top_k_does_not_sort_everything(spark):
    for name in ("minute_buckets", "limit_preview"):
        assert "TakeOrderedAndProject" in planned(spark, name)


def test_broadcast_needs_a_bound(spark):
    big, small = spark.range(10), spark.range(5)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(joins.attach_key(big, small, "id", 5))
        assert "SortMergeJoin" in plan(joins.attach_key(big, small, "id"))
        assert "SortMergeJoin" in plan(joins.attach_key(big, small, "id", 10**9))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
