"""One query per operator. Each reads the given tables whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewell.functions import scalars as S
from placewell.functions.classify import classify
from placewell.functions.ordering import asc, desc
from placewell.operators import joins, profiling, ranking
from placewell.plans import checkins, checks, places, readings, refresh, reviews
from placewell.registry import inputs
from placewell.registry.inputs import TABLES, labelled_documents, table
from placewell.session import scratch_dir
from placewell.sources import compaction, files, ingest, landing
from placewell.streaming import latest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- landing ---------------------------------------------------------------


@query
def json_inferred_ingest(spark, sf_dir):
    raw = scratch_dir(spark, "json")
    part = table(spark, sf_dir, "part")
    part.write.json(raw)
    landed = landing.read_json_lines(spark, raw)
    return landed.select(*[F.col(f.name).cast(f.dataType) for f in part.schema])


@query
def json_schema_ingest(spark, sf_dir):
    raw = scratch_dir(spark, "json")
    table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date"),
    ).write.json(raw)
    return landing.read_json_lines(
        spark, raw,
        "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, date STRING",
        {"date": "date_ts"},
    )


@query
def json_rescued_fields(spark, sf_dir):
    """Fields that the declared columns do not have, from beside them."""
    raw = scratch_dir(spark, "json")
    table(spark, sf_dir, "events").select(
        "event_id", F.struct("event_type", F.when(F.col("event_type") == "error", F.col("value")).alias("code")).alias("detail"),
        F.when(F.col("event_type") == "click", F.col("user_id")).alias("user"),
    ).write.json(raw)
    landed = landing.read_json_lines(
        spark, raw, "event_id BIGINT, detail STRUCT<event_type: STRING>", rescue="rest")
    return landed.select(
        "event_id", F.col("detail.event_type").alias("event_type"),
        F.try_variant_get("rest", "$.user", "bigint").alias("user_id"),
        F.try_variant_get("rest", "$['detail.code']", "double").alias("code"),
        F.col("rest").isNotNull().alias("has_rest"))


@query
def parquet_overwrite(spark, sf_dir):
    target = scratch_dir(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    landing.write_parquet(orders, target)
    landing.write_parquet(orders, target)
    return spark.read.parquet(target)


@query
def land_nested_json(spark, sf_dir):
    raw, target = scratch_dir(spark, "polls"), scratch_dir(spark, "readings")
    table(spark, sf_dir, "events").select(
        F.concat_ws(",", "user_id", "event_id").alias("coord"),
        F.col("user_id").cast("string").alias("business_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("polled_at"),
        # a failed poll has no payload
        F.struct(F.when(F.col("event_type") != "error", F.struct(
            "event_type", "value",
            F.struct(F.get_json_object("props", "$.k").cast("bigint").alias("k")).alias("detail"),
        )).alias("flowSegmentData")).alias("response"),
    ).write.json(raw)
    polls = landing.read_json_lines(
        spark, raw,
        "coord STRING, business_id STRING, polled_at STRING, response STRUCT<flowSegmentData: "
        "STRUCT<event_type: STRING, value: DOUBLE, detail: STRUCT<k: BIGINT>>>",
    ).withColumn("polled_at", S.parse_timestamp(F.col("polled_at")))
    landing.land_readings(polls, target, "Philadelphia")
    landed = spark.read.parquet(target)
    return landed.select(
        "event_type", "value", F.col("`detail.k`").alias("detail_k"), "coord", "city",
        F.col("BUSINESS_ID").alias("business_id"), "timestamp", "year", "month", "day",
    )


# --- file ingest -----------------------------------------------------------


def _halves(rows: DataFrame, condition: str) -> tuple[DataFrame, DataFrame]:
    """Rows for which the condition holds, and all others; NULL counts as not holding."""
    holds = F.coalesce(F.expr(condition), F.lit(False))
    return rows.where(holds), rows.where(~holds)


EARLY = "ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'"


@query
def incremental_ingest(spark, sf_dir):
    root = scratch_dir(spark, "ingest")
    events = table(spark, sf_dir, "events")
    for drop, rows in zip("ab", _halves(events, EARLY), strict=True):
        rows.write.parquet(f"{root}/drops/{drop}")
        ingest.ingest_table(spark, f"{root}/drops", f"{root}/raw", events.schema)
    return ingest.read_table(spark, f"{root}/raw").select(events.columns)


@query
def ingest_backfill(spark, sf_dir):
    root = scratch_dir(spark, "ingest")
    events = table(spark, sf_dir, "events")
    for drop, rows in zip("ab", _halves(events, EARLY), strict=True):
        rows.write.parquet(f"{root}/drops/{drop}")
    for _ in ("backfill", "nothing new"):
        ingest.ingest_table(spark, f"{root}/drops", f"{root}/raw", events.schema)
    return ingest.read_table(spark, f"{root}/raw").select(events.columns)


@query
def ingest_by_name(spark, sf_dir):
    root = scratch_dir(spark, "ingest")
    supplier = table(spark, sf_dir, "supplier")
    upper = supplier.toDF(*[c.upper() for c in supplier.columns])
    low, rest = _halves(upper, "S_NATIONKEY < 13")
    low.write.parquet(f"{root}/drops/a")
    (
        rest.drop("S_ACCTBAL").withColumn("EXTRA", F.lit(1))
        .write.parquet(f"{root}/drops/b")
    )
    ingest.ingest_table(spark, f"{root}/drops", f"{root}/raw", supplier.schema)
    return ingest.read_table(spark, f"{root}/raw").select(supplier.columns)


@query
def ingest_schema_drift(spark, sf_dir):
    """The second drop has a wider type and one more column than the first."""
    root = scratch_dir(spark, "ingest")
    low, rest = _halves(table(spark, sf_dir, "supplier"), "s_nationkey < 13")
    for drop in (low.drop("s_acctbal"), rest.withColumn("s_nationkey", F.col("s_nationkey").cast("bigint"))):
        drop.write.mode("append").parquet(f"{root}/drops")
        ingest.ingest_table(spark, f"{root}/drops", f"{root}/raw", drop.schema)
    return ingest.read_table(spark, f"{root}/raw").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@query
def ingest_skip_bad_files(spark, sf_dir):
    root = scratch_dir(spark, "ingest")
    customer = table(spark, sf_dir, "customer")
    customer.write.parquet(f"{root}/drops/good")
    customer.withColumn("c_custkey", F.col("c_name")).write.parquet(f"{root}/drops/wrong_type")
    customer.select("c_name").write.text(f"{root}/drops/not_parquet")
    ingest.ingest_table(spark, f"{root}/drops", f"{root}/raw", customer.schema, "part-*")
    return ingest.read_table(spark, f"{root}/raw").select(customer.columns)


@query
def load_history(spark, sf_dir):
    """Rows and status per drop, from the history per file."""
    root = scratch_dir(spark, "ingest")
    events = table(spark, sf_dir, "events")
    events.withColumn("kind", F.col("event_type")).write.partitionBy("kind").parquet(f"{root}/drops")
    ingest.ingest_table(spark, f"{root}/drops", f"{root}/raw", events.schema)
    history = ingest.load_history(spark, f"{root}/raw", "14 days")
    return history.groupBy(
        F.regexp_extract("file_name", "/kind=([^/]+)/", 1).alias("kind"), "status"
    ).agg(F.sum("row_count").alias("row_count"), F.sum("file_rows").alias("file_rows"))


@query
def ingest_first_error(spark, sf_dir):
    """What is wrong with the files of each drop, from the load history."""
    root = scratch_dir(spark, "ingest")
    customer = table(spark, sf_dir, "customer")
    customer.write.parquet(f"{root}/drops/good")
    customer.withColumn("c_acctbal", F.col("c_name")).write.parquet(f"{root}/drops/wrong_type")
    customer.withColumn("c_name", F.array("c_name")).write.parquet(f"{root}/drops/nested")
    customer.select("c_name").write.text(f"{root}/drops/not_parquet")
    ingest.ingest_table(spark, f"{root}/drops", f"{root}/raw", customer.schema, "part-*")
    # nothing is wrong with an empty file that fits; there is one where the first split of the table has no row
    status = F.when(F.col("status") == "no_rows", "loaded").otherwise(F.col("status"))
    return ingest.load_history(spark, f"{root}/raw").groupBy(
        F.regexp_extract("file_name", "/drops/([^/]+)/", 1).alias("kind"), status.alias("status"), "first_error"
    ).agg(F.sum("row_count").alias("row_count"))


@query
def ingest_compacted(spark, sf_dir):
    """Batches before, in and after a segment, when their own folders are gone."""
    root = scratch_dir(spark, "ingest")
    events = table(spark, sf_dir, "events")
    views, rest = _halves(events, "event_type = 'view'")
    clicks, rest = _halves(rest, "event_type = 'click'")
    for drop, rows in (("a", views), ("b", clicks), ("c", rest)):
        rows.write.parquet(f"{root}/drops/{drop}")
        ingest.ingest_table(spark, f"{root}/drops", f"{root}/raw", events.schema)
    compaction.compact(spark, f"{root}/raw", sort_by=["user_id"])
    compaction.vacuum(spark, f"{root}/raw", timedelta(0))
    return ingest.read_table(spark, f"{root}/raw").select(events.columns)


@query
def variant_landing(spark, sf_dir):
    root = scratch_dir(spark, "ingest")
    table(spark, sf_dir, "events").select(
        "event_id", "value", "event_type",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.from_json("props", "k BIGINT").alias("props"),
    ).write.parquet(f"{root}/drops/a")
    ingest.ingest_variant(spark, f"{root}/drops", f"{root}/raw", "timestamp")
    return ingest.read_table(spark, f"{root}/raw").select(
        readings.field("event_id", "bigint").alias("event_id"),
        readings.field("value", "double").alias("value"),
        readings.field("event_type", "string").alias("event_type"),
        S.parse_timestamp(readings.field("timestamp", "string")).alias("ts"),
        readings.field("props.k", "bigint").alias("k"),
        F.col("payload_year").cast("int").alias("payload_year"),
    )


@query
def stage_file_listing(spark, sf_dir):
    """Rows per table in the files that the listing has; a missing or cut file shows."""
    one_slash = lambda path: F.regexp_replace(path, "^([a-z]+):/+", "$1:/")
    listed = files.list_files(spark, sf_dir, "*.parquet").where("length > 0").select(
        one_slash("path").alias("path"))
    # no column is selected: the footers alone answer this, in one scan of all tables
    counted = spark.read.schema("_none string").parquet(*[f"{sf_dir}/{n}.parquet" for n in TABLES]).groupBy(
        one_slash("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("row_count"))
    return listed.join(counted, "path").groupBy(
        F.regexp_extract("path", r"/([a-z]+)\.parquet(?:/|$)", 1).alias("table_name")).agg(
        F.sum("row_count").alias("row_count"))


# --- projections, filters, scalar functions --------------------------------


@query
def select_rename_coalesce(spark, sf_dir):
    return labelled_documents(spark, sf_dir).select(
        "doc_id", F.col("lang").alias("doc_language"), F.col("source").alias("doc_source"),
        S.with_default(F.col("quality").cast("string"), "Unknown").alias("doc_quality"),
    )


PART_RULES = (
    ("Round parts", ("RING", "rod", "wid")),
    ("Fasteners", ("Bolt", "ring")),
    ("Drive parts", ("gear", "giz")),
)


@query
def keyword_classify(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return classify(part, "p_name", "part_class", PART_RULES)


@query
def region_category_filter(spark, sf_dir):
    return places.in_region(
        table(spark, sf_dir, "customer"), F.col("c_name"), "cUSTOMER#",
        F.col("c_nationkey"), 7, F.col("c_mktsegment"), ("BUILDING", "MACHINERY", "FURNITURE"),
    )


@query
def not_null_guard(spark, sf_dir):
    return S.not_null(labelled_documents(spark, sf_dir), "doc_id", "quality").select(
        "doc_id", "quality", "toxic"
    )


@query
def year_prefix_filter(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(S.in_year(F.col("o_orderdate"), 1997))


@query
def variant_extract(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(
        "event_id", F.try_parse_json("props").alias("raw_data"))
    return raw.select(
        "event_id",
        readings.field("k", "bigint").alias("k_int"),
        readings.field("k", "double").alias("k_float"),
        readings.field("k", "string").alias("k_text"),
        readings.field("K", "bigint").alias("k_other_case"),
    )


@query
def coord_split(spark, sf_dir):
    name = F.col("c_name")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        S.list_part(name, 1, separator="#").alias("part_one"),
        S.list_part(name, 2, "double", "#").alias("part_two"),
        S.list_part(name, 3, "double", "#").alias("part_three"),
    )


@query
def safe_ratio(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        S.safe_ratio(F.col("value"), F.get_json_object("props", "$.k").cast("double")).alias("ratio"),
    )


@query
def tz_convert(spark, sf_dir):
    eastern = S.shift_zone(F.col("ts"), "UTC", "America/New_York")
    return table(spark, sf_dir, "events").select(
        "event_id", eastern.alias("eastern"),
        S.shift_zone(eastern, "America/New_York", "America/Los_Angeles").alias("pacific"),
    )


@query
def date_parts(spark, sf_dir):
    typed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    stamped = table(spark, sf_dir, "orders").select(
        "o_orderkey", S.first_timestamp(typed, text).alias("order_timestamp"))
    return reviews.with_date_parts(stamped, "order_timestamp", "order").withColumn(
        "order_month_day", S.month_of_date(F.col("order_date")))


@query
def delimited_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", S.delimited_count(F.col("text")).cast("bigint").alias("entry_count"))


@query
def explode_delimited(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return joins.explode_list(documents, "text", "entry").select("doc_id", "entry")


# --- ranking ---------------------------------------------------------------


@query
def dedup_best_row(spark, sf_dir):
    return ranking.keep_first(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
        [desc("l_extendedprice"), asc("l_shipdate"), asc("l_partkey"), asc("l_suppkey")],
    )


@query
def dedup_newest_row(spark, sf_dir):
    return ranking.keep_newest(table(spark, sf_dir, "events"), ["event_type", "user_id"], "ts")


@query
def dedup_exact(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select(F.trim("text").alias("body"))
    return ranking.distinct_keys(texts, "body")


@query
def top_n_per_group(spark, sf_dir):
    return ranking.top_n(
        table(spark, sf_dir, "customer"), ["c_mktsegment"],
        [desc("c_acctbal"), asc("c_name")], 5, "rank_in_segment",
    )


@query
def latest_per_key(spark, sf_dir):
    return ranking.latest_per_key(table(spark, sf_dir, "events"), "user_id", "ts")


# --- aggregations and reports ----------------------------------------------


def _cents(name: str):
    # whole cents add up exactly in any order
    return F.round(F.col(name) * 100).cast("bigint")


@query
def null_profile(spark, sf_dir):
    return profiling.null_profile(
        labelled_documents(spark, sf_dir), ["doc_id", "text", "quality", "toxic"], ["source"])


@query
def row_counts(spark, sf_dir):
    return profiling.row_counts({name: table(spark, sf_dir, name) for name in inputs.TABLES})


@query
def monthly_trend(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        S.month_of_timestamp(F.col("o_orderdate")).alias("order_month"),
        _cents("o_totalprice").alias("cents"),
    )
    return profiling.monthly_trend(orders, "order_month", "cents", "order_count", "avg_cents")


@query
def minute_buckets(spark, sf_dir):
    return profiling.minute_buckets(table(spark, sf_dir, "events"), "ts", 20)


@query
def category_state_summary(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_mktsegment", "c_nationkey", _cents("c_acctbal").alias("cents"), "c_custkey")
    return profiling.category_state_summary(
        customers, "c_mktsegment", "c_nationkey", "cents", "c_custkey")


@query
def activity_by_month(spark, sf_dir):
    return profiling.activity_by_month(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


@query
def limit_preview(spark, sf_dir):
    return profiling.preview(table(spark, sf_dir, "part"), "p_partkey", 30)


# --- joins -----------------------------------------------------------------


@query
def point_key_join(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return joins.attach_key(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), nations, "c_nationkey")


@query
def top_n_with_latest(spark, sf_dir):
    """The five richest customers of each segment with their latest order."""
    best = ranking.top_n(
        table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "custkey"), ["c_mktsegment"],
        [desc("c_acctbal"), asc("c_name")], 5, "rank_in_segment",
    )
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey")
    mine = joins.only_keys_of(orders, best, "custkey")
    return joins.attach_latest(
        best, ranking.latest_per_key(mine, "custkey", "o_orderdate"), "custkey")


@query
def regional_top_live(spark, sf_dir):
    """The best places of the region with their latest reading."""
    clean = places.entity_clean(inputs.places(spark, sf_dir))
    return places.regional_top_with_latest(clean, inputs.readings(spark, sf_dir, of_places=True), year=2024)


# --- whole transforms ------------------------------------------------------


@query
def entity_clean(spark, sf_dir):
    clean = places.entity_clean(inputs.places(spark, sf_dir))
    return clean.withColumn("brand", F.col("attributes.brand")).drop("attributes", "hours")


@query
def regional_top_entities(spark, sf_dir):
    return places.regional_top(places.entity_clean(inputs.places(spark, sf_dir)))


@query
def review_clean(spark, sf_dir):
    return reviews.review_clean(inputs.reviews(spark, sf_dir))


@query
def checkin_summary(spark, sf_dir):
    summary = checkins.checkin_summary(inputs.checkins(spark, sf_dir))
    return summary.withColumn("checkin_count_est", F.col("checkin_count_est").cast("bigint"))


@query
def checkin_events(spark, sf_dir):
    return checkins.checkin_events(inputs.checkins(spark, sf_dir))


@query
def readings_typed(spark, sf_dir):
    return readings.readings_typed(inputs.readings(spark, sf_dir), year=2024)


@query
def readings_latest(spark, sf_dir):
    return readings.readings_latest(inputs.readings(spark, sf_dir), year=2024)


@query
def readings_late_view(spark, sf_dir):
    """The latest readings by a view that was opened before the second load and its compaction."""
    root = scratch_dir(spark, "views")
    early, late = _halves(inputs.reading_records(spark, sf_dir), "timestamp < '2024-01-16'")
    names = [f"{n}_{uuid.uuid4().hex}" for n in ("final", "latest")]
    for drop, rows in (("a", early), ("b", late)):
        rows.write.parquet(f"{root}/drops/{drop}")
        ingest.ingest_variant(spark, f"{root}/drops", f"{root}/raw", "timestamp")
        if drop == "a":
            readings.open_views(spark, f"{root}/raw", 2024, names=names)
    compaction.compact(spark, f"{root}/raw", least=1)
    return spark.table(names[1])


@query
def latest_report(spark, sf_dir):
    return readings.latest_report(readings_latest(spark, sf_dir))


@query
def newest_readings(spark, sf_dir):
    """The ten newest raw readings of the year."""
    fields = readings.reading_fields(inputs.readings(spark, sf_dir), year=2024)
    newest = profiling.newest_first(fields, readings.INSTANT, 10, [asc("business_id")])
    return newest.select("business_id", readings.INSTANT, "current_speed")


@query
def review_trend(spark, sf_dir):
    """Reviews and mean stars by month, from the clean reviews."""
    return checks.review_trend(review_clean(spark, sf_dir))


@query
def review_null_profile(spark, sf_dir):
    """Missing values of the raw reviews."""
    return checks.review_profile(inputs.reviews(spark, sf_dir))


@query
def place_null_profile(spark, sf_dir):
    """Missing values of the raw places."""
    return checks.place_profile(inputs.places(spark, sf_dir))


@query
def checkin_activity(spark, sf_dir):
    """Check-ins by place and month, from the clean events."""
    return profiling.activity_by_month(checkin_events(spark, sf_dir), "business_id", "checkin_date")


@query
def stream_latest_state(spark, sf_dir):
    target = scratch_dir(spark, "state")
    schema = table(spark, sf_dir, "events").schema
    # a glob, so that the table may be one file or a folder of files
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    latest.run_latest_state(stream, "user_id", "ts", target).awaitTermination()
    return latest.read_latest_state(spark, target, "user_id", "ts").select(schema.names)


@query
def medallion_refresh(spark, sf_dir):
    root = scratch_dir(spark, "clean")
    return refresh.refresh(
        inputs.places(spark, sf_dir), inputs.reviews(spark, sf_dir),
        inputs.checkins(spark, sf_dir), root,
    )


def _changed(spark, sf_dir, name):
    """A clean table after two loads, each taken in by a refresh of changed keys."""
    root = scratch_dir(spark, "changed")
    raw = {n: f"{root}/raw/{n}" for n in ("places", "reviews", "checkins")}
    tables = {
        "places": _halves(inputs.places(spark, sf_dir), "review_count <= 75"),
        "reviews": _halves(inputs.reviews(spark, sf_dir), "useful <= 3"),
        "checkins": _halves(inputs.checkins(spark, sf_dir), "date LIKE '%,'"),
    }
    source = refresh.KEYED[name][0]
    for drop in range(2):
        tables[source][drop].write.parquet(f"{root}/drops/{drop}")
        ingest.ingest_table(spark, f"{root}/drops", raw[source], tables[source][drop].schema)
        refresh.refresh_changed(spark, raw, f"{root}/clean", buckets=8)
    return refresh.changed_tables(spark, f"{root}/clean")


@query
def refresh_changed_places(spark, sf_dir):
    clean = _changed(spark, sf_dir, "entity_clean")["entity_clean"]
    return clean.withColumn("brand", F.col("attributes.brand")).drop("attributes", "hours")


@query
def refresh_changed_reviews(spark, sf_dir):
    return _changed(spark, sf_dir, "review_clean")["review_clean"]


@query
def refresh_changed_checkins(spark, sf_dir):
    return _changed(spark, sf_dir, "checkin_events")["checkin_events"]


@query
def checkin_rejects(spark, sf_dir):
    """Lists and entries of the raw check-ins, and how many of them cannot be used."""
    return checkins.checkin_rejects(inputs.checkins(spark, sf_dir).withColumn(
        "date", F.when(F.col("business_id") == "1", F.concat("date", F.lit(", no time"))).otherwise(F.col("date"))))
