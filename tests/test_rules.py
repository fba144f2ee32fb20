"""The rules that are easy to get wrong, each on a few rows with the expected result written out."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from placewell.functions import scalars as S
from placewell.functions.classify import classify
from placewell.functions.ordering import asc, desc, tie_columns
from placewell.operators import joins, profiling, ranking
from placewell.plans.checkins import checkin_events, checkin_rejects, checkin_summary
from placewell.plans.places import entity_clean, regional_top, regional_top_with_latest
from placewell.plans.readings import (
    latest_report, readings_latest, readings_typed, register_views,
)
from placewell.plans.reviews import review_clean

PLACE = (
    "business_id string, name string, address string, city string, state string, "
    "postal_code string, latitude double, longitude double, stars double, review_count bigint, "
    "is_open bigint, categories string, attributes struct<wifi: string>, hours struct<monday: string>"
)
REVIEW = (
    "review_id string, user_id string, business_id string, stars double, useful bigint, "
    "funny bigint, cool bigint, text string, date string, date_ts timestamp_ntz"
)


def place(key="p1", name="A", stars=4.0, reviews=10, categories="Food", city="Philadelphia",
          state="PA", attributes=("free",)):
    return (key, name, "1 Main St", city, state, "19100", 39.9, -75.1, stars, reviews, 1,
            categories, attributes, None)


def review(key="r1", user="u1", business="p1", stars=5.0, text="fine",
           day="2020-05-17 10:11:12", ts=None):
    return (key, user, business, stars, 1, 2, 3, text, day, ts)


def readings(spark, *records):
    frame = spark.createDataFrame([(r,) for r in records], "text string")
    return frame.select(F.parse_json("text").alias("raw_data"))


def reading(key="p1", time="2026-03-16T21:05:30.5", more='"currentSpeed": 30, "freeFlowSpeed": 40'):
    return (f'{{"BUSINESS_ID": "{key}", "coord": "39.95,-75.16", "city": "X", '
            f'"timestamp": "{time}"{", " + more if more else ""}}}')


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- places ----------------------------------------------------------------


def test_missing_rating_ranks_before_any_other(spark):
    raw = spark.createDataFrame([place(stars=5.0), place(stars=None, name="B")], PLACE)
    assert values(entity_clean(raw), "business_name", "business_stars") == [("B", None)]


def test_best_row_by_stars_then_reviews_then_name(spark):
    raw = spark.createDataFrame([
        place("p1", "B", 4.5, 10), place("p1", "A", 4.5, 10), place("p1", "C", 4.5, 9),
        place("p1", "D", 4.0, 99), place("p2", None, 3.0, 1), place("p2", "Z", 3.0, 1),
        place(None, "nobody"),
    ], PLACE)
    assert values(entity_clean(raw), "business_id", "business_name") == [("p1", "A"), ("p2", "Z")]


def test_nested_columns_pass_through(spark):
    raw = spark.createDataFrame([place()], PLACE)
    row = entity_clean(raw).first()
    assert row.attributes.wifi == "free" and row.hours is None


@pytest.mark.parametrize("text, expected", [
    ("Barbers, Hair Salons", "Food & Restaurants"),  # "Bar" comes first
    ("RESTAURANTS", "Food & Restaurants"),
    ("Doctors", "Health & Medical"),
    ("Gas Stations", "Automotive"),
    ("Nail Salons", "Beauty & Personal Care"),
    ("Department Stores", "Retail & Shopping"),
    ("plumbing", "Home Services"),
    ("Gyms", "Fitness"),
    ("Colleges", "Education"),
    ("Insurance", "Financial Services"),
    ("Tours", "Travel & Hospitality"),
    ("Museums", "Entertainment"),
    ("Spanish", "Beauty & Personal Care"),  # "Spa" inside a word
    ("Laundry", "Other"),
    ("", "Other"),
    (None, "Other"),
])
def test_first_matching_class_wins(spark, text, expected):
    df = spark.createDataFrame([(text,)], "c string")
    assert classify(df, "c", "label").first().label == expected


def test_classes_without_rules(spark):
    df = spark.createDataFrame([("Food",)], "c string")
    assert classify(df, "c", "label", ()).first().label == "Other"


def test_missing_categories_read_unknown_but_class_is_other(spark):
    raw = spark.createDataFrame([place(categories=None)], PLACE)
    assert values(entity_clean(raw), "categories", "primary_category") == [("Unknown", "Other")]


def test_regional_top_keeps_five_per_class(spark):
    rows = [place(f"p{i}", f"N{i}", float(i % 5), i) for i in range(20)]
    rows += [place("far", "far", 5.0, 999, city="Pittsburgh"), place("nj", "nj", 5.0, 999, state="NJ")]
    rows += [place("gym", "gym", 5.0, 999, categories="Gym")]
    rows += [place("spa", "spa", None, 1, categories="Spa", city="North PHILADELPHIA")]
    top = regional_top(entity_clean(spark.createDataFrame(rows, PLACE)))
    assert values(top, "primary_category", "rank_in_category", "business_id") == [
        ("Beauty & Personal Care", 1, "spa"),
        ("Food & Restaurants", 1, "p19"), ("Food & Restaurants", 2, "p14"),
        ("Food & Restaurants", 3, "p9"), ("Food & Restaurants", 4, "p4"),
        ("Food & Restaurants", 5, "p18"),
    ]


# --- reviews ---------------------------------------------------------------


def test_review_date_parts(spark):
    raw = spark.createDataFrame([review()], REVIEW)
    columns = ("review_timestamp", "review_date", "review_month", "review_year")
    clean = review_clean(raw)
    assert values(clean, *columns) == [
        (datetime(2020, 5, 17, 10, 11, 12), date(2020, 5, 17), datetime(2020, 5, 1), 2020)]
    assert dict(clean.dtypes)["review_month"] == "timestamp_ntz"


def test_typed_timestamp_goes_before_text(spark):
    raw = spark.createDataFrame([review(ts=datetime(2021, 1, 2))], REVIEW)
    assert values(review_clean(raw), "review_date") == [(date(2021, 1, 2),)]


def test_newest_review_wins_and_needs_all_keys(spark):
    raw = spark.createDataFrame([
        review(day="2020-01-01 00:00:00", text="old"), review(day="2020-01-02 00:00:00", text="new"),
        review("r2", user=None), review("r3", business=None), review(None),
    ], REVIEW)
    assert values(review_clean(raw), "review_id", "review_text") == [("r1", "new")]


def test_bad_date_is_null_and_counted(spark):
    raw = spark.createDataFrame([review(day="last week"), review("r2"), review("r3", day=None)], REVIEW)
    assert values(review_clean(raw), "review_id", "review_date") == [
        ("r1", None), ("r2", date(2020, 5, 17)), ("r3", None)]
    profile = profiling.null_profile(raw, ["date", "date_ts"], ["date"]).first()
    assert profile.asDict() == {
        "total_rows": 3, "missing_date": 1, "missing_date_ts": 3, "rejected_date": 1}


def test_review_without_time_counts_as_newest(spark):
    raw = spark.createDataFrame([review(text="dated"), review(day=None, text="undated")], REVIEW)
    assert values(review_clean(raw), "review_text") == [("undated",)]


def test_equal_rows_give_the_same_choice_in_any_order(spark):
    rows = [review(text=t, stars=s) for t in "bca" for s in (2.0, 1.0, None)]
    kept = {
        tuple(review_clean(spark.createDataFrame(order, REVIEW).repartition(n)).first())
        for n, order in ((1, rows), (3, rows[::-1]), (5, rows[4:] + rows[:4]))
    }
    assert len(kept) == 1


# --- check-ins -------------------------------------------------------------


def checkin(spark, *rows):
    return spark.createDataFrame(list(rows), "business_id string, date string")


def test_checkin_estimate_differs_from_events(spark):
    raw = checkin(spark, ("p1", "2020-01-01 10:00:00,2020-01-02 11:00:00,"))
    assert values(checkin_summary(raw), "checkin_count_est") == [(3,)]
    assert checkin_events(raw).count() == 2


def test_checkin_summary(spark):
    raw = checkin(spark, ("p1", " a,b "), ("p1", "a,b"), ("p1", None), ("p1", "  "), (None, "a"))
    assert values(checkin_summary(raw), "checkin_raw", "checkin_count_est") == [
        ("", 0), ("a,b", 2), (None, 0)]


def test_checkin_events(spark):
    raw = checkin(
        spark,
        ("p1", "2020-01-01 10:00:00, 2020-01-02 11:00:00, 2020-01-01 10:00:00"),
        ("p1", "2020-01-01 10:00:00"), ("p2", " ,, "), ("p3", None), (None, "2020-01-01 10:00:00"),
        ("p4", "2020-02-03"), ("p5", "soon,later"),
    )
    events = checkin_events(raw)
    assert values(events, "business_id", "checkin_time", "checkin_date", "checkin_month") == [
        ("p1", datetime(2020, 1, 1, 10), date(2020, 1, 1), date(2020, 1, 1)),
        ("p1", datetime(2020, 1, 2, 11), date(2020, 1, 2), date(2020, 1, 1)),
        ("p4", datetime(2020, 2, 3), date(2020, 2, 3), date(2020, 2, 1)),
        ("p5", None, None, None),
    ]
    assert dict(events.dtypes)["checkin_month"] == "date"


def test_checkin_rejects_is_one_row_without_a_join(spark):
    raw = checkin(
        spark, ("p1", "2020-01-01 10:00:00, soon, "), ("p2", " ,, "), ("p3", None), (None, "2020-01-01"), (None, None))
    unread = checkin(spark, ("p1", None), (None, "soon"))
    for rows, want in ((raw, (5, 2, 2, 2, 1)), (unread, (2, 1, 1, 0, 0)), (raw.limit(0), (0, 0, 0, 0, 0))):
        found = checkin_rejects(rows)
        assert [tuple(r) for r in found.collect()] == [want]
        assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_raw_duplicates_do_not_change_clean_tables(spark):
    places = spark.createDataFrame([place(), place("p2", "B", None)], PLACE)
    reviews = spark.createDataFrame([review(), review("r2")], REVIEW)
    lists = checkin(spark, ("p1", "2020-01-01 10:00:00"))
    for raw, clean in ((places, entity_clean), (reviews, review_clean),
                       (lists, checkin_events), (lists, checkin_summary)):
        assert sorted(clean(raw.union(raw)).collect(), key=repr) == sorted(clean(raw).collect(), key=repr)


# --- readings --------------------------------------------------------------


def test_typed_reading(spark):
    more = ('"frc": "FRC3", "confidence": 0.97, "roadClosure": false, "currentSpeed": 30.5, '
            '"freeFlowSpeed": 40, "currentTravelTime": 100, "freeFlowTravelTime": 75')
    row = readings_typed(readings(spark, reading(more=more))).first().asDict()
    assert row == {
        "business_id": "p1", "lat": 39.95, "lon": -75.16, "city": "X", "road_class": "FRC3",
        "data_confidence": 0.97, "is_closed": False, "current_speed": 31, "free_flow_speed": 40,
        "current_travel_time": 100, "free_flow_travel_time": 75, "speed_ratio": 30.5 / 40,
        "event_time_utc": datetime(2026, 3, 16, 21, 5, 30, 500000),
        "event_time": datetime(2026, 3, 16, 17, 5, 30, 500000),
    }


def test_other_years_and_lower_case_keys_are_left_out(spark):
    raw = readings(
        spark, reading("old", "2025-12-31T23:59:59"), reading("next", "2027-01-01T00:00:00"),
        reading("first", "2026-01-01T00:00:00"), reading("last", "2026-12-31T23:59:59.999999"),
        '{"business_id": "lower", "timestamp": "2026-05-05T00:00:00"}',
        '{"BUSINESS_ID": "timeless"}', '{"BUSINESS_ID": "bad", "timestamp": "2026-05"}',
        '{"BUSINESS_ID": "worse", "timestamp": "2026-99-99"}',
    )
    # "2026-05" is a valid text for the first of May
    assert values(readings_typed(raw), "business_id") == [("bad",), ("first",), ("last",)]
    # a reading without a time that can be read has no place in the order, whatever the year
    assert values(readings_typed(raw, year=None), "business_id") == [
        ("bad",), ("first",), ("last",), ("next",), ("old",)]


@pytest.mark.parametrize("coord, lat, lon", [
    ("39.95,-75.16", 39.95, -75.16), ("39.95", 39.95, None), ("", None, None),
    ("x, 1", None, 1.0), ("1,2,3", 1.0, 2.0),
])
def test_coordinates(spark, coord, lat, lon):
    raw = readings(spark, f'{{"BUSINESS_ID": "p", "timestamp": "2026-01-02", "coord": "{coord}"}}')
    assert values(readings_typed(raw), "lat", "lon") == [(lat, lon)]


@pytest.mark.parametrize("more, ratio", [
    ('"currentSpeed": 30, "freeFlowSpeed": 0', None), ('"currentSpeed": 30', None),
    ('"freeFlowSpeed": 30', None), ('"currentSpeed": "30", "freeFlowSpeed": 40', 0.75),
    ('"currentSpeed": 0, "freeFlowSpeed": 40', 0.0), ('"currentSpeed": "n/a", "freeFlowSpeed": 4', None),
])
def test_speed_ratio(spark, more, ratio):
    assert values(readings_typed(readings(spark, reading(more=more))), "speed_ratio") == [(ratio,)]


def test_latest_across_the_autumn_clock_change(spark):
    raw = readings(spark, reading(time="2026-11-01T05:40:00", more='"currentSpeed": 1'),
                   reading(time="2026-11-01T06:20:00", more='"currentSpeed": 2'))
    assert values(readings_latest(raw), "current_speed", "event_time") == [
        (2, datetime(2026, 11, 1, 1, 20))]


def test_failed_poll_can_be_latest_unless_a_metric_is_required(spark):
    raw = readings(spark, reading(time="2026-03-16T20:00:00"),
                   reading(time="2026-03-16T20:20:00", more=""))
    assert values(readings_latest(raw), "current_speed") == [(None,)]
    assert values(readings_latest(raw, require_metric=True), "current_speed") == [(30,)]


def test_report_rounds_and_shows_pacific_time(spark):
    raw = readings(
        spark, reading("p1", "2026-07-01T12:00:00", '"currentSpeed": 1, "freeFlowSpeed": 3'),
        reading("p2", "2026-07-01T13:00:00", '"currentSpeed": 1, "freeFlowSpeed": 8'))
    report = latest_report(readings_latest(raw)).collect()
    assert [tuple(r) for r in report] == [
        ("p2", 1, 0.13, datetime(2026, 7, 1, 6)), ("p1", 1, 0.33, datetime(2026, 7, 1, 5))]


def test_views_follow_the_raw_data(spark):
    register_views(readings(spark, reading(), reading(time="2026-03-16T22:00:00")))
    assert spark.table("readings_final").count() == 2
    assert spark.sql("SELECT hour(event_time) h FROM readings_latest").first().h == 18


# --- building blocks -------------------------------------------------------


@pytest.mark.parametrize("number, expected", [(2.5, 3), (-2.5, -3), (2.4, 2), (None, None)])
def test_whole_numbers_round_halves_away_from_zero(spark, number, expected):
    df = spark.createDataFrame([(number,)], "x double")
    assert df.select(S.whole_number(F.col("x"))).first()[0] == expected


@pytest.mark.parametrize("text, expected", [
    ("2020-01-01 10:00:00", datetime(2020, 1, 1, 10)), (" 2020-01-01 ", datetime(2020, 1, 1)),
    ("2026-03-16T21:05:30.123456", datetime(2026, 3, 16, 21, 5, 30, 123456)),
    ("2020-13-01", None), ("", None), (None, None),
])
def test_parse_timestamp(spark, text, expected):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(S.parse_timestamp(F.col("x"))).first()[0] == expected


def test_results_do_not_depend_on_the_session_zone(spark):
    def run():
        raw = spark.createDataFrame([review(day="2021-03-14 02:30:00")], REVIEW)
        return review_clean(raw).selectExpr("cast(review_timestamp as string)",
                                            "cast(review_month as string)").first()

    utc = run()
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist there on that day
        assert run() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_null_order(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert [r.x for r in df.orderBy(desc("x")).collect()] == [None, 2, 1]
    assert [r.x for r in df.orderBy(asc("x")).collect()] == [1, 2, None]


def test_ties_skip_what_cannot_be_compared(spark):
    df = spark.sql("SELECT 1 AS a, map(1, 2) AS m, parse_json('1') AS v, "
                   "struct(1 AS x) AS s, array(1) AS r, 1 AS `d.e`")
    assert tie_columns(df, ["a"]) == ["`s`", "`r`", "`d.e`"]
    assert ranking.keep_first(df, ["a"], []).count() == 1


def test_point_keys_pair_up_to_the_shorter_list(spark):
    points = joins.point_keys(spark, ["1,1", "2,2", "3,3"], ["a", "b"])
    polls = spark.createDataFrame([("1,1", 5), ("3,3", 6)], "coord string, v int")
    assert values(joins.attach_key(polls, points, "coord", 2), "coord", "v", "business_id") == [
        ("1,1", 5, "a")]


def test_top_with_latest_keeps_places_without_readings(spark):
    top = spark.createDataFrame([("a", 1), ("b", 2)], "business_id string, rank int")
    log = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("c", 3, 30)],
                                "business_id string, ts int, v int")
    mine = joins.only_keys_of(log, top, "business_id", 2)
    latest = ranking.latest_per_key(mine, "business_id", "ts")
    for rows in (2, None, 10**9):
        joined = joins.attach_latest(top, latest, "business_id", rows)
        assert values(joined, "business_id", "v") == [("a", 20), ("b", None)]


def test_regional_top_with_latest_reading(spark):
    clean = entity_clean(spark.createDataFrame(
        [place("p1", stars=5.0), place("p2", stars=4.0), place("far", city="Pittsburgh")], PLACE))
    raw = readings(spark, reading("p1", "2026-03-01T00:00:00", '"currentSpeed": 1'),
                   reading("p1", "2026-03-02T00:00:00", '"currentSpeed": 2'), reading("far"))
    joined = regional_top_with_latest(clean, raw)
    assert values(joined, "business_id", "rank_in_category", "city", "current_speed") == [
        ("p1", 1, "Philadelphia", 2), ("p2", 2, "Philadelphia", None)]


def test_minute_buckets_newest_first(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 1, 1, 10, m, s),) for m in range(30) for s in (1, 59)], "ts timestamp_ntz")
    rows = profiling.minute_buckets(df, "ts", 3).collect()
    assert [(r.time_bucket.minute, r.row_count) for r in rows] == [(29, 2), (28, 2), (27, 2)]
    assert profiling.minute_buckets(df, "ts", None).count() == 30


def test_split_is_not_a_pattern(spark):
    df = spark.createDataFrame([("a|b.c|",)], "x string")
    assert [r.i for r in joins.explode_list(df, "x", "i", "|").collect()] == ["a", "b.c"]
    assert df.select(S.delimited_count(F.col("x"), ".")).first()[0] == 2


def test_readings_without_a_time_are_left_out_of_batch_and_stream(spark):
    from placewell.streaming.latest import latest_state

    rows = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("b", None, 3)], "k string, t long, v int")
    assert [tuple(r) for r in latest_state(rows, "k", "t").collect()] == [("a", 5, 2)]


def test_halves_lose_no_null(spark):
    from placewell.registry.queries import _halves

    rows = spark.createDataFrame([(1,), (20,), (None,)], "x int")
    low, rest = _halves(rows, "x < 13")
    assert low.count() == 1 and rest.count() == 2


def test_fold_before_the_first_change(spark, folder):
    from placewell.streaming.latest import fold_changes

    assert fold_changes(spark, folder, "k", "t") == -1


def test_whole_results_are_delivered(spark, folder, capsys):
    from placewell.__main__ import deliver

    deliver(spark.range(150), None)
    assert "\n149\n" in capsys.readouterr().out
    deliver(spark.range(150), f"{folder}/out")
    assert "150 rows" in capsys.readouterr().out
