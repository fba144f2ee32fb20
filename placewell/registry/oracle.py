"""The same questions in plain SQL, for an independent check of every query."""

from __future__ import annotations

from placewell.registry.inputs import PAYLOAD_COLUMNS, PLACE_COLUMNS, REVIEW_COLUMNS, TABLES


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in columns.items())


LABELLED = "documents LEFT JOIN labels USING (doc_id)"
K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

# The class labels and their keywords, in order of precedence.
CLASSES = """
    (VALUES (1, 'Food & Restaurants', 'restaurant|food|coffee|bar|pizza'),
            (2, 'Health & Medical', 'health|medical|doctor|dentist'),
            (3, 'Automotive', 'automotive|gas station|auto'),
            (4, 'Beauty & Personal Care', 'beauty|hair|nail|spa'),
            (5, 'Retail & Shopping', 'shopping|store'),
            (6, 'Home Services', 'home services|plumbing|contractor'),
            (7, 'Fitness', 'fitness|gym|yoga'),
            (8, 'Education', 'education|school|college'),
            (9, 'Financial Services', 'financial|bank|insurance'),
            (10, 'Travel & Hospitality', 'hotel|travel|tour'),
            (11, 'Entertainment', 'entertainment|museum|cinema')) AS classes (place, label, words)
"""

ENTITY = f"""
    SELECT best.* EXCLUDE (raw_categories),
           coalesce((SELECT arg_min(label, place) FROM {CLASSES}
                     WHERE regexp_matches(best.raw_categories, words, 'i')), 'Other')
             AS primary_category
    FROM (SELECT DISTINCT ON (business_id)
                 * EXCLUDE (categories) RENAME (name AS business_name, stars AS business_stars),
                 coalesce(categories, 'Unknown') AS categories,
                 categories AS raw_categories
          FROM (SELECT {_select(PLACE_COLUMNS)}, p_brand AS brand FROM part)
          WHERE business_id IS NOT NULL
          ORDER BY business_id, stars DESC NULLS FIRST, review_count DESC NULLS FIRST,
                   name NULLS LAST, address) AS best
"""

REGIONAL = f"""
    SELECT * FROM (
      SELECT business_id, business_name, address, city, state, postal_code, latitude, longitude,
             primary_category, business_stars, review_count,
             CAST(row_number() OVER (PARTITION BY primary_category
               ORDER BY business_stars DESC NULLS FIRST, review_count DESC NULLS FIRST,
                        business_name NULLS LAST, business_id) AS INTEGER) AS rank_in_category
      FROM ({ENTITY})
      WHERE city ILIKE '%philadel%' AND state = 'PA' AND primary_category IN
        ('Food & Restaurants', 'Beauty & Personal Care', 'Health & Medical',
         'Retail & Shopping', 'Home Services'))
    WHERE rank_in_category <= 5
"""

REVIEW = f"""
    SELECT *, CAST(review_timestamp AS DATE) AS review_date,
           CAST(date_trunc('month', review_timestamp) AS TIMESTAMP) AS review_month,
           CAST(year(review_timestamp) AS INTEGER) AS review_year
    FROM (SELECT DISTINCT ON (review_id)
                 * EXCLUDE (date, date_ts) RENAME (stars AS review_stars, text AS review_text),
                 coalesce(date_ts, CAST(date AS TIMESTAMP)) AS review_timestamp
          FROM (SELECT {_select(REVIEW_COLUMNS)},
                       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS date FROM lineitem)
          WHERE review_id IS NOT NULL AND user_id IS NOT NULL AND business_id IS NOT NULL
          ORDER BY review_id, coalesce(date_ts, CAST(date AS TIMESTAMP)) DESC NULLS FIRST,
                   user_id, business_id, stars, useful, funny, cool, text)
"""

_NOW = "strftime(ts, '%Y-%m-%d %H:00:00')"
_LATER = "strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d %H:00:00')"
CHECKIN = f"""
    SELECT CAST(user_id AS VARCHAR) AS business_id,
           CASE event_type WHEN 'view' THEN concat({_NOW}, ', ', {_LATER}, ', ', {_NOW})
                WHEN 'click' THEN concat(' ', {_NOW}, ', ,', {_LATER}, ', ')
                WHEN 'signup' THEN concat({_NOW}, ',')
                WHEN 'error' THEN '  ' END AS date
    FROM events
"""

CHECKIN_EVENTS = f"""
    SELECT DISTINCT business_id, checkin_time, CAST(checkin_time AS DATE) AS checkin_date,
           CAST(date_trunc('month', checkin_time) AS DATE) AS checkin_month
    FROM (SELECT business_id, CAST(trim(entry, ' ') AS TIMESTAMP) AS checkin_time
          FROM (SELECT business_id, unnest(string_split(date, ',')) AS entry FROM ({CHECKIN}))
          WHERE trim(entry, ' ') <> '')
"""

def _readings(key: str, events: str) -> str:
    return f"""
    SELECT BUSINESS_ID AS business_id, value AS lat,
           CASE WHEN frc <> 'click' THEN CAST(event_id AS DOUBLE) END AS lon,
           city, frc AS road_class, confidence AS data_confidence, roadClosure AS is_closed,
           CAST(round(currentSpeed) AS BIGINT) AS current_speed, k AS free_flow_speed,
           currentTravelTime AS current_travel_time,
           CAST(NULL AS BIGINT) AS free_flow_travel_time,
           currentSpeed / nullif(CAST(k AS DOUBLE), 0) AS speed_ratio,
           ts AS event_time_utc,
           (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS event_time
    FROM (SELECT {_select(PAYLOAD_COLUMNS | {"BUSINESS_ID": key})}, {K} AS k, value, event_id, ts FROM {events})
    WHERE BUSINESS_ID IS NOT NULL AND strftime(ts, '%Y-%m-%d') LIKE '2024-%'
"""


def _latest(readings: str) -> str:
    return f"""
    SELECT * EXCLUDE (event_time_utc, pick)
    FROM (SELECT *, row_number() OVER (PARTITION BY business_id
                                       ORDER BY event_time_utc DESC) AS pick FROM ({readings}))
    WHERE pick = 1
"""


READINGS = _readings(PAYLOAD_COLUMNS["BUSINESS_ID"], "events")
READINGS_LATEST = _latest(READINGS)
PLACE_LATEST = _latest(_readings(PLACE_COLUMNS["business_id"], "events LEFT JOIN part ON event_id = p_partkey"))

LATEST_EVENT = """
    SELECT * EXCLUDE (pick)
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST) AS pick
          FROM events)
    WHERE pick = 1
"""

ORACLE = {
    "json_inferred_ingest": "SELECT * FROM part",
    "json_schema_ingest": """
        SELECT event_id, user_id, event_type, value,
               strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS date, ts AS date_ts FROM events""",
    "json_rescued_fields": """
        SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN user_id END AS user_id,
               CASE WHEN event_type = 'error' THEN value END AS code,
               (event_type = 'click' AND user_id IS NOT NULL) OR (event_type = 'error' AND value IS NOT NULL) AS has_rest
        FROM events""",
    "parquet_overwrite": "SELECT * FROM orders",
    "land_nested_json": f"""
        SELECT CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
               CASE WHEN event_type <> 'error' THEN value END AS value,
               CASE WHEN event_type <> 'error' THEN {K} END AS detail_k,
               concat(user_id, ',', event_id) AS coord, 'Philadelphia' AS city,
               CAST(user_id AS VARCHAR) AS business_id,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
               CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
               CAST(day(ts) AS INTEGER) AS day
        FROM events""",
    "incremental_ingest": "SELECT * FROM events",
    "ingest_backfill": "SELECT * FROM events",
    "ingest_by_name": """
        SELECT s_suppkey, s_name, s_nationkey,
               CASE WHEN s_nationkey < 13 THEN s_acctbal END AS s_acctbal FROM supplier""",
    "ingest_schema_drift": """
        SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey,
               CASE WHEN NOT coalesce(s_nationkey < 13, false) THEN s_acctbal END AS s_acctbal
        FROM supplier""",
    "ingest_skip_bad_files": "SELECT * FROM customer",
    "load_history": """
        SELECT event_type AS kind, 'loaded' AS status, count(*) AS row_count,
               count(*) AS file_rows FROM events GROUP BY event_type""",
    "ingest_first_error": """
        SELECT 'good' AS kind, 'loaded' AS status, CAST(NULL AS VARCHAR) AS first_error, count(*) AS row_count
        FROM customer
        UNION ALL SELECT 'wrong_type', 'skipped', 'column c_acctbal: string instead of double', 0
        UNION ALL SELECT 'nested', 'skipped', 'column c_name: array<string> instead of string', 0
        UNION ALL SELECT 'not_parquet', 'skipped', 'no readable footer', 0""",
    "ingest_compacted": "SELECT * FROM events",
    "variant_landing": f"""
        SELECT event_id, value, event_type, ts, {K} AS k,
               CAST(year(ts) AS INTEGER) AS payload_year FROM events""",
    "stage_file_listing": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in TABLES),
    "select_rename_coalesce": f"""
        SELECT doc_id, lang AS doc_language, source AS doc_source,
               coalesce(CAST(quality AS VARCHAR), 'Unknown') AS doc_quality FROM {LABELLED}""",
    "keyword_classify": """
        SELECT p_partkey, p_name,
               CASE WHEN p_name ILIKE '%ring%' OR p_name ILIKE '%rod%' OR p_name ILIKE '%wid%'
                      THEN 'Round parts'
                    WHEN p_name ILIKE '%bolt%' THEN 'Fasteners'
                    WHEN p_name ILIKE '%gear%' OR p_name ILIKE '%giz%' THEN 'Drive parts'
                    ELSE 'Other' END AS part_class
        FROM part""",
    "region_category_filter": """
        SELECT * FROM customer WHERE c_name ILIKE '%cUSTOMER#%' AND c_nationkey = 7
          AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE')""",
    "not_null_guard": f"""
        SELECT doc_id, quality, toxic FROM {LABELLED} WHERE quality IS NOT NULL""",
    "year_prefix_filter": """
        SELECT * FROM orders WHERE CAST(o_orderdate AS VARCHAR) LIKE '1997-%'""",
    "variant_extract": f"""
        SELECT event_id, {K} AS k_int, CAST({K} AS DOUBLE) AS k_float,
               json_extract_string(props, '$.k') AS k_text,
               CAST(json_extract_string(props, '$.K') AS BIGINT) AS k_other_case
        FROM events""",
    "coord_split": """
        SELECT c_custkey, split_part(c_name, '#', 1) AS part_one,
               TRY_CAST(split_part(c_name, '#', 2) AS DOUBLE) AS part_two,
               TRY_CAST(split_part(c_name, '#', 3) AS DOUBLE) AS part_three
        FROM customer""",
    "safe_ratio": f"""
        SELECT event_id, value / nullif(CAST({K} AS DOUBLE), 0) AS ratio FROM events""",
    "tz_convert": """
        SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS eastern,
               (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS pacific
        FROM events""",
    "date_parts": """
        SELECT o_orderkey, o_orderdate AS order_timestamp, CAST(o_orderdate AS DATE) AS order_date,
               CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS order_month,
               CAST(year(o_orderdate) AS INTEGER) AS order_year,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month_day
        FROM orders""",
    "delimited_count": """
        SELECT doc_id, CASE WHEN text IS NULL OR trim(text, ' ') = '' THEN 0
                            ELSE len(string_split(text, ',')) END AS entry_count
        FROM documents""",
    "explode_delimited": """
        SELECT doc_id, trim(part, ' ') AS entry
        FROM (SELECT doc_id, unnest(string_split(text, ',')) AS part FROM documents)
        WHERE trim(part, ' ') <> ''""",
    "dedup_best_row": """
        SELECT * EXCLUDE (pick) FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_extendedprice DESC NULLS FIRST, l_shipdate NULLS LAST,
                     l_partkey NULLS LAST, l_suppkey NULLS LAST, l_quantity, l_discount, l_tax,
                     l_returnflag, l_linestatus) AS pick
          FROM lineitem)
        WHERE pick = 1""",
    "dedup_newest_row": """
        SELECT * EXCLUDE (pick) FROM (
          SELECT *, row_number() OVER (PARTITION BY event_type, user_id
            ORDER BY ts DESC NULLS FIRST, event_id) AS pick
          FROM events)
        WHERE pick = 1""",
    "dedup_exact": "SELECT DISTINCT trim(text, ' ') AS body FROM documents",
    "top_n_per_group": """
        SELECT * FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY c_mktsegment
            ORDER BY c_acctbal DESC NULLS FIRST, c_name NULLS LAST) AS INTEGER) AS rank_in_segment
          FROM customer)
        WHERE rank_in_segment <= 5""",
    "latest_per_key": LATEST_EVENT,
    "null_profile": f"""
        SELECT count(*) AS total_rows,
               count(*) FILTER (WHERE doc_id IS NULL) AS missing_doc_id,
               count(*) FILTER (WHERE text IS NULL) AS missing_text,
               count(*) FILTER (WHERE quality IS NULL) AS missing_quality,
               count(*) FILTER (WHERE toxic IS NULL) AS missing_toxic,
               count(*) FILTER (WHERE source IS NOT NULL AND TRY_CAST(source AS TIMESTAMP) IS NULL)
                 AS rejected_source
        FROM {LABELLED}""",
    "row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in TABLES),
    "monthly_trend": """
        SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS order_month,
               count(*) AS order_count,
               avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS avg_cents
        FROM orders GROUP BY 1""",
    "minute_buckets": """
        SELECT CAST(date_trunc('minute', ts) AS TIMESTAMP) AS time_bucket, count(*) AS row_count
        FROM events GROUP BY 1 ORDER BY 1 DESC NULLS FIRST LIMIT 20""",
    "category_state_summary": """
        SELECT c_mktsegment, c_nationkey, count(*) AS entity_count,
               avg(CAST(round(c_acctbal * 100) AS BIGINT)) AS avg_stars,
               CAST(sum(c_custkey) AS BIGINT) AS total_reviews
        FROM customer GROUP BY c_mktsegment, c_nationkey""",
    "activity_by_month": """
        SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS activity_month,
               count(*) AS event_count
        FROM orders GROUP BY 1, 2""",
    "limit_preview": "SELECT * FROM part ORDER BY p_partkey NULLS LAST LIMIT 30",
    "point_key_join": """
        SELECT c_custkey, c_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "top_n_with_latest": """
        SELECT b.c_custkey AS custkey, b.c_name, b.c_nationkey, b.c_acctbal, b.c_mktsegment,
               b.rank_in_segment, o.o_orderkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
               o.o_orderpriority
        FROM (SELECT * FROM (
                SELECT *, CAST(row_number() OVER (PARTITION BY c_mktsegment
                  ORDER BY c_acctbal DESC NULLS FIRST, c_name) AS INTEGER) AS rank_in_segment
                FROM customer)
              WHERE rank_in_segment <= 5) b
        LEFT JOIN (SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY o_custkey
                  ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) AS pick FROM orders)
              WHERE pick = 1) o
          ON b.c_custkey = o.o_custkey""",
    "regional_top_live": f"""
        SELECT best.*, latest.* EXCLUDE (business_id, city)
        FROM ({REGIONAL}) best LEFT JOIN ({PLACE_LATEST}) latest USING (business_id)""",
    "entity_clean": ENTITY,
    "regional_top_entities": REGIONAL,
    "review_clean": REVIEW,
    "checkin_summary": f"""
        SELECT DISTINCT business_id, trim(date, ' ') AS checkin_raw,
               CASE WHEN date IS NULL OR trim(date, ' ') = '' THEN 0
                    ELSE len(string_split(trim(date, ' '), ',')) END AS checkin_count_est
        FROM ({CHECKIN}) WHERE business_id IS NOT NULL""",
    "checkin_events": CHECKIN_EVENTS,
    "readings_typed": READINGS,
    "readings_latest": READINGS_LATEST,
    "readings_late_view": READINGS_LATEST,
    "latest_report": f"""
        SELECT business_id, current_speed,
               -- through the text form, so that the value is rounded once, as a decimal
               CAST(round(CAST(CAST(speed_ratio AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE)
                 AS friction_index,
               (event_time AT TIME ZONE 'America/New_York') AT TIME ZONE 'America/Los_Angeles'
                 AS latest_pulse_pst
        FROM ({READINGS_LATEST})""",
    "newest_readings": f"""
        SELECT business_id, event_time_utc, value AS current_speed
        FROM (SELECT CAST(user_id AS VARCHAR) AS business_id, ts AS event_time_utc, value
              FROM events WHERE event_type <> 'error'
                AND strftime(ts, '%Y-%m-%d') LIKE '2024-%')
        ORDER BY event_time_utc DESC NULLS FIRST, business_id LIMIT 10""",
    "review_trend": f"""
        SELECT review_month, count(*) AS review_count, avg(review_stars) AS avg_stars
        FROM ({REVIEW}) GROUP BY review_month""",
    "review_null_profile": f"""
        SELECT count(*) AS total_rows,
               count(*) - count(review_id) AS missing_review_id,
               count(*) - count(user_id) AS missing_user_id,
               count(*) - count(business_id) AS missing_business_id,
               count(*) - count(stars) AS missing_stars,
               count(*) FILTER (WHERE shipped IS NULL) AS missing_date,
               count(*) - count(date_ts) AS missing_date_ts,
               count(*) - count(text) AS missing_text,
               CAST(0 AS BIGINT) AS rejected_date
        FROM (SELECT {_select(REVIEW_COLUMNS)}, l_shipdate AS shipped FROM lineitem)""",
    "place_null_profile": f"""
        SELECT count(*) AS total_rows,
               count(*) - count(business_id) AS missing_business_id,
               count(*) - count(name) AS missing_name,
               count(*) - count(address) AS missing_address,
               count(*) - count(city) AS missing_city,
               count(*) - count(state) AS missing_state,
               count(*) - count(postal_code) AS missing_postal_code,
               count(*) - count(categories) AS missing_categories
        FROM (SELECT {_select(PLACE_COLUMNS)} FROM part)""",
    "checkin_activity": f"""
        SELECT business_id, checkin_month AS activity_month, count(*) AS event_count
        FROM ({CHECKIN_EVENTS}) GROUP BY business_id, checkin_month""",
    "stream_latest_state": LATEST_EVENT,
    "refresh_changed_places": ENTITY,
    "refresh_changed_reviews": REVIEW,
    "refresh_changed_checkins": CHECKIN_EVENTS,
    "checkin_rejects": f"""
        WITH lists AS (SELECT business_id, CASE WHEN business_id = '1' THEN date || ', no time' ELSE date END AS date
                       FROM ({CHECKIN})),
        entries AS (SELECT trim(entry, ' ') AS entry
                    FROM (SELECT unnest(string_split(date, ',')) AS entry FROM lists WHERE business_id IS NOT NULL)
                    WHERE trim(entry, ' ') <> '')
        SELECT (SELECT count(*) FROM lists) AS list_count,
               (SELECT count(*) FROM lists WHERE business_id IS NULL) AS lists_without_place,
               (SELECT count(*) FROM lists WHERE date IS NULL) AS missing_lists,
               (SELECT count(*) FROM entries) AS entry_count,
               (SELECT count(*) FROM entries WHERE TRY_CAST(entry AS TIMESTAMP) IS NULL) AS rejected_entries""",
    "medallion_refresh": f"""
        SELECT 'entity_clean' AS table_name, count(*) AS row_count FROM ({ENTITY})
        UNION ALL SELECT 'regional_top', count(*) FROM ({REGIONAL})
        UNION ALL SELECT 'review_clean', count(*) FROM ({REVIEW})
        UNION ALL SELECT 'checkin_events', count(*) FROM ({CHECKIN_EVENTS})""",
}
