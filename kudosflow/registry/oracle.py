"""The registered queries again, as SQL for an independent engine."""

from __future__ import annotations

# The review tables built from the sales tables, as in the views module.
_TABLES = """
WITH businesses AS (
    SELECT p_partkey AS business_id, p_name AS name, CAST(p_size AS DOUBLE) / 10 AS stars,
           p_partkey % 100 AS review_count, p_brand AS state, p_type AS city,
           nullif(p_type, 'ECONOMY') AS categories
    FROM part),
users AS (
    SELECT nullif(c_custkey, 30) AS user_id, nullif(c_name, 'Customer#000000044') AS name, c_mktsegment AS yelping_since,
           c_custkey % 60 AS review_count,
           CAST(100 + (c_custkey * 7) % 401 AS DOUBLE) / CAST(100 AS DOUBLE) AS average_stars,
           c_custkey % 37 AS useful
    FROM customer),
reviews AS (
    SELECT l_orderkey * 10 + l_linenumber AS review_id, nullif(o_custkey, 30) AS user_id,
           l_partkey AS business_id, CAST(least(l_linenumber, 5) AS DOUBLE) AS stars,
           concat(l_returnflag, l_linestatus) AS review_text, l_shipdate AS date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
top_rated AS (
    SELECT name, stars, review_count, state, city, categories, business_id
    FROM businesses WHERE stars >= 3.5 AND review_count >= 50),
engaged AS (
    SELECT * FROM users
    WHERE review_count > 25 AND average_stars BETWEEN CAST(2.49 AS DOUBLE) AND CAST(4.01 AS DOUBLE)
      AND CAST(review_count AS DOUBLE) / nullif(useful, 0) < 2),
by_engaged AS (
    SELECT r.user_id, review_id, business_id, stars, review_text, date AS review_date,
           name AS username, average_stars AS user_average_stars, useful
    FROM reviews r JOIN engaged u ON r.user_id IS NOT DISTINCT FROM u.user_id),
five_stars AS (SELECT * FROM by_engaged WHERE stars = 5),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY business_id
        ORDER BY useful DESC NULLS LAST, review_id NULLS FIRST, username NULLS FIRST,
                 review_date NULLS FIRST, review_text NULLS FIRST,
                 user_average_stars NULLS FIRST) AS row
    FROM five_stars),
best AS (SELECT * EXCLUDE (row) FROM ranked WHERE row = 1)
"""

_EVENTS = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props
FROM events
"""
_MISFITS = """
WITH written AS (
    SELECT event_id, user_id, event_type, event_id % 10 AS number,
           CASE WHEN event_id % 10 < 3 THEN 'User_ID' WHEN event_id % 10 < 5 THEN 'USER_ID'
                ELSE 'user_id' END AS spelled,
           CASE event_id % 10 WHEN 7 THEN '"u' || user_id || '"' WHEN 8 THEN user_id || '.5'
                ELSE CAST(user_id AS VARCHAR) END AS value
    FROM events)
SELECT event_id, CASE WHEN number NOT IN (7, 8) THEN user_id END AS user_id,
       CASE WHEN number IN (7, 8) THEN '{"Event_Id":' || event_id || ',"' || spelled || '":'
            || value || ',"event_type":"' || event_type || '"}' END AS _corrupt_record,
       event_type
FROM written
"""
_COUNTS = "CAST(len(string_split(text, ',')) AS INTEGER) AS checkin_count FROM documents"
_REVIEWED = """
SELECT business_id, name, city, state, stars FROM top_rated
WHERE business_id IN (SELECT r.business_id FROM reviews r JOIN engaged u USING (user_id)
                      WHERE r.stars = 5)
"""
_LEFT_JOIN = """
SELECT t.*, b.review_id, b.username
FROM top_rated t LEFT JOIN best b ON t.business_id = b.business_id
"""


def oracle_sql() -> dict[str, str]:
    plain = {
        "ingest_json": _EVENTS,
        "ingest_json_inferred": _EVENTS,
        "ingest_json_passthrough": _EVENTS,
        "ingest_json_misfit": _MISFITS,
        "checkin_count": f"SELECT doc_id, {_COUNTS}",
        "silver_checkin_count": f"SELECT doc_id, text AS date, {_COUNTS}",
    }
    over_reviews = {
        "partitioned_roundtrip": "SELECT * FROM reviews",
        "partition_pruned_scan": "SELECT * FROM reviews WHERE stars = 5",
        "schema_merge_overwrite": "SELECT *, CAST(NULL AS VARCHAR) AS extra FROM reviews",
        "external_table_replace": "SELECT * FROM top_rated",
        "project_columns": "SELECT name, stars, state, business_id FROM businesses",
        "drop_rename": "SELECT * FROM reviews",
        "range_filter": """SELECT * FROM users
            WHERE average_stars BETWEEN CAST(2.49 AS DOUBLE) AND CAST(4.01 AS DOUBLE)""",
        "ratio_filter": """SELECT * FROM users
            WHERE CAST(review_count AS DOUBLE) / nullif(useful, 0) < 2""",
        "drop_any_null": "SELECT * FROM businesses WHERE categories IS NOT NULL",
        "drop_null_subset": """SELECT * REPLACE (nullif(city, 'PROMO') AS city) FROM businesses
            WHERE categories IS NOT NULL AND review_count % 7 <> 0""",
        "null_safe_join": "SELECT * FROM by_engaged",
        "using_join": "SELECT * FROM by_engaged WHERE user_id IS NOT NULL",
        "join_filter_literal": "SELECT * FROM five_stars",
        "left_join": _LEFT_JOIN,
        "left_join_drop_null": f"""SELECT * FROM ({_LEFT_JOIN})
            WHERE categories IS NOT NULL AND review_id IS NOT NULL AND username IS NOT NULL""",
        "semi_join_in": """SELECT * FROM businesses
            WHERE business_id IN (SELECT business_id FROM five_stars)""",
        "distinct_keys": "SELECT DISTINCT business_id FROM reviews",
        "row_number_rank": """SELECT * REPLACE (nullif(useful, 20) AS useful, row_number() OVER (
                PARTITION BY business_id
                ORDER BY nullif(useful, 20) DESC NULLS LAST, review_id NULLS FIRST,
                    username NULLS FIRST, review_date NULLS FIRST, review_text NULLS FIRST,
                    user_average_stars NULLS FIRST) AS row)
            FROM ranked""",
        "top1_per_group": "SELECT * FROM best",
        "silver_engaged_users": "SELECT * FROM engaged",
        "silver_top_rated": "SELECT * FROM top_rated",
        "silver_user_review": "SELECT * FROM reviews",
        "gold_best_review": """
            SELECT t.business_id, name, stars, review_count, state, city, categories, username,
                   user_average_stars, useful, review_text, review_id, review_date
            FROM top_rated t
            JOIN (SELECT * EXCLUDE (stars) FROM best) b ON t.business_id = b.business_id
            WHERE categories IS NOT NULL AND username IS NOT NULL""",
        "gold_reviewed_by_engaged": _REVIEWED,
        "gold_reviewed_by_engaged_sql": _REVIEWED,
        "cached_view_semi": _REVIEWED,
    }
    return plain | {name: _TABLES + query for name, query in over_reviews.items()}
