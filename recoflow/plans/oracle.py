"""Oracle SQL (DuckDB dialect) for the relational queries.

Written independently of the Spark code: the adapters below re-derive the raw
review, game and user tables from the driver's views in plain SQL. Spark's
``try_cast`` to boolean trims its input and DuckDB's does not, hence ``trim``;
decimal literals are written as doubles to keep results bit-equal.
"""

from __future__ import annotations

REVIEWS_RAW = """
reviews_raw AS (
  SELECT
    json_extract_string(props, '$.k') AS app_id,
    NULL::VARCHAR AS helpful,
    NULL::VARCHAR AS funny,
    strftime(ts, '%Y-%m-%d') AS date,
    CASE WHEN event_id % 503 = 0 THEN 'on'
         WHEN event_type IN ('view', 'click', 'purchase') THEN 'true'
         ELSE 'false' END AS is_recommended,
    CASE WHEN event_id % 997 = 0 THEN '20000'
         WHEN event_id % 991 = 0 THEN 'bad'
         ELSE CAST(value AS VARCHAR) END AS hours,
    CASE WHEN event_id % 499 = 0 THEN 'x' || CAST(user_id AS VARCHAR)
         ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CAST(event_id AS VARCHAR) AS review_id
  FROM events
)"""

GAMES_RAW = """
games_raw AS (
  SELECT
    CASE WHEN p_partkey % 7 = 3 THEN 'g' || CAST(p_partkey AS VARCHAR)
         ELSE CAST(p_partkey AS VARCHAR) END AS app_id,
    p_name AS title,
    NULL::VARCHAR AS date_release, NULL::VARCHAR AS win, NULL::VARCHAR AS mac,
    NULL::VARCHAR AS linux,
    p_type AS rating,
    CAST(p_partkey * 37 % 104 AS VARCHAR) AS positive_ratio,
    CASE WHEN p_partkey % 11 = 5 THEN NULL
         ELSE CAST(p_partkey * 13 % 5000 AS VARCHAR) END AS user_reviews,
    NULL::VARCHAR AS price_final,
    CASE p_size WHEN 50 THEN '250.00' WHEN 49 THEN '-1.00' WHEN 48 THEN NULL
                WHEN 47 THEN 'n/a' ELSE CAST(p_size - 1 AS VARCHAR) || '.99' END
      AS price_original,
    NULL::VARCHAR AS discount, NULL::VARCHAR AS steam_deck
  FROM part
)"""

USERS_RAW = """
users_raw AS (
  SELECT
    CASE WHEN c_custkey % 5 = 2 THEN 'u' || CAST(c_custkey AS VARCHAR)
         ELSE CAST(c_custkey AS VARCHAR) END AS user_id,
    CAST(c_nationkey AS VARCHAR) AS products,
    CAST(c_custkey % 17 AS VARCHAR) AS reviews
  FROM customer
)"""

TYPED = """
joined AS (
  SELECT r.app_id, r.user_id, r.is_recommended, r.hours, r.date,
         g.price_original, g.positive_ratio, g.user_reviews, g.rating, r.review_id
  FROM reviews_raw r
  JOIN users_raw u ON r.user_id = u.user_id
  JOIN games_raw g ON r.app_id = g.app_id
),
typed AS (
  SELECT *,
    TRY_CAST(app_id AS INTEGER) AS app_id_int,
    TRY_CAST(user_id AS INTEGER) AS user_id_int,
    CAST(TRY_CAST(trim(is_recommended) AS BOOLEAN) AS DOUBLE) AS is_recommended_label,
    TRY_CAST(hours AS DOUBLE) AS hours_numeric,
    TRY_CAST(price_original AS DOUBLE) AS price_numeric,
    TRY_CAST(positive_ratio AS DOUBLE) AS positive_ratio_numeric,
    TRY_CAST(user_reviews AS DOUBLE) AS user_reviews_numeric
  FROM joined
),
featured AS (
  SELECT *,
    CASE WHEN price_numeric <= 9.99::DOUBLE THEN 1.0::DOUBLE
         WHEN price_numeric <= 29.99::DOUBLE THEN 2.0::DOUBLE
         ELSE 3.0::DOUBLE END AS price_category,
    positive_ratio_numeric * (user_reviews_numeric / 1000.0::DOUBLE) AS quality_score
  FROM typed
),
complete AS (
  SELECT * FROM featured
  WHERE app_id_int IS NOT NULL AND user_id_int IS NOT NULL
    AND is_recommended_label IS NOT NULL AND NOT isnan(is_recommended_label)
    AND hours_numeric IS NOT NULL AND NOT isnan(hours_numeric)
),
processed AS (
  SELECT * FROM complete
  WHERE hours_numeric >= 0.1::DOUBLE AND hours_numeric <= 10000.0::DOUBLE
    AND price_numeric >= 0.0::DOUBLE AND price_numeric <= 200.0::DOUBLE
    AND positive_ratio_numeric >= 0.0::DOUBLE AND positive_ratio_numeric <= 100.0::DOUBLE
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


ALL_RAW = (REVIEWS_RAW, GAMES_RAW, USERS_RAW)
PROCESSED = ALL_RAW + (TYPED,)

SQL: dict[str, str] = {}

SQL["processed_reviews"] = with_ctes(*PROCESSED, body="SELECT * FROM processed")

HOURS_OR_ZERO = ("CASE WHEN TRY_CAST(hours AS DOUBLE) IS NULL OR isnan(TRY_CAST(hours AS DOUBLE)) "
                 "THEN 0.0::DOUBLE ELSE TRY_CAST(hours AS DOUBLE) END")
LABEL_INT = "CAST(CAST(TRY_CAST(trim(is_recommended) AS BOOLEAN) AS DOUBLE) AS INTEGER)"

SAMPLE = """
sample AS (
  SELECT * FROM reviews_raw
  ORDER BY md5('42:' || review_id), review_id
  LIMIT 5000
)"""

MESSAGES = """
messages AS (
  SELECT CAST(review_id AS BIGINT) AS msg_id,
    CASE WHEN CAST(review_id AS BIGINT) % 1009 = 1 THEN '{bad'
         WHEN CAST(review_id AS BIGINT) % 1013 = 2 THEN '[1,2]'
         WHEN CAST(review_id AS BIGINT) % 1019 = 3 THEN '{}'
         WHEN CAST(review_id AS BIGINT) % 1021 = 4 THEN 'null'
         WHEN CAST(review_id AS BIGINT) % 1031 = 5 THEN '3'
         WHEN CAST(review_id AS BIGINT) % 1033 = 6
           THEN '{"app_id": 12, "user_id": "' || user_id || '", "extra": "x"}'
         ELSE json_object('app_id', app_id, 'user_id', user_id,
                          'is_recommended', is_recommended, 'hours', hours,
                          'date', date)::VARCHAR
    END AS value
  FROM reviews_raw
),
routed AS (
  SELECT msg_id, value,
    CASE WHEN json_valid(value) THEN json_type(value) END AS jtype
  FROM messages
)"""

REQUESTS = """
req AS (
  SELECT r.review_id AS request_id,
    CASE WHEN CAST(r.review_id AS BIGINT) % 10 = 0 THEN NULL
         ELSE TRY_CAST(r.hours AS DOUBLE) END AS hours,
    CASE WHEN CAST(r.review_id AS BIGINT) % 10 = 1 THEN NULL
         ELSE TRY_CAST(g.price_original AS DOUBLE) END AS price,
    CASE WHEN CAST(r.review_id AS BIGINT) % 10 = 2 THEN NULL
         ELSE TRY_CAST(g.positive_ratio AS DOUBLE) END AS positive_ratio,
    TRY_CAST(g.user_reviews AS DOUBLE) AS user_reviews
  FROM reviews_raw r JOIN games_raw g ON r.app_id = g.app_id
)"""

PRICE_CAT = """CASE WHEN {p} <= 9.99::DOUBLE THEN 1.0::DOUBLE
         WHEN {p} <= 29.99::DOUBLE THEN 2.0::DOUBLE ELSE 3.0::DOUBLE END"""

SQL["reviews_column_subset"] = with_ctes(REVIEWS_RAW, body="""
SELECT user_id, app_id, is_recommended, hours, date FROM reviews_raw""")

SQL["reviews_renamed"] = with_ctes(REVIEWS_RAW, body=f"""
SELECT user_id, app_id, {LABEL_INT} AS recommended, {HOURS_OR_ZERO} AS hours,
       date AS timestamp
FROM reviews_raw""")

SQL["games_projected"] = with_ctes(GAMES_RAW, body="SELECT app_id, title, price_final FROM games_raw")

SQL["users_projected"] = with_ctes(USERS_RAW, body="SELECT user_id, products, reviews FROM users_raw")

SQL["ids_typed"] = with_ctes(REVIEWS_RAW, body="""
SELECT review_id, app_id, user_id, TRY_CAST(app_id AS INTEGER) AS app_id_int,
       TRY_CAST(user_id AS INTEGER) AS user_id_int
FROM reviews_raw""")

SQL["label_typed"] = with_ctes(REVIEWS_RAW, body="""
SELECT review_id, is_recommended,
       CAST(TRY_CAST(trim(is_recommended) AS BOOLEAN) AS DOUBLE) AS is_recommended_label,
       TRY_CAST(is_recommended AS DOUBLE) AS label_direct_double
FROM reviews_raw""")

SQL["numerics_typed"] = with_ctes(GAMES_RAW, body="""
SELECT app_id, TRY_CAST(price_original AS DOUBLE) AS price_numeric,
       TRY_CAST(positive_ratio AS DOUBLE) AS positive_ratio_numeric,
       TRY_CAST(user_reviews AS DOUBLE) AS user_reviews_numeric
FROM games_raw""")

SQL["hours_coerced"] = with_ctes(REVIEWS_RAW, body=f"""
SELECT review_id, hours, TRY_CAST(hours AS DOUBLE) AS hours_numeric,
       {HOURS_OR_ZERO} AS hours_or_zero
FROM reviews_raw""")

SQL["price_category"] = with_ctes(GAMES_RAW, body=f"""
SELECT app_id, price_numeric, {PRICE_CAT.format(p="price_numeric")} AS price_category
FROM (SELECT app_id, TRY_CAST(price_original AS DOUBLE) AS price_numeric FROM games_raw)""")

SQL["quality_score"] = with_ctes(GAMES_RAW, body="""
SELECT app_id, positive_ratio_numeric, user_reviews_numeric,
       positive_ratio_numeric * (user_reviews_numeric / 1000.0::DOUBLE) AS quality_score
FROM (SELECT app_id, TRY_CAST(positive_ratio AS DOUBLE) AS positive_ratio_numeric,
             TRY_CAST(user_reviews AS DOUBLE) AS user_reviews_numeric FROM games_raw)""")

SQL["join_users"] = with_ctes(REVIEWS_RAW, USERS_RAW, body="""
SELECT r.user_id, r.app_id, r.helpful, r.funny, r.date, r.is_recommended, r.hours,
       r.review_id, u.products, u.reviews
FROM reviews_raw r JOIN users_raw u ON r.user_id = u.user_id""")

SQL["join_games"] = with_ctes(*ALL_RAW, body="""
SELECT r.app_id, r.user_id, r.helpful, r.funny, r.date, r.is_recommended, r.hours,
       r.review_id, u.products, u.reviews, g.title, g.date_release, g.win, g.mac,
       g.linux, g.rating, g.positive_ratio, g.user_reviews, g.price_final,
       g.price_original, g.discount, g.steam_deck
FROM reviews_raw r
JOIN users_raw u ON r.user_id = u.user_id
JOIN games_raw g ON r.app_id = g.app_id""")

SQL["model_columns"] = with_ctes(*PROCESSED, body="""
SELECT app_id, user_id, is_recommended, hours, date, price_original, positive_ratio,
       user_reviews, rating, review_id
FROM joined""")

SQL["drop_nulls"] = with_ctes(*PROCESSED, body="SELECT * FROM complete")

SQL["range_filtered"] = with_ctes(*PROCESSED, body="""
SELECT * FROM featured
WHERE hours_numeric >= 0.1::DOUBLE AND hours_numeric <= 10000.0::DOUBLE
  AND price_numeric >= 0.0::DOUBLE AND price_numeric <= 200.0::DOUBLE
  AND positive_ratio_numeric >= 0.0::DOUBLE AND positive_ratio_numeric <= 100.0::DOUBLE""")

SQL["feature_complete_keys"] = with_ctes(*PROCESSED, body="""
SELECT review_id FROM processed
WHERE hours_numeric IS NOT NULL AND NOT isnan(hours_numeric)
  AND price_numeric IS NOT NULL AND NOT isnan(price_numeric)
  AND positive_ratio_numeric IS NOT NULL AND NOT isnan(positive_ratio_numeric)
  AND quality_score IS NOT NULL AND NOT isnan(quality_score)
  AND price_category IS NOT NULL AND NOT isnan(price_category)""")

SQL["sample_fixed_size"] = with_ctes(REVIEWS_RAW, SAMPLE, body=f"""
SELECT review_id, user_id, app_id, {LABEL_INT} AS recommended,
       {HOURS_OR_ZERO} AS hours, date AS timestamp
FROM sample""")

SQL["games_in_sample"] = with_ctes(REVIEWS_RAW, GAMES_RAW, body="""
SELECT app_id, title, price_final FROM games_raw
WHERE app_id IN (SELECT app_id FROM reviews_raw)""")

SQL["users_in_sample"] = with_ctes(REVIEWS_RAW, USERS_RAW, body="""
SELECT user_id, products, reviews FROM users_raw
WHERE user_id IN (SELECT user_id FROM reviews_raw)""")

SQL["distinct_ids"] = with_ctes(REVIEWS_RAW, body="""
SELECT * FROM (SELECT DISTINCT 'app_id' AS kind, app_id AS id FROM reviews_raw)
UNION ALL
SELECT * FROM (SELECT DISTINCT 'user_id' AS kind, user_id AS id FROM reviews_raw)""")

SQL["first_n_reviews"] = with_ctes(*PROCESSED, body="""
SELECT * FROM processed
ORDER BY TRY_CAST(review_id AS BIGINT) NULLS LAST, review_id NULLS LAST
LIMIT 500000""")

SQL["trimmed_rows"] = with_ctes(REVIEWS_RAW, body="""
SELECT * FROM reviews_raw
ORDER BY TRY_CAST(review_id AS BIGINT) NULLS LAST, review_id NULLS LAST
LIMIT 4999999""")

SQL["stage_counts"] = with_ctes(*PROCESSED, body="""
SELECT 'reviews' AS stage, count(*) AS rows FROM reviews_raw
UNION ALL SELECT 'users', count(*) FROM users_raw
UNION ALL SELECT 'games', count(*) FROM games_raw
UNION ALL SELECT 'after_joins', count(*) FROM joined
UNION ALL SELECT 'after_null_filter', count(*) FROM complete
UNION ALL SELECT 'final', count(*) FROM processed
UNION ALL SELECT 'lr_rows', least(count(*), 500000) FROM processed
UNION ALL SELECT 'gbt_rows', least(count(*), 750000) FROM processed
UNION ALL SELECT 'als_rows', count(*) FROM processed
  WHERE user_id_int IS NOT NULL AND app_id_int IS NOT NULL
    AND hours_numeric IS NOT NULL AND NOT isnan(hours_numeric)""")

SQL["als_triples"] = with_ctes(*PROCESSED, body="""
SELECT user_id_int AS "user", app_id_int AS item, hours_numeric AS rating
FROM processed
WHERE user_id_int IS NOT NULL AND app_id_int IS NOT NULL
  AND hours_numeric IS NOT NULL AND NOT isnan(hours_numeric)""")

SQL["auc_exact"] = """
WITH s AS (
  SELECT l_extendedprice AS score, CAST(l_returnflag = 'R' AS INTEGER) AS label
  FROM lineitem
  WHERE l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice)
    AND l_returnflag IS NOT NULL
),
g AS (
  SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
  FROM s GROUP BY score
),
c AS (
  SELECT pos, neg,
    COALESCE(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS below
  FROM g
),
t AS (
  SELECT CAST(sum(pos * (2 * below + neg)) AS BIGINT) AS s2,
         CAST(sum(pos) AS BIGINT) AS p, CAST(sum(neg) AS BIGINT) AS n
  FROM c
)
SELECT CAST(s2 AS DOUBLE) / (2.0::DOUBLE * p * n) AS auc, p AS positives, n AS negatives
FROM t"""

SQL["rmse"] = """
SELECT round(sqrt(avg((prediction - label) * (prediction - label))), 9) AS rmse,
       count(*) AS rows
FROM (SELECT l_extendedprice / 1000.0::DOUBLE AS prediction, l_quantity AS label FROM lineitem)
WHERE prediction IS NOT NULL AND label IS NOT NULL
  AND NOT isnan(prediction) AND NOT isnan(label)"""

SQL["review_messages"] = with_ctes(REVIEWS_RAW, body="""
SELECT review_id,
       json_object('app_id', app_id, 'user_id', user_id, 'is_recommended', is_recommended,
                   'hours', hours, 'date', date)::VARCHAR AS value
FROM reviews_raw""")

SQL["message_decoded"] = with_ctes(REVIEWS_RAW, MESSAGES, body=r"""
SELECT msg_id,
       json_extract_string(value, '$.app_id') AS app_id,
       json_extract_string(value, '$.user_id') AS user_id,
       json_extract_string(value, '$.is_recommended') AS is_recommended,
       json_extract_string(value, '$.hours') AS hours,
       json_extract_string(value, '$.date') AS date
FROM routed
WHERE jtype = 'OBJECT' AND NOT regexp_matches(trim(value), '^\{\s*\}$')""")

SQL["messages_quarantined"] = with_ctes(REVIEWS_RAW, MESSAGES, body="""
SELECT msg_id, value,
       CASE WHEN jtype IS NULL THEN 'malformed_json' ELSE 'not_an_object' END AS reason
FROM routed
WHERE jtype IS NULL OR jtype <> 'OBJECT'""")

SQL["request_features"] = with_ctes(REVIEWS_RAW, GAMES_RAW, REQUESTS, body=f"""
SELECT request_id, hours_numeric, price_numeric, positive_ratio_numeric, user_reviews_numeric,
       {PRICE_CAT.format(p="price_numeric")} AS price_category,
       positive_ratio_numeric * (user_reviews_numeric / 1000.0::DOUBLE) AS quality_score
FROM (
  SELECT request_id, hours AS hours_numeric,
         COALESCE(price, 15.0::DOUBLE) AS price_numeric,
         COALESCE(positive_ratio, 75.0::DOUBLE) AS positive_ratio_numeric,
         COALESCE(user_reviews, 100.0::DOUBLE) AS user_reviews_numeric
  FROM req WHERE hours IS NOT NULL AND NOT isnan(hours)
)""")

SQL["requests_rejected"] = with_ctes(REVIEWS_RAW, GAMES_RAW, REQUESTS, body="""
SELECT request_id, 'missing ''hours'' in features' AS reason
FROM req WHERE hours IS NULL OR isnan(hours)""")

SQL["ingest_stream"] = with_ctes(REVIEWS_RAW, MESSAGES, body=r"""
SELECT md5(value) AS msg_key,
       json_extract_string(value, '$.app_id') AS app_id,
       json_extract_string(value, '$.user_id') AS user_id,
       json_extract_string(value, '$.is_recommended') AS is_recommended,
       json_extract_string(value, '$.hours') AS hours,
       json_extract_string(value, '$.date') AS date
FROM routed
WHERE jtype = 'OBJECT' AND NOT regexp_matches(trim(value), '^\{\s*\}$')""")


SQL["join_users_semi"] = with_ctes(REVIEWS_RAW, USERS_RAW, body="""
SELECT * FROM reviews_raw WHERE user_id IN (SELECT user_id FROM users_raw)""")

_MESSAGE_SOURCE = REVIEWS_RAW.replace("reviews_raw AS (", "review_src AS (", 1)
_MESSAGES_FROM_SRC = MESSAGES.replace("FROM reviews_raw", "FROM review_src")
_REVIEWS_FROM_MESSAGES = r"""
reviews_raw AS (
  SELECT json_extract_string(value, '$.app_id') AS app_id,
         NULL::VARCHAR AS helpful, NULL::VARCHAR AS funny,
         json_extract_string(value, '$.date') AS date,
         json_extract_string(value, '$.is_recommended') AS is_recommended,
         json_extract_string(value, '$.hours') AS hours,
         json_extract_string(value, '$.user_id') AS user_id,
         CAST(msg_id AS VARCHAR) AS review_id
  FROM routed
  WHERE jtype = 'OBJECT' AND NOT regexp_matches(trim(value), '^\{\s*\}$')
)"""
SQL["processed_from_messages"] = with_ctes(
    _MESSAGE_SOURCE, _MESSAGES_FROM_SRC, _REVIEWS_FROM_MESSAGES, GAMES_RAW, USERS_RAW, TYPED,
    body="SELECT * FROM processed")

SQL["preprocess_sample"] = with_ctes(REVIEWS_RAW, body=f"""
SELECT review_id, user_id, app_id, {LABEL_INT} AS recommended,
       {HOURS_OR_ZERO} AS hours, date AS timestamp
FROM (SELECT * FROM reviews_raw ORDER BY md5('42:' || review_id), review_id LIMIT 5000000)""")

BY_KEY = "ORDER BY TRY_CAST(review_id AS BIGINT) NULLS LAST, review_id NULLS LAST"

SQL["first_tenth_reviews"] = with_ctes(*PROCESSED, body=f"""
SELECT * EXCLUDE (i) FROM (SELECT *, row_number() OVER ({BY_KEY}) AS i FROM processed)
WHERE i <= (SELECT count(*) // 10 FROM processed)""")

SQL["trimmed_half"] = with_ctes(REVIEWS_RAW, body=f"""
SELECT * EXCLUDE (i) FROM (SELECT *, row_number() OVER ({BY_KEY}) AS i FROM reviews_raw)
WHERE i <= (SELECT count(*) // 2 FROM reviews_raw)""")

SQL["sample_third"] = with_ctes(REVIEWS_RAW, body=f"""
SELECT review_id, user_id, app_id, {LABEL_INT} AS recommended, {HOURS_OR_ZERO} AS hours, date AS timestamp
FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || review_id), review_id) AS i FROM reviews_raw)
WHERE i <= (SELECT count(*) // 3 FROM reviews_raw)""")

SQL["first_n_text_keys"] = with_ctes(REVIEWS_RAW, body="""
SELECT * EXCLUDE (i) FROM (SELECT *, row_number() OVER (ORDER BY md5(user_id) NULLS LAST, CAST(review_id AS BIGINT)) AS i FROM reviews_raw)
WHERE i <= (SELECT count(*) * 2 // 3 FROM reviews_raw)""")

SQL["als_triples_unfiltered"] = with_ctes(*PROCESSED, body="""
SELECT user_id_int AS "user", app_id_int AS item, hours_numeric AS rating FROM typed
WHERE user_id_int IS NOT NULL AND app_id_int IS NOT NULL AND hours_numeric IS NOT NULL AND NOT isnan(hours_numeric)""")

SQL["auc_by_levels"] = SQL["auc_exact"].replace("l_extendedprice AS score", "l_extendedprice - 30000.0::DOUBLE AS score")

OUTCOME = """CASE WHEN app_id_int IS NULL THEN 'missing app_id_int' WHEN user_id_int IS NULL THEN 'missing user_id_int'
            WHEN is_recommended_label IS NULL OR isnan(is_recommended_label) THEN 'missing is_recommended_label'
            WHEN hours_numeric IS NULL OR isnan(hours_numeric) THEN 'missing hours_numeric'
            WHEN NOT (hours_numeric >= 0.1::DOUBLE AND hours_numeric <= 10000.0::DOUBLE) THEN 'implausible hours_numeric'
            WHEN NOT coalesce(price_numeric >= 0.0::DOUBLE AND price_numeric <= 200.0::DOUBLE, false) THEN 'implausible price_numeric'
            WHEN NOT coalesce(positive_ratio_numeric >= 0.0::DOUBLE AND positive_ratio_numeric <= 100.0::DOUBLE, false) THEN 'implausible positive_ratio_numeric'
            ELSE 'accepted' END"""
SQL["rejected_reviews"] = with_ctes(*PROCESSED, body=f"""
SELECT * FROM (SELECT review_id, {OUTCOME} AS reason FROM featured) WHERE reason <> 'accepted'""")
SQL["routed_stage_counts"] = with_ctes(*PROCESSED, body=f"SELECT {OUTCOME} AS outcome, count(*) AS rows FROM featured GROUP BY 1")

SQL["processed_by_date"] = SQL["processed_reviews"]
SQL["csv_round_trip"] = SQL["processed_reviews"]

SQL["landed_with_skipped_files"] = """
SELECT (SELECT count(*) FROM events) AS rows, count(*) AS skipped, CAST(sum(length('no Parquet: ' || event_type) + 1) AS BIGINT) AS skipped_bytes
FROM (SELECT DISTINCT event_type FROM events)"""

SQL["request_scores_checked"] = with_ctes(REVIEWS_RAW, GAMES_RAW, REQUESTS, body="""
SELECT model, request_id, coalesce(CAST(request_id AS BIGINT) % 10 <> 3, true) AS scored, true AS is_probability,
       CASE WHEN CAST(request_id AS BIGINT) % 10 = 3 THEN 'invalid features' END AS reason
FROM req, (VALUES ('M1_LR'), ('M2_GBT')) m(model) WHERE hours IS NOT NULL AND NOT isnan(hours)""")

SQL["train_split_checked"] = with_ctes(*PROCESSED, body="""
SELECT model, count(*) FILTER (NOT held) AS train_rows, count(*) FILTER (held) AS held_out, true AS passed, true AS passed_held_out
FROM (SELECT ('0x' || left(md5(review_id), 8))::BIGINT < CAST(0.2 * 4294967296 AS BIGINT) AS held FROM processed), (VALUES ('M1_LR'), ('M2_GBT')) m(model)
GROUP BY model""")

SQL["feature_vectors"] = with_ctes(*PROCESSED, body="""
SELECT review_id, 5 AS n, hours_numeric, price_numeric, positive_ratio_numeric, quality_score, price_category FROM processed
WHERE quality_score IS NOT NULL AND NOT isnan(quality_score)""")

SQL["class_one_scores"] = "SELECT l_orderkey, l_linenumber, l_extendedprice AS score FROM lineitem"

SQL["flattened_tops"] = """
WITH l AS (
  SELECT o_custkey AS "user", l_partkey AS app_id, l_extendedprice AS score,
         row_number() OVER (PARTITION BY o_custkey ORDER BY l_extendedprice DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) AS rank
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT c_custkey AS "user", rank IS NOT NULL AS known, CAST(rank AS INTEGER) AS rank, app_id, score
FROM customer LEFT JOIN l ON c_custkey = "user" AND rank <= 10"""

_ASKED = """
triples AS (SELECT o_custkey AS u, l_partkey AS item FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
asked AS (
  SELECT CAST(c_custkey AS VARCHAR) AS "user", c_custkey AS u FROM customer
  UNION ALL SELECT '9999999999' || CAST(c_custkey AS VARCHAR), NULL FROM customer WHERE c_custkey % 100 = 0),
had AS (SELECT u, count(DISTINCT item) AS n FROM triples GROUP BY u),
answers AS (SELECT "user", had.u IS NOT NULL AS known,
                   CASE WHEN had.u IS NULL THEN 0 ELSE least(10, (SELECT count(DISTINCT item) FROM triples) - {seen}) END AS items
            FROM asked LEFT JOIN had ON asked.u = had.u)"""
_ANSWERS = """
SELECT "user", known, items, items AS distinct_items, CAST(nullif(items, 0) AS INTEGER) AS last_rank, 0::BIGINT AS rises{more} FROM answers"""
SQL["recommendations_checked"] = with_ctes(_ASKED.format(seen="0"), body=_ANSWERS.format(more=""))
SQL["unseen_recommendations_checked"] = with_ctes(_ASKED.format(seen="had.n"), body=_ANSWERS.format(more=", 0::BIGINT AS seen_again"))
