"""Fixed schemas of the raw inputs, the message stream and the typed outputs."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Raw CSV column lists, in file order (all read as strings).
USERS_COLUMNS = ("user_id", "products", "reviews")
GAMES_COLUMNS = (
    "app_id", "title", "date_release", "win", "mac", "linux", "rating",
    "positive_ratio", "user_reviews", "price_final", "price_original",
    "discount", "steam_deck",
)
REVIEWS_COLUMNS = (
    "app_id", "helpful", "funny", "date", "is_recommended", "hours", "user_id",
    "review_id",
)
# Review message fields, in message order; also the landed batch
# column order.
MESSAGE_COLUMNS = ("app_id", "user_id", "is_recommended", "hours", "date")

USERS_SCHEMA = _strings(*USERS_COLUMNS)
GAMES_SCHEMA = _strings(*GAMES_COLUMNS)
REVIEWS_SCHEMA = _strings(*REVIEWS_COLUMNS)
MESSAGE_SCHEMA = _strings(*MESSAGE_COLUMNS)
BATCH_SCHEMA = MESSAGE_SCHEMA

CORRUPT_COLUMN = "_corrupt_record"
# A message wrapped as {"m": <message>, "end": 1}.
MESSAGE_PARSE_SCHEMA = T.StructType([
    T.StructField("m", MESSAGE_SCHEMA, True), T.StructField("end", T.IntegerType(), True), T.StructField(CORRUPT_COLUMN, T.StringType(), True),
])

# Model columns kept after the joins, in output order, plus the
# stable review key that replaces a partition-dependent row id.
MODEL_COLUMNS = (
    "app_id", "user_id", "is_recommended", "hours", "date", "price_original",
    "positive_ratio", "user_reviews", "rating",
)
KEY_COLUMN = "review_id"

# The classifier feature vector, in this order.
FEATURE_COLUMNS = (
    "hours_numeric", "price_numeric", "positive_ratio_numeric", "quality_score",
    "price_category",
)
LABEL_COLUMN = "is_recommended_label"

ALS_SCHEMA = T.StructType([
    T.StructField("user", T.IntegerType(), True),
    T.StructField("item", T.IntegerType(), True),
    T.StructField("rating", T.DoubleType(), True),
])

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType(), False),
    T.StructField("hours", T.DoubleType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("positive_ratio", T.DoubleType(), True),
    T.StructField("user_reviews", T.DoubleType(), True),
])
