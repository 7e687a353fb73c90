"""Feature definitions (P11-P14): the one definition shared by training and scoring.

Both paths call :func:`with_features`, so a model never sees features computed
one way in training and another way in serving. All features are doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Price category bounds and codes.
BUDGET_MAX_PRICE = 9.99
MID_MAX_PRICE = 29.99
BUDGET, MID_RANGE, PREMIUM = 1.0, 2.0, 3.0

# Serving defaults for optional request features.
DEFAULT_PRICE = 15.0
DEFAULT_POSITIVE_RATIO = 75.0
DEFAULT_USER_REVIEWS = 100.0


def price_category(price: Column) -> Column:
    """<= 9.99 -> 1, <= 29.99 -> 2, else (also NULL / NaN) -> 3."""
    return (
        F.when(price <= F.lit(BUDGET_MAX_PRICE), F.lit(BUDGET))
        .when(price <= F.lit(MID_MAX_PRICE), F.lit(MID_RANGE))
        .otherwise(F.lit(PREMIUM))
    )


def quality_score(positive_ratio: Column, user_reviews: Column) -> Column:
    """Ratio x (reviews / 1000), evaluated in that order."""
    return positive_ratio * (user_reviews / F.lit(1000.0))


def with_features(
    df: DataFrame,
    price: str = "price_numeric",
    positive_ratio: str = "positive_ratio_numeric",
    user_reviews: str = "user_reviews_numeric",
) -> DataFrame:
    """Append ``price_category`` and ``quality_score``."""
    return df.withColumns({
        "price_category": price_category(F.col(price)),
        "quality_score": quality_score(F.col(positive_ratio), F.col(user_reviews)),
    })


def request_features(requests: DataFrame) -> DataFrame:
    """P13 + P14: serving feature rows from a request table.

    ``requests`` has ``request_id, hours, price, positive_ratio, user_reviews``
    (doubles, optional ones nullable). Missing optional values take the serving
    defaults; the output carries the training feature names.
    """
    filled = requests.select(
        "request_id",
        F.col("hours").alias("hours_numeric"),
        F.coalesce("price", F.lit(DEFAULT_PRICE)).alias("price_numeric"),
        F.coalesce("positive_ratio", F.lit(DEFAULT_POSITIVE_RATIO)).alias("positive_ratio_numeric"),
        F.coalesce("user_reviews", F.lit(DEFAULT_USER_REVIEWS)).alias("user_reviews_numeric"),
    )
    return with_features(filled)
