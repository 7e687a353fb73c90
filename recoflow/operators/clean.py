"""Projections, typing and row filters of the cleaning stage.

Filters are written on typed columns after the joins; Catalyst pushes each
conjunct to the side that owns its column (hours to reviews, price and ratio to
games), so rows are dropped before they are shuffled.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import label_to_int, to_double, to_hours_or_zero, to_int_id, to_label
from ..functions.features import with_features
from ..schemas import KEY_COLUMN, MODEL_COLUMNS

# The NULL-check columns and the plausibility bounds of training rows.
REQUIRED_COLUMNS = ("app_id_int", "user_id_int", "is_recommended_label", "hours_numeric")
MIN_HOURS, MAX_HOURS = 0.1, 10000.0
MIN_PRICE, MAX_PRICE = 0.0, 200.0
MIN_RATIO, MAX_RATIO = 0.0, 100.0


def model_columns(joined: DataFrame) -> DataFrame:
    """The 9 model columns after the joins, plus the stable review key."""
    return joined.select(*MODEL_COLUMNS, KEY_COLUMN)


def with_typed_columns(df: DataFrame) -> DataFrame:
    """Typed copies of the raw string columns."""
    return df.withColumns({
        "app_id_int": to_int_id("app_id"),
        "user_id_int": to_int_id("user_id"),
        "is_recommended_label": to_label("is_recommended"),
        "hours_numeric": to_double("hours"),
        "price_numeric": to_double("price_original"),
        "positive_ratio_numeric": to_double("positive_ratio"),
        "user_reviews_numeric": to_double("user_reviews"),
    })


def drop_incomplete(df: DataFrame, subset=REQUIRED_COLUMNS) -> DataFrame:
    """drop rows with NULL (or NaN, for doubles) in any required column."""
    return df.na.drop(subset=list(subset))


#: F2: column and bounds, in the order in which a rejected row is given its reason.
PLAUSIBLE = {"hours_numeric": (MIN_HOURS, MAX_HOURS), "price_numeric": (MIN_PRICE, MAX_PRICE),
             "positive_ratio_numeric": (MIN_RATIO, MAX_RATIO)}
DOUBLES = ("is_recommended_label", "hours_numeric")
ACCEPTED = "accepted"


def is_present(name: str) -> Column:
    """F1 for one required column: not NULL, and not NaN."""
    return F.col(name).isNotNull() & ~F.isnan(name) if name in DOUBLES else F.col(name).isNotNull()


def is_complete() -> Column:
    """F1 as a condition, never NULL."""
    return reduce(and_, (is_present(c) for c in REQUIRED_COLUMNS))


def in_range(name: str) -> Column:
    """F2 for one column; NULL for NULL, false for NaN (NaN is above every number)."""
    low, high = PLAUSIBLE[name]
    return (F.col(name) >= low) & (F.col(name) <= high)


def is_plausible() -> Column:
    """F2 as a condition; NULL if a column is NULL."""
    return reduce(and_, (in_range(c) for c in PLAUSIBLE))


def in_plausible_range(df: DataFrame) -> DataFrame:
    """F2: keep 0.1<=hours<=10000, 0<=price<=200, 0<=ratio<=100.

    A NULL or NaN in any of the three columns fails the predicate.
    """
    return df.filter(is_plausible())


def outcome() -> Column:
    """What F1 and F2 make of a typed row: ``accepted``, ``missing <column>`` (the first required one that
    is absent or unreadable) or ``implausible <column>``. Rows that F1 drops come before those that F2 drops."""
    missing = [(~is_present(c), f"missing {c}") for c in REQUIRED_COLUMNS]
    odd = [(~F.coalesce(in_range(c), F.lit(False)), f"implausible {c}") for c in PLAUSIBLE]
    (first, reason), *rest = missing + odd
    says = F.when(first, F.lit(reason))
    for condition, reason in rest:
        says = says.when(condition, F.lit(reason))
    return says.otherwise(F.lit(ACCEPTED))


def typed_with_features(joined: DataFrame) -> DataFrame:
    """P1 -> casts -> P11/P12, before any row filter."""
    return with_features(with_typed_columns(model_columns(joined)))


def als_triples(processed: DataFrame) -> DataFrame:
    """P3 + F3: ``(user, item, rating)`` from processed reviews, NULLs dropped."""
    return processed.select(
        F.col("user_id_int").alias("user"),
        F.col("app_id_int").alias("item"),
        F.col("hours_numeric").alias("rating"),
    ).na.drop()


def reviews_renamed(reviews: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """S6 + P2 + P7 + P10: the preprocessing projection.

    ``is_recommended -> recommended`` (0/1 int), ``date -> timestamp`` (kept as
    text, as the reference does), ``hours`` coerced with bad values -> 0.
    ``keep`` carries extra columns (such as the review key) in front.
    """
    return reviews.select(
        *keep,
        "user_id",
        "app_id",
        label_to_int("is_recommended").alias("recommended"),
        to_hours_or_zero("hours").alias("hours"),
        F.col("date").alias("timestamp"),
    )


def games_projected(games: DataFrame) -> DataFrame:
    """Games -> ``app_id, title, price_final``."""
    return games.select("app_id", "title", "price_final")


def users_projected(users: DataFrame) -> DataFrame:
    """Users -> ``user_id, products, reviews``."""
    return users.select("user_id", "products", "reviews")
