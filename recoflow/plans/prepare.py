"""The prepare plan: raw reviews + users + games -> processed training rows.

One lazy plan: J1 -> J2 -> P1 -> casts -> features -> F1 -> F2. Nothing is
materialised between steps; the single action is the caller's write or count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.clean import drop_incomplete, in_plausible_range, outcome, typed_with_features
from ..operators.joins import join_games, join_users


def joined_reviews(reviews: DataFrame, users: DataFrame, games: DataFrame,
                   users_unique: bool = False) -> DataFrame:
    """J1 then J2."""
    return join_games(join_users(reviews, users, users_unique), games)


def processed_reviews(reviews: DataFrame, users: DataFrame, games: DataFrame,
                      users_unique: bool = False) -> DataFrame:
    """The flagship: rows usable for training, with their features.

    Output: the 9 raw model columns, ``review_id`` (the stable key), the typed
    columns and ``price_category`` / ``quality_score``.
    """
    typed = typed_with_features(joined_reviews(reviews, users, games, users_unique))
    return in_plausible_range(drop_incomplete(typed))


def routed_reviews(reviews: DataFrame, users: DataFrame, games: DataFrame,
                   users_unique: bool = False) -> DataFrame:
    """Every joined row with its ``outcome``: the flagship's rows are ``accepted``, the others carry the
    reason for which F1 or F2 drops them."""
    typed = typed_with_features(joined_reviews(reviews, users, games, users_unique))
    return typed.withColumn("outcome", outcome())
