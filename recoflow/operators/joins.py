"""Joins between reviews and the two dimensions.

Strategy is left to Catalyst/AQE on purpose:

* users can be as large as the reviews themselves, so J1 is a shuffled
  sort-merge join on ``user_id``; a hot user is split by AQE skew join.
* games is a catalogue; it is broadcast when its estimated (planning) or
  measured (AQE) size is under the session's broadcast bound, and stays a
  shuffled join above it. No unconditional ``broadcast()`` hint is used.
* the semi joins (J3, J4) only need the distinct keys of the sample; they are
  de-duplicated map-side (partial aggregation) before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_users(reviews: DataFrame, users: DataFrame, users_unique: bool = False) -> DataFrame:
    """Reviews x users on ``user_id``.

    Inner by default, which repeats a review once per matching user row, as the
    reference does. ``users_unique=True`` declares the key unique and uses a
    semi join (existence check, no user columns, no repeats).
    """
    if users_unique:
        return reviews.join(users.select("user_id"), "user_id", "left_semi")
    return reviews.join(users, "user_id", "inner")


def join_games(reviews: DataFrame, games: DataFrame) -> DataFrame:
    """Reviews x games on ``app_id``, inner."""
    return reviews.join(games, "app_id", "inner")


def games_in_sample(games: DataFrame, sample: DataFrame) -> DataFrame:
    """Games whose ``app_id`` occurs in the sampled reviews (semi join).

    The sample's keys are de-duplicated first (partial aggregation, map-side),
    so a game reviewed millions of times is one key on the build side.
    """
    return games.join(sample.select("app_id").distinct(), "app_id", "left_semi")


def users_in_sample(users: DataFrame, sample: DataFrame) -> DataFrame:
    """Users whose ``user_id`` occurs in the sampled reviews (semi join),
    with the sample's keys de-duplicated map-side first."""
    return users.join(sample.select("user_id").distinct(), "user_id", "left_semi")
