"""Stand-ins for the review dataset, derived by Spark from the driver's tables.

The reference reads games, users and reviews CSVs that are not available here.
These adapters turn the given parquet tables into tables with the same raw,
all-string shape, so every query reads the given tables and its work grows with
them. Each adapter keeps every source row; dirty values (bad IDs, unparseable
labels and numbers, out-of-range prices, malformed keys) are planted at
deterministic positions so the cleaning rules have something to remove.

The oracle SQL writes the same adapters independently (see ``plans/oracle.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import GAMES_COLUMNS, REVIEWS_COLUMNS, USERS_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(col: Column) -> Column:
    return col.cast("string")


def _null() -> Column:
    return F.lit(None).cast("string")


def reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews (all strings) from ``events``; ``review_id`` is ``event_id``."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    user_id = (
        F.when(eid % 499 == 0, F.concat(F.lit("x"), _s(F.col("user_id"))))
        .otherwise(_s(F.col("user_id")))
    )
    is_recommended = (
        F.when(eid % 503 == 0, F.lit("on"))
        .when(F.col("event_type").isin("view", "click", "purchase"), F.lit("true"))
        .otherwise(F.lit("false"))
    )
    hours = (
        F.when(eid % 997 == 0, F.lit("20000"))
        .when(eid % 991 == 0, F.lit("bad"))
        .otherwise(_s(F.col("value")))
    )
    return ev.select(
        F.get_json_object("props", "$.k").alias("app_id"),
        _null().alias("helpful"),
        _null().alias("funny"),
        F.col("ts").cast("date").cast("string").alias("date"),  # yyyy-MM-dd, no time zone
        is_recommended.alias("is_recommended"),
        hours.alias("hours"),
        user_id.alias("user_id"),
        _s(eid).alias("review_id"),
    ).select(*REVIEWS_COLUMNS)


def games_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games (all strings) from ``part``.

    Every part row is kept. Parts with ``p_partkey % 7 = 3`` carry a malformed
    key (``'g<key>'``), so reviews of those games find no game and the join has
    rows to drop. ``p_size`` 10 and 30 land exactly on the price bounds.
    """
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    size = F.col("p_size")
    price = (
        F.when(size == 50, F.lit("250.00"))
        .when(size == 49, F.lit("-1.00"))
        .when(size == 48, _null())
        .when(size == 47, F.lit("n/a"))
        .otherwise(F.concat(_s(size - 1), F.lit(".99")))
    )
    app_id = F.when(key % 7 == 3, F.concat(F.lit("g"), _s(key))).otherwise(_s(key))
    user_reviews = F.when(key % 11 == 5, _null()).otherwise(_s(key * 13 % 5000))
    return part.select(
        app_id.alias("app_id"),
        F.col("p_name").alias("title"),
        _null().alias("date_release"),
        _null().alias("win"),
        _null().alias("mac"),
        _null().alias("linux"),
        F.col("p_type").alias("rating"),
        _s(key * 37 % 104).alias("positive_ratio"),
        user_reviews.alias("user_reviews"),
        _null().alias("price_final"),
        price.alias("price_original"),
        _null().alias("discount"),
        _null().alias("steam_deck"),
    ).select(*GAMES_COLUMNS)


def users_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users (all strings) from ``customer``; ``c_custkey % 5 = 2`` carry a
    malformed key (``'u<key>'``), so their reviews find no user."""
    cust = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    user_id = F.when(key % 5 == 2, F.concat(F.lit("u"), _s(key))).otherwise(_s(key))
    return cust.select(
        user_id.alias("user_id"),
        _s(F.col("c_nationkey")).alias("products"),
        _s(key % 17).alias("reviews"),
    ).select(*USERS_COLUMNS)


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User-item-rating triples at scale: orders x lineitem.

    user = ``o_custkey``, item = ``l_partkey``, rating = ``l_quantity``.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return items.join(orders, items.l_orderkey == orders.o_orderkey, "inner").select(
        F.col("o_custkey").try_cast("int").alias("user"),
        F.col("l_partkey").try_cast("int").alias("item"),
        F.col("l_quantity").alias("rating"),
    )


def messages_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review messages as JSON text (the topic payload), from the reviews.

    ``msg_id`` is the message position (the review's event id). Edge messages
    replace the payload at fixed positions: broken JSON, an array, ``{}``,
    JSON ``null``, a bare number, and an object with a numeric value and an
    unknown key.
    """
    from ..functions.json_codec import encode_message

    reviews = reviews_raw(spark, sf_dir)
    mid = F.col("review_id").try_cast("bigint")
    value = (
        F.when(mid % 1009 == 1, F.lit("{bad"))
        .when(mid % 1013 == 2, F.lit("[1,2]"))
        .when(mid % 1019 == 3, F.lit("{}"))
        .when(mid % 1021 == 4, F.lit("null"))
        .when(mid % 1031 == 5, F.lit("3"))
        .when(mid % 1033 == 6, F.concat(F.lit('{"app_id": 12, "user_id": "'),
                                        F.col("user_id"), F.lit('", "extra": "x"}')))
        .otherwise(encode_message())
    )
    return reviews.select(mid.alias("msg_id"), value.alias("value"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests: one per review of a known game, features as doubles.

    ``hours`` is missing for ids ending in 0, ``price`` for 1, the ratio for 2.
    """
    reviews = reviews_raw(spark, sf_dir)
    games = games_raw(spark, sf_dir)
    rid = F.col("review_id").try_cast("bigint")

    def unless(digit: int, c: Column) -> Column:
        return F.when(rid % 10 == digit, F.lit(None).cast("double")).otherwise(c.try_cast("double"))

    return reviews.join(games, "app_id", "inner").select(
        F.col("review_id").alias("request_id"),
        unless(0, F.col("hours")).alias("hours"),
        unless(1, F.col("price_original")).alias("price"),
        unless(2, F.col("positive_ratio")).alias("positive_ratio"),
        F.col("user_reviews").try_cast("double").alias("user_reviews"),
    )


def labelled(processed: DataFrame) -> DataFrame:
    """Model-test rows: processed reviews with a planted label.

    label = ``hours_numeric > 40``, flipped when ``event_id * 7919 % 10 = 0``
    (10 % noise). The driver tables carry no signal of their own.
    """
    eid = F.col("review_id").try_cast("bigint")
    signal = F.col("hours_numeric") > 40
    flip = (eid * 7919 % 10) == 0
    label = F.when(flip, ~signal).otherwise(signal).cast("double")
    return processed.withColumn("is_recommended_label", label)
