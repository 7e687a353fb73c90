"""First-n, trim and fixed-size sampling (L1-L3) against brute force."""

import pytest
from pyspark.sql import functions as F

from recoflow.operators import sampling as S
from recoflow.sources import tables as T
from tests.conftest import SF_MID


def _keys(df, key="review_id"):
    return [r[key] for r in df.collect()]


def test_first_n_equals_brute_force(spark):
    reviews = T.reviews_raw(spark, SF_MID)
    num = F.col("review_id").cast("bigint")
    brute = _keys(reviews.orderBy(num, "review_id").limit(1234))
    assert sorted(_keys(S.first_n_by_key(reviews, 1234)), key=int) == brute


def test_sample_equals_brute_force_and_is_exact(spark):
    reviews = T.reviews_raw(spark, SF_MID)
    h = F.md5(F.concat(F.lit("42:"), F.col("review_id")))
    brute = set(_keys(reviews.orderBy(h, "review_id").limit(777)))
    assert set(_keys(S.sample_fixed_size(reviews, 777, "review_id"))) == brute and len(brute) == 777


def test_no_rank_is_left_to_one_task(spark):
    """No sort, limit or window over rows: the plan is a filter, pushed below the joins."""
    from recoflow.plans.prepare import processed_reviews

    raw = T.reviews_raw(spark, SF_MID), T.users_raw(spark, SF_MID), T.games_raw(spark, SF_MID)
    first = S.first_n_by_key(processed_reviews(*raw), 1000)
    assert first.count() == 1000
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    assert not any(word in plan for word in ("Limit", "Sort", "Window"))


def test_equal_and_tied_rows(spark):
    """Rows that agree in the key are told apart by their other columns; equal rows are repeated."""
    df = spark.createDataFrame([("7", "x")] * 40 + [("7", "y")] * 40 + [(None, "z")] * 5, "k string, v string")
    for n in (1, 39, 41, 80, 82, 85, 90):
        got = [tuple(r) for r in S.first_n_by_key(df, n, "k").collect()]
        assert len(got) == min(n, 85)
        assert sum(k is None for k, _ in got) == max(0, min(n, 85) - 80)
    a = sorted(map(tuple, S.first_n_by_key(df.repartition(3), 50, "k").collect()))
    assert a == sorted(map(tuple, S.first_n_by_key(df.coalesce(1), 50, "k").collect()))


def test_sample_larger_than_table_returns_all(spark):
    reviews = T.reviews_raw(spark, SF_MID)
    assert S.sample_fixed_size(reviews, 10**9, "review_id").count() == reviews.count()


def test_partition_independence(spark):
    reviews = T.reviews_raw(spark, SF_MID)
    a = set(_keys(S.sample_fixed_size(reviews.repartition(2), 300, "review_id")))
    b = set(_keys(S.sample_fixed_size(reviews.repartition(7), 300, "review_id")))
    assert a == b
    c = sorted(_keys(S.first_n_by_key(reviews.repartition(2), 50)), key=int)
    d = sorted(_keys(S.first_n_by_key(reviews.repartition(7), 50)), key=int)
    assert c == d == [str(i) for i in range(50)]


def test_trim(spark):
    reviews = T.reviews_raw(spark, SF_MID)
    assert S.trim_rows(reviews, 1).count() == 0
    assert sorted(_keys(S.trim_rows(reviews, 4))) == ["0", "1", "2"]
    with pytest.raises(ValueError):
        S.trim_rows(reviews, 0)


def test_large_n_equals_brute_force(spark):
    """n = half of 100k rows."""
    reviews = T.reviews_raw(spark, "/root/testdata/sf0.1")
    h = F.md5(F.concat(F.lit("7:"), F.col("review_id")))
    brute = set(_keys(reviews.orderBy(h, "review_id").limit(50_000)))
    got = _keys(S.sample_fixed_size(reviews, 50_000, "review_id", seed=7))
    assert len(got) == 50_000 and set(got) == brute


def test_first_n_text_keys_equals_brute_force(spark):
    """Landed batches are keyed by md5 text: the selection must still be exact."""
    reviews = T.reviews_raw(spark, SF_MID)
    mixed = reviews.withColumn(
        "review_id",
        F.when(F.col("review_id").cast("int") % 3 == 0, F.md5("review_id"))
        .when(F.col("review_id").cast("int") % 3 == 1, F.col("review_id"))
        .otherwise(F.lit(None).cast("string")))
    order = [F.col("review_id").try_cast("bigint").asc_nulls_last(), F.col("review_id").asc_nulls_last()]
    for n in (100, 4000, 9000):
        brute = sorted(map(str, _keys(mixed.orderBy(*order).limit(n))))
        fast = S.first_n_by_key(mixed, n)
        assert sorted(map(str, _keys(fast))) == brute


def test_sample_with_null_keys_equals_brute_force(spark):
    reviews = T.reviews_raw(spark, SF_MID).withColumn(
        "review_id", F.when(F.col("review_id").cast("int") % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("review_id")))
    h = F.md5(F.concat(F.lit("42:"), F.col("review_id")))
    for n in (500, 7600, 9000):
        brute = sorted(map(str, _keys(reviews.orderBy(h.asc_nulls_last(), F.col("review_id").asc_nulls_last()).limit(n))))
        got = sorted(map(str, _keys(S.sample_fixed_size(reviews, n, "review_id"))))
        assert got == brute
