"""Joins (J1-J4) and the plan shape of the flagship query."""

from recoflow.operators import joins as J
from recoflow.plans.queries import processed_reviews
from tests.conftest import SF_MID


def test_duplicate_user_key_inner_vs_semi(spark):
    reviews = spark.createDataFrame([("1", "10", "r1"), ("2", "10", "r2")],
                                    "user_id string, app_id string, review_id string")
    users = spark.createDataFrame([("1", "a", "b"), ("1", "a", "b"), ("2", "c", "d")],
                                  "user_id string, products string, reviews string")
    assert J.join_users(reviews, users).count() == 3
    assert J.join_users(reviews, users, users_unique=True).count() == 2


def test_filters_pushed_below_joins(spark):
    df = processed_reviews(spark, SF_MID)
    physical = df._jdf.queryExecution().executedPlan().toString()
    # column pruning: the users side reads only the key
    assert "ReadSchema: struct<c_custkey:bigint>" in physical
    # predicate pushdown: the hours bound is applied on the events side,
    # below the joins, not after them
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    join_pos = optimized.find("Join Inner")
    assert join_pos >= 0 and "10000.0" in optimized[join_pos:]
    assert "10000.0" not in optimized[:join_pos]


def test_skewed_key_is_split(spark):
    """A key holding a third of all rows: AQE splits its partition at the join."""
    from pyspark.sql import functions as F
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        reviews = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string"))
            .alias("user_id"), F.col("id").alias("rid"))
        users = spark.range(997).select(F.col("id").cast("string").alias("user_id")).unionByName(
            spark.createDataFrame([("hot",)], "user_id string"))
        joined = J.join_users(reviews, users)
        assert len(joined.collect()) == n
        final = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
