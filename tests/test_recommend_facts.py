"""Facts per user of recommendations, and how often the interactions are joined for them."""

import random

from pyspark.sql import functions as F

from recoflow.plans import queries as Q

RECS = "user string, known boolean, rank int, app_id int, score double"


def test_facts_per_user(spark):
    """Seen items count once a rank, however often they were seen; ids compare as text; nulls match nothing."""
    recs = spark.createDataFrame(
        [("1", True, 1, 10, 3.0), ("1", True, 2, 11, 4.0), ("1", True, 3, 10, 4.0), ("1", True, 4, 12, 1.0), ("2", True, None, None, None),
         ("03", True, 1, 10, 1.0), ("9", False, None, None, None), (None, True, 1, 10, 2.0), ("4", True, 1, 7, 1.0)], RECS)
    seen = spark.createDataFrame([(1, 10), (1, 10), (1, 12), (1, None), (2, 5), (3, 10), (None, 10), (8, 1)], "user int, item int")
    out = Q._per_user(recs, seen)
    assert [t for _, t in out.dtypes] == ["string", "boolean", "bigint", "bigint", "int", "bigint", "bigint"]
    assert {tuple(r) for r in out.collect()} == {
        ("1", True, 4, 3, 4, 1, 3), ("2", True, 0, 0, None, 0, 0), ("03", True, 1, 1, 1, 0, 0), ("9", False, 0, 0, None, 0, 0),
        (None, True, 1, 1, 1, 0, 0), ("4", True, 1, 1, 1, 0, 0)}
    assert {tuple(r) for r in Q._per_user(recs, seen.limit(0)).select("user", "seen_again").collect()} == {(u, 0) for u in ("1", "2", "03", "9", None, "4")}


def test_facts_shuffle_answers_and_seen_items_once(spark, tmp):
    spark.range(50).selectExpr("cast(id as string) user", "true known", "1 rank", "cast(id as int) app_id", "1D score").write.parquet(f"{tmp}/recs")
    spark.range(50).selectExpr("cast(id as int) user", "cast(id as int) item").write.parquet(f"{tmp}/seen")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as tables too large to broadcast
    try:
        out = Q._per_user(spark.read.parquet(f"{tmp}/recs"), spark.read.parquet(f"{tmp}/seen"))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange hashpartitioning") == 2
    assert {r["seen_again"] for r in out.collect()} == {1}


def test_interactions_are_joined_once(spark, tmp):
    """After the fit, the answers read the written interactions; orders and lineitem are not joined again."""
    r = random.Random(5)
    spark.range(30).selectExpr("id c_custkey").write.parquet(f"{tmp}/customer.parquet")
    spark.createDataFrame([(o, o % 25) for o in range(120)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp}/orders.parquet")
    lines = [(o, r.randrange(14), float(r.randrange(1, 50))) for o in range(120) for _ in range(3)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp}/lineitem.parquet")
    had = {}
    for o, p, _ in lines:
        had.setdefault(str(o % 25), set()).add(p)
    catalogue = len({p for _, p, _ in lines})
    for name in ("unseen_recommendations_checked", "recommendations_checked"):
        out = Q.QUERIES[name](spark, tmp)
        assert not [f for f in out.inputFiles() if "lineitem.parquet" in f or "orders.parquet" in f]
        rows = {x["user"]: x for x in out.where(F.length("user") < 10).collect()}
        assert len(rows) == 30 and all(rows[str(u)]["known"] == (u < 25) for u in range(30))
        for u, x in rows.items():
            left = catalogue - (len(had.get(u, ())) if name.startswith("unseen") else 0)
            assert x["items"] == (min(10, left) if u in had else 0) == x["distinct_items"] and x["rises"] == 0
            assert name == "recommendations_checked" or x["seen_again"] == 0
