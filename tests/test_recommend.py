"""ALS top-N invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recoflow.operators import scoring as SC
from recoflow.operators import training as TR
from recoflow.sources import tables as T
from tests.conftest import SF_SMALL


def test_top_n_known_and_unknown_users(spark):
    triples = T.interactions(spark, SF_SMALL)
    model = TR.train_als(triples).model
    n_items = triples.select("item").distinct().count()
    users = triples.select("user").distinct().limit(20).unionByName(
        spark.createDataFrame([(-5,)], "user int"))
    out = SC.recommend_for(model, users).collect()
    by_user = {}
    for r in out:
        by_user.setdefault(r["user"], []).append(r)
    assert by_user[-5][0]["known"] is False and by_user[-5][0]["rank"] is None
    known = [u for u in by_user if u != -5]
    assert len(known) == 20
    for u in known:
        rows = sorted(by_user[u], key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, min(10, n_items) + 1))
        scores = [r["score"] for r in rows]
        assert all(a >= b for a, b in zip(scores, scores[1:])) and min(scores) >= 0


def test_subset_equals_all_users_filtered(spark):
    triples = T.interactions(spark, SF_SMALL)
    model = TR.train_als(triples).model
    users = triples.select("user").distinct().orderBy("user").limit(5)
    sub = SC.recommend_from(model, users, 10).collect()
    wanted = [r["user"] for r in users.collect()]
    allr = SC.recommend_all(model).filter(F.col("user").isin(wanted)).collect()
    assert sorted(sub) == sorted(allr)


def test_refit_same_factors(spark):
    triples = T.interactions(spark, SF_SMALL)
    a = TR.train_als(triples).model.itemFactors.orderBy("id").collect()
    b = TR.train_als(triples).model.itemFactors.orderBy("id").collect()
    assert a == b


def _factors(spark, rows, seed, scale=1.0):
    r = np.random.default_rng(seed)
    f = r.standard_normal((rows, 6)) * r.exponential(scale, (rows, 1))
    return spark.createDataFrame([(i, [float(x) for x in v.astype(np.float32)]) for i, v in enumerate(f)], "id int, features array<float>")


@pytest.mark.parametrize("group_bytes", [1 << 20, 48 * 40])
def test_top_items_equals_all_pairs(spark, group_bytes):
    """One group and several, ties (repeated items), items left out, users without factors."""
    users, items = _factors(spark, 70, 1), _factors(spark, 150, 2)
    items = items.unionByName(items.where("id < 20").withColumn("id", F.col("id") + 1000))
    r = np.random.default_rng(3)
    seen = {u: sorted({int(i) for i in r.integers(0, 150, r.integers(0, 149))}) for u in range(0, 70, 2)}
    seen[4] = list(range(150)) + list(range(1000, 1020))
    lists = spark.createDataFrame(list(seen.items()), "user int, seen array<int>")
    asked = users.withColumnRenamed("id", "user").join(lists, "user", "left").unionByName(spark.createDataFrame([(-1, None, None)], "user int, features array<float>, seen array<int>"))
    got = {x["user"]: x for x in SC.top_items(asked, items, 7, group_bytes=group_bytes, block=16).collect()}
    v = {x["id"]: np.array(x["features"], dtype=np.float64) for x in items.collect()}
    for x in users.collect():
        u = np.array(x["features"], dtype=np.float64)
        best = sorted((-round(float(u @ f), 9), i) for i, f in v.items() if i not in set(seen.get(x["id"], [])))[:7]
        row = got[x["id"]]
        assert [round(s, 9) for s in row["scores"]] == [-s for s, _ in best] and row["known"]
        assert [v[i].tolist() for i in row["items"]] == [v[i].tolist() for _, i in best]
    assert got[-1]["items"] == [] and not got[-1]["known"] and got[4]["items"] == []


def test_requested_ids_and_seen_items(spark):
    triples = T.interactions(spark, SF_SMALL)
    model = TR.train_als(triples).model
    users = triples.select(F.col("user").cast("string").alias("user")).distinct().limit(30).unionByName(
        spark.createDataFrame([("99999999999",), ("88888888888",), ("x",), (None,)], "user string"))
    out = SC.recommend_for(model, users, exclude=triples).collect()
    assert {r["user"] for r in out if not r["known"]} == {"99999999999", "88888888888", "x", None}
    n_items = triples.select("item").distinct().count()
    seen = {}
    for r in triples.collect():
        seen.setdefault(str(r["user"]), set()).add(r["item"])
    for user in {r["user"] for r in out if r["known"]}:
        rows = [r for r in out if r["user"] == user and r["rank"] is not None]
        assert len(rows) == min(10, n_items - len(seen[user])) and not {r["app_id"] for r in rows} & seen[user]


def test_no_pairs_of_users_and_items(spark):
    model = TR.train_als(T.interactions(spark, SF_SMALL)).model
    assert "CartesianProduct" not in SC.recommend_all(model)._jdf.queryExecution().executedPlan().toString()


def test_rating_blocks_grow_with_the_ratings_and_stay_on_disk(spark, monkeypatch):
    """A block is built in one task's heap, so more ratings are more blocks, not larger ones."""
    rows = spark.range(600).selectExpr("cast(id % 60 as int) user", "cast(id * 7 % 50 as int) item", "cast(id % 5 + 1 as float) rating")
    monkeypatch.setattr(TR, "ALS_BLOCK_RATINGS", 40)
    result = TR.train_als(rows, count_rows=True)
    assert result.rows == 600 and result.model.userFactors.rdd.getNumPartitions() == 15
    assert result.model.userFactors.count() == 60 and result.model.itemFactors.count() == 50
    assert TR.train_als(rows, blocks=11).model.userFactors.rdd.getNumPartitions() == 11
    assert TR.als_estimator().getIntermediateStorageLevel() == "DISK_ONLY"


def test_users_leave_when_no_group_can_help_them(spark, tmp, monkeypatch):
    """Between groups of items only users that may still gain carry factors; factors travel in single precision."""
    sent, best_of, paths = [], SC._best_of, []
    monkeypatch.setattr(SC, "_best_of", lambda ids, factors, *a: sent.append(factors) or best_of(ids, factors, *a))
    monkeypatch.setattr(SC, "scratch_dir", lambda _, name: paths.append(f"{tmp}/{name}-{len(paths)}") or paths[-1])
    users = spark.createDataFrame([(u, [1.0, float(u % 2)], None) for u in range(8)] + [(9, None, None)], "user int, features array<float>, seen array<int>")
    items = spark.createDataFrame([(i, [20.0 - i, 0.0] if i < 10 else [0.0, 20.0 - i]) for i in range(20)], "id int, features array<float>")
    got = {r["user"]: r for r in SC.top_items(users, items, 3, group_bytes=16 * 5).collect()}
    assert len(got) == 9 and got[9]["items"] == [] and not got[9]["known"]
    assert all(got[u]["items"] == [0, 1, 2] and got[u]["scores"] == [20.0, 19.0, 18.0] and got[u]["known"] for u in range(8))
    assert {f.dtype for f in sent} == {np.dtype("float32")} and len(sent) < 4
    rounds = [spark.read.parquet(p) for p in paths if "top-items" in p]
    assert [(r.count(), r.where("open = 'true'").count()) for r in rounds] == [(9, 4), (4, 0)]
    assert not any(r.where("open = 'false' and (features is not null or seen is not null)").count() for r in rounds)
