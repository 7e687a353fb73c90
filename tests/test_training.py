"""Model invariants (M1-M4, M6, A4, A5)."""

import os

from pyspark.sql import functions as F

from recoflow.operators import scoring as SC
from recoflow.operators import training as TR
from recoflow.plans.queries import processed_reviews, request_features
from recoflow.sources import tables as T
from tests.conftest import SF_MID


def _labelled(spark):
    return T.labelled(processed_reviews(spark, SF_MID))


def test_min_rows_gate(spark):
    assert not TR.has_min_rows(spark.range(99))
    assert TR.has_min_rows(spark.range(100))


def test_lr_signal_gate_save_load(spark, tmp):
    res = TR.train_lr(_labelled(spark))
    assert res.train_auc > TR.AUC_TARGET and res.passed
    req = request_features(spark, SF_MID)
    scores = SC.score_requests(res.model, req)
    probs = [r["probability"] for r in scores.collect() if r["probability"] is not None]
    assert probs and all(0.0 <= p <= 1.0 for p in probs)
    path = os.path.join(tmp, "M1_LR")
    TR.save_model(res.model, path)
    again = SC.score_requests(TR.load_model(path, TR.LR_NAME), req)
    a = {r["request_id"]: r["probability"] for r in scores.collect()}
    b = {r["request_id"]: r["probability"] for r in again.collect()}
    assert a == b


def test_shuffled_label_has_no_signal(spark):
    shuffled = _labelled(spark).withColumn(
        "is_recommended_label",
        (F.conv(F.substring(F.md5("review_id"), 1, 6), 16, 10).cast("bigint") % 2).cast("double"))
    res = TR.train_lr(shuffled)
    assert abs(res.train_auc - 0.5) < 0.1 and not res.passed


def test_gbt_same_seed_same_scores(spark):
    data = _labelled(spark)
    req = request_features(spark, SF_MID).limit(200)
    one = SC.score_requests(TR.train_gbt(data).model, req).collect()
    two = SC.score_requests(TR.train_gbt(data).model, req).collect()
    assert sorted(one) == sorted(two)


def test_invalid_features_kept_with_reason(spark):
    res = TR.train_lr(_labelled(spark))
    req = spark.createDataFrame([("ok", 3.0, 10.0, 50.0, 100.0), ("nan", float("nan"), 10.0, 50.0, 100.0)],
                                "request_id string, hours double, price double, "
                                "positive_ratio double, user_reviews double")
    from recoflow.functions.features import request_features as rf
    out = {r["request_id"]: r for r in SC.score_requests(res.model, rf(req)).collect()}
    assert out["ok"]["probability"] is not None and out["ok"]["reason"] is None
    assert out["nan"]["probability"] is None and out["nan"]["reason"] == SC.REASON_INVALID


def test_load_or_train_is_idempotent(spark, tmp):
    calls = []

    def train():
        calls.append(1)
        return TR.train_lr(_labelled(spark))

    path = os.path.join(tmp, "M1_LR")
    _, trained = TR.load_or_train(path, TR.LR_NAME, train)
    _, trained_again = TR.load_or_train(path, TR.LR_NAME, train)
    assert trained and not trained_again and len(calls) == 1
