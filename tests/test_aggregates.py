"""Counts and metrics."""

import math

import pandas as pd
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from recoflow.operators.aggregates import exact_auc, ordered_bits, rmse, sums_before, written_rows
from recoflow.sources import tables as T
from tests.conftest import SF_MID


def _lineitem(spark):
    return T.table(spark, SF_MID, "lineitem").select(
        F.col("l_extendedprice").alias("score"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"))


def _rank_sum_auc(pdf):
    ranks = pdf["score"].rank(method="average")
    pos = pdf["label"] == 1
    p, n = pos.sum(), (~pos).sum()
    return (ranks[pos].sum() - p * (p + 1) / 2) / (p * n)


def test_auc_matches_rank_sum_and_mllib(spark):
    li = _lineitem(spark)
    pdf = li.toPandas()
    expected = _rank_sum_auc(pdf)
    one = exact_auc(li, "score", "label").first()["auc"]
    many = exact_auc(li, "score", "label", window_rows=500).first()["auc"]
    assert math.isclose(one, expected, rel_tol=0, abs_tol=1e-12)
    assert one == many
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    mllib = ev.evaluate(li.withColumn("label", F.col("label").cast("double")))
    assert math.isclose(one, mllib, abs_tol=1e-9)


def test_auc_ties_count_half(spark):
    df = spark.createDataFrame([(1.0, 1), (1.0, 0), (2.0, 1), (0.5, 0)], "score double, label int")
    pdf = pd.DataFrame({"score": [1.0, 1.0, 2.0, 0.5], "label": [1, 0, 1, 0]})
    assert exact_auc(df, "score", "label").first()["auc"] == _rank_sum_auc(pdf) == 0.875


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (None, 1.0)], "p double, l double")
    row = rmse(df, "p", "l").first()
    assert row["rows"] == 2 and row["rmse"] == round(math.sqrt(0.5), 9)


def test_written_rows(spark, tmp):
    spark.range(123).write.parquet(tmp + "/t")
    assert written_rows(spark, tmp + "/t") == 123


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0)], "score double, label int")
    row = exact_auc(df, "score", "label").first()
    assert row["auc"] is None and row["positives"] == 0 and row["negatives"] == 2


def test_ordered_bits_are_the_bits_of_a_double(spark):
    import struct

    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1e-310, 0.1, 0.5, 0.49999999999999994, 1.0, 1.0000000000000002,
              3.0, 4.0, 3.9999999999999996, 1e300, 1.7976931348623157e308, -7.25, float("inf"), float("-inf")]
    values += [2.0 ** e for e in range(-1074, 1024, 37)] + [2.0 ** e * (2 - 2 ** -52) for e in range(-1000, 1000, 41)]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", ordered_bits(F.col("x")).alias("b")).collect()
    order = [b for _, b in sorted((struct.unpack(">d", struct.pack(">d", r.x + 0.0))[0], r.b) for r in rows)]
    assert order == sorted(order)
    assert len({r.b for r in rows}) == len({r.x for r in rows})


def test_sums_before_any_limit(spark):
    keys = [-(1 << 62), -70_000, -1, 0, 1, 65_535, 65_536, 1 << 20, (1 << 33) + 5, (1 << 33) + 6, (1 << 62) + 1]
    df = spark.createDataFrame([(k, i + 1) for i, k in enumerate(keys)], "k long, v long")
    for limit in (1, 3, 100):
        got = {r.k: r.before for r in sums_before(df, "k", "v", limit).collect()}
        assert got == {k: sum(range(1, i + 1)) for i, k in enumerate(keys)}
