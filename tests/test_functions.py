"""Edge rows of FIXTURES.md section 3: casts, labels, price category, range filter."""

import math

from pyspark.sql import functions as F

from recoflow.functions import casts as C
from recoflow.functions.features import price_category, quality_score, request_features
from recoflow.operators.clean import in_plausible_range


def col_values(df, c):
    return [r[c] for r in df.collect()]


def test_int_ids(spark):
    vals = ["12", " 7 ", "abc", "", None, "99999999999", "1.5"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s string")
    out = df.orderBy("i").select(C.to_int_id("s").alias("x"))
    assert col_values(out, "x") == [12, 7, None, None, None, None, None]


def test_labels(spark):
    trues = ["true", "True", "1", "yes", "y", "t", "TRUE "]
    falses = ["false", "0"]
    nulls = ["on", "1.0", "None", None]
    vals = trues + falses + nulls
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s string")
    out = col_values(df.orderBy("i").select(C.to_label("s").alias("x")), "x")
    assert out == [1.0] * len(trues) + [0.0] * len(falses) + [None] * len(nulls)
    ints = col_values(df.orderBy("i").select(C.label_to_int("s").alias("x")), "x")
    assert ints[:len(trues)] == [1] * len(trues)


def test_direct_double_cast_loses_text_labels(spark):
    df = spark.createDataFrame([("true",), ("false",)], "s string")
    assert col_values(df.select(C.to_double("s").alias("x")), "x") == [None, None]


def test_hours_or_zero(spark):
    df = spark.createDataFrame([(0, "3.5"), (1, "bad"), (2, None), (3, "NaN")], "i int, s string")
    out = col_values(df.orderBy("i").select(C.to_hours_or_zero("s").alias("x")), "x")
    assert out == [3.5, 0.0, 0.0, 0.0]


def test_price_category_bounds(spark):
    vals = [9.99, 9.991, 29.99, 30.0, None, float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, p double")
    out = col_values(df.orderBy("i").select(price_category(F.col("p")).alias("c")), "c")
    assert out == [1.0, 2.0, 2.0, 3.0, 3.0, 3.0]


def test_quality_score_order_of_operations(spark):
    df = spark.createDataFrame([(85.0, 1234.0), (None, 10.0)], "r double, n double")
    out = col_values(df.select(quality_score(F.col("r"), F.col("n")).alias("q")), "q")
    assert out[0] == 85.0 * (1234.0 / 1000.0)
    assert out[1] is None


def test_range_filter(spark):
    hours = [0.1, 0.09, 10000.0, 10000.1, float("nan"), None]
    rows = [(i, h, 10.0, 50.0) for i, h in enumerate(hours)]
    df = spark.createDataFrame(rows, "i int, hours_numeric double, price_numeric double, "
                                     "positive_ratio_numeric double")
    kept = sorted(r["i"] for r in in_plausible_range(df).collect())
    assert kept == [0, 2]


def test_request_defaults(spark):
    req = spark.createDataFrame([("a", 5.0, None, None, None), ("b", 1.0, 40.0, 90.0, 2000.0)],
                                "request_id string, hours double, price double, "
                                "positive_ratio double, user_reviews double")
    out = {r["request_id"]: r for r in request_features(req).collect()}
    a = out["a"]
    assert (a.price_numeric, a.positive_ratio_numeric, a.user_reviews_numeric) == (15.0, 75.0, 100.0)
    assert a.price_category == 2.0 and math.isclose(a.quality_score, 7.5)
    assert out["b"].price_category == 3.0
