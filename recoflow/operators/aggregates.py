"""Counts, distinct keys and model metrics.

All of these are partial/final aggregations: map-side partial aggregates
collapse a hot key or a hot score value before the shuffle, so no single task
receives a third of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.features import with_features
from ..operators.clean import ACCEPTED, is_complete, is_plausible, with_typed_columns
from ..session import scratch_dir


def distinct_ids(sample: DataFrame) -> DataFrame:
    """A2: distinct app and user IDs of a (sampled) review table."""
    ids = F.explode(F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("id"))
                              for c in ("app_id", "user_id"))))
    return sample.select(ids.alias("i")).select("i.kind", "i.id").distinct()


def stage_counts(reviews: DataFrame, users: DataFrame, games: DataFrame,
                 lr_rows: int = 500_000, gbt_rows: int = 750_000) -> DataFrame:
    """A1: row counts of the inputs, of each prepare stage and of each model's
    training set, as ``(stage, rows)``.

    The join stages come from ONE pass: reviews are left-joined to per-key user
    multiplicities and to games, and each stage is a conditional sum weighted by
    the multiplicity the inner joins would have produced.
    """
    user_mult = users.groupBy("user_id").agg(F.count(F.lit(1)).alias("_user_rows"))
    g = games.withColumn("_game_row", F.lit(1))
    joined = reviews.join(user_mult, "user_id", "left").join(g, "app_id", "left")
    typed = with_features(with_typed_columns(joined))
    weight = F.when(F.col("_game_row").isNotNull(), F.coalesce("_user_rows", F.lit(0))).otherwise(0)
    complete = is_complete()
    final = complete & F.coalesce(is_plausible(), F.lit(False))
    # ALS input: final rows with user, item and rating present
    als_ok = (final & F.col("user_id_int").isNotNull() & F.col("app_id_int").isNotNull()
              & F.col("hours_numeric").isNotNull() & ~F.isnan("hours_numeric"))
    stages = typed.agg(
        F.sum(weight).cast("bigint").alias("after_joins"),
        F.sum(F.when(complete, weight).otherwise(0)).cast("bigint").alias("after_null_filter"),
        F.sum(F.when(final, weight).otherwise(0)).cast("bigint").alias("final"),
        F.sum(F.when(als_ok, weight).otherwise(0)).cast("bigint").alias("als_rows"),
    ).select(
        "*",
        # training sets per model: the first LR_ROWS / GBT_ROWS rows (M1, M2)
        F.least("final", F.lit(lr_rows).cast("bigint")).alias("lr_rows"),
        F.least("final", F.lit(gbt_rows).cast("bigint")).alias("gbt_rows"),
    ).selectExpr("stack(6, 'after_joins', after_joins, 'after_null_filter', after_null_filter, "
                 "'final', final, 'lr_rows', lr_rows, 'gbt_rows', gbt_rows, "
                 "'als_rows', als_rows) AS (stage, rows)")

    def count_of(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("rows"))

    return (count_of(reviews, "reviews").unionByName(count_of(users, "users"))
            .unionByName(count_of(games, "games")).unionByName(stages))


def written_rows(spark, path: str, fmt: str = "parquet") -> int:
    """A1 in a production job: rows of a table the job has just written.

    For Parquet the count comes from file footers, so it costs no recompute of
    the plan that produced the table. CSV is parsed as it was written: a quoted line break is no row.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("escape", '"').option("multiLine", "true")
    return reader.load(path).count()


def written_outcomes(spark, path: str) -> DataFrame:
    """A1 of a routed write: ``outcome, rows`` from the partition folders and file footers alone."""
    return spark.read.parquet(path).groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))


def outcome_stages(outcomes: dict[str, int]) -> dict[str, int]:
    """The prepare stages' row counts from the rows per outcome."""
    joined = sum(outcomes.values())
    missing = sum(n for o, n in outcomes.items() if o.startswith("missing "))
    return {"after_joins": joined, "after_null_filter": joined - missing, "final": outcomes.get(ACCEPTED, 0)}


def ordered_bits(x: Column) -> Column:
    """The bits of a double (not NaN) as a bigint of the same order: negated below zero, and -0.0 is 0.0.

    A logarithm that is rounded to the next exponent does no harm: the mantissa is
    then 2 or just under 1, which gives the same number.
    """
    size = F.abs(x)
    exponent = F.floor(F.log2(size)).cast("double")
    mantissa = size / F.pow(F.lit(2.0), exponent)
    normal = (exponent + 1023).cast("bigint") * (1 << 52) + F.floor((mantissa - 1.0) * float(1 << 52)).cast("bigint")
    tiny = F.floor(size * 2.0 ** 1000 * 2.0 ** 74).cast("bigint")  # numbers under the smallest normal one
    bits = F.when(size == float("inf"), F.lit(2047 << 52)).when(size < 2.0 ** -1022, tiny).otherwise(normal)
    return F.when(size == 0.0, F.lit(0)).when(x < 0, -bits).otherwise(bits)


#: Rows that one window of a prefix sum may sort; a prefix of all but the last 16 bits has at most 65,536.
WINDOW_ROWS = 2_000_000


def sums_before(rows: DataFrame, key: str, value: str, limit: int = WINDOW_ROWS, levels: int = 4) -> DataFrame:
    """``rows`` (``key``: distinct bigints) with ``before``, the sum of ``value`` over all smaller keys.

    Rows are grouped by leading bits of the key, as many as leave ``limit`` rows or fewer
    in each group (65,536 at the least); a window sums inside a group, and the groups' own
    sums go through the same function, four ``levels`` at most (64 bits). No window and no
    broadcast depends on the number of rows, and there is no list of cuts.
    """
    run = lambda w: F.coalesce(F.sum(value).over(w.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spark = rows.sparkSession
    path = scratch_dir(spark, "prefix-sums")
    rows.write.parquet(path)
    rows = spark.read.parquet(path)
    if levels == 0 or rows.count() <= limit:  # counted from the footers
        return rows.withColumn("before", run(Window.partitionBy(F.lit(0))))
    for shift in (48, 32, 16):
        group = F.shiftright(key, shift)
        if shift == 16 or rows.groupBy(group).count().agg(F.max("count")).first()[0] <= limit:
            break
    name = f"_group{levels}"
    grouped = rows.withColumn(name, group)
    groups = grouped.groupBy(name).agg(F.sum(value).alias("_sum"))
    offsets = sums_before(groups, name, "_sum", limit, levels - shift // 16).select(name, F.col("before").alias("_offset"))
    inside = grouped.withColumn("before", run(Window.partitionBy(name)))
    return inside.join(offsets, name).withColumn("before", F.col("before") + F.col("_offset")).drop(name, "_offset")


def exact_auc(df: DataFrame, score: str, label: str, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """A3: exact area under ROC, ties counted one half (rank-sum with average ranks).

    AUC = sum over positives of (#negatives scored lower + 0.5 * #negatives tied)
          / (P * N).
    Computed distributed and in integers (times two), so it is exact:

    1. aggregate to one row per distinct score (map-side partial aggregation), keyed
       by the score's bits in order (:func:`ordered_bits`),
    2. the negatives below each score by prefix sums over leading bits
       (:func:`sums_before`); the per-score table is written once, in the shared
       folder, because several passes read it.
    """
    valid = df.filter(F.col(score).isNotNull() & ~F.isnan(score) & F.col(label).isNotNull())
    per_score = valid.groupBy(ordered_bits(F.col(score).cast("double")).alias("bits")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("bigint").alias("neg"),
    )
    ranked = sums_before(per_score, "bits", "neg", window_rows)
    # pos x (negatives below) reaches ~10^24 at 10^12 rows: exact in decimal(38,0),
    # not in bigint.
    exact = "decimal(38,0)"
    twice = F.col("pos").cast(exact) * (F.lit(2) * F.col("before") + F.col("neg")).cast(exact)
    agg = ranked.agg(
        F.sum(twice).alias("s2"),
        F.sum("pos").cast("bigint").alias("p"),
        F.sum("neg").cast("bigint").alias("n"),
    )
    return agg.select(
        # NULL, not an error, when one class is missing (no pairs to rank)
        F.try_divide(F.col("s2").cast("double"), F.lit(2.0) * F.col("p") * F.col("n")).alias("auc"),
        F.col("p").alias("positives"),
        F.col("n").alias("negatives"),
    )


def rmse(df: DataFrame, prediction: str, label: str, digits: int = 9) -> DataFrame:
    """Root mean squared error over rows with both values, rounded."""
    d = F.col(prediction) - F.col(label)
    valid = df.filter(F.col(prediction).isNotNull() & F.col(label).isNotNull()
                      & ~F.isnan(prediction) & ~F.isnan(label))
    return valid.agg(
        F.round(F.sqrt(F.avg(d * d)), digits).alias("rmse"),
        F.count(F.lit(1)).alias("rows"),
    )
