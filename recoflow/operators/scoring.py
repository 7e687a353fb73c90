"""Batch scoring and top-N recommendation.

The reference answers one HTTP request per Spark job. Here a table of requests
goes in and a table of answers comes out, so a million requests are one
distributed job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FEATURE_COLUMNS
from ..session import scratch_dir
from .training import assembler

TOP_N = 10
REASON_INVALID = "invalid features"


def score_requests(model: PipelineModel, features: DataFrame, key: str = "request_id") -> DataFrame:
    """M4 + P19: P(recommended) per request.

    Rows whose features hold NULL/NaN are kept with a NULL probability and a
    reason: the vector is assembled with handleInvalid='keep' and the result is
    masked, so there is no join back to the input.
    """
    classifier = model.stages[-1]
    vec = assembler("keep").transform(features)
    scored = classifier.transform(vec)
    valid = F.lit(True)
    for c in FEATURE_COLUMNS:
        valid = valid & F.col(c).isNotNull() & ~F.isnan(c)
    return scored.select(
        key,
        F.when(valid, vector_to_array("probability")[1]).alias("probability"),
        F.when(valid, F.lit(None).cast("string")).otherwise(F.lit(REASON_INVALID)).alias("reason"),
    )


def recommend_all(model: ALSModel, n: int = TOP_N) -> DataFrame:
    """L5 + P20: top ``n`` items for every user known to the model: ``user, rank, app_id, score`` (rank from 1)."""
    users = model.userFactors.select(F.col("id").alias("user"), "features")
    return ranked(top_items(users, model.itemFactors, n)).where(F.col("rank").isNotNull()).drop("known")


def recommend_from(model: ALSModel, users: DataFrame, n: int, exclude: DataFrame | None = None) -> DataFrame:
    """Top ``n`` for each distinct ``user`` that the model knows."""
    return recommend_for(model, users, n, exclude).where(F.col("rank").isNotNull()).drop("known")


def recommend_for(model: ALSModel, users: DataFrame, n: int = TOP_N, exclude: DataFrame | None = None) -> DataFrame:
    """M5 + F7: top ``n`` for each requested ``user``, ``user, known, rank, app_id, score``.

    Only the requested users are scored, not all users as the reference does
    before filtering one. The requested ids come back as they were asked; one
    that is unknown (no factors, or no int at all) is one row with ``known =
    false`` and NULL rank, item and score (the reference returns an empty list).

    ``exclude`` (``user, item``): items not to recommend, such as those a user has
    rated; the next best take their place. A known user with nothing left to
    recommend is one row with NULL rank. Without it nothing is excluded, as in
    the reference.
    """
    wanted = users.select("user").distinct().withColumn("_id", F.col("user").try_cast("int"))
    known = model.userFactors.select(F.col("id").alias("_id"), "features")
    asked = wanted.join(known, "_id", "left")
    if exclude is not None:
        # At most every item of the catalogue per user, however often it was rated.
        seen = exclude.select(F.col("user").try_cast("int").alias("_id"), F.col("item").cast("int").alias("item"))
        seen = seen.groupBy("_id").agg(F.collect_set("item").alias("seen"))
        asked = asked.join(seen, "_id", "left")
    asked = asked.drop("_id")
    return ranked(top_items(asked, model.itemFactors, n))


def ranked(tops: DataFrame) -> DataFrame:
    """P20: ``user, known, items, scores`` -> ``user, known, rank, app_id, score`` (rank from 1)."""
    pairs = F.arrays_zip(F.col("items").alias("item"), F.col("scores").alias("score"))
    return tops.select("user", "known", F.posexplode_outer(pairs).alias("pos", "rec")).select(
        "user", "known", (F.col("pos") + 1).alias("rank"), F.col("rec.item").alias("app_id"), F.col("rec.score").alias("score"))


# Items whose factors are sent to the tasks at a time, in bytes of a task's two copies (sent and unpacked); a larger
# catalogue takes several rounds.
GROUP_BYTES = 64 << 20
# Items multiplied at a time, and users.
BLOCK_ITEMS, BLOCK_USERS = 4096, 256


def top_items(users: DataFrame, items: DataFrame, n: int, group_bytes: int = GROUP_BYTES,
              block: int = BLOCK_ITEMS) -> DataFrame:
    """Per row of ``users`` (``user, features`` and, if given, ``seen`` items to leave out): the ``n`` items
    (``id, features``) of the largest products, ties by smaller id: ``user, known, items, scores``.

    Items go by falling norm, in groups of ``group_bytes`` that are sent to the tasks, and
    blocks. A product is at most the product of the norms, so a user whose n-th
    score is above the block's bound needs none of the blocks that follow;
    users are compared with a few blocks instead of with all items, and no join
    pairs users with items. State between groups is a written table; users that
    need no further group leave it with their answer alone.
    """
    spark = users.sparkSession
    if "seen" not in users.columns:
        users = users.withColumn("seen", F.lit(None).cast("array<int>"))
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    first = items.select(F.size("features")).first()
    single = dict(items.dtypes)["features"] == "array<float>"
    size = max(1, group_bytes // ((8 if single else 16) * first[0])) if first else 1
    items = items.select(F.col("id").cast("int").alias("id"), "features", norm.alias("norm"))
    groups = max(1, -(-items.count() // size))
    if groups > 1:
        path = scratch_dir(spark, "item-groups")
        split = items.repartitionByRange(groups, F.col("norm").desc(), "id").withColumn("part", F.spark_partition_id())
        split.write.partitionBy("part").parquet(path)
        items = spark.read.parquet(path)
    bounds = {r["part"]: r["top"] for r in items.groupBy("part").agg(F.max("norm").alias("top")).collect()} if groups > 1 else {}

    none = "array<{}>".format
    kept = users.select("user", "features", F.col("seen").cast("array<int>").alias("seen"), F.col("features").isNotNull().alias("known"),
                        F.array().cast(none("int")).alias("items"), F.array().cast(none("double")).alias("scores"), F.lit(True).alias("open"))
    schema, answer = kept.schema, ["user", "known", "items", "scores"]
    state, done = kept, []
    parts = sorted(bounds) or [None]
    for i, part in enumerate(parts):
        group = (items if part is None else items.where(F.col("part") == part)).orderBy(F.col("norm").desc(), "id").toArrow().combine_chunks()
        ids, norms = group["id"].to_numpy(), group["norm"].to_numpy()
        factors = group["features"].combine_chunks().flatten().to_numpy().reshape(len(ids), first[0] if first else 0)
        later = bounds[parts[i + 1]] if i + 1 < len(parts) else None
        state = state.mapInArrow(_best_of(ids, factors, norms, n, block, later), schema)
        if later is not None:
            path = scratch_dir(spark, "top-items")
            left = [F.when(F.col("open"), F.col(c)).alias(c) for c in ("features", "seen")]
            state.select("user", *left, "known", "items", "scores", "open").write.partitionBy("open").parquet(path)
            state = spark.read.schema(schema).parquet(path)
            done.append(state.where(~F.col("open")).select(answer))
            state = state.where(F.col("open")).select(schema.names)
            if state.isEmpty():
                break
    tops = state.select(answer)
    for x in done:
        tops = x.unionByName(tops)
    return tops


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All products of rows, summed in the order of the factors, so that a score does not depend on which others
    are computed with it (as it may in a matrix product)."""
    out = np.zeros((len(a), len(b)))
    for x, y in zip(a.T, b.T):
        out += x[:, None] * y[None, :]
    return out


def _best_of(ids: np.ndarray, factors: np.ndarray, norms: np.ndarray, n: int, block: int, later: float | None = None):
    """Merges one group of items, by falling norm, into each user's best ``n``. ``later``: the largest norm of the
    groups that follow; a user that needs none of them is no longer ``open``."""
    by_id = np.argsort(ids)

    def merged(u: np.ndarray, seen: list[np.ndarray], best: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        size = np.sqrt((u * u).sum(axis=1)) * (1 + 1e-9)  # products are rounded
        least = np.array([s[-1] if len(s) == n else -np.inf for _, s in best])
        for lo in range(0, len(ids), block):
            open_ = np.flatnonzero(size * norms[lo] >= least)
            if not len(open_):
                break
            some_factors = factors[lo:lo + block].astype(np.float64)
            # A matrix product is fast, and near enough to tell which products may be among the best.
            about = u[open_] @ some_factors.T
            slack = 1e-9 * size[open_] * norms[lo]
            floor = least[open_] - slack
            for row in np.flatnonzero(about.max(axis=1) >= floor):
                k = open_[row]
                near, left = about[row], seen[k]
                if len(left):
                    near[left[(left >= lo) & (left < lo + block)] - lo] = -np.inf
                at = np.flatnonzero((near >= floor[row]) & (near > -np.inf))
                if len(at) > n:
                    at = at[near[at] >= np.partition(near[at], -n)[-n] - 2 * slack[row]]
                score = _products(u[k:k + 1], some_factors[at])[0]
                some = np.flatnonzero(score >= least[k])
                if len(some) > n:  # the n-th best and its ties
                    some = some[score[some] >= np.partition(score[some], -n)[-n]]
                item, value = np.concatenate([best[k][0], ids[lo + at[some]]]), np.concatenate([best[k][1], score[some]])
                order = np.lexsort((item, -value))[:n]
                best[k] = item[order], value[order]
                if len(order) == n:
                    least[k] = value[order[-1]]
        return size * later >= least if later is not None else np.zeros(len(u), dtype=bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_USERS):
                batch = whole.slice(at, BLOCK_USERS)
                features, items, scores = (batch.column(c).to_pylist() for c in ("features", "items", "scores"))
                seen = batch.column("seen")
                known = [i for i, f in enumerate(features) if f is not None]
                best = [(np.array(i, dtype=np.int32), np.array(s, dtype=np.float64)) for i, s in zip(items, scores)]
                still = np.zeros(batch.num_rows, dtype=bool)
                if known and n > 0:
                    left = []
                    for i in known:
                        s = seen[i].values
                        s = np.array([], dtype=np.int32) if s is None else s.drop_null().to_numpy()
                        at_id = np.minimum(np.searchsorted(ids, s, sorter=by_id), len(ids) - 1)
                        left.append(by_id[at_id][ids[by_id[at_id]] == s] if len(ids) else s)
                    some = [best[i] for i in known]
                    still[known] = merged(np.array([features[i] for i in known], dtype=np.float64), left, some)
                    for i, b in zip(known, some):
                        best[i] = b
                columns = [batch.column(c) for c in ("user", "features", "seen", "known")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([i for i, _ in best], pa.list_(pa.int32())), pa.array([s for _, s in best], pa.list_(pa.float64())), pa.array(still)],
                                                 names=["user", "features", "seen", "known", "items", "scores", "open"])

    return run
