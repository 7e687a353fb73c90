"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recoflow.streaming.ingest import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: cuts the lineage, and
    survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of an id's text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def groups_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Runs of equal ``key`` from batches that are sorted by it.

    Yields, for every input batch, one batch that ends at a group boundary; a
    group that crosses batches is carried over, so groups are never cut.
    """
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        k = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(k != k[-1], False)) if k[0] == k[-1] else int(np.flatnonzero(k != k[-1])[-1]) + 1
        if cut:
            yield batch.slice(0, cut)
        rest = batch.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def smallest(rows: DataFrame, key: str, hashed: str, ties: str, n: int, max_keys: int = 1000) -> DataFrame:
    """The ``n`` rows of each ``key`` with the smallest hash (a bigint), for the ``max_keys`` most frequent keys.

    Keys are counted first (partial sums; one row per key comes to the driver); then only hashes below a
    threshold are ranked, which four times ``n`` rows of a key are expected to pass, so that no task ranks
    a key that holds most rows.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("c")).orderBy(F.desc("c"), key).limit(max_keys).collect()
    some = F.lit(False)
    for r in counts:
        below = int(min(1.0, 4 * n / r["c"]) * (1 << 64)) - (1 << 63)
        some = some | ((F.col(key) == F.lit(r[key])) & (F.col(hashed) <= F.lit(min(below, (1 << 63) - 1))))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(hashed, ties))
    return rows.where(some).withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


_BASE = 0x5851F42D4C957F2D  # odd, so that powers have inverses modulo 2**64
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base of polynomial hashes and of its inverse, at least n of each."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            _POWERS[i] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def boundaries(keys: np.ndarray) -> np.ndarray:
    """Start offsets of the runs in ``keys``, and its length at the end."""
    if not len(keys):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (columns u, v: bigint, no nulls).

    Alternating large-star and small-star: each round rewires every edge to the
    smallest neighbour, until the edges are stars around the smallest id of
    their component. Only minima are aggregated (map-side combined), so a vertex
    with very many neighbours is never gathered in one task; the join back to
    its edges is an equi-join that adaptive execution can split. Every round is
    written to the shared folder. Vertices without edges are not returned.
    """

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))

    def small_star(e: DataFrame) -> DataFrame:
        # Every edge is (larger, smaller) here; the smallest edge of a vertex stays, others are moved to its end.
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        moved = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        return e.join(least, "u").select(moved.alias("u"), F.col("m").alias("v")).distinct()

    def settled(e: DataFrame) -> bool:
        """Whether no vertex has two smaller neighbours, or a smaller and a larger one."""
        ends = e.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            e.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return ends.where("up > 1 or (up = 1 and down = 1)").isEmpty()

    e = edges.select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v"))
    e = materialize(e.where("u <> v").distinct(), "cc")
    rounds = 0
    while not settled(e):
        if rounds == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        e = materialize(small_star(large_star(e)), "cc")
        rounds += 1
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
