"""Operator 3: near-duplicate vectors by p-stable hashing.

Vectors are normalised; in each of ``TABLES`` tables ``FUNCTIONS`` random Gaussian
projections, shifted and quantised at ``STEP``, make a bucket. Two vectors at a
cosine of 0.93 (a distance of 0.374) agree in one function with a probability of
0.851 and in one bucket with 0.104, so that 100 tables miss such a pair with a
probability of 2e-5, closer ones with far less; unrelated vectors agree in a
bucket with 4e-5. Vectors of one label in one bucket are compared by cosine in
double precision.

Equal vectors of a label are one class with a count, found by a partial sum.
Only buckets that two classes share go on. A bucket is cut into blocks of about
``BLOCK`` classes by a hash, and each pair of blocks is a unit of work of its own,
so a bucket that holds a third of all vectors is shared by many tasks. A unit
multiplies its two blocks. A pair found in several tables counts in the first in
which its buckets agree, so counts need no list of pairs: a unit returns for
each of its vectors how many others it links with, and a spanning forest of its
links for the components.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, null labels and null ids link with nothing (n_links 0, their own
component); vectors of different length are never compared; repeated rows of one
id are copies that link with each other; an empty table gives an empty result;
only vec_id, embedding and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoflow.llm.common import boundaries, connected_components, groups_of, materialize

THRESHOLD = 0.93
TABLES = 100
FUNCTIONS = 14
STEP = 2.0
BLOCK = 1024
SEED = 5
# Pairs of a unit from which the first tables are asked before products are made, and how many tables.
LARGE, EARLY = 1 << 14, 8


def _projections(dim: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dim])
    return rng.standard_normal((dim, TABLES * FUNCTIONS)), rng.uniform(0, STEP, TABLES * FUNCTIONS)


def buckets_of(vectors: np.ndarray) -> np.ndarray:
    """Bucket (32 bits) of each normalised vector in each table."""
    a, b = _projections(vectors.shape[1])
    cell = np.floor((vectors @ a + b) / STEP).astype(np.int64).view(np.uint64).reshape(len(vectors), TABLES, FUNCTIONS)
    h = np.zeros((len(vectors), TABLES), dtype=np.uint64)
    for k in range(FUNCTIONS):
        h = (h ^ cell[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(16)).astype(np.uint32)


def _hashed(classes: DataFrame) -> DataFrame:
    """Classes with their bucket in every table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.diff(batch.column("vec").offsets.to_numpy())
            out = np.zeros((batch.num_rows, TABLES), dtype=np.uint32)
            flat = batch.column("vec").flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(dims)[:-1]])
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                v = flat[starts[rows][:, None] + np.arange(dim)[None, :]]
                v = v / np.abs(v).max(axis=1, keepdims=True)
                out[rows] = buckets_of(v / np.linalg.norm(v, axis=1, keepdims=True))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, TABLES, dtype=np.int32)), pa.array(out.view(np.int32).ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "cells"])

    return classes.mapInArrow(run, classes.select("*", F.array(F.lit(0)).alias("cells")).schema)


def _compare(threshold: float):
    """Units (rows sorted by ``unit``) to rows (u, v, n): n links of u, or an edge u-v where n is 0."""
    def unit(ids, copies, side, cells, table, v) -> Iterator[tuple[int, int, int]]:
        one, two = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        # A pair counts only in the first table where the two agree. In a dense group most agree in one of the
        # first tables, so these are asked before anything is multiplied.
        early = min(int(table), EARLY) if len(one) * len(two) >= LARGE else 0
        if early:
            new = cells[one, 0][:, None] != cells[two, 0][None, :]
            for t in range(1, early):
                if not new.any():
                    return
                new &= cells[one, t][:, None] != cells[two, t][None, :]
            a, b = new.any(axis=1), new.any(axis=0)
            one, two, new = one[a], two[b], new[np.ix_(a, b)]
            if not len(one):
                return
        linked = v[one] @ v[two].T >= threshold
        i, j = np.nonzero(linked & new if early else linked)
        i, j = one[i], two[j]
        mine = ids[i] < ids[j] if side[0] == 2 else np.ones(len(i), dtype=bool)
        i, j = i[mine], j[mine]
        for t in range(early, int(table)):
            if not len(i):
                return
            if len(i) < 20_000:  # all other tables at once
                apart = (cells[i, t:table] != cells[j, t:table]).all(axis=1)
                i, j = i[apart], j[apart]
                break
            apart = cells[i, t] != cells[j, t]
            i, j = i[apart], j[apart]
        if not len(i):
            return
        n = np.bincount(i, weights=copies[j], minlength=len(ids)) + np.bincount(j, weights=copies[i], minlength=len(ids))
        for k in np.flatnonzero(n):
            yield int(ids[k]), int(ids[k]), int(n[k])
        root = np.arange(len(ids))

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        left = len(ids) - 1
        for x, y in zip(i.tolist(), j.tolist()):
            p, q = find(x), find(y)
            if p != q:
                root[p] = q
                yield int(ids[x]), int(ids[y]), 0
                left -= 1
                if not left:  # all are one component
                    return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups_of(batches, "unit"):
            unit_ids = batch.column("unit").to_numpy()
            ids, copies, side, table, dim = (batch.column(c).to_numpy() for c in ("rep", "copies", "side", "at", "dim"))
            cells = batch.column("cells").flatten().to_numpy().reshape(-1, TABLES)
            flat = batch.column("vec").flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(dim)])
            edges = boundaries(unit_ids)
            rows: list[tuple[int, int, int]] = []
            for lo, hi in zip(edges[:-1], edges[1:]):
                if hi - lo > 1:
                    v = flat[starts[lo]:starts[hi]].astype(np.float64).reshape(hi - lo, -1)
                    v = v / np.abs(v).max(axis=1, keepdims=True)
                    v /= np.linalg.norm(v, axis=1, keepdims=True)
                    rows.extend(unit(ids[lo:hi], copies[lo:hi], side[lo:hi], cells[lo:hi], table[lo], v))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["u", "v", "n"])

    return run


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    vec = F.col("embedding").cast("array<double>")
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0)
              & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0))
    # Negative zero and zero are one value to the comparison, but not to a hash.
    plain = F.transform("vec", lambda x: F.when(x == 0, 0.0).otherwise(x))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", vec.alias("vec"))
    rows = rows.withColumn("vec", F.when(F.coalesce(usable, F.lit(False)), plain))
    rows = materialize(rows.withColumn("h1", F.when(F.col("vec").isNotNull(), F.xxhash64("label", "vec")))
                       .withColumn("h2", F.when(F.col("vec").isNotNull(), F.hash("vec", "label"))), "vectors")
    same = ["label", "h1", "h2"]
    classes = rows.where("h1 is not null").groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = materialize(classes, "classes")
    reps = (rows.join(classes.withColumnRenamed("rep", "vec_id"), [*same, "vec_id"])
            .dropDuplicates([*same, "vec_id"]).select(F.col("vec_id").alias("rep"), "label", "copies", F.size("vec").alias("dim"), "vec"))
    hashed = materialize(_hashed(reps), "hashed")
    cells = hashed.select("rep", "label", "dim", F.posexplode("cells").alias("at", "cell"))
    bucket = F.xxhash64("label", "dim", "at", "cell").alias("bucket")
    cells = cells.select("rep", "at", bucket)
    shared = cells.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    placed = cells.join(shared, "bucket").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    # Each class goes to the units of its block with every block; a unit of one block has side 2.
    placed = placed.withColumn("mine", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    placed = placed.select("rep", "at", "bucket", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    lo, hi = F.least("mine", "other"), F.greatest("mine", "other")
    side = F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1)
    units = materialize(placed.select("rep", "at", F.xxhash64("bucket", lo, hi).alias("unit"), side.alias("side")), "units")
    work = units.join(hashed.select("rep", "copies", "dim", "vec", "cells"), "rep")
    work = work.repartition("unit").sortWithinPartitions("unit")
    found = materialize(work.select("unit", "rep", "copies", "side", "at", "dim", "vec", "cells")
                        .mapInArrow(_compare(threshold), "u bigint, v bigint, n bigint"), "links")
    counts = found.where("n > 0").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("others"))
    comp = connected_components(found.where("n = 0").select("u", "v"))
    known = (classes.join(counts, "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
             .select(*same, (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    out = rows.join(known, same, "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
