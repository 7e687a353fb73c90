"""File sinks (K1, K2, K5).

A failed write raises: a job never reports success without its output (the
reference logs the error and carries on).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_processed(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """K1: overwrite processed rows as Parquet (optionally partitioned, e.g. by
    landing date, so per-segment training reads only its partition).

    Partitioned, rows are first rebalanced by the partition columns: a value's rows
    come together, so that a task does not write a small file into every
    folder, and adaptive execution splits a large value over tasks and merges small ones.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """K2: a header CSV folder (one file per task; no single-writer funnel)."""
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
