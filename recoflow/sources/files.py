"""File sources.

CSV is read with an explicit all-string schema and the options that make a
Spark read agree with Python's ``csv`` module: doubled quotes inside a quoted
field (``escape='"'``), quoted newlines (``multiLine``, games only: it makes a
file unsplittable), and a header that must match the schema by name
(``enforceSchema=false``), so a reordered file fails loudly instead of
silently swapping columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import BATCH_SCHEMA, GAMES_SCHEMA, MODEL_COLUMNS, REVIEWS_SCHEMA, USERS_SCHEMA


def read_csv(spark: SparkSession, path: str, schema: StructType, multiline: bool = False) -> DataFrame:
    """Header CSV with a fixed schema, all values as strings.

    ``multiline=True`` is needed only when quoted fields contain line breaks;
    it makes every file one unsplittable task, so it is used only for the small
    games catalogue (free-text titles). The large tables are read splittable.
    """
    return (spark.read.schema(schema)
            .option("header", "true")
            .option("enforceSchema", "false")
            .option("escape", '"')
            .option("multiLine", "true" if multiline else "false")
            .option("mode", "PERMISSIVE")
            .csv(path))


def read_users_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Ids and counts only, read splittable."""
    return read_csv(spark, path, USERS_SCHEMA, multiline)


def read_games_csv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Titles may hold quoted line breaks; a catalogue is small."""
    return read_csv(spark, path, GAMES_SCHEMA, multiline)


def read_reviews_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """S3 / S9 (the producer reads the same file as string records): the
    largest table; ids, flags, numbers and dates only, read splittable."""
    return read_csv(spark, path, REVIEWS_SCHEMA, multiline)


def read_batches(spark: SparkSession, path: str, schema: StructType = BATCH_SCHEMA) -> DataFrame:
    """S4 + S5: Parquet batches by folder with the fixed schema; corrupt or
    vanished files are skipped for this read only (not session-wide)."""
    return (spark.read.schema(schema)
            .option("ignoreCorruptFiles", "true")
            .option("ignoreMissingFiles", "true")
            .parquet(path))


def read_or_empty(spark: SparkSession, path: str, schema: StructType, multiline: bool = False) -> DataFrame:
    """The CSV table if the path exists, else an empty table with the columns."""
    try:
        df = read_csv(spark, path, schema, multiline)
        df.schema  # resolve now so a missing path fails here
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """Processed rows (K1). The raw model columns stay text when the table is partitioned by one of
    them: Spark would make a date of a folder named ``date=2024-01-31``."""
    found = spark.read.parquet(path).schema
    return spark.read.schema(StructType([StructField(f.name, StringType(), True) if f.name in MODEL_COLUMNS else f for f in found])).parquet(path)


#: A Parquet file without rows is smaller than this; of larger files only rows can tell that they were read.
EMPTY_FILE_BYTES = 1 << 20


def _has_footer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of small files, those that are no Parquet."""
    for batch in batches:
        broken = []
        for blob in batch.column("content"):
            try:
                pq.ParquetFile(pa.BufferReader(blob.as_buffer())).metadata  # noqa: B018
                broken.append(False)
            except (pa.ArrowException, OSError):
                broken.append(True)
        yield batch.select(["path", "length"]).filter(pa.array(broken, pa.bool_()))


def skipped_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, length`` of the files that :func:`read_batches` leaves out because they do not read as Parquet.

    The listing (names and sizes, no contents) less the files that rows came from; of what
    is left, small files are opened, because a sound file without rows gives none either. A file that
    breaks after its first rows were read counts as read in part and is not listed, nor is a file of no bytes.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    # The metadata column holds a URI, the listing a plain path.
    uri = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    read = read_batches(spark, path).select(plain(F.url_decode(uri)).alias("file")).distinct()
    silent = listing.select("path", "length", plain(F.col("path")).alias("file")).join(read, "file", "left_anti").select("path", "length")
    small = listing.where(F.col("length") <= EMPTY_FILE_BYTES).select("path", "length", "content").join(silent.select("path"), "path", "left_semi")
    return silent.where(F.col("length") > EMPTY_FILE_BYTES).unionByName(small.mapInArrow(_has_footer, "path string, length bigint"))
