"""Continuous ingest of review messages.

source (Kafka topic or a folder of JSON-lines files)
  -> decode (P17) -> split landable / quarantine (F5) -> align (P15)
  -> one Parquet batch per micro-batch (K4), quarantine beside it.

Delivery is exactly-once from source offsets to files: offsets are committed
in the checkpoint only after the batch is written, and each micro-batch writes
into its own ``batch_id=<n>`` folder with overwrite, so a replayed batch
replaces its earlier partial output instead of duplicating it. The reference
consumer auto-commits offsets and clears its buffer even when a write fails,
so it can both lose and repeat rows.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..functions.json_codec import decode_messages, encode_message, landable, quarantined
from ..schemas import BATCH_SCHEMA, MESSAGE_COLUMNS
from ..session import default_parallelism, scratch_dir  # noqa: F401  (scratch_dir: imported from here by callers)

log = logging.getLogger(__name__)

# Topic, consumer group and batch closing rules.
TOPIC = "game.reviews"
GROUP_ID = "parquet_consumer_group"
BATCH_ROWS = 500_000
BATCH_TIMEOUT = "5 minutes"
# Kafka: the trigger only polls; minOffsetsPerTrigger / maxTriggerDelay decide
# when a batch closes (500k messages or 5 minutes, whichever comes first).
KAFKA_POLL = "10 seconds"
# File source: bytes that a micro-batch takes per task slot, so a backlog lands in batches that fit the cluster.
BYTES_PER_SLOT = 256 << 20


def kafka_source_options(bootstrap_servers: str, topic: str = TOPIC,
                         batch_rows: int = BATCH_ROWS, batch_timeout: str = BATCH_TIMEOUT,
                         group_id: str = GROUP_ID, slots: int = 1) -> dict[str, str]:
    """S8 + T2: Kafka source options.

    Earliest offsets for a new query; a micro-batch closes when ``batch_rows``
    messages wait or, with fewer, after ``batch_timeout``. If more wait it takes up to
    ``batch_rows`` for each of the cluster's task ``slots``, so the rate grows with the
    cluster (files hold ``batch_rows`` at most in any case). Offsets live in
    the query checkpoint, not in the consumer group (the group id only names
    the client for broker-side quotas and monitoring).
    """
    delay = batch_timeout.replace(" minutes", "m").replace(" minute", "m")
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(batch_rows * max(1, slots)),
        "minOffsetsPerTrigger": str(batch_rows),
        "maxTriggerDelay": delay,
        "kafka.group.id": group_id,
        "failOnDataLoss": "true",
    }


def kafka_sink_options(bootstrap_servers: str, topic: str = TOPIC) -> dict[str, str]:
    """K3: producer options; ``acks=all`` and retries as the reference sets them."""
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.linger.ms": "10",
        "kafka.batch.size": str(16384 * 2),
    }


def kafka_message_key(partition, offset):
    """Stable numeric key of a message in the (single) topic:
    ``partition * 2^40 + offset``, as text. Unique, ordered by partition then
    offset, and numeric, so first-n over landed rows takes the distributed
    numeric-rank path (a ``topic:partition:offset`` text key would tie on its
    common prefix)."""
    return (F.col(partition).cast("bigint") * F.lit(1 << 40) + F.col(offset)).cast("string")


def read_kafka(spark: SparkSession, bootstrap_servers: str, **kw) -> DataFrame:
    """Messages from a topic, with their position as the stable key."""
    kw.setdefault("slots", default_parallelism(spark))
    raw = spark.readStream.format("kafka").options(**kafka_source_options(bootstrap_servers, **kw)).load()
    return raw.select(
        F.col("value").cast("string").alias("value"),
        kafka_message_key("partition", "offset").alias("msg_key"),
    )


def bytes_per_trigger(spark: SparkSession) -> int:
    """T2 for files: what a micro-batch takes, by the cluster's size."""
    return BYTES_PER_SLOT * default_parallelism(spark)


def read_json_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """A folder of JSON-lines files as a message stream (one message per line).

    A micro-batch takes up to ``max_bytes`` (one file at least), or ``files_per_trigger``
    files, or all that is there if neither is given. Files carry no offsets, so the key is md5 of the message text: equal keys
    mean identical messages, which are interchangeable.
    """
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    elif max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.load(path).select("value", F.md5("value").alias("msg_key"))


def land_batch(batch: DataFrame, batch_id: int, out_dir: str, quarantine_dir: str,
               max_records_per_file: int = BATCH_ROWS) -> int:
    """K4 + F5 for one micro-batch: landable rows and quarantine, idempotently. Returns the messages read."""
    decoded = decode_messages(batch).persist()
    try:
        good = landable(decoded, keep=("msg_key",))
        (good.write.mode("overwrite").option("maxRecordsPerFile", str(max_records_per_file))
         .parquet(f"{out_dir}/batch_id={batch_id}"))
        bad = quarantined(decoded, keep=("msg_key",))
        bad.write.mode("overwrite").parquet(f"{quarantine_dir}/batch_id={batch_id}")
        return decoded.count()
    finally:
        decoded.unpersist()


def start_ingest(messages: DataFrame, out_dir: str, quarantine_dir: str, checkpoint: str,
                 trigger: dict | None = None, query_name: str | None = None, batch_rows: int = BATCH_ROWS,
                 batch_timeout: str = BATCH_TIMEOUT) -> StreamingQuery:
    """T1 (+T2/T3 via ``trigger``): start the landing query.

    ``trigger``: ``{"processingTime": KAFKA_POLL}`` for a Kafka consumer (the
    source options close batches at 500k messages or 5 minutes),
    ``{"processingTime": "5 minutes"}`` (the default) for a file source, or
    ``{"availableNow": True}`` to drain what is there and stop (T3). Files hold ``batch_rows`` at most.

    T5: every batch leaves its progress beside the checkpoint (:func:`landed_batches`),
    so the record outlives the driver; a replayed batch replaces its own.
    """
    progress = progress_dir(checkpoint)

    def land(batch: DataFrame, batch_id: int) -> None:
        rows = land_batch(batch, batch_id, out_dir, quarantine_dir, max_records_per_file=batch_rows)
        done = batch.sparkSession.range(1).select(F.lit(rows).cast("long").alias("numInputRows"), F.current_timestamp().alias("timestamp"))
        done.coalesce(1).write.mode("overwrite").parquet(f"{progress}/batch_id={batch_id}")

    writer = (messages.writeStream
              .foreachBatch(land)
              .option("checkpointLocation", checkpoint)
              .trigger(**(trigger or {"processingTime": batch_timeout})))
    if query_name:
        writer = writer.queryName(query_name)
    query = writer.start()
    query.progress_dir = progress
    return query


def progress_dir(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-progress"


def landed_batches(spark: SparkSession, checkpoint_progress: str) -> DataFrame:
    """T5: ``batchId, numInputRows, timestamp`` of every micro-batch landed since the checkpoint was new, whichever
    driver landed it."""
    schema = StructType([StructField("numInputRows", LongType()), StructField("timestamp", TimestampType()), StructField("batch_id", LongType())])
    try:
        done = spark.read.schema(schema).parquet(checkpoint_progress)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        done = spark.createDataFrame([], schema)
    return done.select(F.col("batch_id").alias("batchId"), "numInputRows", "timestamp")


def progress_summary(query: StreamingQuery, last: int | None = None) -> list[dict]:
    """T5: rows read per finished micro-batch of a query that ``start_ingest`` returned, also those of earlier
    runs from the same checkpoint; the ``last`` ones only, if given."""
    done = landed_batches(query.sparkSession if hasattr(query, "sparkSession") else SparkSession.active(), query.progress_dir)
    done = done.orderBy("batchId") if last is None else done.orderBy(F.col("batchId").desc()).limit(last)
    rows = [{"batchId": r["batchId"], "numInputRows": r["numInputRows"], "timestamp": r["timestamp"].isoformat()} for r in done.collect()]
    return sorted(rows, key=lambda r: r["batchId"])


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """S4 + S5: landed batches with the fixed 5-string schema (+ key, batch id).

    Corrupt or vanished files are skipped for this read only, not session-wide.
    """
    schema = StructType(list(BATCH_SCHEMA.fields) + [StructField("msg_key", StringType(), True)])
    return (spark.read.schema(schema)
            .option("ignoreCorruptFiles", "true")
            .option("ignoreMissingFiles", "true")
            .parquet(path))


def reviews_from_landed(landed: DataFrame) -> DataFrame:
    """Landed messages shaped as raw reviews, so prepare runs the same casts
    (P6, never the lossy P8), joins and filters on them; the message key
    becomes the review key."""
    return landed.select(
        "app_id", F.lit(None).cast("string").alias("helpful"),
        F.lit(None).cast("string").alias("funny"), "date", "is_recommended", "hours",
        "user_id", F.col("msg_key").alias("review_id"))


def publish(reviews: DataFrame) -> DataFrame:
    """K3 / T4 payload: one JSON message per review (``value`` column), ready for
    ``write.format('kafka').options(**kafka_sink_options(...))``."""
    return reviews.select(encode_message(*MESSAGE_COLUMNS).alias("value"))


def read_reviews_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """S9 as a stream: review CSV files arriving in a folder, all values as text."""
    from ..schemas import REVIEWS_SCHEMA

    reader = (spark.readStream.schema(REVIEWS_SCHEMA).option("header", "true")
              .option("enforceSchema", "false").option("escape", '"'))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.csv(path)


def start_publish(reviews: DataFrame, checkpoint: str, bootstrap_servers: str | None = None,
                  path: str | None = None, topic: str = TOPIC,
                  trigger: dict | None = None) -> StreamingQuery:
    """T4: publish every review as a JSON message.

    To a topic with ``bootstrap_servers`` (Kafka sink, acks=all), or as
    JSON-lines files under ``path`` (the file-source ingest reads those).
    The checkpoint makes the publisher resume where it stopped.
    """
    writer = publish(reviews).writeStream.option("checkpointLocation", checkpoint)
    if bootstrap_servers:
        writer = writer.format("kafka").options(**kafka_sink_options(bootstrap_servers, topic))
    else:
        writer = writer.format("text").option("path", path)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
