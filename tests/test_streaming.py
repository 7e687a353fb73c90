"""Streaming ingest (T1-T5, K4): restart without loss or duplicates."""

import os

from recoflow.plans.queries import message_decoded
from recoflow.sources import tables as T
from recoflow.streaming import ingest as IN
from tests.conftest import SF_SMALL


def _run(spark, src, base):
    q = IN.start_ingest(IN.read_json_lines(spark, src, files_per_trigger=1), f"{base}/landed",
                        f"{base}/quarantine", f"{base}/ckpt", trigger={"availableNow": True})
    q.awaitTermination()
    return q


def test_two_halves_with_restart_equal_batch(spark, tmp):
    msgs = T.messages_raw(spark, SF_SMALL)
    src = os.path.join(tmp, "in")
    msgs.filter("msg_id % 2 = 0").select("value").repartition(3).write.text(f"{src}/a")
    q1 = _run(spark, f"{src}/*", tmp)
    assert sum(p["numInputRows"] for p in IN.progress_summary(q1)) == msgs.filter("msg_id % 2 = 0").count()
    msgs.filter("msg_id % 2 = 1").select("value").repartition(2).write.text(f"{src}/b")
    _run(spark, f"{src}/*", tmp)  # restart from the same checkpoint
    landed = IN.read_landed(spark, f"{tmp}/landed").select(*IN.MESSAGE_COLUMNS)
    expected = message_decoded(spark, SF_SMALL).select(*IN.MESSAGE_COLUMNS)
    assert landed.count() == expected.count()
    assert landed.exceptAll(expected).count() == 0 and expected.exceptAll(landed).count() == 0
    quarantined = spark.read.parquet(f"{tmp}/quarantine")
    assert quarantined.count() == msgs.count() - expected.count() - msgs.filter("value = '{}'").count()


def test_summary_holds_all_batches(spark, tmp):
    src = os.path.join(tmp, "in")
    T.messages_raw(spark, SF_SMALL).limit(10).select("value").repartition(5).write.text(src)
    files = len([f for f in os.listdir(src) if f.endswith(".txt")])
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "2")
    try:
        q = _run(spark, src, tmp)
    finally:
        spark.conf.unset(key)
    got = IN.progress_summary(q)
    assert [p["batchId"] for p in got] == list(range(files)) and files > 2
    assert sum(p["numInputRows"] for p in got) == 10


def test_kafka_options():
    opts = IN.kafka_source_options("broker:9093")
    assert opts["subscribe"] == "game.reviews" and opts["startingOffsets"] == "earliest"
    assert opts["maxOffsetsPerTrigger"] == opts["minOffsetsPerTrigger"] == "500000"
    assert IN.kafka_source_options("broker:9093", slots=64)["maxOffsetsPerTrigger"] == "32000000"
    assert opts["maxTriggerDelay"] == "5m"
    sink = IN.kafka_sink_options("broker:9093")
    assert sink["kafka.acks"] == "all" and sink["kafka.retries"] == "3"


def test_publish_csv_stream_then_ingest(spark, tmp):
    """T4 then T1: review CSV files -> JSON messages -> landed batches."""
    from recoflow.sinks.files import write_csv
    from recoflow.plans.queries import review_messages

    csv_dir = os.path.join(tmp, "csv")
    write_csv(T.reviews_raw(spark, SF_SMALL).repartition(3), csv_dir)
    out = os.path.join(tmp, "messages")
    q = IN.start_publish(IN.read_reviews_stream(spark, csv_dir, files_per_trigger=1),
                         os.path.join(tmp, "pub_ckpt"), path=out)
    q.awaitTermination()
    sent = spark.read.text(out)
    expected = review_messages(spark, SF_SMALL).select("value")
    assert sent.count() == expected.count()
    assert sent.exceptAll(expected).count() == 0
    _run(spark, out, os.path.join(tmp, "ingest"))
    landed = IN.read_landed(spark, os.path.join(tmp, "ingest", "landed"))
    assert landed.count() == expected.count()


def test_failed_batch_is_replayed_without_duplicates(spark, tmp, monkeypatch):
    """A crash after a batch's files are written but before its offsets are
    committed: the restart replays the batch into the same folder (overwrite)."""
    from pyspark.errors import StreamingQueryException

    msgs = T.messages_raw(spark, SF_SMALL)
    src = os.path.join(tmp, "in")
    msgs.select("value").repartition(2).write.text(src)
    real = IN.land_batch
    state = {"failed": False}

    def flaky(batch, batch_id, out_dir, quarantine_dir, **kw):
        real(batch, batch_id, out_dir, quarantine_dir, **kw)
        if batch_id == 0 and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("executor lost after writing")

    monkeypatch.setattr(IN, "land_batch", flaky)
    try:
        _run(spark, src, tmp)
        raise AssertionError("the first run should have failed")
    except StreamingQueryException:
        pass
    assert state["failed"]
    monkeypatch.setattr(IN, "land_batch", real)
    _run(spark, src, tmp)
    landed = IN.read_landed(spark, f"{tmp}/landed").select(*IN.MESSAGE_COLUMNS)
    expected = message_decoded(spark, SF_SMALL).select(*IN.MESSAGE_COLUMNS)
    assert landed.count() == expected.count()
    assert landed.exceptAll(expected).count() == 0 and expected.exceptAll(landed).count() == 0


def test_kafka_message_key_is_numeric_and_ordered(spark):
    df = spark.createDataFrame([(0, 5), (0, 6), (1, 0), (3, 2**39)], "partition int, offset long")
    keys = [int(r["k"]) for r in df.select(IN.kafka_message_key("partition", "offset").alias("k")).collect()]
    assert keys == sorted(keys) and len(set(keys)) == 4


def test_progress_outlives_the_driver(spark, tmp):
    """The second run's summary, and a reader without any query, know the first run's batches."""
    src = os.path.join(tmp, "in")
    rows = T.messages_raw(spark, SF_SMALL).limit(60).select("value")
    rows.limit(20).repartition(2).write.text(f"{src}/a")
    _run(spark, f"{src}/*", tmp)
    rows.limit(20).repartition(1).write.text(f"{src}/b")
    q = _run(spark, f"{src}/*", tmp)
    got = IN.progress_summary(q)
    assert [p["batchId"] for p in got] == [0, 1, 2] and sum(p["numInputRows"] for p in got) == 40
    assert IN.landed_batches(spark, IN.progress_dir(f"{tmp}/ckpt")).count() == 3
    assert [p["batchId"] for p in IN.progress_summary(q, last=2)] == [1, 2]
    assert IN.landed_batches(spark, f"{tmp}/none").count() == 0


def test_backlog_lands_in_batches_of_bounded_size(spark, tmp):
    src = os.path.join(tmp, "in")
    T.messages_raw(spark, SF_SMALL).select("value").repartition(8).write.text(src)
    size = max(os.path.getsize(os.path.join(src, f)) for f in os.listdir(src) if f.endswith(".txt"))
    q = IN.start_ingest(IN.read_json_lines(spark, src, max_bytes=2 * size), f"{tmp}/landed", f"{tmp}/quarantine", f"{tmp}/ckpt", trigger={"availableNow": True})
    q.awaitTermination()
    assert 3 <= len(IN.progress_summary(q)) <= 8
    assert IN.read_landed(spark, f"{tmp}/landed").count() == message_decoded(spark, SF_SMALL).count()
