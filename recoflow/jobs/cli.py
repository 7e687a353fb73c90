"""Job subcommands (``spark-submit --py-files recoflow.zip run_job.py <sub> ...``,
or locally ``python -m recoflow.jobs.cli <sub> ...``).

    ... prepare --reviews R --users U --games G --out P [--partition-by date] [--rejects]
    (--rejects: also the rows that are dropped, each under outcome=<reason>, and the row
    count of every stage; the training rows are then under P/outcome=accepted)
    ... preprocess --reviews R --users U --games G --out DIR [--rows 5000000]
    ... trim --reviews R --out DIR [--lines 5000000]
    ... publish --reviews R --checkpoint DIR --bootstrap HOST:PORT|--out DIR
    ... ingest --source DIR|--bootstrap HOST:PORT --out DIR --checkpoint DIR [--drain]
        [--batch-rows 500000] [--batch-minutes 5]
    ... train --processed P --models DIR [--holdout 0.2] [--segment COL]
    (prepare --partition-by date + train --segment date: one model set per day,
    each read from its own partition)
    ... score --model DIR/M1_LR --requests PARQUET --out DIR
    ... recommend --model DIR/M3_ALS --users PARQUET --out DIR
    ... status --models DIR          (which models load: healthy / degraded)

Paths are parameters; nothing is hard-coded. Every subcommand exits non-zero
on failure.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from ..plans import jobs
from ..sources import files
from ..streaming import ingest


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="recoflow")
    sub = p.add_subparsers(dest="cmd", required=True)

    for name in ("prepare", "preprocess"):
        s = sub.add_parser(name)
        s.add_argument("--reviews", required=True)
        s.add_argument("--users", required=True)
        s.add_argument("--games", required=True)
        s.add_argument("--out", required=True)
        s.add_argument("--landed", action="store_true", help="reviews are landed Parquet batches")
        s.add_argument("--rows", type=int, default=jobs.SAMPLE_ROWS)
        s.add_argument("--users-unique", action="store_true")
        s.add_argument("--rejects", action="store_true", help="prepare: write dropped rows with their reason as well")
        s.add_argument("--partition-by", help="comma-separated columns, e.g. date (for M8 segments)")

    s = sub.add_parser("trim")
    s.add_argument("--reviews", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--lines", type=int, default=jobs.SAMPLE_ROWS, help="lines to keep, header included")

    s = sub.add_parser("publish")
    s.add_argument("--reviews", required=True, help="folder of review CSV files")
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--bootstrap")
    s.add_argument("--topic", default=ingest.TOPIC)
    s.add_argument("--out", help="JSON-lines folder instead of a topic")

    s = sub.add_parser("ingest")
    s.add_argument("--source")
    s.add_argument("--bootstrap")
    s.add_argument("--topic", default=ingest.TOPIC)
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--drain", action="store_true", help="availableNow: land what is there, stop")
    s.add_argument("--batch-rows", type=int, default=ingest.BATCH_ROWS, help="messages that close a batch; rows of a file at most")
    s.add_argument("--batch-minutes", type=int, default=5, help="minutes after which a smaller batch closes")
    s.add_argument("--bytes-per-trigger", type=int, help="file source: bytes of a micro-batch (default: by the cluster's task slots)")
    s.add_argument("--files-per-trigger", type=int, help="file source: files of a micro-batch instead of bytes")

    s = sub.add_parser("train")
    s.add_argument("--processed", required=True)
    s.add_argument("--models", required=True)
    s.add_argument("--holdout", type=float, default=0.0)
    s.add_argument("--segment")
    s.add_argument("--concurrent", type=int, default=jobs.CONCURRENT_SEGMENTS, help="segments trained at a time")
    s.add_argument("--same-input", action="store_true", help="reuse a model only if it was trained on the same files")
    s.add_argument("--als-blocks", type=int, help="ALS user/item blocks (default: cluster parallelism)")

    s = sub.add_parser("status")
    s.add_argument("--models", required=True)

    for name in ("score", "recommend"):
        s = sub.add_parser(name)
        s.add_argument("--model", required=True)
        s.add_argument("--requests" if name == "score" else "--users", required=True)
        s.add_argument("--out", required=True)
        if name == "recommend":
            s.add_argument("--seen", help="Parquet of user, item pairs not to recommend")
    return p


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    args = _parser().parse_args(argv)
    from pyspark.sql import SparkSession
    owned = SparkSession.getActiveSession() is None  # stop only a session we start
    spark = jobs.session_for_jobs(f"recoflow-{args.cmd}")
    try:
        if args.cmd in ("prepare", "preprocess"):
            from ..schemas import GAMES_SCHEMA, USERS_SCHEMA
            if args.cmd == "preprocess":  # S7: a missing dimension file -> empty table
                users = files.read_or_empty(spark, args.users, USERS_SCHEMA)
                games = files.read_or_empty(spark, args.games, GAMES_SCHEMA, multiline=True)
            else:
                users = files.read_users_csv(spark, args.users)
                games = files.read_games_csv(spark, args.games)
            if args.landed:
                reviews = ingest.reviews_from_landed(ingest.read_landed(spark, args.reviews))
            else:
                reviews = files.read_reviews_csv(spark, args.reviews)
            if args.cmd == "prepare":
                parts = args.partition_by.split(",") if args.partition_by else None
                out = jobs.prepare(reviews, users, games, args.out, args.users_unique, parts, args.rejects)
            else:
                out = jobs.preprocess(reviews, games, users, args.out, args.rows)
            print(json.dumps(out))
        elif args.cmd == "trim":
            print(json.dumps(jobs.trim(files.read_reviews_csv(spark, args.reviews), args.out, args.lines)))
        elif args.cmd == "publish":
            if bool(args.bootstrap) == bool(args.out):
                raise SystemExit("publish needs --bootstrap or --out")
            reviews = ingest.read_reviews_stream(spark, args.reviews)
            ingest.start_publish(reviews, args.checkpoint, args.bootstrap, args.out, args.topic).awaitTermination()
        elif args.cmd == "ingest":
            minutes = f"{args.batch_minutes} minutes"
            if args.bootstrap:
                messages = ingest.read_kafka(spark, args.bootstrap, topic=args.topic, batch_rows=args.batch_rows, batch_timeout=minutes)
            else:
                messages = ingest.read_json_lines(spark, args.source, args.files_per_trigger, args.bytes_per_trigger or ingest.bytes_per_trigger(spark))
            if args.drain:
                trigger = {"availableNow": True}
            elif args.bootstrap:
                trigger = {"processingTime": ingest.KAFKA_POLL}
            else:
                trigger = None  # file source: flush every batch-minutes
            q = ingest.start_ingest(messages, f"{args.out}/landed", f"{args.out}/quarantine",
                                    args.checkpoint, trigger, batch_rows=args.batch_rows, batch_timeout=minutes)
            q.awaitTermination()
            print(json.dumps(ingest.progress_summary(q, last=1000)))  # all of them are in the checkpoint's progress table
        elif args.cmd == "train":
            processed = files.read_processed(spark, args.processed)
            if args.segment:
                reports = jobs.train_segments(processed, args.segment, args.models, args.holdout,
                                              args.als_blocks, args.concurrent)
                print(json.dumps({k: v.__dict__ for k, v in reports.items()}, sort_keys=True))
            else:
                print(jobs.train_all(processed, args.models, args.holdout, args.als_blocks,
                                     same_input=args.same_input).to_json())
        elif args.cmd == "status":
            print(json.dumps(jobs.model_status(args.models), sort_keys=True))
        elif args.cmd == "score":
            jobs.score(args.model, spark.read.parquet(args.requests), args.out)
        elif args.cmd == "recommend":
            seen = spark.read.parquet(args.seen) if args.seen else None
            jobs.recommend(args.model, spark.read.parquet(args.users), args.out, seen=seen)
        return 0
    finally:
        if owned:
            spark.stop()


if __name__ == "__main__":
    sys.exit(main())
