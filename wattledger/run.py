"""Submit entry points. Executors run built-in expressions only and need no Python code.

    PYTHONPATH=. spark-submit wattledger/run.py settle  --root PATH --sim-day 2024-01-01
    PYTHONPATH=. spark-submit wattledger/run.py settle-next --root PATH
    PYTHONPATH=. spark-submit wattledger/run.py pending --root PATH
    PYTHONPATH=. spark-submit wattledger/run.py gate    --root PATH --sim-day 2024-01-01
    PYTHONPATH=. spark-submit wattledger/run.py report  --root PATH --sim-day 2024-01-01
    PYTHONPATH=. spark-submit wattledger/run.py stream  --root PATH --servers HOST:PORT --topic NAME
"""

from __future__ import annotations

import argparse
import sys
from datetime import date

from pyspark.sql import SparkSession

from wattledger.operators.parse import parse_messages
from wattledger.plans import reconcile
from wattledger.session import pin_utc, use_rocksdb_state
from wattledger.sources.messages import read_file_messages, read_kafka_messages
from wattledger.streaming import queries
from wattledger.streaming.progress import ProgressLog


def parse_args(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="wattledger.run")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("settle", "settle-next", "pending", "gate", "report", "stream"):
        job = jobs.add_parser(name)
        job.add_argument("--root", required=True, help="folder of all tables")
        if name in ("settle", "gate", "report"):
            job.add_argument("--sim-day", required=True, type=date.fromisoformat)
            job.add_argument("--last-day", type=date.fromisoformat)
        if name in ("settle", "settle-next"):
            job.add_argument("--run-id")
        if name == "stream":
            job.add_argument("--servers")
            job.add_argument("--topic")
            job.add_argument("--dead-letter-topic")
            job.add_argument("--messages", help="folder of landed message files")
            job.add_argument("--max-offsets", type=int, help="messages per trigger from a topic")
            job.add_argument("--max-files", type=int, help="files per trigger from a folder")
            job.add_argument("--trigger-seconds", type=int, default=queries.BASE_TRIGGER_SECONDS)
    args = parser.parse_args(argv)
    if args.job == "stream" and not (args.messages or (args.servers and args.topic)):
        parser.error("stream needs --messages, or --servers and --topic")
    return args


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    use_rocksdb_state(spark)
    spark.streams.addListener(ProgressLog(spark, f"{args.root.rstrip('/')}/ops_stream_progress"))
    if args.messages:
        messages = read_file_messages(spark, args.messages, max_files_per_trigger=args.max_files)
    else:
        rate = {"max_offsets_per_trigger": args.max_offsets} if args.max_offsets else {}
        messages = read_kafka_messages(spark, args.servers, args.topic, **rate)
    options = {}
    if args.dead_letter_topic:
        options = {
            "dead_letter_format": "kafka", "kafka.bootstrap.servers": args.servers,
            "topic": args.dead_letter_topic,
        }
    started = queries.start_all(
        parse_messages(messages), args.root, base_seconds=args.trigger_seconds, **options
    )
    queries.await_any(spark, started)


def main(argv: list[str]) -> int:
    args = parse_args(argv)
    spark = pin_utc(SparkSession.builder.appName(f"wattledger-{args.job}").getOrCreate())
    layout = reconcile.Layout(args.root)
    if args.job == "settle":
        print(reconcile.settle_days(spark, layout, args.sim_day, args.last_day, args.run_id))
    elif args.job == "pending":
        for row in reconcile.find_pending_days(spark, layout).collect():  # one per day
            print(row["sim_date"])
    elif args.job == "settle-next":
        print(reconcile.settle_next(spark, layout, args.run_id) or "no day is pending")
    elif args.job == "gate":
        reconcile.require_coverage(spark, layout, args.sim_day, args.last_day)
    elif args.job == "report":
        reconcile.publish_report(spark, layout, args.sim_day, args.last_day)
    else:
        stream(spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
