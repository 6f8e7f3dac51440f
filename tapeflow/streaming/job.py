"""One ingest query as a job for ``spark-submit``.

    spark-submit --py-files tapeflow.zip tapeflow/streaming/job.py trades --servers broker:9092 \\
        --table s3a://lake/trades --quarantine s3a://lake/bad --checkpoint s3a://lake/cp
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tapeflow.contracts import SPECS
from tapeflow.functions.decode import read_messages
from tapeflow.sources.tables import jdbc_options
from tapeflow.sources.topics import kafka_stream, text_stream
from tapeflow.streaming.ingest import jdbc_sink, parquet_sink, start_console, start_ingest


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Stream one topic into its table.")
    parser.add_argument("stream", choices=sorted(SPECS))
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--files", help="folder of text files, one message per line")
    parser.add_argument("--starting", default="latest", choices=("latest", "earliest"))
    parser.add_argument("--max-offsets", type=int)
    parser.add_argument("--max-bytes", type=int, help="file input per batch")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--table", help="path of a Parquet table")
    target.add_argument("--jdbc", metavar="URL")
    target.add_argument("--console", action="store_true")
    parser.add_argument("--jdbc-option", action="append", default=[], metavar="NAME=VALUE")
    parser.add_argument("--conflicts", help="path of the conflict report")
    parser.add_argument("--quarantine", help="path of messages set aside")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--available-now", action="store_true", help="stop when caught up")
    parser.add_argument("--interval", help="time between batches, such as '5 seconds'")
    parsed = parser.parse_args(argv)
    if not parsed.console and not parsed.quarantine:
        parser.error("--quarantine is required")
    return parsed


def trigger(args: argparse.Namespace) -> dict | None:
    if args.available_now:
        return {"availableNow": True}
    return {"processingTime": args.interval} if args.interval else None


def start(spark: SparkSession, args: argparse.Namespace):
    spec = SPECS[args.stream]
    if args.servers:
        messages = kafka_stream(
            spark, args.servers, [spec.topic], args.starting, args.max_offsets
        )
    else:
        messages = text_stream(spark, args.files, max_bytes=args.max_bytes)
    if args.console:
        return start_console(read_messages(messages, spec), args.checkpoint, trigger(args))
    if args.table:
        sink = parquet_sink(spec, args.table, args.conflicts)
    else:
        more = dict(pair.split("=", 1) for pair in args.jdbc_option)
        sink = jdbc_sink(spec, jdbc_options(args.jdbc, spec.name, **more))
    return start_ingest(messages, spec, sink, args.quarantine, args.checkpoint, trigger(args))


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"ingest {args.stream}").getOrCreate()
    start(spark, args).awaitTermination()


if __name__ == "__main__":
    main()
