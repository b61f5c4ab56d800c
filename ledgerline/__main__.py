"""Command line: ``spark-submit ... -m ledgerline <job> --lake <root> ...``.

Connector packages, endpoints and credentials are Spark settings (``--conf``) or come from the
environment variables named on the command line; none are kept here.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from ledgerline.operators.quality import DataQualityError
from ledgerline.plans.chain import run_chain
from ledgerline.plans.daily import run_daily
from ledgerline.plans.export import run_export
from ledgerline.plans.forecast import run_forecast
from ledgerline.plans.ingest import compact, ingest
from ledgerline.plans.smoke import run_smoke
from ledgerline.plans.verify import run_verify
from ledgerline.session import create_session, size_shuffles, stored_bytes
from ledgerline.sinks.tables import jdbc_sink, parquet_sink
from ledgerline.sources.lake import Lake
from ledgerline.sources.messages import json_lines_stream, kafka_stream
from ledgerline.sources.tables import TableUnavailable, read_jdbc, read_parquet
from ledgerline.streaming.ingest import run_to_end


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ledgerline")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        sub.add_argument("--lake", required=True, help="root folder of the tables")
        sub.add_argument("--late-rows", choices=["event", "arrival"], default="event")
        sub.add_argument("--order-format", choices=["parquet", "hudi"], default="parquet")
        sub.add_argument("--grain", choices=["day", "month", "year"], default="day", help="dates in one folder")
        return sub

    def serving(sub: argparse.ArgumentParser, required: bool) -> None:
        target = sub.add_mutually_exclusive_group(required=required)
        target.add_argument("--jdbc-url")
        target.add_argument("--serving-dir", help="parquet folder in place of a database")
        sub.add_argument("--jdbc-driver", default="org.postgresql.Driver")
        sub.add_argument("--jdbc-user-env", default="JDBC_USER")
        sub.add_argument("--jdbc-password-env", default="JDBC_PASSWORD")

    sub = job("ingest", "message stream to order table")
    source = sub.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka-servers")
    source.add_argument("--json-lines")
    sub.add_argument("--topic", default="orders")
    sub.add_argument("--starting-offsets", help="before the first checkpoint: latest (Kafka) or earliest (JSON lines)")
    sub.add_argument("--max-offsets", type=int, help="Kafka records per micro-batch")
    sub.add_argument("--checkpoint", required=True)
    sub.add_argument("--interval", default="10 seconds")
    sub.add_argument("--once", action="store_true", help="read what is there, then stop")
    job("compact", "write the order table anew in files of an even size")

    for name, text in (("daily", "metrics of one day"), ("chain", "daily, export and counts")):
        sub = job(name, text)
        sub.add_argument("--date", help="yyyy-mm-dd, yesterday by default")
        sub.add_argument("--fallback", action="store_true", help="use all orders on an empty day")
        sub.add_argument("--keep-history", action="store_true", help="keep tables per date")
        if name == "chain":
            serving(sub, required=True)
    serving(job("export", "metric tables to the serving side"), required=True)
    serving(job("forecast", "history, seasonality and forecast"), required=False)
    job("smoke", "read, compute, write and read back")
    sub = job("verify", "checks on the order table")
    sub.add_argument("--minimum-rows", type=int, default=50)
    return parser.parse_args(argv)


def _sink(args: argparse.Namespace):
    if args.jdbc_url:
        return jdbc_sink(args.jdbc_url, _properties(args))
    return parquet_sink(args.serving_dir) if args.serving_dir else None


def _properties(args: argparse.Namespace) -> dict[str, str]:
    return {
        "user": os.environ.get(args.jdbc_user_env, ""),
        "password": os.environ.get(args.jdbc_password_env, ""),
        "driver": args.jdbc_driver,
    }


def _run(args: argparse.Namespace, lake: Lake) -> int:
    if args.job == "ingest":
        raw = (
            kafka_stream(
                lake.spark, args.kafka_servers, args.topic, args.starting_offsets or "latest", args.max_offsets
            )
            if args.kafka_servers
            else json_lines_stream(
                lake.spark, args.json_lines, starting=args.starting_offsets or "earliest", checkpoint=args.checkpoint
            )
        )
        interval = None if args.once else args.interval
        run_to_end(ingest(lake, raw, args.checkpoint, interval))
    elif args.job == "compact":
        compact(lake)
    elif args.job == "daily":
        for table in run_daily(
            lake, args.date, args.fallback, keep_history=args.keep_history
        ).values():
            table.show(24, truncate=False)
    elif args.job == "export":
        run_export(lake, _sink(args)).show(truncate=False)
    elif args.job == "forecast":
        status = run_forecast(lake, _sink(args))
        lake.read("revenue_forecast").orderBy("forecast_date").show(truncate=False)
        lake.read("revenue_forecast_summary").show(truncate=False)
        if status is not None:
            status.show(truncate=False)
    elif args.job == "smoke":
        for table in run_smoke(lake):
            table.show(truncate=False)
    elif args.job == "verify":
        for table in run_verify(lake, args.minimum_rows):
            table.show(truncate=False)
    else:

        def read_serving(table: str):
            if args.jdbc_url:
                return read_jdbc(lake.spark, args.jdbc_url, table, _properties(args))
            return read_parquet(lake.spark, f"{args.serving_dir}/{table}")

        result = run_chain(
            lake, _sink(args), read_serving, args.date, args.fallback, args.keep_history
        )
        result.status.show(truncate=False)
        result.counts.show(truncate=False)
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _arguments(argv)
    session = spark or create_session(f"ledgerline {args.job}", conf={"spark.ui.enabled": "false"})
    if args.job != "ingest":  # a micro-batch is bounded by its trigger
        size_shuffles(session, stored_bytes(session, f"{args.lake.rstrip('/')}/orders_raw"))
    try:
        return _run(args, Lake(session, args.lake, args.late_rows, order_format=args.order_format, grain=args.grain))
    except (TableUnavailable, DataQualityError) as error:
        print(error, file=sys.stderr)
        return 1
    finally:
        if spark is None:
            session.stop()


if __name__ == "__main__":
    sys.exit(main())
