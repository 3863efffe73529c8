"""Command line of the jobs: ``spark-submit -m``-style, one subcommand per job."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tripforge import schemas
from tripforge.operators.messages import (
    first_messages,
    parse_delimited,
    parse_json,
    to_delimited_messages,
    to_json_messages,
    to_json_rides,
)
from tripforge.plans import batch, ingest
from tripforge.session import build_session, size_shuffles
from tripforge.sinks.files import publish
from tripforge.sources.files import read_csv, read_text_csv
from tripforge.sources.tables import TableStore
from tripforge.sources.topics import read_topic
from tripforge.streaming.jobs import (
    rides_log,
    start_count_query,
    start_landing_queries,
    start_ride_queries,
    supervise,
)


def clean(spark: SparkSession, args: argparse.Namespace) -> None:
    store = TableStore(spark, args.dataset, args.format)
    for name in batch.run_clean(store, args.input_table, args.mode):
        print(f"wrote {store.address(name)}")


def dims(spark: SparkSession, args: argparse.Namespace) -> None:
    store = TableStore(spark, args.dataset, args.format)
    source = TableStore(spark, args.trips or args.dataset, args.format)
    if args.grow:
        for name, rows in batch.run_grow_dims(source.read(batch.ALL_CLEANED), store).items():
            print(f"added {rows} to {store.address(name)}")
        return
    for name in batch.run_dims(source, store, args.mode):
        print(f"wrote {store.address(name)}")


def fact(spark: SparkSession, args: argparse.Namespace) -> None:
    store = TableStore(spark, args.dataset, args.format)
    source = TableStore(spark, args.trips or args.dataset, args.format)
    batch.run_fact(source, store, args.mode, args.broadcast)


def revenue(spark: SparkSession, args: argparse.Namespace) -> None:
    trips = batch.trips_from_paths(spark, args.input_green, args.input_yellow)
    if args.dataset:
        batch.run_revenue(
            trips, store=TableStore(spark, args.dataset, args.format), name=args.output
        )
    else:
        batch.run_revenue(trips, path=args.output)


def reports(spark: SparkSession, args: argparse.Namespace) -> None:
    batch.run_reports(TableStore(spark, args.dataset, args.format), args.output, args.mode)


def load_zones(spark: SparkSession, args: argparse.Namespace) -> None:
    zones = read_csv(spark, args.input, schemas.ZONES_SCHEMA)
    TableStore(spark, args.dataset, args.format).write(zones, batch.ZONES, args.mode)


def csv_to_parquet(spark: SparkSession, args: argparse.Namespace) -> None:
    ingest.csv_to_parquet(
        spark, args.color, args.input, args.output, args.years, args.months, mode=args.mode
    )


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    absent = ingest.land_months(
        spark, args.input, args.color, args.output, args.year, args.months, args.mode
    )
    if absent:
        print(f"Months without a file: {absent}")


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    store = TableStore(spark, args.dataset, args.format)
    if args.replace:
        loaded = ingest.replace_months(
            spark, args.input, args.color, args.year, args.months, store, args.table_name
        )
        print(f"Total rows: {sum(loaded.rows.values())}")
        if loaded.absent:
            print(f"Months without a file: {loaded.absent}")
        return
    paths = ingest.month_paths(args.input, args.color, args.year, args.months, "parquet")
    print(f"Total rows: {ingest.append_months(spark, paths, store, args.table_name)}")


def publish_rides(spark: SparkSession, args: argparse.Namespace) -> None:
    # As text, so that a message repeats the file's own spelling of every field.
    rides = read_text_csv(spark, args.input)
    if args.json:
        named = to_json_rides(rides.withColumnRenamed("VendorID", "vendor_id"))
        messages = to_json_messages(named, "pu_location_id")
    else:
        messages = to_delimited_messages(rides, "PULocationID", rides.columns)
    sample = first_messages(messages, args.first) if args.first else messages
    publish(sample, args.servers, args.topic)


def stream_counts(spark: SparkSession, args: argparse.Namespace) -> None:
    messages = read_topic(spark, args.servers, args.topic, args.starting)
    supervise(
        spark,
        lambda: start_ride_queries(
            messages,
            args.servers,
            args.output_topic,
            args.trigger,
            args.watermark,
            parse_json if args.json else parse_delimited,
        ),
        args.restarts,
    )


def stream_landing(spark: SparkSession, args: argparse.Namespace) -> None:
    messages = read_topic(spark, args.servers, args.topic, args.starting)
    checkpoints = (f"{args.checkpoint}/files", f"{args.checkpoint}/table")
    supervise(
        spark,
        lambda: start_landing_queries(
            messages,
            args.output,
            args.table,
            checkpoints,
            args.format,
            args.trigger,
            parse=parse_json if args.json else parse_delimited,
        ),
        args.restarts,
    )


def compact_rides(spark: SparkSession, args: argparse.Namespace) -> None:
    rides_log(spark, args.output).compact(args.last_batch, args.file_rows)


def stream_windows(spark: SparkSession, args: argparse.Namespace) -> None:
    messages = read_topic(spark, args.servers, args.topic, args.starting)
    parse = parse_json if args.json else parse_delimited
    supervise(
        spark,
        lambda: [
            start_count_query(messages, args.output, args.checkpoint, args.trigger, args.watermark, parse)
        ],
        args.restarts,
    )


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tripforge")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run, mode: str | None = "errorifexists") -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        if mode:
            sub.add_argument("--mode", default=mode)
        sub.add_argument("--input_gb", type=float, default=0, help="input of the job, to size its shuffles by")
        return sub

    def tables(sub: argparse.ArgumentParser, required: bool = True) -> None:
        sub.add_argument("--dataset", required=required, help="where the tables are")
        sub.add_argument("--format", default="parquet", help="file format, catalog, or connector")

    def months(sub: argparse.ArgumentParser, default: list[int]) -> None:
        sub.add_argument("--months", type=int, nargs="+", default=default)
        sub.add_argument("--color", default=schemas.YELLOW)
        sub.add_argument("--input", required=True)

    def topic(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--servers", required=True)
        sub.add_argument("--topic", required=True)
        sub.add_argument("--starting", default="latest")
        sub.add_argument("--trigger", default="5 seconds")
        sub.add_argument("--json", action="store_true", help="messages are JSON rides")
        sub.add_argument("--restarts", type=int, default=0, help="times that failed queries are started again")

    sub = job("clean", clean)
    tables(sub)
    sub.add_argument("--input_table", default="yellow_trips_data")

    for name, run in {"dims": dims, "fact": fact}.items():
        sub = job(name, run)
        tables(sub)
        sub.add_argument("--trips", help="where the cleaned trips are, if elsewhere")
        if name == "dims":
            sub.add_argument("--grow", action="store_true", help="add new keys to stored dimensions, whose ids stay")
        else:
            sub.add_argument("--broadcast", action="store_true")

    sub = job("revenue", revenue, mode=None)
    tables(sub, required=False)
    for name in ("--input_green", "--input_yellow", "--output"):
        sub.add_argument(name, required=True)

    sub = job("reports", reports, mode="overwrite")
    tables(sub)
    sub.add_argument("--output", required=True)

    sub = job("zones", load_zones, mode="overwrite")
    tables(sub)
    sub.add_argument("--input", required=True, help="CSV of LocationID, Zone, Borough")

    sub = job("csv-to-parquet", csv_to_parquet)
    months(sub, list(range(1, 13)))
    sub.add_argument("--years", type=int, nargs="+", required=True)
    sub.add_argument("--output", required=True)

    sub = job("land", land)
    months(sub, [1, 2])
    sub.add_argument("--year", type=int, default=2021)
    sub.add_argument("--output", required=True)

    sub = job("load", load, mode=None)
    months(sub, [1, 2])
    tables(sub)
    sub.add_argument("--year", type=int, default=2021)
    sub.add_argument("--table_name", default="rides")
    sub.add_argument(
        "--replace", action="store_true", help="put the months in place of those loaded before; needs a file format"
    )

    sub = job("publish", publish_rides, mode=None)
    sub.add_argument("--input", required=True)
    sub.add_argument("--servers", required=True)
    sub.add_argument("--topic", required=True)
    sub.add_argument("--json", action="store_true")
    sub.add_argument("--first", type=int, help="send only so many messages, as a sample")

    sub = job("stream-counts", stream_counts, mode=None)
    topic(sub)
    sub.add_argument("--output_topic", required=True)
    sub.add_argument("--watermark", help="how late rides may come; without it all windows are kept")

    sub = job("stream-windows", stream_windows, mode=None)
    topic(sub)
    for name in ("--output", "--checkpoint"):
        sub.add_argument(name, required=True)
    sub.add_argument("--watermark", help="how late rides may come; without it all windows are kept")

    sub = job("stream-landing", stream_landing, mode=None)
    topic(sub)
    for name in ("--output", "--table", "--checkpoint"):
        sub.add_argument(name, required=True)
    sub.add_argument("--format", help="connector of the table; the catalog without it")

    sub = job("compact-rides", compact_rides, mode=None)
    sub.add_argument("--output", required=True, help="the landing job's output")
    sub.add_argument("--last_batch", type=int, required=True, help="a finished batch of the landing job")
    sub.add_argument("--file_rows", type=int, default=1_000_000)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"tripforge-{args.job}")
    if args.input_gb or not spark.sparkContext.master.startswith("local"):
        size_shuffles(spark, int(args.input_gb * (1 << 30)))
    args.run(spark, args)


if __name__ == "__main__":
    main()
