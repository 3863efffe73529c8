"""The two ride jobs over a message stream."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripforge.operators.messages import count_messages, parse_delimited
from tripforge.streaming.batch_log import BatchLog, KeyedLog, changes_sink, log_sink
from tripforge.streaming.counts import count_by, observe_rejects, windowed_count
from tripforge.streaming.sinks import (
    FIVE_SECONDS,
    console_sink,
    new_checkpoint,
    table_sink,
    topic_sink,
)

PICKUP = "tpep_pickup_datetime"


Parse = Callable[[DataFrame], DataFrame]


def rides_from(messages: DataFrame, parse: Parse = parse_delimited) -> DataFrame:
    """Parsed rides, with rejected messages counted in the query progress.

    ``parse`` is ``parse_delimited`` or ``parse_json``, as the topic carries them.
    """
    return observe_rejects(parse(messages), PICKUP)


def windowed_vendor_counts(rides: DataFrame, watermark: str | None = None) -> DataFrame:
    return windowed_count(rides, PICKUP, ["vendor_id"], "10 minutes", "5 minutes", watermark)


def windowed_vendor_messages(rides: DataFrame, watermark: str | None = None) -> DataFrame:
    """Window counts as messages keyed by vendor; the value names its window."""
    counts = windowed_vendor_counts(rides, watermark)
    return count_messages(counts, ["window", "count"], "vendor_id")


def start_ride_queries(
    messages: DataFrame,
    servers: str,
    topic: str,
    trigger: str | None = FIVE_SECONDS,
    watermark: str | None = None,
    parse: Parse = parse_delimited,
) -> list[StreamingQuery]:
    """Raw rides and vendor counts on the console, window counts to a topic."""
    rides = rides_from(messages, parse)
    return [
        console_sink(rides, new_checkpoint(rides, f"rides-{topic}"), "append", trigger),
        console_sink(
            count_by(rides, ["vendor_id"]),
            new_checkpoint(rides, f"vendors-{topic}"),
            "complete",
            trigger,
        ),
        topic_sink(
            windowed_vendor_messages(rides, watermark),
            servers,
            topic,
            new_checkpoint(rides, f"counts-{topic}"),
            "append" if watermark else "complete",
            trigger,
        ),
    ]


def start_count_query(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = FIVE_SECONDS,
    watermark: str | None = None,
    parse: Parse = parse_delimited,
) -> StreamingQuery:
    """Window counts kept as a table: a batch writes the windows that it changed, not all since the start."""
    rides = rides_from(messages, parse)
    return changes_sink(windowed_vendor_counts(rides, watermark), counts_log(rides.sparkSession, path), checkpoint, trigger)


def counts_log(spark: SparkSession, path: str) -> KeyedLog:
    return KeyedLog(spark, path, keys=("window", "vendor_id"))


def rides_log(spark: SparkSession, path: str) -> BatchLog:
    """Where landed rides lie, by pickup zone; both message forms name it so."""
    return BatchLog(spark, path, "PULocationID")


def start_landing_queries(
    messages: DataFrame,
    path: str,
    table: str,
    checkpoints: tuple[str, str],
    fmt: str | None = None,
    trigger: str | None = FIVE_SECONDS,
    table_path: str | None = None,
    parse: Parse = parse_delimited,
) -> list[StreamingQuery]:
    """Raw rides to files by pickup zone and to a table; two queries, two checkpoints.

    Each query reads the source itself, so that one can fail or lag without the other. The files are a
    :func:`rides_log`, which splits a hot zone over all tasks and packs small files on request.
    """
    rides = rides_from(messages, parse)
    by_zone = rides.withColumnRenamed("pu_location_id", "PULocationID")
    return [
        log_sink(by_zone, rides_log(rides.sparkSession, path), checkpoints[0], trigger),
        table_sink(rides, table, checkpoints[1], fmt=fmt, trigger=trigger, path=table_path),
    ]


def supervise(
    spark: SparkSession,
    start: Callable[[], list[StreamingQuery]],
    restarts: int = 0,
    pause: float = 5.0,
) -> int:
    """Start queries and wait until one of them ends; earlier ones are forgotten first. Restarts made.

    A query that fails is started again with the others, from their checkpoints, up to ``restarts`` times and after a
    pause that doubles each time; the last failure is raised. The others are stopped before.
    """
    made = 0
    while True:
        spark.streams.resetTerminated()
        queries = start()
        try:
            spark.streams.awaitAnyTermination()
            return made
        except StreamingQueryException:
            for query in queries:
                query.stop()
            if made == restarts:
                raise
            time.sleep(pause * 2**made)
            made += 1
