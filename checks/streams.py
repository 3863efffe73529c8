"""Messages and streams. A stream is run to the end of its input and its result read back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.batch import counted
from checks.fixture import TRIPS_SQL, rides, table
from checks.registry import check
from tripforge import schemas
from tripforge.operators.messages import (
    first_messages,
    parse_delimited,
    parse_json,
    to_delimited_messages,
    to_json_messages,
    to_json_rides,
)
from tripforge.sources.files import read_parquet
from tripforge.sources.topics import read_message_files
from tripforge.staging import stage, staging_path
from tripforge.streaming.counts import count_by, windowed_count
from tripforge.streaming.batch_log import log_sink
from tripforge.streaming.jobs import (
    PICKUP,
    counts_log,
    rides_from,
    rides_log,
    start_count_query,
    start_landing_queries,
    windowed_vendor_counts,
    windowed_vendor_messages,
)
from tripforge.streaming.progress import ProgressTable
from tripforge.streaming.sinks import (
    fan_out_sink,
    file_sink,
    memory_sink,
    snapshot_path,
    snapshot_sink,
)

_RIDE = schemas.RIDE_SCHEMA.names


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_delimited_messages(rides(spark, sf_dir), "PULocationID", _RIDE)


def _json_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides as the JSON objects a producer sends; half carry their times in arrays."""
    plain = to_json_messages(to_json_rides(rides(spark, sf_dir)), "pu_location_id")
    wrapped = F.regexp_replace("value", r'("tpep_\w+_datetime":)("[^"]*")', "$1[$2]")
    odd = F.col("key").cast("int") % 2 == 1
    return plain.withColumn("value", F.when(odd, wrapped).otherwise(F.col("value")))


def _stream(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """Messages written to the shared folder and read back as a stream of files."""
    path = staging_path(spark, "messages")
    messages.write.parquet(path)
    return read_message_files(spark, path)


def _checkpoint(spark: SparkSession) -> str:
    return staging_path(spark, "checkpoint")


def _finished_snapshot(counts: DataFrame) -> DataFrame:
    """The aggregate of a stream after all of its input."""
    spark = counts.sparkSession
    path = staging_path(spark, "snapshot")
    query = snapshot_sink(counts, path, _checkpoint(spark), trigger=None)
    query.awaitTermination()
    return read_parquet(spark, snapshot_path(path, query.lastProgress["batchId"]))


def _flat_window(counts: DataFrame) -> DataFrame:
    others = [c for c in counts.columns if c != "window"]
    return counts.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *others,
    )


def _cents(value: Column) -> Column:
    """``round(value, 2)`` of a double. Decimal arithmetic is for those near the middle of two cents, and for large ones."""
    cents = value * 100
    part = F.abs(cents) - F.floor(F.abs(cents))
    clear = (F.abs(value) < 1e9) & (F.abs(part - 0.5) > 1e-3)
    # Zero is added for the sign: a negative amount may round to zero.
    return F.when(clear, F.rint(cents) / 100 + 0.0).otherwise(F.round(value, 2))


def _rounded(df: DataFrame) -> DataFrame:
    """Amounts to cents as doubles and times without zone, for comparison."""
    fixes = {}
    for field in df.schema:
        kind = field.dataType.typeName()
        if kind in ("float", "decimal"):
            fixes[field.name] = _cents(F.col(field.name).cast("double"))
        elif kind == "timestamp":
            fixes[field.name] = F.col(field.name).cast("timestamp_ntz")
    return df.withColumns(fixes)


# --- messages -----------------------------------------------------------------

_TEXT_SQL = """SELECT CAST("PULocationID" AS VARCHAR) AS key, concat_ws(', ',
    "VendorID", strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'),
    strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S'), passenger_count,
    CASE WHEN isnan(trip_distance) THEN 'NaN' ELSE CAST(trip_distance AS VARCHAR) END,
    "RatecodeID", store_and_fwd_flag, "PULocationID", "DOLocationID", payment_type, fare_amount,
    extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
    coalesce(CAST(congestion_surcharge AS VARCHAR), '')) AS value
  FROM trips"""


@check("delimited_messages", f"WITH {TRIPS_SQL} {_TEXT_SQL}")
def delimited_messages(spark, sf_dir):
    return _messages(spark, sf_dir)


@check("first_messages", f"WITH {TRIPS_SQL} {_TEXT_SQL} ORDER BY value LIMIT 100")
def first_messages_query(spark, sf_dir):
    return first_messages(_messages(spark, sf_dir).orderBy("value"), 100)


_RIDES_SQL = """SELECT "VendorID" AS vendor_id, pickup_datetime AS tpep_pickup_datetime,
    dropoff_datetime AS tpep_dropoff_datetime, passenger_count, trip_distance, "RatecodeID",
    store_and_fwd_flag, "PULocationID", "DOLocationID", payment_type, fare_amount, extra, mta_tax,
    tip_amount, tolls_amount, improvement_surcharge, total_amount, congestion_surcharge
  FROM trips"""


@check("delimited_roundtrip", f"WITH {TRIPS_SQL} {_RIDES_SQL}")
def delimited_roundtrip(spark, sf_dir):
    return _rounded(parse_delimited(stage(_messages(spark, sf_dir), "messages")))


_JSON_RIDES_SQL = """SELECT CAST("VendorID" AS VARCHAR) AS vendor_id,
    pickup_datetime AS tpep_pickup_datetime, dropoff_datetime AS tpep_dropoff_datetime,
    passenger_count, CASE WHEN NOT isnan(trip_distance) THEN trip_distance END AS trip_distance,
    "RatecodeID" AS rate_code_id, store_and_fwd_flag, "PULocationID" AS pu_location_id,
    "DOLocationID" AS do_location_id, CAST(payment_type AS VARCHAR) AS payment_type, fare_amount,
    extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
    congestion_surcharge
  FROM trips"""


@check("json_roundtrip", f"WITH {TRIPS_SQL} {_JSON_RIDES_SQL}")
def json_roundtrip(spark, sf_dir):
    return _rounded(parse_json(stage(_json_messages(spark, sf_dir), "messages")))


_CUT_FIELDS = {
    "vendors": "vendor_id",
    "pickups": "tpep_pickup_datetime",
    "dropoffs": "tpep_dropoff_datetime",
    "passengers": "passenger_count",
    "distances": "trip_distance",
    "rates": "RatecodeID",
    "flags": "store_and_fwd_flag",
    "totals": "total_amount",
}


@check(
    "damaged_messages",
    f"""WITH {TRIPS_SQL}
    SELECT count(*) AS messages, count(*) FILTER (passenger_count >= 1) AS vendors,
      count(*) FILTER (passenger_count >= 2) AS pickups,
      count(*) FILTER (passenger_count >= 3) AS dropoffs,
      count(*) FILTER (passenger_count >= 4) AS passengers,
      count(*) FILTER (passenger_count >= 5) AS distances,
      count(*) FILTER (passenger_count >= 6) AS rates,
      count(*) FILTER (passenger_count >= 6) AS flags, CAST(0 AS BIGINT) AS totals
    FROM trips""",
)
def damaged_messages(spark, sf_dir):
    """Messages broken off after as many fields as the trip has riders, then junk."""
    tokens = F.split("value", schemas.MESSAGE_SEPARATOR)
    riders = F.element_at(tokens, 4).cast("int")
    broken = F.concat_ws(schemas.MESSAGE_SEPARATOR, F.slice(tokens, 1, riders), F.lit("junk"))
    parsed = parse_delimited(_messages(spark, sf_dir).select("key", broken.alias("value")))
    return parsed.agg(
        counted("messages"), *[F.count(c).alias(n) for n, c in _CUT_FIELDS.items()]
    )


# --- streams --------------------------------------------------------------------


@check(
    "vendor_counts",
    f"""WITH {TRIPS_SQL} SELECT "VendorID" AS vendor_id, count(*) AS count
    FROM trips GROUP BY "VendorID" """,
)
def vendor_counts(spark, sf_dir):
    stream = rides_from(_stream(spark, _messages(spark, sf_dir)))
    return _finished_snapshot(count_by(stream, ["vendor_id"]))


_WINDOWS_SQL = """
windows AS (
  SELECT time_bucket(INTERVAL '5 minutes', pickup_datetime) - shift AS window_start,
    time_bucket(INTERVAL '5 minutes', pickup_datetime) - shift + INTERVAL '10 minutes'
      AS window_end, "VendorID" AS vendor_id
  FROM trips, (VALUES (INTERVAL '0 minutes'), (INTERVAL '5 minutes')) AS shifts(shift)
)"""


@check(
    "windowed_vendor_counts",
    f"""WITH {TRIPS_SQL}, {_WINDOWS_SQL}
    SELECT window_start, window_end, vendor_id, count(*) AS count
    FROM windows GROUP BY 1, 2, 3""",
)
def windowed_vendor_counts_query(spark, sf_dir):
    stream = rides_from(_stream(spark, _messages(spark, sf_dir)))
    return _flat_window(_finished_snapshot(windowed_vendor_counts(stream)))


@check(
    "windowed_vendor_messages",
    f"""WITH {TRIPS_SQL}, {_WINDOWS_SQL}
    SELECT CAST(vendor_id AS VARCHAR) AS key, strftime(window_start, '%Y-%m-%d %H:%M:%S') || ', '
      || strftime(window_end, '%Y-%m-%d %H:%M:%S') || ', ' || count(*) AS value
    FROM windows GROUP BY window_start, window_end, vendor_id""",
)
def windowed_vendor_messages_query(spark, sf_dir):
    stream = rides_from(_stream(spark, _messages(spark, sf_dir)))
    return _finished_snapshot(windowed_vendor_messages(stream))


@check(
    "tumbling_vendor_counts",
    f"""WITH {TRIPS_SQL}
    SELECT time_bucket(INTERVAL '1 hour', pickup_datetime) AS window_start,
      time_bucket(INTERVAL '1 hour', pickup_datetime) + INTERVAL '1 hour' AS window_end,
      "VendorID" AS vendor_id, count(*) AS count
    FROM trips GROUP BY 1, 2, 3""",
)
def tumbling_vendor_counts(spark, sf_dir):
    stream = rides_from(_stream(spark, _messages(spark, sf_dir)))
    return _flat_window(_finished_snapshot(windowed_count(stream, PICKUP, ["vendor_id"], "1 hour")))


@check(
    "closed_vendor_windows",
    f"""WITH {TRIPS_SQL}, {_WINDOWS_SQL}
    SELECT window_start, window_end, vendor_id, count(*) AS count
    FROM windows
    WHERE window_end <= (SELECT max(pickup_datetime) - INTERVAL '2 days' FROM trips)
    GROUP BY 1, 2, 3""",
)
def closed_vendor_windows(spark, sf_dir):
    """With a watermark a window is written once, when it can no longer change."""
    stream = rides_from(_stream(spark, _messages(spark, sf_dir)))
    path = staging_path(spark, "closed")
    query = file_sink(
        windowed_vendor_counts(stream, watermark="2 days"),
        path,
        _checkpoint(spark),
        partition_by=None,
        trigger=None,
    )
    query.awaitTermination()
    return _flat_window(read_parquet(spark, path))


@check(
    "windowed_event_counts",
    """WITH windows AS (
      SELECT time_bucket(INTERVAL '5 minutes', ts) - shift AS window_start,
        time_bucket(INTERVAL '5 minutes', ts) - shift + INTERVAL '10 minutes' AS window_end,
        event_type
      FROM events, (VALUES (INTERVAL '0 minutes'), (INTERVAL '5 minutes')) AS shifts(shift)
    )
    SELECT window_start, window_end, event_type, count(*) AS count
    FROM windows GROUP BY 1, 2, 3""",
)
def windowed_event_counts(spark, sf_dir):
    events = (
        spark.readStream.schema(table(spark, sf_dir, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    counts = windowed_count(events, "ts", ["event_type"], "10 minutes", "5 minutes")
    return _flat_window(_finished_snapshot(counts))


@check(
    "updated_vendor_windows",
    f"""WITH {TRIPS_SQL}, {_WINDOWS_SQL}
    SELECT window_start, window_end, vendor_id, count(*) AS count
    FROM windows GROUP BY 1, 2, 3""",
)
def updated_vendor_windows(spark, sf_dir):
    """Messages of odd and even zones in two runs; the second writes the windows that it changes only."""
    path, checkpoint, source = (staging_path(spark, n) for n in ("windows", "checkpoint", "messages"))
    messages = stage(_messages(spark, sf_dir), "messages")
    for odd in (0, 1):
        messages.where(F.col("key").cast("int") % 2 == odd).write.mode("append").parquet(source)
        start_count_query(read_message_files(spark, source), path, checkpoint, trigger=None).awaitTermination()
    return _flat_window(counts_log(spark, path).read())


@check(
    "rejected_messages",
    f"""WITH {TRIPS_SQL}
    SELECT 'rides' AS observed, 'rows' AS metric, count(*) AS value FROM trips
    UNION ALL SELECT 'rides', 'rejected', count(*) FILTER (passenger_count < 2) FROM trips""",
)
def rejected_messages(spark, sf_dir):
    """Messages broken off after as many fields as riders: without a second field there is no pickup time."""
    tokens = F.split("value", schemas.MESSAGE_SEPARATOR)
    riders = F.element_at(tokens, 4).cast("int")
    broken = F.concat_ws(schemas.MESSAGE_SEPARATOR, F.slice(tokens, 1, riders), F.lit("junk"))
    stream = rides_from(_stream(spark, _messages(spark, sf_dir).select("key", broken.alias("value"))))
    with ProgressTable(spark, staging_path(spark, "progress")) as table_of_batches:
        table_of_batches.finish(
            file_sink(stream, staging_path(spark, "rides"), _checkpoint(spark), partition_by=None, trigger=None)
        )
    noted = table_of_batches.read()
    return noted.groupBy("observed", "metric").agg(F.sum("value").alias("value"))


def _of_both(**parts: DataFrame) -> DataFrame:
    """Whole rides of both places, tagged with the place."""
    tagged = [
        _rounded(df).select(F.lit(name).alias("place"), *[F.col(c) for c in _RIDE])
        for name, df in parts.items()
    ]
    return tagged[0].unionByName(tagged[1])


_LANDED_SQL = f"""WITH {TRIPS_SQL}, rides AS ({_RIDES_SQL})
  SELECT place, rides.* FROM rides, (VALUES ('files'), ('table')) AS places(place)"""


@check("landed_rides", _LANDED_SQL)
def landed_rides(spark, sf_dir):
    stream = _stream(spark, _messages(spark, sf_dir))
    files, table_path = staging_path(spark, "rides"), staging_path(spark, "rides-table")
    name = f"tripforge_rides_{uuid4().hex}"
    for query in start_landing_queries(
        stream, files, name, (_checkpoint(spark), _checkpoint(spark)), trigger=None, table_path=table_path
    ):
        query.awaitTermination()
    found = spark.table(name)
    # The table is external and the frame holds its files: nothing is left in the catalog.
    spark.sql(f"DROP TABLE {name}")
    return _of_both(files=rides_log(spark, files).read(), table=found)


@check("compacted_rides", f"WITH {TRIPS_SQL} {_RIDES_SQL}")
def compacted_rides(spark, sf_dir):
    """Landed in three runs from one checkpoint, the first two packed into large files."""
    log = rides_log(spark, staging_path(spark, "rides"))
    checkpoint, source = _checkpoint(spark), staging_path(spark, "messages")
    messages = stage(_messages(spark, sf_dir), "messages")
    for part in range(3):
        messages.where(F.col("key").cast("int") % 3 == part).write.mode("append").parquet(source)
        rides_ = parse_delimited(read_message_files(spark, source))
        query = log_sink(rides_, log, checkpoint, trigger=None)
        query.awaitTermination()
        if part == 1:
            log.compact(query.lastProgress["batchId"])
    return _rounded(log.read()).select(*_RIDE)


@check(
    "restarted_vendor_counts",
    f"""WITH {TRIPS_SQL} SELECT "VendorID" AS vendor_id, count(*) AS count
    FROM trips GROUP BY "VendorID" """,
)
def restarted_vendor_counts(spark, sf_dir):
    """Half of the messages, a stop, and the rest after a start from the same checkpoint."""
    path, checkpoint, source = (staging_path(spark, n) for n in ("snapshot", "checkpoint", "messages"))
    messages = stage(_messages(spark, sf_dir), "messages")
    for odd in (0, 1):
        messages.where(F.col("key").cast("int") % 2 == odd).write.mode("append").parquet(source)
        counts = count_by(rides_from(read_message_files(spark, source)), ["vendor_id"])
        query = snapshot_sink(counts, path, checkpoint, trigger=None)
        query.awaitTermination()
    return read_parquet(spark, snapshot_path(path, query.lastProgress["batchId"]))


@check("fanned_out_rides", _LANDED_SQL)
def fanned_out_rides(spark, sf_dir):
    stream = parse_delimited(_stream(spark, _messages(spark, sf_dir)))
    paths = [staging_path(spark, "first"), staging_path(spark, "second")]
    fan_out_sink(stream, paths, _checkpoint(spark), trigger=None).awaitTermination()
    return _of_both(files=read_parquet(spark, paths[0]), table=read_parquet(spark, paths[1]))


@check("json_ride_stream", f"WITH {TRIPS_SQL} {_JSON_RIDES_SQL}")
def json_ride_stream(spark, sf_dir):
    stream = parse_json(_stream(spark, _json_messages(spark, sf_dir)))
    path = staging_path(spark, "json-rides")
    file_sink(
        stream, path, _checkpoint(spark), partition_by=None, trigger=None
    ).awaitTermination()
    return _rounded(read_parquet(spark, path))


@check(
    "memory_table_answer",
    f"""WITH {TRIPS_SQL} SELECT "VendorID" AS vendor_id, count(*) AS count
    FROM trips GROUP BY "VendorID" """,
)
def memory_table_answer(spark, sf_dir):
    """Only the counts per vendor reach the driver's memory table."""
    stream = parse_delimited(_stream(spark, _messages(spark, sf_dir)))
    answer, query = memory_sink(
        count_by(stream, ["vendor_id"]),
        f"vendors_{uuid4().hex}",
        "SELECT vendor_id, `count` FROM {table_name}",
        "complete",
    )
    query.stop()
    return answer
