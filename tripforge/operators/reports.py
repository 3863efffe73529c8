"""Report tables over the star, and small questions on date-partitioned trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.functions.calendar import weekday_name
from tripforge.functions.codes import tip_band
from tripforge.staging import broadcast_if_small, stage


def trip_moments(dims: dict[str, DataFrame]) -> DataFrame:
    """Distance, duration, times and calendar parts of every trip id, with the id of its time pair as ``own_id``.

    Both near-fact-size dimensions, which are narrow, meet on the time pair that both hold.
    """
    pair = ["pickup_datetime", "dropoff_datetime"]
    own = dims["dim_datetime"].withColumnRenamed("datetime_id", "own_id")
    return dims["dim_trip"].join(own, pair, "left")


def _with_moments(
    rows: DataFrame,
    dims: dict[str, DataFrame],
    times: list[str],
    distances: list[str],
    moments: DataFrame | None,
) -> DataFrame:
    """Inner join of fact rows with both near-fact-size dimensions, by one join of the wide rows.

    The rows meet the moments on ``trip_distance_id``. A row whose ``datetime_id`` is not the one of its
    trip's time pair (not so in a star built from its own trips) takes its times from ``dim_datetime``; a pass over
    the two ids alone tells which ids those are, and without any the rows are joined no further.
    """
    if moments is None:
        moments = trip_moments(dims)
    agrees = F.coalesce(F.col("datetime_id") == F.col("own_id"), F.lit(False))
    ids = rows.select("datetime_id", "trip_distance_id").join(moments.select("trip_distance_id", "own_id"), "trip_distance_id")
    apart = stage(ids.where(~agrees).select("datetime_id").distinct(), "apart")
    joined = rows.join(moments.select("trip_distance_id", "own_id", *times, *distances), "trip_distance_id")
    if apart.isEmpty():
        return joined.select(*rows.columns, *times, *distances)
    by_id = stage(dims["dim_datetime"].select("datetime_id", *times).join(apart, "datetime_id"), "apart-times")
    renamed = by_id.toDF("apart_id", *[f"apart_{c}" for c in times])
    # Rows that agree match nothing; ids are positive, so they are spread over negative numbers.
    spread = -1 - F.pmod(F.xxhash64("trip_distance_id", "datetime_id"), F.lit(1 << 40))
    key = F.when(agrees, spread).otherwise(F.coalesce("datetime_id", spread))
    found = joined.join(broadcast_if_small(renamed), key == F.col("apart_id"), "left")
    own_times = [F.when(agrees, F.col(c)).otherwise(F.col(f"apart_{c}")).alias(c) for c in times]
    return found.where(agrees | F.col("apart_id").isNotNull()).select(*rows.columns, *own_times, *distances)


def overview_report(
    fact: DataFrame, dims: dict[str, DataFrame], zones: DataFrame, moments: DataFrame | None = None
) -> DataFrame:
    """One row per trip: riders, time, revenue, distance, service, payment, zone, rate.

    Inner joins: a trip whose pickup zone is not in ``zones`` is left out. Zones join
    the location dimension first, so one small table meets the fact. ``moments`` are stored
    :func:`trip_moments`, if there are any.
    """
    places = stage(
        dims["dim_location"]
        .join(zones, F.col("PULocationID") == F.col("LocationID"))
        .select("location_id", "Zone"),
        "places",
    )
    rows = (
        fact.join(broadcast_if_small(places), "location_id")
        .join(broadcast_if_small(dims["dim_passenger"]), "passenger_id")
        .join(broadcast_if_small(dims["dim_payment_type"]), "payment_id")
        .join(broadcast_if_small(dims["dim_rate"]), "rate_id")
        .select(
            "datetime_id",
            "trip_distance_id",
            "passenger_count",
            "fare_amount",
            "service_type",
            "payment_code",
            "Zone",
            "rate_name",
        )
    )
    times, distances = ["pickup_datetime", "pickup_month"], ["trip_distance"]
    return _with_moments(rows, dims, times, distances, moments).select(
        F.col("passenger_count").alias("NumPassengers"),
        "pickup_datetime",
        F.col("fare_amount").alias("Revenue"),
        F.col("trip_distance").alias("Distance"),
        F.col("service_type").alias("Service"),
        F.col("payment_code").alias("Payment"),
        "Zone",
        F.col("pickup_month").alias("Month"),
        F.col("rate_name").alias("Rate"),
    )


def routes(dim_location: DataFrame, zones: DataFrame) -> DataFrame:
    """Location dimension with the names of both ends; zones play two roles."""
    pickup, dropoff = zones.alias("pickup"), zones.alias("dropoff")
    return (
        dim_location.join(pickup, F.col("PULocationID") == F.col("pickup.LocationID"))
        .join(dropoff, F.col("DOLocationID") == F.col("dropoff.LocationID"))
        .select(
            "location_id",
            F.col("pickup.Zone").alias("Zone"),
            F.col("pickup.Borough").alias("Borough"),
            F.concat("pickup.Zone", F.lit("-"), "dropoff.Zone").alias("Route"),
        )
    )


def analytics_report(
    fact: DataFrame, dims: dict[str, DataFrame], zones: DataFrame, moments: DataFrame | None = None
) -> DataFrame:
    """One row per trip: route, hour, weekday, distance, duration, service, tip band."""
    named = stage(routes(dims["dim_location"], zones), "routes")
    rows = fact.join(broadcast_if_small(named), "location_id").select(
        "datetime_id",
        "trip_distance_id",
        "Zone",
        "Borough",
        "Route",
        "service_type",
        "tip_amount",
        "fare_amount",
        "tolls_amount",
    )
    times, distances = ["pickup_datetime"], ["trip_distance", "trip_duration"]
    return _with_moments(rows, dims, times, distances, moments).select(
        "pickup_datetime",
        "Zone",
        "Borough",
        "Route",
        F.hour("pickup_datetime").alias("Hour"),
        weekday_name("pickup_datetime").alias("Day"),
        F.col("trip_distance").alias("Distance"),
        F.col("trip_duration").alias("Duration"),
        F.col("service_type").alias("Service"),
        tip_band("tip_amount", "fare_amount", "tolls_amount").alias("TipRate"),
    )


def between_dates(df: DataFrame, start: str, end: str, date_col: str = "pickup_date") -> DataFrame:
    """Rows of the dates ``start`` to ``end``, both included, by the partition column."""
    return df.filter(
        F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )


def distinct_vendors(df: DataFrame, start: str, end: str) -> DataFrame:
    return between_dates(df, start, end).select("VendorID").distinct()


def vendor_trip_count(df: DataFrame, start: str, end: str, vendor: int) -> DataFrame:
    rows = between_dates(df, start, end).filter(F.col("VendorID") == vendor)
    return rows.agg(F.count(F.lit(1)).alias("trips"))


def partition_row_counts(df: DataFrame, table_name: str, date_col: str = "pickup_date") -> DataFrame:
    """Rows per date partition, largest first. Reads file footers only."""
    return (
        df.groupBy(F.col(date_col).alias("partition_id"))
        .agg(F.count(F.lit(1)).alias("total_rows"))
        .select(F.lit(table_name).alias("table_name"), "partition_id", "total_rows")
        .orderBy(F.desc("total_rows"), "partition_id")
    )


def preview(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows; ordered for a reproducible preview when ``order_by`` is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
