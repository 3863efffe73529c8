"""The six dimensions of the trip star. Input: cleaned trips."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripforge.functions.calendar import calendar_parts, minutes_between
from tripforge.functions.codes import payment_name, rate_name
from tripforge.operators.keys import extend_surrogate_key, with_surrogate_key


# Natural keys and id of each dimension.
KEYS = {
    "dim_passenger": (["passenger_count"], "passenger_id"),
    "dim_location": (["PULocationID", "DOLocationID"], "location_id"),
    "dim_trip": (["pickup_datetime", "dropoff_datetime", "trip_distance"], "trip_distance_id"),
    "dim_rate": (["RatecodeID"], "rate_id"),
    "dim_payment_type": (["payment_type"], "payment_id"),
    "dim_datetime": (["pickup_datetime", "dropoff_datetime"], "datetime_id"),
}


def _describe(name: str, keyed: DataFrame) -> DataFrame:
    """The dimension's columns from its natural keys and id."""
    if name == "dim_passenger":
        return keyed.select("passenger_id", "passenger_count")
    if name == "dim_trip":
        return keyed.select(
            "trip_distance",
            "pickup_datetime",
            "dropoff_datetime",
            "trip_distance_id",
            minutes_between("pickup_datetime", "dropoff_datetime").alias("trip_duration"),
        )
    if name == "dim_rate":
        return keyed.withColumn("rate_name", rate_name("RatecodeID"))
    if name == "dim_payment_type":
        return keyed.withColumn("payment_code", payment_name("payment_type"))
    if name == "dim_datetime":
        return keyed.select(
            "datetime_id",
            "pickup_datetime",
            *calendar_parts("pickup_datetime", "pickup"),
            "dropoff_datetime",
            *calendar_parts("dropoff_datetime", "dropoff"),
        )
    return keyed


def build(name: str, trips: DataFrame) -> DataFrame:
    """A dimension of the trips, its ids 1..n in the order of its natural keys."""
    keys, id_col = KEYS[name]
    return _describe(name, with_surrogate_key(trips.select(*keys).distinct(), keys, id_col))


def grow(name: str, stored: DataFrame, trips: DataFrame) -> DataFrame:
    """The rows that a stored dimension needs for further trips; the ids that it has stay as they are."""
    keys, id_col = KEYS[name]
    return _describe(name, extend_surrogate_key(stored.select(*keys, id_col), trips, keys, id_col))


def dim_passenger(trips: DataFrame) -> DataFrame:
    return build("dim_passenger", trips)


def dim_trip(trips: DataFrame) -> DataFrame:
    return build("dim_trip", trips)


def dim_location(trips: DataFrame) -> DataFrame:
    return build("dim_location", trips)


def dim_rate(trips: DataFrame) -> DataFrame:
    return build("dim_rate", trips)


def dim_payment_type(trips: DataFrame) -> DataFrame:
    return build("dim_payment_type", trips)


def dim_datetime(trips: DataFrame) -> DataFrame:
    return build("dim_datetime", trips)


DIMENSIONS = {
    "dim_passenger": dim_passenger,
    "dim_location": dim_location,
    "dim_trip": dim_trip,
    "dim_rate": dim_rate,
    "dim_payment_type": dim_payment_type,
    "dim_datetime": dim_datetime,
}
