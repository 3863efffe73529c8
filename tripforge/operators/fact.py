"""Fact assembly: natural keys of a trip replaced by surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripforge.staging import broadcast_if_small

# Columns of the fact table, in order.
FACT_COLUMNS = [
    "VendorID",
    "datetime_id",
    "passenger_id",
    "trip_distance_id",
    "rate_id",
    "store_and_fwd_flag",
    "location_id",
    "payment_id",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "service_type",
]

# (dimension, natural key, surrogate key)
_SMALL = [
    ("dim_passenger", ["passenger_count"], "passenger_id"),
    ("dim_location", ["PULocationID", "DOLocationID"], "location_id"),
    ("dim_rate", ["RatecodeID"], "rate_id"),
    ("dim_payment_type", ["payment_type"], "payment_id"),
]
_DATETIME_KEY = ["pickup_datetime", "dropoff_datetime"]
_TRIP_KEY = [*_DATETIME_KEY, "trip_distance"]


def _with_small_keys(trips: DataFrame, dims: dict[str, DataFrame], hint: bool) -> DataFrame:
    for name, keys, id_col in _SMALL:
        dim = dims[name].select(*keys, id_col)
        trips = trips.join(broadcast_if_small(dim) if hint else dim, keys, "left")
    return trips


def _with_large_keys(trips: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Both near-fact-size dimensions, each by its own left join.

    The trips are shuffled once: partitioned by the time pair, they also meet the
    dimension whose key is the pair and the distance.
    """
    return (
        trips.join(dims["dim_datetime"].select(*_DATETIME_KEY, "datetime_id"), _DATETIME_KEY, "left")
        .join(dims["dim_trip"].select(*_TRIP_KEY, "trip_distance_id"), _TRIP_KEY, "left")
        .select(*FACT_COLUMNS)
    )


def fact_table(trips: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """One fact row per trip, by left joins; the join strategy is Spark's choice.

    The small dimensions come first so that they join before any shuffle of the
    trips. The two near-fact-size dimensions join by shuffle: their keys are unique,
    so their side is even, and AQE splits a key that is hot on the trip side.
    """
    return _with_large_keys(_with_small_keys(trips, dims, hint=False), dims)


def fact_table_broadcast(trips: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The rows of :func:`fact_table`; small dimensions are broadcast after a size check."""
    return _with_large_keys(_with_small_keys(trips, dims, hint=True), dims)
