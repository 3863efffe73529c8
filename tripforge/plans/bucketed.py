"""A star stored in buckets, for facts and reports that are built again and again.

Trips and the two near-fact-size dimensions lie in buckets of their time pair, and the fact and the moments (both
dimensions on the pair) in buckets of ``trip_distance_id``. Fact assembly and reports then join them without an
exchange; the one exchange of a table is paid when it is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tripforge.operators.fact import fact_table_broadcast
from tripforge.operators.reports import analytics_report, overview_report, trip_moments
from tripforge.plans.batch import FACT, build_dims
from tripforge.sources.buckets import HOT_ROWS, BucketStore, hot_keys

# Table names and the keys they lie by.
TRIPS, MOMENTS = "trips", "moments"
LARGE_DIMS = ["dim_trip", "dim_datetime"]
TIME_PAIR = ["pickup_datetime", "dropoff_datetime"]
TRIP_ID = ["trip_distance_id"]


def store_trips(
    trips: DataFrame, store: BucketStore, mode: str = "errorifexists", hot_rows: int = HOT_ROWS
) -> dict[str, DataFrame]:
    """Trips and large dimensions in buckets of the time pair; all six dimensions."""
    dims = build_dims(trips)
    hot = hot_keys(trips, TIME_PAIR, store.buckets, hot_rows)
    for name, df in {TRIPS: trips, **{name: dims[name] for name in LARGE_DIMS}}.items():
        store.write(df, name, TIME_PAIR, hot, mode)
    return dims


def bucketed_fact(store: BucketStore, dims: dict[str, DataFrame]) -> DataFrame:
    """The fact of the stored trips: those of hot time pairs join by the ordinary rules."""
    parts = []
    for read in (store.read, store.read_hot):
        parts.append(fact_table_broadcast(read(TRIPS), {**dims, **{name: read(name) for name in LARGE_DIMS}}))
    return parts[0].unionByName(parts[1])


def store_fact(
    store: BucketStore, dims: dict[str, DataFrame], mode: str = "errorifexists", hot_rows: int = HOT_ROWS
) -> None:
    """The fact, and the moments that the reports join it with, in buckets of the trip's id."""
    fact = bucketed_fact(store, dims)
    hot = hot_keys(fact.select(*TRIP_ID), TRIP_ID, store.buckets, hot_rows)
    store.write(fact, FACT, TRIP_ID, hot, mode)
    parts = [trip_moments({name: read(name) for name in LARGE_DIMS}) for read in (store.read, store.read_hot)]
    store.write(parts[0].unionByName(parts[1]), MOMENTS, TRIP_ID, hot, mode)


def _report(
    report: Callable[..., DataFrame], store: BucketStore, dims: dict[str, DataFrame], zones: DataFrame
) -> DataFrame:
    parts = [report(read(FACT), dims, zones, read(MOMENTS)) for read in (store.read, store.read_hot)]
    return parts[0].unionByName(parts[1])


def bucketed_overview(store: BucketStore, dims: dict[str, DataFrame], zones: DataFrame) -> DataFrame:
    """The rows of :func:`overview_report` over the stored fact."""
    return _report(overview_report, store, dims, zones)


def bucketed_analytics(store: BucketStore, dims: dict[str, DataFrame], zones: DataFrame) -> DataFrame:
    """The rows of :func:`analytics_report` over the stored fact."""
    return _report(analytics_report, store, dims, zones)
