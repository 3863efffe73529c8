"""Trips, cleaning, star schema, revenue and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixture import (
    CLEAN_SQL,
    DIMS_SQL,
    FACT_SQL,
    PAYMENT_CASE,
    RATE_CASE,
    TRIPS_SQL,
    raw_services,
    trips,
    zones,
)
from checks.registry import check
from tripforge.functions.calendar import calendar_parts, minutes_between, month_start, weekday_name
from tripforge.functions.codes import payment_name, rate_name, tip_band
from tripforge.operators import dims as dimensions
from tripforge.operators import reports
from tripforge.operators.fact import fact_table, fact_table_broadcast
from tripforge.operators.quality import keep_good, reject_counts
from tripforge.operators.revenue import monthly_revenue, monthly_revenue_sql
from tripforge.plans import bucketed
from tripforge.plans.batch import (
    ALL_CLEANED,
    FACT,
    build_dims,
    clean_all,
    run_dims,
    run_fact,
    run_grow_dims,
)
from tripforge.sources.buckets import BucketStore
from tripforge.sources.tables import TableStore
from tripforge.staging import stage, staging_path


def counted(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def total(column: str) -> Column:
    """Money sum rounded to cents, which hides the order of floating-point addition."""
    return F.round(F.sum(column), 2)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_all(raw_services(spark, sf_dir))


# --- unify ------------------------------------------------------------------


@check("unified_trips", f"WITH {TRIPS_SQL} SELECT * FROM trips")
def unified_trips(spark, sf_dir):
    return trips(spark, sf_dir)


@check(
    "unified_trips_by_service",
    f"""WITH {TRIPS_SQL}
    SELECT service_type, count(*) AS trips, round(sum(fare_amount), 2) AS fare,
      round(sum(total_amount), 2) AS total
    FROM trips GROUP BY service_type""",
)
def unified_trips_by_service(spark, sf_dir):
    return trips(spark, sf_dir).groupBy("service_type").agg(
        counted("trips"), total("fare_amount").alias("fare"), total("total_amount").alias("total")
    )


# --- quality ----------------------------------------------------------------


@check("clean_trips", f"WITH {CLEAN_SQL} SELECT * FROM clean")
def clean_trips(spark, sf_dir):
    return cleaned(spark, sf_dir)


@check("distinct_trips", f"WITH {TRIPS_SQL} SELECT DISTINCT * FROM trips")
def distinct_trips(spark, sf_dir):
    return trips(spark, sf_dir).dropDuplicates()


_AMOUNTS = [
    "fare_amount",
    "total_amount",
    "trip_distance",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
]
# NaN is not below zero in either engine.
_RULE_SQL = {
    "complete": "congestion_surcharge IS NOT NULL AND NOT isnan(trip_distance)",
    "ends_after_start": "dropoff_datetime > pickup_datetime",
    "has_passengers": "passenger_count > 0",
    "known_payment": "payment_type BETWEEN 1 AND 6",
    "known_vendor": '"VendorID" IN (1, 2)',
    "known_pickup_zone": '"PULocationID" BETWEEN 1 AND 265',
    "known_dropoff_zone": '"DOLocationID" BETWEEN 1 AND 265',
    "known_rate": '"RatecodeID" BETWEEN 1 AND 6',
    **{f"{name}_not_negative": f"{name} >= 0" for name in _AMOUNTS},
}


@check(
    "clean_reject_counts",
    f"WITH {TRIPS_SQL} "
    + " UNION ALL ".join(
        f"SELECT service_type, '{rule}' AS rule, "
        f"count(*) FILTER (WHERE NOT coalesce({good}, false)) AS rejected "
        "FROM trips GROUP BY service_type"
        for rule, good in _RULE_SQL.items()
    ),
)
def clean_reject_counts(spark, sf_dir):
    return reject_counts(trips(spark, sf_dir))


def _rule_query(name: str, rules: list[str]) -> None:
    good = " AND ".join(_RULE_SQL[rule] for rule in rules)

    @check(
        name,
        f"""WITH {TRIPS_SQL}
        SELECT service_type, "VendorID", count(*) AS trips, round(sum(fare_amount), 2) AS fare
        FROM trips WHERE {good} GROUP BY service_type, "VendorID" """,
    )
    def query(spark, sf_dir):
        kept = keep_good(trips(spark, sf_dir), rules)
        return kept.groupBy("service_type", "VendorID").agg(
            counted("trips"), total("fare_amount").alias("fare")
        )


_rule_query("keep_complete", ["complete"])
_rule_query("keep_ends_after_start", ["ends_after_start"])
_rule_query("keep_with_passengers", ["has_passengers"])
_rule_query("keep_fare_not_negative", ["fare_amount_not_negative"])
_rule_query("keep_total_not_negative", ["total_amount_not_negative"])
_rule_query("keep_distance_not_negative", ["trip_distance_not_negative"])
_rule_query("keep_known_payment", ["known_payment"])
_rule_query("keep_known_vendor", ["known_vendor"])
_rule_query("keep_known_pickup_zone", ["known_pickup_zone"])
_rule_query("keep_known_dropoff_zone", ["known_dropoff_zone"])
_rule_query("keep_known_rate", ["known_rate"])
_rule_query("keep_charges_not_negative", [f"{name}_not_negative" for name in _AMOUNTS[3:]])


# --- scalar functions over all trips ------------------------------------------


@check(
    "calendar_columns",
    f"""WITH {TRIPS_SQL}
    SELECT pickup_datetime, count(*) AS trips,
      date_trunc('month', pickup_datetime) AS month_start,
      CAST(pickup_datetime AS DATE) AS pickup_date,
      CAST(year(pickup_datetime) AS INT) AS pickup_year,
      CAST(month(pickup_datetime) AS INT) AS pickup_month,
      CAST(day(pickup_datetime) AS INT) AS pickup_day,
      CAST(dayofweek(pickup_datetime) + 1 AS INT) AS pickup_weekday,
      CAST(hour(pickup_datetime) AS INT) AS pickup_hour,
      dayname(pickup_datetime) AS weekday_name
    FROM trips GROUP BY pickup_datetime""",
)
def calendar_columns(spark, sf_dir):
    ts = "pickup_datetime"
    return (
        trips(spark, sf_dir)
        .groupBy(ts)
        .agg(counted("trips"))
        .select(
            ts,
            "trips",
            month_start(ts).cast("timestamp_ntz").alias("month_start"),
            F.to_date(ts).alias("pickup_date"),
            *calendar_parts(ts, "pickup"),
            F.hour(ts).alias("pickup_hour"),
            weekday_name(ts).alias("weekday_name"),
        )
    )


@check(
    "trip_durations",
    f"""WITH {TRIPS_SQL}
    SELECT round((epoch(dropoff_datetime) - epoch(pickup_datetime)) / 60, 2) AS minutes,
      count(*) AS trips
    FROM trips GROUP BY 1""",
)
def trip_durations(spark, sf_dir):
    minutes = minutes_between("pickup_datetime", "dropoff_datetime").alias("minutes")
    return trips(spark, sf_dir).groupBy(minutes).agg(counted("trips"))


@check(
    "code_names",
    f"""WITH {TRIPS_SQL}
    SELECT "RatecodeID", {RATE_CASE} AS rate_name, payment_type, {PAYMENT_CASE} AS payment_code,
      count(*) AS trips
    FROM trips GROUP BY "RatecodeID", payment_type""",
)
def code_names(spark, sf_dir):
    codes = trips(spark, sf_dir).groupBy("RatecodeID", "payment_type").agg(counted("trips"))
    return codes.select(
        "RatecodeID",
        rate_name("RatecodeID").alias("rate_name"),
        "payment_type",
        payment_name("payment_type").alias("payment_code"),
        "trips",
    )


_TIP_PERCENT = "round(tip_amount * 100 / (fare_amount + tip_amount + tolls_amount), 2)"
TIP_CASE = f"""CASE WHEN tip_amount = 0 THEN 'No Tip'
  WHEN {_TIP_PERCENT} <= 5 THEN 'Less than 5%' WHEN {_TIP_PERCENT} <= 10 THEN '5% to 10%'
  WHEN {_TIP_PERCENT} <= 15 THEN '10% to 15%' WHEN {_TIP_PERCENT} <= 20 THEN '15% to 20%'
  WHEN {_TIP_PERCENT} <= 25 THEN '20% to 25%' ELSE 'More than 25%' END"""


@check(
    "tip_bands",
    f"""WITH {TRIPS_SQL}
    SELECT service_type, {TIP_CASE} AS tip_band, count(*) AS trips
    FROM trips GROUP BY 1, 2""",
)
def tip_bands(spark, sf_dir):
    band = tip_band("tip_amount", "fare_amount", "tolls_amount").alias("tip_band")
    return trips(spark, sf_dir).groupBy("service_type", band).agg(counted("trips"))


# --- revenue ------------------------------------------------------------------

_SUMS = {
    "revenue_monthly_fare": "fare_amount",
    "revenue_monthly_extra": "extra",
    "revenue_monthly_mta_tax": "mta_tax",
    "revenue_monthly_tip_amount": "tip_amount",
    "revenue_monthly_tolls_amount": "tolls_amount",
    "revenue_monthly_improvement_surcharge": "improvement_surcharge",
    "revenue_monthly_total_amount": "total_amount",
    "revenue_monthly_congestion_surcharge": "congestion_surcharge",
}
_AVERAGES = {
    "avg_monthly_passenger_count": "passenger_count",
    "avg_monthly_trip_distance": "trip_distance",
}
REVENUE_SQL = f"""WITH {TRIPS_SQL}
  SELECT "PULocationID" AS revenue_zone, date_trunc('month', pickup_datetime) AS revenue_month,
    service_type,
    {", ".join(f"round(sum({c}), 2) AS {n}" for n, c in _SUMS.items())},
    {", ".join(f"round(avg({c}), 9) AS {n}" for n, c in _AVERAGES.items())}
  FROM trips GROUP BY 1, 2, 3"""


def rounded_revenue(revenue: DataFrame) -> DataFrame:
    return revenue.withColumns(
        {n: F.round(n, 2) for n in _SUMS} | {n: F.round(n, 9) for n in _AVERAGES}
    )


@check("monthly_revenue", REVENUE_SQL)
def monthly_revenue_query(spark, sf_dir):
    return rounded_revenue(monthly_revenue(trips(spark, sf_dir)))


@check("monthly_revenue_sql", REVENUE_SQL)
def monthly_revenue_sql_query(spark, sf_dir):
    return rounded_revenue(monthly_revenue_sql(trips(spark, sf_dir)))


# --- star ---------------------------------------------------------------------


def _dim_query(name: str, build) -> None:
    @check(name, f"WITH {DIMS_SQL} SELECT * FROM {name}")
    def query(spark, sf_dir):
        return build(cleaned(spark, sf_dir))


for _name, _build in dimensions.DIMENSIONS.items():
    _dim_query(_name, _build)


def star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Stored cleaned trips and their dimensions."""
    stored = stage(cleaned(spark, sf_dir), "cleaned")
    return stored, build_dims(stored)


@check("fact_table", f"WITH {FACT_SQL} SELECT * FROM fact_table")
def fact_table_query(spark, sf_dir):
    return fact_table(*star(spark, sf_dir))


@check("fact_table_broadcast", f"WITH {FACT_SQL} SELECT * FROM fact_table")
def fact_table_broadcast_query(spark, sf_dir):
    return fact_table_broadcast(*star(spark, sf_dir))


def _foreign_dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """All cleaned trips, and dimensions that know only the first vendor's."""
    stored = stage(cleaned(spark, sf_dir), "cleaned")
    return stored, build_dims(stored.where("VendorID = 1"))


_FOREIGN_SQL = FACT_SQL.replace("FROM clean)", 'FROM clean WHERE "VendorID" = 1)')


@check("fact_with_foreign_dims", f"WITH {_FOREIGN_SQL} SELECT * FROM fact_table")
def fact_with_foreign_dims(spark, sf_dir):
    return fact_table(*_foreign_dims(spark, sf_dir))


@check("fact_with_foreign_dims_broadcast", f"WITH {_FOREIGN_SQL} SELECT * FROM fact_table")
def fact_with_foreign_dims_broadcast(spark, sf_dir):
    return fact_table_broadcast(*_foreign_dims(spark, sf_dir))


@check(
    "fact_key_coverage",
    f"""WITH {FACT_SQL}
    SELECT count(*) AS facts, count(datetime_id) AS with_datetime, count(trip_distance_id) AS
      with_trip, count(location_id) AS with_location, count(passenger_id) AS with_passenger,
      count(rate_id) AS with_rate, count(payment_id) AS with_payment,
      count(DISTINCT trip_distance_id) AS trip_ids, max(trip_distance_id) AS last_trip_id,
      count(DISTINCT datetime_id) AS datetime_ids, max(datetime_id) AS last_datetime_id
    FROM fact_table""",
)
def fact_key_coverage(spark, sf_dir):
    facts = fact_table_broadcast(*star(spark, sf_dir))
    return facts.agg(
        counted("facts"),
        F.count("datetime_id").alias("with_datetime"),
        F.count("trip_distance_id").alias("with_trip"),
        F.count("location_id").alias("with_location"),
        F.count("passenger_id").alias("with_passenger"),
        F.count("rate_id").alias("with_rate"),
        F.count("payment_id").alias("with_payment"),
        F.countDistinct("trip_distance_id").alias("trip_ids"),
        F.max("trip_distance_id").alias("last_trip_id"),
        F.countDistinct("datetime_id").alias("datetime_ids"),
        F.max("datetime_id").alias("last_datetime_id"),
    )


# --- reports --------------------------------------------------------------------

OVERVIEW_SQL = f"""WITH {FACT_SQL}
  SELECT passenger_count AS "NumPassengers", d.pickup_datetime, fare_amount AS "Revenue",
    trip_distance AS "Distance", service_type AS "Service", payment_code AS "Payment",
    z."Zone", pickup_month AS "Month", rate_name AS "Rate"
  FROM fact_table
    JOIN dim_datetime d USING (datetime_id) JOIN dim_passenger USING (passenger_id)
    JOIN dim_trip USING (trip_distance_id) JOIN dim_location l USING (location_id)
    JOIN zones z ON l."PULocationID" = z."LocationID"
    JOIN dim_payment_type USING (payment_id) JOIN dim_rate USING (rate_id)"""

ANALYTICS_SQL = f"""WITH {FACT_SQL}
  SELECT d.pickup_datetime, pu."Zone" AS "Zone", pu."Borough" AS "Borough",
    pu."Zone" || '-' || dz."Zone" AS "Route",
    CAST(hour(d.pickup_datetime) AS INT) AS "Hour", dayname(d.pickup_datetime) AS "Day",
    trip_distance AS "Distance", trip_duration AS "Duration", service_type AS "Service",
    {TIP_CASE} AS "TipRate"
  FROM fact_table
    JOIN dim_datetime d USING (datetime_id) JOIN dim_location l USING (location_id)
    JOIN zones pu ON l."PULocationID" = pu."LocationID"
    JOIN zones dz ON l."DOLocationID" = dz."LocationID"
    JOIN dim_trip USING (trip_distance_id)"""


def stored_fact(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    stored, dims = star(spark, sf_dir)
    return stage(fact_table_broadcast(stored, dims), "fact"), dims


@check("overview_report", OVERVIEW_SQL)
def overview_report_query(spark, sf_dir):
    return reports.overview_report(*stored_fact(spark, sf_dir), zones(spark, sf_dir))


@check("analytics_report", ANALYTICS_SQL)
def analytics_report_query(spark, sf_dir):
    return reports.analytics_report(*stored_fact(spark, sf_dir), zones(spark, sf_dir))


def bucketed_star(
    spark: SparkSession, sf_dir: str, buckets: int = 16
) -> tuple[BucketStore, dict[str, DataFrame]]:
    """The star in buckets, under names of its own."""
    path = staging_path(spark, "buckets")
    store = BucketStore(spark, path, f"b{path[-12:]}_", buckets)
    dims = bucketed.store_trips(stage(cleaned(spark, sf_dir), "cleaned"), store)
    bucketed.store_fact(store, dims)
    return store, dims


def _grown_sql(name: str, keys: str, id_col: str, rest: str) -> str:
    """Ids of the first vendor's trips in order, then those of the other trips' new keys."""
    return f"""WITH {CLEAN_SQL},
    keys AS (SELECT {keys}, min(CASE WHEN "VendorID" = 1 THEN 1 ELSE 2 END) AS load FROM clean GROUP BY {keys})
    SELECT row_number() OVER (ORDER BY load, {keys}) AS {id_col}, {keys}, {rest} load FROM keys"""


def _grown(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A dimension written for the first vendor's trips, read back and grown for all; the load of each row."""
    store = TableStore(spark, staging_path(spark, "store"))
    stored = stage(cleaned(spark, sf_dir), "cleaned")
    store.write_all(build_dims(stored.where("VendorID = 1")))
    first = store.read(name).count()
    run_grow_dims(stored, store)
    (id_col,) = [c for c in store.read(name).columns if c.endswith("_id")]
    return store.read(name).withColumn("load", F.when(F.col(id_col) <= first, 1).otherwise(2))


@check(
    "grown_dim_trip",
    _grown_sql(
        "dim_trip",
        "pickup_datetime, dropoff_datetime, trip_distance",
        "trip_distance_id",
        "round((epoch(dropoff_datetime) - epoch(pickup_datetime)) / 60, 2) AS trip_duration,",
    ),
)
def grown_dim_trip(spark, sf_dir):
    return _grown(spark, sf_dir, "dim_trip")


@check("grown_dim_location", _grown_sql("dim_location", '"PULocationID", "DOLocationID"', "location_id", ""))
def grown_dim_location(spark, sf_dir):
    return _grown(spark, sf_dir, "dim_location")


@check(
    "stored_dimensions",
    f"""WITH {DIMS_SQL} SELECT *
    FROM (SELECT 'dim_passenger' AS name, count(*) AS rows, max(passenger_id) AS top FROM dim_passenger
    UNION ALL SELECT 'dim_location', count(*), max(location_id) FROM dim_location
    UNION ALL SELECT 'dim_trip', count(*), max(trip_distance_id) FROM dim_trip
    UNION ALL SELECT 'dim_rate', count(*), max(rate_id) FROM dim_rate
    UNION ALL SELECT 'dim_payment_type', count(*), max(payment_id) FROM dim_payment_type
    UNION ALL SELECT 'dim_datetime', count(*), max(datetime_id) FROM dim_datetime)""",
)
def stored_dimensions(spark, sf_dir):
    """All six dimensions written by the job and read back by name."""
    store = TableStore(spark, staging_path(spark, "store"))
    store.write(cleaned(spark, sf_dir), ALL_CLEANED)
    found = None
    for name, df in store.read_all(run_dims(store, store)).items():
        (id_col,) = [c for c in df.columns if c.endswith("_id")]
        part = df.agg(F.lit(name).alias("name"), counted("rows"), F.max(id_col).alias("top"))
        found = part if found is None else found.unionByName(part)
    return found


@check("stored_fact", f"WITH {FACT_SQL} SELECT * FROM fact_table")
def stored_fact_query(spark, sf_dir):
    """The fact job over dimensions that were written and read back."""
    store = TableStore(spark, staging_path(spark, "store"))
    store.write(cleaned(spark, sf_dir), ALL_CLEANED)
    run_dims(store, store)
    run_fact(store, store, broadcast=True)
    return store.read(FACT)


def _bucketed_query(name: str, sql: str, build) -> None:
    @check(name, sql)
    def query(spark, sf_dir):
        store, dims = bucketed_star(spark, sf_dir)
        found = build(store, dims, spark, sf_dir)
        # The frame holds its files; nothing is left in the catalog.
        store.forget(bucketed.TRIPS, bucketed.MOMENTS, FACT, *bucketed.LARGE_DIMS)
        return found


_bucketed_query(
    "bucketed_fact_table",
    f"WITH {FACT_SQL} SELECT * FROM fact_table",
    lambda store, dims, spark, sf_dir: bucketed.bucketed_fact(store, dims),
)
_bucketed_query(
    "bucketed_overview_report",
    OVERVIEW_SQL,
    lambda store, dims, spark, sf_dir: bucketed.bucketed_overview(store, dims, zones(spark, sf_dir)),
)
_bucketed_query(
    "bucketed_analytics_report",
    ANALYTICS_SQL,
    lambda store, dims, spark, sf_dir: bucketed.bucketed_analytics(store, dims, zones(spark, sf_dir)),
)


@check(
    "location_routes",
    f"""WITH {FACT_SQL}
    SELECT location_id, pu."Zone" AS "Zone", pu."Borough" AS "Borough",
      pu."Zone" || '-' || dz."Zone" AS "Route"
    FROM dim_location l JOIN zones pu ON l."PULocationID" = pu."LocationID"
      JOIN zones dz ON l."DOLocationID" = dz."LocationID" """,
)
def location_routes(spark, sf_dir):
    pairs = dimensions.dim_location(cleaned(spark, sf_dir))
    return reports.routes(pairs, zones(spark, sf_dir))


@check(
    "preview",
    f"""WITH {TRIPS_SQL} SELECT * FROM trips
    ORDER BY pickup_datetime, dropoff_datetime, "PULocationID", "DOLocationID", fare_amount,
      tip_amount, "VendorID", payment_type, extra LIMIT 10""",
)
def preview_query(spark, sf_dir):
    order = [
        "pickup_datetime",
        "dropoff_datetime",
        "PULocationID",
        "DOLocationID",
        "fare_amount",
        "tip_amount",
        "VendorID",
        "payment_type",
        "extra",
    ]
    return reports.preview(trips(spark, sf_dir), 10, order)


# Batch queries whose plans are checked to hold no Python node.
QUERIES_WITHOUT_PYTHON = [
    "unified_trips",
    "clean_trips",
    "clean_reject_counts",
    "monthly_revenue",
    "monthly_revenue_sql",
    "dim_trip",
    "dim_rate",
    "fact_table",
    "overview_report",
    "analytics_report",
    "tip_bands",
]
