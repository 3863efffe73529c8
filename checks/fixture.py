"""Trips derived from the order lines, in Spark and in SQL.

Every tenth order appears twice, so that exact copies exist, and codes, times,
distances and amounts include values each quality rule must reject.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge import schemas
from tripforge.operators.unify import unify


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    pickup, dropoff = schemas.SERVICE_TIMES[service]
    extras = ["CAST(NULL AS DOUBLE) AS ehail_fee", "1 AS trip_type"]
    return (
        table(spark, sf_dir, "lineitem")
        .filter("l_returnflag = 'N'" if service == schemas.YELLOW else "l_returnflag <> 'N'")
        .withColumns(
            {
                "copy": F.expr("explode(array_repeat(0, if(l_orderkey % 10 = 0, 2, 1)))"),
                "start": F.expr("l_partkey * 37 % 86400"),
                "ride": F.expr("(l_orderkey % 60 - 5) * 60 + l_partkey % 60"),
                "fare": F.expr("floor(l_extendedprice / 10)"),
                "tolls": F.expr("l_suppkey % 3 * 200"),
            }
        )
        .withColumn("tip", F.expr("floor(fare * (l_orderkey % 7) * 7 / 100)"))
        .selectExpr(
            "CAST(l_suppkey % 3 AS INT) AS VendorID",
            f"l_shipdate + make_dt_interval(0, 0, 0, start) AS {pickup}",
            f"l_shipdate + make_dt_interval(0, 0, 0, start + ride) AS {dropoff}",
            "if(l_linestatus = 'F', 'Y', 'N') AS store_and_fwd_flag",
            "CAST(l_orderkey % 8 AS INT) AS RatecodeID",
            "CAST(l_partkey % 267 AS INT) AS PULocationID",
            "CAST((l_suppkey * 7 + l_linenumber) % 267 AS INT) AS DOLocationID",
            "CAST(l_quantity AS INT) % 7 AS passenger_count",
            "if(l_linenumber = 5 AND l_partkey % 10 = 0, double('NaN'), "
            "double(l_partkey * 13 % 2500) / 100D) AS trip_distance",
            "fare / 100D AS fare_amount",
            "if(l_linenumber = 6, -0.5D, 0.5D) AS extra",
            "0.5D AS mta_tax",
            "tip / 100D AS tip_amount",
            "tolls / 100D AS tolls_amount",
            "0.3D AS improvement_surcharge",
            "(fare + tip + tolls + 130) / 100D AS total_amount",
            "CAST((l_orderkey + l_linenumber) % 7 AS INT) AS payment_type",
            "if(l_linenumber = 7, NULL, 2.5D) AS congestion_surcharge",
            *(extras if service == schemas.GREEN else []),
        )
    )


def raw_services(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One raw frame per service, with that service's column names."""
    return {s: _raw(spark, sf_dir, s) for s in (schemas.GREEN, schemas.YELLOW)}


def raw_as_typed(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """Raw frame in the column order of the service's files."""
    return _raw(spark, sf_dir, service).select(schemas.SERVICE_SCHEMAS[service].names)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unify(raw_services(spark, sf_dir))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("LocationID"),
        F.col("p_name").alias("Zone"),
        F.col("p_brand").alias("Borough"),
    )


RIDE_SOURCES = {
    "vendor_id": "VendorID",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
}


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips under the column names and order of ride messages."""
    sources = {n: RIDE_SOURCES.get(n, n) for n in schemas.RIDE_SCHEMA.names}
    return trips(spark, sf_dir).select([F.col(c).alias(n) for n, c in sources.items()])


# The same derivation in SQL. Common table expressions, to be put after WITH.
TRIPS_SQL = """
lines AS (
  SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 10 = 0
),
cents AS (
  SELECT *,
    CAST(floor(l_extendedprice / 10) AS BIGINT) AS fare_cents,
    CAST(floor(floor(l_extendedprice / 10) * (l_orderkey % 7) * 7 / 100) AS BIGINT) AS tip_cents,
    CAST((l_suppkey % 3) * 200 AS BIGINT) AS tolls_cents
  FROM lines
),
trips AS (
  SELECT
    CAST(l_suppkey % 3 AS INT) AS "VendorID",
    l_shipdate + (l_partkey * 37 % 86400) * INTERVAL '1' SECOND AS pickup_datetime,
    l_shipdate + (l_partkey * 37 % 86400 + (l_orderkey % 60 - 5) * 60 + l_partkey % 60)
      * INTERVAL '1' SECOND AS dropoff_datetime,
    CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(l_orderkey % 8 AS INT) AS "RatecodeID",
    CAST(l_partkey % 267 AS INT) AS "PULocationID",
    CAST((l_suppkey * 7 + l_linenumber) % 267 AS INT) AS "DOLocationID",
    CAST(l_quantity AS INT) % 7 AS passenger_count,
    CASE WHEN l_linenumber = 5 AND l_partkey % 10 = 0 THEN CAST('NaN' AS DOUBLE)
         ELSE CAST(l_partkey * 13 % 2500 AS DOUBLE) / CAST(100 AS DOUBLE) END AS trip_distance,
    fare_cents / CAST(100 AS DOUBLE) AS fare_amount,
    CASE WHEN l_linenumber = 6 THEN CAST(-0.5 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    tip_cents / CAST(100 AS DOUBLE) AS tip_amount,
    tolls_cents / CAST(100 AS DOUBLE) AS tolls_amount,
    CAST(0.3 AS DOUBLE) AS improvement_surcharge,
    (fare_cents + tip_cents + tolls_cents + 130) / CAST(100 AS DOUBLE) AS total_amount,
    CAST((l_orderkey + l_linenumber) % 7 AS INT) AS payment_type,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
    CASE WHEN l_returnflag = 'N' THEN 'yellow' ELSE 'green' END AS service_type
  FROM cents
)"""

CLEAN_SQL = (
    TRIPS_SQL
    + """,
clean AS (
  SELECT DISTINCT * FROM trips
  WHERE NOT isnan(trip_distance) AND congestion_surcharge IS NOT NULL
    AND dropoff_datetime > pickup_datetime AND passenger_count > 0
    AND fare_amount >= 0 AND total_amount >= 0 AND trip_distance >= 0
    AND payment_type BETWEEN 1 AND 6 AND "VendorID" IN (1, 2)
    AND "PULocationID" BETWEEN 1 AND 265 AND "DOLocationID" BETWEEN 1 AND 265
    AND "RatecodeID" BETWEEN 1 AND 6
    AND extra >= 0 AND mta_tax >= 0 AND tip_amount >= 0 AND tolls_amount >= 0
    AND improvement_surcharge >= 0 AND congestion_surcharge >= 0
)"""
)

# Code names.
RATE_CASE = """CASE "RatecodeID" WHEN 1 THEN 'Standard rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
  WHEN 4 THEN 'Nassau or Westchester' WHEN 5 THEN 'Negotiated fare' WHEN 6 THEN 'Group ride' END"""

PAYMENT_CASE = """CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash'
  WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown'
  WHEN 6 THEN 'Voided trip' END"""

DIMS_SQL = (
    CLEAN_SQL
    + f""",
dim_passenger AS (
  SELECT passenger_count, row_number() OVER (ORDER BY passenger_count) AS passenger_id
  FROM (SELECT DISTINCT passenger_count FROM clean)
),
dim_trip AS (
  SELECT trip_distance, pickup_datetime, dropoff_datetime,
    row_number() OVER (ORDER BY pickup_datetime, dropoff_datetime, trip_distance)
      AS trip_distance_id,
    round((epoch(dropoff_datetime) - epoch(pickup_datetime)) / 60, 2) AS trip_duration
  FROM (SELECT DISTINCT trip_distance, pickup_datetime, dropoff_datetime FROM clean)
),
dim_location AS (
  SELECT "PULocationID", "DOLocationID",
    row_number() OVER (ORDER BY "PULocationID", "DOLocationID") AS location_id
  FROM (SELECT DISTINCT "PULocationID", "DOLocationID" FROM clean)
),
dim_rate AS (
  SELECT "RatecodeID", row_number() OVER (ORDER BY "RatecodeID") AS rate_id,
    {RATE_CASE} AS rate_name
  FROM (SELECT DISTINCT "RatecodeID" FROM clean)
),
dim_payment_type AS (
  SELECT payment_type, row_number() OVER (ORDER BY payment_type) AS payment_id,
    {PAYMENT_CASE} AS payment_code
  FROM (SELECT DISTINCT payment_type FROM clean)
),
dim_datetime AS (
  SELECT row_number() OVER (ORDER BY pickup_datetime, dropoff_datetime) AS datetime_id,
    pickup_datetime,
    CAST(year(pickup_datetime) AS INT) AS pickup_year,
    CAST(month(pickup_datetime) AS INT) AS pickup_month,
    CAST(day(pickup_datetime) AS INT) AS pickup_day,
    CAST(dayofweek(pickup_datetime) + 1 AS INT) AS pickup_weekday,
    dropoff_datetime,
    CAST(year(dropoff_datetime) AS INT) AS dropoff_year,
    CAST(month(dropoff_datetime) AS INT) AS dropoff_month,
    CAST(day(dropoff_datetime) AS INT) AS dropoff_day,
    CAST(dayofweek(dropoff_datetime) + 1 AS INT) AS dropoff_weekday
  FROM (SELECT DISTINCT pickup_datetime, dropoff_datetime FROM clean)
)"""
)

FACT_SQL = (
    DIMS_SQL
    + """,
fact_table AS (
  SELECT "VendorID", datetime_id, passenger_id, trip_distance_id, rate_id, store_and_fwd_flag,
    location_id, payment_id, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
    improvement_surcharge, service_type
  FROM clean
    LEFT JOIN dim_passenger USING (passenger_count)
    LEFT JOIN dim_trip USING (trip_distance, pickup_datetime, dropoff_datetime)
    LEFT JOIN dim_location USING ("PULocationID", "DOLocationID")
    LEFT JOIN dim_rate USING ("RatecodeID")
    LEFT JOIN dim_payment_type USING (payment_type)
    LEFT JOIN dim_datetime USING (pickup_datetime, dropoff_datetime)
),
zones AS (
  SELECT CAST(p_partkey AS INT) AS "LocationID", p_name AS "Zone", p_brand AS "Borough" FROM part
)"""
)
