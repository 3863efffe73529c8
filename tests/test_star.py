from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.batch import cleaned
from tripforge.operators.dims import dim_datetime, dim_payment_type, dim_rate
from tripforge.operators.fact import fact_table, fact_table_broadcast
from tripforge.operators.keys import with_surrogate_key
from tripforge.operators.reports import analytics_report, overview_report
from tripforge.plans.batch import build_dims
from tripforge.staging import stage

SF_DIR = "/root/testdata/sf0.001"


def ids(df, keys, id_col):
    return {tuple(r[k] for k in keys): r[id_col] for r in df.collect()}


@pytest.fixture(scope="module")
def star(spark):
    trips = stage(cleaned(spark, SF_DIR), "cleaned")
    return trips, build_dims(trips)


@pytest.fixture
def skewed_keys(spark):
    """Two thirds of the keys share their leading value, in no order."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("lead"),
        F.expr("pmod(xxhash64(id), 1000000) * 100000 + id").alias("rest"),
    )


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_keys_equal_row_number_at_any_parallelism(skewed_keys, settings, partitions):
    settings(
        spark__sql__shuffle__partitions=partitions,
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    keys = ["lead", "rest"]
    expected = skewed_keys.withColumn("id", F.row_number().over(Window.orderBy(*keys)))
    assert ids(with_surrogate_key(skewed_keys, keys, "id"), keys, "id") == ids(expected, keys, "id")


def test_hot_leading_key_is_spread(skewed_keys, settings, spark):
    settings(
        spark__sql__shuffle__partitions="8",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    ordered = skewed_keys.repartitionByRange("lead", "rest")
    sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 30_000 / 8


def test_empty_dimension(spark):
    empty = spark.createDataFrame([], "k int")
    assert with_surrogate_key(empty, ["k"], "id").count() == 0


def test_unknown_codes_have_no_name(make_trips):
    odd = make_trips({"RatecodeID": 99, "payment_type": 42})
    assert dim_rate(odd).first()["rate_name"] is None
    assert dim_payment_type(odd).first()["payment_code"] is None


def test_weekday_of_a_sunday(make_trips):
    row = dim_datetime(make_trips({"pickup_datetime": "2021-01-03 00:00:00"})).first()
    assert (row["pickup_weekday"], row["pickup_day"], row["dropoff_weekday"]) == (1, 3, 3)


def test_fact_has_one_complete_row_per_trip(star):
    trips, dims = star
    fact = fact_table(trips, dims)
    keys = [c for c in fact.columns if c.endswith("_id")]
    assert fact.count() == trips.count()
    assert fact.dropna(subset=keys).count() == fact.count()


def test_dimensions_are_dense_and_unique(star):
    _, dims = star
    for name, df in dims.items():
        (id_col,) = [c for c in df.columns if c.endswith("_id")]
        n, top, distinct = df.agg(
            F.count("*"), F.max(id_col), F.countDistinct(id_col)
        ).first()
        assert n == top == distinct, name


def test_both_assemblies_agree(star):
    trips, dims = star
    plain, hinted = fact_table(trips, dims), fact_table_broadcast(trips, dims)
    assert plain.exceptAll(hinted).count() == hinted.exceptAll(plain).count() == 0


@pytest.mark.parametrize("assemble", [fact_table, fact_table_broadcast])
def test_trip_unknown_to_one_dimension_keeps_its_other_keys(star, assemble):
    trips, dims = star
    without = {**dims, "dim_trip": dims["dim_trip"].limit(0)}
    fact = assemble(trips, without)
    assert fact.filter("trip_distance_id IS NOT NULL").count() == 0
    assert fact.filter("datetime_id IS NULL").count() == 0


def test_reports_follow_a_fact_whose_times_disagree(star, spark):
    trips, dims = star
    fact = stage(fact_table(trips, dims), "fact")
    top = dims["dim_datetime"].count()
    moved = F.when(F.col("fare_amount") > 20, top + 1 - F.col("datetime_id")).otherwise(F.col("datetime_id"))
    odd = stage(fact.withColumn("datetime_id", moved), "odd-fact")
    places = spark.range(1, 266).selectExpr("int(id) AS LocationID", "string(id) AS Zone", "'t' AS Borough")
    expected = odd.join(dims["dim_datetime"], "datetime_id").join(
        dims["dim_trip"].select("trip_distance_id", "trip_distance"), "trip_distance_id"
    )
    columns = ["pickup_datetime", "trip_distance", "fare_amount"]
    report = overview_report(odd, dims, places).select(
        "pickup_datetime", F.col("Distance").alias("trip_distance"), F.col("Revenue").alias("fare_amount")
    )
    assert report.count() == odd.count()
    assert report.exceptAll(expected.select(columns)).count() == 0


def test_reports_drop_trips_outside_the_zones(star, spark):
    trips, dims = star
    fact = stage(fact_table(trips, dims), "fact")
    pickup = trips.first()["PULocationID"]
    one = spark.createDataFrame([(pickup, "Here", "Town")], "LocationID int, Zone string, Borough string")
    expected = trips.filter(F.col("PULocationID") == pickup)
    assert overview_report(fact, dims, one).count() == expected.count()
    within = expected.filter(F.col("DOLocationID") == pickup)
    assert analytics_report(fact, dims, one).count() == within.count()
