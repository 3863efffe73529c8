"""Plan shapes: what must be pushed, broadcast, split or absent."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from checks.batch import QUERIES_WITHOUT_PYTHON, cleaned, stored_fact
from checks.fixture import trips, zones
from checks.registry import QUERIES
from tripforge.operators.fact import fact_table, fact_table_broadcast
from tripforge.operators.quality import clean
from tripforge.operators.reports import (
    analytics_report,
    between_dates,
    overview_report,
    partition_row_counts,
)
from tripforge.operators.revenue import monthly_revenue
from tripforge.plans.batch import build_dims
from tripforge.sinks.files import by_date, write_by_date
from tripforge.sources.files import read_parquet
from tripforge.sources.statistics import analyze_partitions, catalogued_row_counts
from tripforge.staging import BROADCAST_MAX_BYTES, broadcast_if_small, byte_size, stage, staging_path

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    return stage(trips(spark, SF_DIR), "trips")


def test_rules_reach_the_scan(stored):
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan(clean(stored)), re.S).group(1)
    for part in ("IsNotNull(congestion_surcharge)", "GreaterThan(passenger_count,0)",
                 "In(VendorID, [1,2])", "LessThanOrEqual(RatecodeID,6)"):
        assert part in pushed


def test_copies_are_combined_before_the_shuffle(stored):
    text = plan(clean(stored))
    exchange = text.index("Exchange hashpartitioning")
    assert "HashAggregate" in text[:exchange] and "HashAggregate" in text[exchange:]
    assert text.count("Exchange") == 1


def test_revenue_reads_only_its_columns(stored):
    text = plan(monthly_revenue(stored))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert "DOLocationID" not in schema and "dropoff_datetime" not in schema
    assert text.count("Exchange") == 1


def test_date_filter_prunes_partitions(spark, stored):
    path = staging_path(spark, "dated")
    some = stored.filter(F.col("pickup_datetime") < "1995-03-01")
    write_by_date(some, path, "pickup_datetime")
    dated = read_parquet(spark, path)
    text = plan(between_dates(dated, "1995-01-10", "1995-01-20"))
    assert re.search(r"PartitionFilters: \[isnotnull\(pickup_date", text)
    counts = plan(partition_row_counts(dated, "t"))
    assert "ReadSchema: struct<>" in counts


def test_catalogued_counts_read_no_file(spark):
    rows = spark.range(100).select(F.expr("date_add(date'2021-01-01', int(id % 4))").alias("pickup_date"), "id")
    rows.write.partitionBy("pickup_date").saveAsTable("counted_by_date")
    assert {r["total_rows"] for r in catalogued_row_counts(spark, "counted_by_date").collect()} == {None}
    analyze_partitions(spark, "counted_by_date")
    counts = catalogued_row_counts(spark, "counted_by_date")
    assert "FileScan" not in plan(counts) and "LocalTableScan" in plan(counts) or "ExistingRDD" in plan(counts)
    assert [(str(r["partition_id"]), r["total_rows"]) for r in counts.collect()] == [(f"2021-01-0{d}", 25) for d in range(1, 5)]
    spark.sql("DROP TABLE counted_by_date")


def test_hot_date_is_split_over_tasks(spark, settings):
    settings(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="16KB",
    )
    rows = spark.range(0, 200_000, 1, 8).select(
        F.expr("if(id % 3 = 0, timestamp '2021-01-01', timestamp '2021-01-02' + "
               "make_dt_interval(id % 50))").alias("ts"),
        F.xxhash64("id").alias("v"),
    )
    path = staging_path(spark, "hot")
    write_by_date(rows, path, "ts")
    back = read_parquet(spark, path)
    files = back.filter("pickup_date = '2021-01-01'").select(F.input_file_name()).distinct().count()
    assert files > 1
    assert back.count() == 200_000


def test_clustering_sorts_without_another_shuffle(stored):
    text = plan(by_date(stored, "pickup_datetime", cluster_by=("VendorID",)))
    assert text.count("Exchange") == 1
    assert "REBALANCE_PARTITIONS_BY_COL" in text


@pytest.mark.parametrize("assemble", [fact_table, fact_table_broadcast])
def test_hot_trip_key_is_split_in_the_fact_join(spark, settings, assemble):
    settings(
        spark__sql__shuffle__partitions="32",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    third = "fare_amount * 100 % 3 < 1"
    hot = trips(spark, "/root/testdata/sf0.01").withColumns(
        {
            "pickup_datetime": F.expr(
                f"if({third}, timestamp_ntz '1999-01-01 10:00:00', pickup_datetime)"
            ),
            "dropoff_datetime": F.expr(
                f"if({third}, timestamp_ntz '1999-01-01 10:30:00', dropoff_datetime)"
            ),
            "trip_distance": F.expr(f"if({third}, 2.5D, trip_distance)"),
        }
    )
    stored_hot = stage(hot.repartition(16), "hot")
    fact = assemble(stored_hot, build_dims(stored_hot))
    rows = fact.collect()
    assert "skew=true" in plan(fact)
    assert len(rows) == stored_hot.count()
    assert all(r["trip_distance_id"] and r["datetime_id"] for r in rows)


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    stored_trips = stage(cleaned(spark, SF_DIR), "cleaned")
    text = plan(fact_table_broadcast(stored_trips, build_dims(stored_trips)))
    assert len(re.findall(r"BroadcastHashJoin .*LeftOuter", text)) >= 4
    assert len(re.findall(r"SortMergeJoin .*LeftOuter", text)) == 2


def test_reports_shuffle_the_fact_only_for_large_dimensions(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    settings(spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    fact, dims = stored_fact(spark, SF_DIR)
    report = overview_report(fact, dims, zones(spark, SF_DIR))
    report.collect()
    text = plan(report).split("== Initial Plan ==")[0]
    shuffled = re.findall(r"[ +]Exchange hashpartitioning\((\w+)#", text)
    # The fact once and the moments once; all rows agree with their trip's times, so that is all.
    assert shuffled.count("trip_distance_id") == 2
    assert "Union" not in text


def test_rows_that_disagree_take_their_times_without_another_shuffle_of_the_fact(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    settings(spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    fact, dims = stored_fact(spark, SF_DIR)
    top = dims["dim_datetime"].count()
    moved = F.when(F.col("fare_amount") > 20, top + 1 - F.col("datetime_id")).otherwise(F.col("datetime_id"))
    odd = stage(fact.withColumn("datetime_id", moved), "odd-fact")
    report = overview_report(odd, dims, zones(spark, SF_DIR))
    report.collect()
    text = plan(report).split("== Initial Plan ==")[0]
    assert re.findall(r"[ +]Exchange hashpartitioning\((\w+)#", text).count("trip_distance_id") == 2
    assert "Union" not in text and "apart_id" in text


def test_trips_are_shuffled_once_for_both_large_dimensions(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    stored_trips = stage(cleaned(spark, SF_DIR), "cleaned")
    text = plan(fact_table_broadcast(stored_trips, build_dims(stored_trips)))
    assert len(re.findall(r"Exchange hashpartitioning\(pickup_datetime", text)) == 3


def test_hot_moment_is_split_in_the_reports(spark, settings):
    settings(
        spark__sql__shuffle__partitions="32",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    moments = spark.range(1, 20_001).withColumnRenamed("id", "datetime_id").withColumns(
        {"pickup_datetime": F.expr("timestamp '2021-01-01' + make_dt_interval(0, 0, datetime_id)"),
         "pickup_month": F.lit(1)}
    ).withColumn("dropoff_datetime", F.col("pickup_datetime"))
    distances = moments.select(
        F.col("datetime_id").alias("trip_distance_id"), "pickup_datetime", "dropoff_datetime"
    ).withColumns({"trip_distance": F.lit(1.0), "trip_duration": F.lit(2.0)})
    dims = {
        "dim_datetime": stage(moments, "moments"),
        "dim_trip": stage(distances, "distances"),
        "dim_location": spark.range(1, 2).selectExpr(
            "id AS location_id", "1 AS PULocationID", "1 AS DOLocationID"
        ),
    }
    fact = stage(
        spark.range(0, 60_000, 1, 16).selectExpr(
            "if(id % 3 = 0, 5, id % 20000 + 1) AS datetime_id",
            "if(id % 3 = 0, 5, id % 20000 + 1) AS trip_distance_id",
            "1L AS location_id", "double(xxhash64(id) % 1000) AS fare_amount",
            "1D AS tip_amount", "0D AS tolls_amount", "'green' AS service_type",
        ),
        "fact",
    )
    zone = spark.createDataFrame([(1, "A", "X")], "LocationID int, Zone string, Borough string")
    report = analytics_report(fact, dims, zone)
    assert len(report.collect()) == 60_000
    assert "skew=true" in plan(report)


def test_broadcast_depends_on_measured_size(spark):
    small = spark.createDataFrame([(1, "ab")], "k int, t string")
    assert byte_size(small) == 34
    assert "Broadcast" in plan(spark.range(5).join(broadcast_if_small(small), F.col("k") == F.col("id")))
    assert broadcast_if_small(small, max_bytes=33) is small
    assert BROADCAST_MAX_BYTES <= 64 * 1024 * 1024


@pytest.mark.parametrize("name", QUERIES_WITHOUT_PYTHON)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text
