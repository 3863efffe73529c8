"""The star in buckets: no exchange of large tables, hot keys apart, growing dimensions."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from checks.batch import bucketed_star, cleaned
from checks.fixture import trips, zones
from tripforge.operators.dims import KEYS
from tripforge.operators.fact import fact_table_broadcast
from tripforge.operators.keys import extend_surrogate_key, with_surrogate_key
from tripforge.operators.reports import analytics_report, overview_report
from tripforge.plans import bucketed
from tripforge.plans.batch import CODE_DIMS, DIMENSIONS, FACT, build_dims, code_combinations, run_dims, run_grow_dims
from tripforge.session import shuffle_partitions
from tripforge.sources.buckets import BucketStore, hot_keys
from tripforge.sources.tables import TableStore
from tripforge.staging import stage, staging_path

SF_DIR = "/root/testdata/sf0.001"
LARGE = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    store, dims = bucketed_star(spark, SF_DIR, buckets=4)
    yield store, dims
    store.forget(bucketed.TRIPS, bucketed.MOMENTS, FACT, *bucketed.LARGE_DIMS)


def test_fact_is_assembled_without_an_exchange(star, settings):
    settings(**LARGE)
    store, dims = star
    large = {name: store.read(name) for name in bucketed.LARGE_DIMS}
    text = plan(fact_table_broadcast(store.read(bucketed.TRIPS), {**dims, **large}))
    assert "Exchange hashpartitioning" not in text
    assert len(re.findall("SortMergeJoin", text)) == 2
    assert text.count("SelectedBucketsCount: 4 out of 4") == 3


@pytest.mark.parametrize("report", [overview_report, analytics_report])
def test_reports_exchange_neither_fact_nor_moments(star, settings, spark, report):
    settings(**LARGE)
    store, dims = star
    text = plan(report(store.read(FACT), dims, zones(spark, SF_DIR), store.read(bucketed.MOMENTS)))
    assert "Exchange hashpartitioning" not in text
    assert text.count("SelectedBucketsCount: 4 out of 4") == 2
    # Without the stored moments both would be.
    plain = plan(report(store.read(FACT), dims, zones(spark, SF_DIR)))
    assert "Exchange hashpartitioning(trip_distance_id" in plain


def hot_trips(spark):
    third = "fare_amount * 100 % 3 < 1"
    fixes = {
        "pickup_datetime": "timestamp_ntz '1999-01-01 10:00:00'",
        "dropoff_datetime": "timestamp_ntz '1999-01-01 10:30:00'",
        "trip_distance": "2.5D",
    }
    changed = {c: F.expr(f"if({third}, {v}, {c})") for c, v in fixes.items()}
    return stage(cleaned(spark, "/root/testdata/sf0.01").withColumns(changed), "hot-trips")


def test_hot_keys_lie_beside_the_buckets(spark, settings):
    settings(**LARGE)
    hot = hot_trips(spark)
    store = BucketStore(spark, staging_path(spark, "hot"), "hot_star_", 8)
    dims = bucketed.store_trips(hot, store, hot_rows=100)
    bucketed.store_fact(store, dims, hot_rows=100)
    total = hot.count()
    apart, rest = store.read_hot(FACT), store.read(FACT)
    assert total / 4 < apart.count() and apart.count() + rest.count() == total
    sizes = [r["count"] for r in rest.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) <= 8 and max(sizes) < 2 * total / 8
    # Nothing of a hot key is in a bucket, and all tables split at the same keys.
    assert store.read(bucketed.MOMENTS).join(apart.select("trip_distance_id").distinct(), "trip_distance_id").count() == 0
    assert store.read_hot(bucketed.MOMENTS).count() == apart.select("trip_distance_id").distinct().count()
    zone = zones(spark, SF_DIR)
    fact = rest.union(apart)
    for plain, stored in ((overview_report, bucketed.bucketed_overview), (analytics_report, bucketed.bucketed_analytics)):
        one, two = plain(fact, dims, zone), stored(store, dims, zone)
        assert one.count() == two.count() > 0
        assert one.exceptAll(two).count() == 0
    store.forget(bucketed.TRIPS, bucketed.MOMENTS, FACT, *bucketed.LARGE_DIMS)


def test_hot_keys_are_fewer_than_buckets(spark):
    rows = spark.range(10_000).select(F.expr("if(id % 3 = 0, null, id % 50)").alias("k"))
    found = hot_keys(rows, ["k"], 5, hot_rows=10)
    assert [r["k"] for r in found.collect()] == [None]
    assert hot_keys(rows.limit(0), ["k"], 5).count() == 0
    store = BucketStore(spark, staging_path(spark, "nulls"), "null_keys_", 5)
    store.write(rows, "t", ["k"], found)
    assert store.read_hot("t").count() + store.read("t").count() == 10_000
    assert store.read("t").where("k IS NULL").count() == 0
    store.forget("t")


def test_small_dimensions_are_cut_from_one_scan(spark):
    stored = stage(trips(spark, SF_DIR), "one-scan")
    codes = code_combinations(stored)
    assert set(codes.columns) == {k for n in CODE_DIMS for k in KEYS[n][0]}
    for name in CODE_DIMS:
        own, through = DIMENSIONS[name](stored), DIMENSIONS[name](codes)
        assert own.exceptAll(through).count() == through.exceptAll(own).count() == 0
    path = stored.inputFiles()[0].rsplit("/", 1)[0]
    assert path not in plan(DIMENSIONS["dim_rate"](codes))


def test_new_keys_go_on_after_the_stored_ones(spark):
    first = spark.createDataFrame([("b",), ("d",), (None,)], "k string")
    stored = with_surrogate_key(first, ["k"], "id")
    more = spark.createDataFrame([("a",), ("d",), (None,), ("c",), ("a",)], "k string")
    new = extend_surrogate_key(stored, more, ["k"], "id")
    assert sorted((r["id"], r["k"]) for r in new.collect()) == [(4, "a"), (5, "c")]
    assert extend_surrogate_key(stored, first, ["k"], "id").count() == 0
    assert extend_surrogate_key(stored.limit(0), first, ["k"], "id").count() == 3


def test_grown_dimensions_keep_their_ids(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    every = stage(cleaned(spark, SF_DIR), "every")
    store.write(every.where("VendorID = 2"), "trips_data_cleaned")
    run_dims(store, store)
    before = {name: {tuple(r) for r in store.read(name).collect()} for name in DIMENSIONS}
    added = run_grow_dims(every, store)
    assert added == {n: store.read(n).count() - len(before[n]) for n in DIMENSIONS} and added["dim_trip"] > 0
    whole = build_dims(every)
    for name, (keys, id_col) in KEYS.items():
        rows = store.read(name)
        assert before[name] <= {tuple(r) for r in rows.collect()}
        assert rows.select(*keys).exceptAll(whole[name].select(*keys)).count() == 0
        assert sorted(r[0] for r in rows.select(id_col).collect()) == list(range(1, whole[name].count() + 1))
    assert run_grow_dims(every, store) == dict.fromkeys(DIMENSIONS, 0)


def test_shuffles_start_with_partitions_for_cores_and_input(spark):
    cores = spark.sparkContext.defaultParallelism
    assert shuffle_partitions(spark) >= 4 * cores
    assert shuffle_partitions(spark, 100 << 40) == (100 << 40) // (128 << 20)
