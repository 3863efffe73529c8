from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tripforge.operators.messages import (
    parse_delimited,
    parse_json,
    to_json_messages,
    to_json_rides,
)
from tripforge.sources.files import read_parquet
from tripforge.sources.topics import read_message_files, read_topic, topic_options
from tripforge.streaming.batch_log import spread_by_share
from tripforge.streaming.counts import count_by, windowed_count
from tripforge.streaming.jobs import (
    PICKUP,
    counts_log,
    rides_from,
    rides_log,
    start_count_query,
    start_landing_queries,
    start_ride_queries,
    supervise,
    windowed_vendor_counts,
)
from tripforge.streaming.progress import ProgressTable
from tripforge.streaming.sinks import (
    console_sink,
    fan_out_sink,
    file_sink,
    gather,
    memory_sink,
    new_checkpoint,
    snapshot_path,
    snapshot_sink,
    topic_sink,
)


def message(vendor=1, pickup="2020-07-01 10:00:00", zone=5):
    return ("5", f"{vendor}, {pickup}, 2020-07-01 11:00:00, 1, 1.0, 1, N, {zone}, 7, 1, 8, 0, 0, 0, 0, 0, 8, 0")


def add_file(spark, path, *rows):
    df = spark.createDataFrame(list(rows), "key string, value string")
    df.coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def run(query):
    query.awaitTermination()
    return query


def test_stream_counts_equal_batch_counts(spark, folder):
    add_file(spark, folder("in"), message(1), message(2), message(2), ("5", "junk"))
    stream = count_by(rides_from(read_message_files(spark, folder("in"))), ["vendor_id"])
    run(snapshot_sink(stream, folder("out"), folder("ck"), trigger=None))
    batch = count_by(parse_delimited(read_parquet(spark, folder("in"))), ["vendor_id"])
    streamed = read_parquet(spark, snapshot_path(folder("out"), 0))
    assert sorted(streamed.collect(), key=str) == sorted(batch.collect(), key=str)


def test_rejected_messages_are_counted(spark, folder):
    add_file(spark, folder("in"), message(), ("5", "junk"), ("5", "1, never"))
    query = run(
        file_sink(
            rides_from(read_message_files(spark, folder("in"))), folder("out"), folder("ck"), trigger=None
        )
    )
    seen = [p["observedMetrics"]["rides"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(m["rows"] for m in seen) == 3
    assert sum(m["rejected"] for m in seen) == 2


def test_restart_continues_without_counting_twice(spark, folder):
    def go():
        stream = count_by(parse_delimited(read_message_files(spark, folder("in"))), ["vendor_id"])
        query = run(snapshot_sink(stream, folder("out"), folder("ck"), trigger=None))
        return query.lastProgress["batchId"] if query.lastProgress else None

    add_file(spark, folder("in"), message(1), message(1))
    go()
    add_file(spark, folder("in"), message(1))
    last = go()
    assert read_parquet(spark, snapshot_path(folder("out"), last)).first()["count"] == 3


def test_restarted_landing_adds_only_new_rides(spark, folder):
    def go():
        rides = parse_delimited(read_message_files(spark, folder("in")))
        run(file_sink(rides, folder("out"), folder("ck"), trigger=None))

    add_file(spark, folder("in"), message(zone=5), message(zone=6))
    go()
    go()
    add_file(spark, folder("in"), message(zone=7))
    go()
    zones = read_parquet(spark, folder("out")).select("PULocationID").collect()
    assert sorted(r[0] for r in zones) == [5, 6, 7]


LATE = "2020-07-01 07:00:00"


def late_counts(spark, folder, watermark):
    """Counts with a ride three hours behind, arriving in a later batch."""
    def go(batches):
        rides = parse_delimited(read_message_files(spark, folder("in")))
        counts = windowed_vendor_counts(rides, watermark)
        seen = []
        query = (
            counts.writeStream.outputMode("update")
            .option("checkpointLocation", folder("ck"))
            .trigger(availableNow=True)
            .foreachBatch(lambda df, _: seen.extend(r["window"]["start"].hour for r in df.collect()))
            .start()
        )
        run(query)
        batches.append(seen)

    batches = []
    add_file(spark, folder("in"), message(pickup="2020-07-01 10:00:00"))
    go(batches)
    add_file(spark, folder("in"), message(pickup=LATE))
    go(batches)
    return batches


def test_late_ride_counts_without_watermark(spark, folder):
    assert 7 in late_counts(spark, folder, None)[1]


def test_late_ride_is_dropped_behind_the_watermark(spark, folder):
    assert 7 not in late_counts(spark, folder, "1 hour")[1]


def test_gathered_hot_zone_fills_its_tasks_evenly(spark, settings):
    settings(
        spark__sql__shuffle__partitions="32",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    rows = spark.range(0, 12_000, 1, 4).select(F.expr("if(id % 3 = 0, 7, id % 200)").alias("zone"))
    hot = gather(rows, "zone", 4).filter("zone = 7").groupBy(F.spark_partition_id()).count()
    sizes = [r["count"] for r in hot.collect()]
    assert 1 < len(sizes) <= 4 and max(sizes) < sum(sizes)


def test_two_landing_queries_with_their_own_checkpoints(spark, folder):
    add_file(spark, folder("in"), message(zone=5), message(zone=6))
    queries = start_landing_queries(
        read_message_files(spark, folder("in")),
        folder("files"),
        "landed_rides_test",
        (folder("ck1"), folder("ck2")),
        trigger=None,
    )
    for query in queries:
        run(query)
    assert rides_log(spark, folder("files")).read().count() == 2
    assert spark.table("landed_rides_test").count() == 2
    spark.sql("DROP TABLE landed_rides_test")


def test_supervision_returns_when_a_query_ends(spark, folder):
    add_file(spark, folder("in"), message())
    rides = parse_delimited(read_message_files(spark, folder("in")))
    supervise(spark, lambda: [file_sink(rides, folder("out"), folder("ck"), trigger=None)])
    assert read_parquet(spark, folder("out")).count() == 1


def test_fan_out_writes_each_path(spark, folder):
    add_file(spark, folder("in"), message(), message())
    rides = parse_delimited(read_message_files(spark, folder("in")))
    run(fan_out_sink(rides, [folder("a"), folder("b")], folder("ck"), trigger=None))
    assert read_parquet(spark, folder("a")).count() == read_parquet(spark, folder("b")).count() == 2


def test_memory_answer_sees_the_first_batch(spark, folder):
    add_file(spark, folder("in"), message(), message(zone=9))
    rides = parse_delimited(read_message_files(spark, folder("in")))
    answer, query = memory_sink(rides, "memory_rides", "SELECT count(*) AS n FROM {table_name}")
    query.stop()
    assert answer.first()["n"] == 2


def test_json_rides_are_counted(spark, folder):
    rides = parse_delimited(spark.createDataFrame([message(), message(vendor=2), message()], "key string, value string"))
    to_json_messages(to_json_rides(rides), "pu_location_id").write.parquet(folder("in"))
    counts = count_by(rides_from(read_message_files(spark, folder("in")), parse_json), ["vendor_id"])
    run(snapshot_sink(counts, folder("out"), folder("ck"), trigger=None))
    got = {(r["vendor_id"], r["count"]) for r in read_parquet(spark, snapshot_path(folder("out"), 0)).collect()}
    assert got == {("1", 2), ("2", 1)}


def test_console_sink_runs(spark, folder):
    add_file(spark, folder("in"), message())
    counts = count_by(parse_delimited(read_message_files(spark, folder("in"))), ["vendor_id"])
    query = console_sink(counts, folder("ck"), trigger=None)
    run(query)
    assert query.exception() is None
    assert os.path.exists(folder("ck"))


def test_console_takes_only_the_rows_it_prints(spark, folder, capsys):
    add_file(spark, folder("in"), *[message(zone=zone) for zone in range(1, 60)])
    rides = parse_delimited(read_message_files(spark, folder("in")))
    run(console_sink(rides, folder("ck"), "append", trigger=None, rows=3))
    assert "only showing top 3 rows" in capsys.readouterr().out


def test_processing_time_trigger_runs_batch_after_batch(spark, folder):
    add_file(spark, folder("in"), message())
    rides = parse_delimited(read_message_files(spark, folder("in")))
    query = file_sink(rides, folder("out"), folder("ck"), trigger="100 milliseconds")
    query.processAllAvailable()
    add_file(spark, folder("in"), message(), message())
    query.processAllAvailable()
    query.stop()
    assert read_parquet(spark, folder("out")).count() == 3
    assert query.lastProgress is not None


def test_file_count_does_not_change_what_a_watermark_drops(spark, folder):
    """Without a limit of files, all of the input is one batch however it is cut."""
    for hour in range(12):
        add_file(spark, folder("in"), message(pickup=f"2021-01-05 {hour:02d}:00:00"))
    counts = []
    for name, limit in (("one", None), ("many", 1)):
        rides = rides_from(read_message_files(spark, folder("in"), limit))
        windows = windowed_count(rides, PICKUP, ["vendor_id"], "10 minutes", "10 minutes", "1 hour")
        run(file_sink(windows.drop("window"), folder(name), folder(f"ck-{name}"), None, trigger=None))
        counts.append(read_parquet(spark, folder(name)).count())
    # Files in the order of event time: batches of one file drop nothing either.
    assert counts[0] == counts[1] > 0


def test_hot_zone_is_spread_and_files_stay_few(spark, folder):
    rows = spark.range(0, 20_000, 1, 8).select(F.expr("if(id % 3 = 0, 7, id % 40)").alias("PULocationID"), "id")
    log = rides_log(spark, folder("log"))
    log.write_batch(rows, 0)
    found = log.read()
    assert found.count() == 20_000
    places = found.select("PULocationID", F.input_file_name().alias("file")).distinct()
    files = {r["PULocationID"]: r["count"] for r in places.groupBy("PULocationID").count().collect()}
    tasks = spark.sparkContext.defaultParallelism
    assert sum(files.values()) <= tasks + len(files)
    assert files.pop(7) > 1 and set(files.values()) == {1}


def test_shares_of_identical_rows_are_even(spark, settings):
    rows = spark.range(0, 9000, 1, 4).select(F.lit(5).alias("zone"))
    dealt = spread_by_share(rows, "zone", 6)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert dealt.columns == ["zone"] and sum(sizes) == 9000 and len(sizes) > 2
    nulls = spread_by_share(rows.select(F.lit(None).cast("int").alias("zone")), "zone", 6)
    assert nulls.count() == 9000
    assert spread_by_share(rows.limit(0), "zone", 6).count() == 0


def test_a_batch_that_runs_again_replaces_itself(spark, folder):
    log = rides_log(spark, folder("log"))
    rows = parse_delimited(spark.createDataFrame([message(zone=5), message(zone=6)], "key string, value string"))
    log.write_batch(rows, 0)
    log.write_batch(rows, 0)
    log.write_batch(rows.limit(0), 1)
    log.write_batch(rows.where("PULocationID = 6"), 2)
    assert sorted(r["PULocationID"] for r in log.read().collect()) == [5, 6, 6]
    log.compact(1)
    log.compact(1)
    assert sorted(r["PULocationID"] for r in log.read().collect()) == [5, 6, 6]
    log.compact(2)
    log.write_batch(rows, 3)
    assert sorted(r["PULocationID"] for r in log.read().collect()) == [5, 5, 6, 6, 6]
    with pytest.raises(ValueError, match="no batch"):
        rides_log(spark, folder("empty")).read()


def test_compaction_packs_small_files(spark, folder):
    log = rides_log(spark, folder("log"))
    rows = spark.range(0, 400, 1, 4).select((F.col("id") % 4).cast("int").alias("PULocationID"), "id")
    for batch in range(4):
        log.write_batch(rows, batch)

    def files():
        return log.read().select(F.input_file_name()).distinct().count()

    before = files()
    log.compact(3)
    assert files() == 4 < before and log.read().count() == 1600


def test_updates_write_what_changed_only(spark, folder):
    def go():
        query = start_count_query(read_message_files(spark, folder("in")), folder("out"), folder("ck"), trigger=None)
        return run(query).lastProgress["batchId"]

    hours = [f"2020-07-01 {h:02d}:00:00" for h in range(20)]
    add_file(spark, folder("in"), *[message(pickup=p) for p in hours])
    first = go()
    add_file(spark, folder("in"), message(pickup=hours[3]), message(pickup=hours[3], vendor=2))
    second = go()
    sizes = [read_parquet(spark, f"{folder('out')}/batches/batch_id={b}").count() for b in (first, second)]
    assert sizes == [40, 4]
    log = counts_log(spark, folder("out"))
    expected = windowed_vendor_counts(parse_delimited(read_parquet(spark, folder("in"))))
    for _ in range(2):
        got = log.read().select(*expected.columns)
        assert got.exceptAll(expected).count() == expected.exceptAll(got).count() == 0
        log.compact(second)
    add_file(spark, folder("in"), message(pickup=hours[3]))
    go()
    expected = windowed_vendor_counts(parse_delimited(read_parquet(spark, folder("in"))))
    assert expected.exceptAll(log.read().select(*expected.columns)).count() == 0


def test_progress_is_a_table(spark, folder):
    with ProgressTable(spark, folder("progress")) as progress:
        for junk in (1, 2):
            add_file(spark, folder("in"), message(), *[("5", "junk")] * junk)
            rides = rides_from(read_message_files(spark, folder("in")))
            progress.finish(file_sink(rides, folder("out"), folder("ck"), None, trigger=None))
    rows = {(r["batch_id"], r["metric"]): r["value"] for r in progress.read().where("observed = 'rides'").collect()}
    totals = {m: sum(v for (_, n), v in rows.items() if n == m) for m in ("rows", "rejected")}
    assert totals == {"rows": 5, "rejected": 3}
    assert len({b for b, _ in rows}) >= 2


def test_failed_queries_are_started_again(spark, folder):
    add_file(spark, folder("in"), message())
    tries = []

    def start():
        def write(batch, batch_id):
            tries.append(batch_id)
            if len(tries) < 3:
                raise ValueError("not yet")

        rides = parse_delimited(read_message_files(spark, folder("in")))
        out = rides.writeStream.trigger(availableNow=True).option("checkpointLocation", folder("ck"))
        return [out.foreachBatch(write).start()]

    assert supervise(spark, start, restarts=5, pause=0.01) == 2
    tries.clear()
    add_file(spark, folder("in"), message())
    with pytest.raises(Exception, match="not yet"):
        supervise(spark, start, restarts=1, pause=0.01)
    assert len(tries) == 2


def test_json_rides_are_landed(spark, folder):
    rides = parse_delimited(spark.createDataFrame([message(zone=4), message(zone=9)], "key string, value string"))
    to_json_messages(to_json_rides(rides), "pu_location_id").write.parquet(folder("in"))
    queries = start_landing_queries(
        read_message_files(spark, folder("in")), folder("files"), "landed_json_test",
        (folder("ck1"), folder("ck2")), trigger=None, parse=parse_json)
    for query in queries:
        run(query)
    assert sorted(r["PULocationID"] for r in rides_log(spark, folder("files")).read().collect()) == [4, 9]
    assert spark.table("landed_json_test").count() == 2
    spark.sql("DROP TABLE landed_json_test")


def test_memory_sink_has_a_checkpoint_in_the_shared_folder(spark, folder):
    add_file(spark, folder("in"), message())
    counts = count_by(parse_delimited(read_message_files(spark, folder("in"))), ["vendor_id"])
    _, query = memory_sink(counts, "kept_counts", "SELECT * FROM {table_name}", "complete", folder("ck"))
    query.stop()
    add_file(spark, folder("in"), message())
    answer, query = memory_sink(counts, "kept_counts", "SELECT * FROM {table_name}", "complete", folder("ck"))
    query.stop()
    assert [tuple(r) for r in answer.collect()] == [(1, 2)]


def test_topic_options():
    assert topic_options("a:1,b:2", "rides", "earliest") == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "rides",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def test_topics_need_their_connector(spark, folder):
    """The connector is not on the test classpath; the request must get as far as asking for it."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_topic(spark, "localhost:1", "rides")
    add_file(spark, folder("in"), message())
    messages = read_message_files(spark, folder("in"))
    with pytest.raises(Exception, match="(?i)kafka"):
        topic_sink(messages, "localhost:1", "out", folder("ck"), "append").awaitTermination()
    with pytest.raises(Exception, match="(?i)kafka"):
        start_ride_queries(messages, "localhost:1", "out", trigger=None)
    for query in spark.streams.active:
        query.stop()


def test_checkpoints_are_named_in_the_shared_folder(spark):
    path = new_checkpoint(spark.range(1), "counts")
    assert path == spark.conf.get("spark.checkpoint.dir") + "/streams/counts"


def test_events_source_window_matches_batch(spark, folder):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source.write.parquet(folder("events"))
    stream = spark.readStream.schema(source.schema).parquet(folder("events"))
    counts = stream.groupBy(F.window("ts", "1 day"), "event_type").count()
    run(snapshot_sink(counts, folder("out"), folder("ck"), trigger=None))
    expected = source.groupBy(F.window("ts", "1 day"), "event_type").count()
    got = read_parquet(spark, snapshot_path(folder("out"), 0))
    assert got.exceptAll(expected).count() == expected.exceptAll(got).count() == 0


def test_a_large_batch_is_dealt_to_more_tasks(spark, monkeypatch):
    monkeypatch.setattr("tripforge.streaming.batch_log.ROWS_PER_TASK", 1000)
    rows = spark.range(0, 9500, 1, 4).select(F.expr("if(id < 5000, 1, id % 40)").alias("zone"), "id")
    dealt = spread_by_share(rows, "zone", 2)
    assert dealt.rdd.getNumPartitions() == 10 and dealt.distinct().count() == 9500
