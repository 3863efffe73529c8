from __future__ import annotations

import glob
import gzip
import os
import re
from threading import Barrier

import pyarrow.parquet as pq
import pytest

from checks.fixture import raw_services
from tripforge import schemas
from tripforge.cli import main, parser
from tripforge.plans import ingest
from tripforge.plans.batch import DIMENSIONS, run_clean
from tripforge.plans.ingest import append_months, csv_to_parquet, land_file, land_months, month_paths
from tripforge.sinks.files import publish, replace_table, write_parquet, write_single_file
from tripforge.sources.files import (
    external_view,
    months_glob,
    read_csv,
    read_months,
    read_parquet,
    read_text_csv,
)
from tripforge.sources.tables import TableStore
from tripforge.staging import shared_folder

SF_DIR = "/root/testdata/sf0.001"
HEADER = ",".join(schemas.YELLOW_SCHEMA.names)
LINE = "2,2020-03-09 07:05:00,2020-03-09 07:21:30,3,4.25,1,N,41,166,1,16.5,0,0.5,3.46,0,0.3,23.26,2.5"


@pytest.fixture
def write_csv(tmp_path):
    def write(name: str, *lines: str) -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        with gzip.open(path, "wt") as out:
            out.write("\n".join([HEADER, *lines]) + "\n")
        return str(path)

    return write


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def test_bad_csv_field_is_null(spark, write_csv):
    path = write_csv("a.csv.gz", LINE, LINE.replace(",41,", ",??,"))
    rows = read_csv(spark, path, schemas.YELLOW_SCHEMA).collect()
    assert [r["PULocationID"] for r in rows] == [41, None]
    assert rows[0]["trip_distance"] == 4.25


def test_months_glob():
    assert months_glob("b/", [2020, 2021], [1, 2]) == "b/{2020,2021}/{01,02}"
    assert months_glob("b", [2020], [11], ("y=", "m=")) == "b/y={2020}/m={11}"


def test_missing_month_is_skipped_and_later_ones_read(spark, write_csv, tmp_path):
    for month, lines in {"01": 1, "03": 2}.items():
        write_csv(f"raw/2020/{month}/part.csv.gz", *[LINE] * lines)
    base = str(tmp_path / "raw")
    counts = read_months(spark, base, schemas.YELLOW_SCHEMA, [2020, 2021]).groupBy(
        "file_year", "file_month"
    ).count()
    assert sorted(tuple(r) for r in counts.collect()) == [(2020, 1, 1), (2020, 3, 2)]
    csv_to_parquet(spark, schemas.YELLOW, base, str(tmp_path / "pq"), [2020])
    assert read_parquet(spark, str(tmp_path / "pq")).filter("file_month = 3").count() == 2
    with pytest.raises(Exception, match="(?i)exist"):
        csv_to_parquet(spark, schemas.YELLOW, base, str(tmp_path / "pq"), [2020])


def test_fixed_file_count_and_single_file(spark, tmp_path):
    df = spark.range(1000)
    write_parquet(df, str(tmp_path / "four"), files=4)
    assert len(glob.glob(str(tmp_path / "four/*.parquet"))) == 4
    write_parquet(df, str(tmp_path / "zipped"), compression="gzip")
    assert glob.glob(str(tmp_path / "zipped/*.gz.parquet"))
    for _ in range(2):
        write_single_file(df, str(tmp_path / "one"))
    assert len(glob.glob(str(tmp_path / "one/*.parquet"))) == 1
    with pytest.raises(Exception, match="(?i)exist"):
        write_parquet(df, str(tmp_path / "four"))


def test_append_counts_rows_and_adds_up(spark, store, tmp_path):
    paths = month_paths(str(tmp_path), "yellow", 2021, [1, 2], "parquet")
    assert paths[1].endswith("/yellow/yellow_tripdata_2021-02.parquet")
    for path, n in zip(paths, (10, 15)):
        spark.range(n).write.parquet(path)
    assert append_months(spark, paths, store, "rides") == 25
    assert append_months(spark, paths[:1], store, "rides") == 10
    assert store.read("rides").count() == 35


def test_table_addresses(spark):
    assert TableStore(spark, "/data/", "parquet").address("t") == "/data/t"
    assert TableStore(spark, "db", "catalog").address("t") == "db.t"
    assert TableStore(spark, "project.set", "warehouse").address("t") == "project.set.t"


def test_catalog_store(spark):
    store = TableStore(spark, "default", "catalog")
    store.write(spark.range(3), "catalog_numbers", "overwrite")
    assert store.read("catalog_numbers").count() == 3
    spark.sql("DROP TABLE catalog_numbers")


def test_connector_store_asks_for_its_connector(spark):
    with pytest.raises(Exception, match="nosuchconnector"):
        TableStore(spark, "project.set", "nosuchconnector").read("t")


def test_replace_table_replaces(spark):
    replace_table(spark.range(3), "numbers")
    replace_table(spark.range(5), "numbers")
    assert spark.table("numbers").count() == 5
    spark.sql("DROP TABLE numbers")


def test_external_view_over_globs(spark, tmp_path):
    for year in (2019, 2020, 2021):
        spark.range(year).write.parquet(str(tmp_path / f"t_{year}-01.parquet"))
    external_view(spark, "ext", str(tmp_path / "t_2019-*"), str(tmp_path / "t_2020-*"))
    assert spark.sql("SELECT count(*) FROM ext").first()[0] == 4039


def test_unknown_service_is_an_error(store):
    with pytest.raises(ValueError, match="blue_trips"):
        run_clean(store, "blue_trips")


def test_publish_needs_its_connector(spark):
    messages = spark.createDataFrame([("k", "v")], "key string, value string")
    with pytest.raises(Exception, match="(?i)kafka"):
        publish(messages, "localhost:1", "rides")


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_batch_jobs_from_the_command_line(spark, store, tmp_path, make_trips):
    for service, raw in raw_services(spark, SF_DIR).items():
        store.write(raw, f"{service}_trips_data")
    zones = spark.range(1, 266).selectExpr(
        "int(id) AS LocationID", "concat('zone ', id) AS Zone", "'town' AS Borough"
    )
    store.write(zones, "zones")
    where = ["--dataset", store.location]
    main(["clean", *where, "--input_table", "all_trips_data"])
    main(["dims", *where])
    main(["fact", *where, "--broadcast"])
    trips = store.read("trips_data_cleaned").count()
    assert trips == store.read("fact_table").count() == 1261
    assert store.read("green_trips_data_cleaned").count() == 821
    assert all(store.read(name).count() > 0 for name in DIMENSIONS)
    sides = [f"{store.location}/{s}_trips_data" for s in ("green", "yellow")]
    main(["revenue", "--input_green", sides[0], "--input_yellow", sides[1],
          "--output", str(tmp_path / "revenue")])
    assert len(glob.glob(str(tmp_path / "revenue/*.parquet"))) == 1


def test_reports_job(spark, store, tmp_path, make_trips):
    main_args = ["--dataset", store.location]
    store.write(make_trips({}, {"fare_amount": 5.0}).drop("service_type"), "unused")
    raw = make_trips({}, {"pickup_datetime": "2021-01-04 10:00:00"}).drop("service_type")
    green = raw.withColumnsRenamed(
        {"pickup_datetime": "lpep_pickup_datetime", "dropoff_datetime": "lpep_dropoff_datetime"}
    )
    yellow = raw.limit(0).withColumnsRenamed(
        {"pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime"}
    )
    store.write_all({"green_trips_data": green, "yellow_trips_data": yellow})
    store.write(spark.createDataFrame([(10, "A", "X"), (20, "B", "Y")], schemas.ZONES_SCHEMA), "zones")
    main(["clean", *main_args, "--input_table", "all"])
    main(["dims", *main_args])
    main(["fact", *main_args])
    main(["reports", *main_args, "--output", str(tmp_path / "reports")])
    overview = read_parquet(spark, str(tmp_path / "reports/overview_report"))
    analytics = read_parquet(spark, str(tmp_path / "reports/analytics_report"))
    assert {str(r["pickup_date"]) for r in overview.collect()} == {"2021-01-04", "2021-01-05"}
    assert {r["Route"] for r in analytics.collect()} == {"A-B"}
    assert {r["Day"] for r in analytics.collect()} == {"Monday", "Tuesday"}


def test_header_of_another_order_is_an_error(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    names = schemas.YELLOW_SCHEMA.names
    path.write_text(",".join(reversed(names)) + "\n" + ",".join(reversed(LINE.split(","))) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(path), schemas.YELLOW_SCHEMA).collect()


def test_files_are_matched_by_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("VendorID,PULocationID,DOLocationID\n1,10,20\n")
    (tmp_path / "b.csv").write_text("VendorID,DOLocationID,PULocationID\n2,21,11\n")
    (tmp_path / "c.csv").write_text("VendorID,PULocationID\n3,12\n")
    df = read_text_csv(spark, [str(tmp_path / f"{n}.csv") for n in "abc"])
    rows = sorted((r["VendorID"], r["PULocationID"], r["DOLocationID"]) for r in df.collect())
    assert rows == [("1", "10", "20"), ("2", "11", "21"), ("3", "12", None)]


def test_readme_commands_land_and_load(spark, store, write_csv, tmp_path, capsys):
    for month in (1, 2):
        write_csv(f"raw/yellow/yellow_tripdata_2021-{month:02d}.csv.gz", LINE, LINE)
    raw, landed = str(tmp_path / "raw"), str(tmp_path / "landed")
    readme = open(os.path.join(os.path.dirname(__file__), "..", "README.md")).read()
    places = {"raw": raw, "landed": landed, "/lake/trips": store.location}
    for job in ("land", "load"):
        (line,) = re.findall(rf"^python -m tripforge ({job} .*)$", readme, re.M)
        main([places.get(word, word) for word in line.split()])
    assert "Total rows: 4" in capsys.readouterr().out
    row = store.read("yellow_trips_data").first()
    assert row["store_and_fwd_flag"] is False
    assert (row["fare_amount"], row["VendorID"], row["trip_distance"]) == (16.5, 2, 4.25)
    run_clean(store, "yellow_trips_data")
    assert store.read("yellow_trips_data_cleaned").count() == 1


def test_zones_are_loaded(spark, store, tmp_path):
    (tmp_path / "zones.csv").write_text("LocationID,Zone,Borough\n10,A,X\n20,B,Y\n")
    main(["zones", "--input", str(tmp_path / "zones.csv"), "--dataset", store.location])
    rows = sorted(tuple(r) for r in store.read("zones").collect())
    assert rows == [(10, "A", "X"), (20, "B", "Y")]


def test_arguments():
    args = parser().parse_args(["load", "--input", "in", "--dataset", "d"])
    assert (args.months, args.year, args.color, args.table_name) == ([1, 2], 2021, "yellow", "rides")
    assert parser().parse_args(["clean", "--dataset", "d"]).input_table == "yellow_trips_data"


def test_files_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tripforge.sinks.files.FILE_BYTES", 1600)
    write_parquet(spark.range(1000), str(tmp_path / "out"), files=4)
    assert len(glob.glob(str(tmp_path / "out/*.parquet"))) == 10
    assert read_parquet(spark, str(tmp_path / "out")).distinct().count() == 1000


def test_place_of_a_month_is_sought_in_its_last_names(spark, write_csv, tmp_path):
    write_csv("1999/12/raw/year=2020/month=03/part.csv.gz", LINE)
    base = str(tmp_path / "1999/12/raw")
    months = read_months(spark, base, schemas.YELLOW_SCHEMA, [2020], prefixes=("year=", "month="))
    assert [tuple(r) for r in months.select("file_year", "file_month").collect()] == [(2020, 3)]
    assert "substring_index" in months._jdf.queryExecution().toString()


def test_raw_files_of_the_checks_are_lightly_packed(spark, tmp_path):
    from checks.tables import _CSV_FILES

    rows = spark.range(0, 5000, 1, 1).selectExpr("id", "hash(id) AS x", "id % 7 AS y")
    rows.write.options(**_CSV_FILES).csv(str(tmp_path / "light"))
    rows.write.options(header=True, compression="gzip").csv(str(tmp_path / "usual"))
    light, usual = (glob.glob(str(tmp_path / f"{n}/*.csv.gz")) for n in ("light", "usual"))
    assert len(light) == len(usual) == 1
    assert gzip.open(light[0]).read() == gzip.open(usual[0]).read()
    assert os.path.getsize(light[0]) > os.path.getsize(usual[0])


def test_even_files_are_landed_without_a_shuffle(spark, write_csv, tmp_path, monkeypatch):
    for name, lines in (("even", [20] * 8), ("uneven", [5000] + [20] * 7), ("one", [20])):
        for i, n in enumerate(lines):
            write_csv(f"{name}/{i}.csv.gz", *[LINE.replace(",41,", f",{k % 265},") for k in range(n)])
        monkeypatch.setattr(ingest, "SHARE_BYTES", 0)
        landed = str(tmp_path / f"{name}-landed")
        land_file(spark, str(tmp_path / name), schemas.YELLOW, landed)
        files = glob.glob(f"{landed}/*.gz.parquet")
        assert len(files) == (8 if name == "even" else 1)
        found = read_parquet(spark, landed).groupBy("PULocationID").count()
        wanted = [k % 265 for n in lines for k in range(n)]
        assert {r[0]: r[1] for r in found.collect()} == {k: wanted.count(k) for k in set(wanted)}
    # Little data is gathered into few files, however it lies.
    monkeypatch.undo()
    land_file(spark, str(tmp_path / "even"), schemas.YELLOW, str(tmp_path / "little"))
    assert len(glob.glob(str(tmp_path / "little/*.gz.parquet"))) == 1


def test_months_are_landed_side_by_side(spark, write_csv, tmp_path, monkeypatch):
    for month in (1, 2):
        write_csv(f"raw/yellow/yellow_tripdata_2021-{month:02d}.csv.gz", *[LINE] * month)
    both, land = Barrier(2), ingest._land
    monkeypatch.setattr(ingest, "_land", lambda *args: both.wait(60) + 1 and land(*args))
    landed = str(tmp_path / "landed")
    assert land_months(spark, str(tmp_path / "raw"), schemas.YELLOW, landed, 2021, [1, 2, 3]) == [3]
    paths = month_paths(landed, schemas.YELLOW, 2021, [1, 2], "parquet")
    assert [read_parquet(spark, p).count() for p in paths] == [1, 2]


def test_cleaned_tables_of_the_services_are_cut_side_by_side(spark, store, monkeypatch):
    for service, rows in raw_services(spark, SF_DIR).items():
        store.write(rows, f"{service}_trips_data")
    both, write = Barrier(2), TableStore.write

    def together(self, df, name, *args, **options):
        if name in ("green_trips_data_cleaned", "yellow_trips_data_cleaned"):
            both.wait(60)
        write(self, df, name, *args, **options)

    monkeypatch.setattr(TableStore, "write", together)
    names = run_clean(store, "all")
    counts = [store.read(name).count() for name in names]
    assert counts[0] + counts[1] == counts[2] and min(counts) > 0


def test_services_of_the_check_are_loaded_side_by_side(spark, monkeypatch):
    from checks import tables

    both, append = Barrier(2), tables.append_months
    monkeypatch.setattr(tables, "append_months", lambda *args: both.wait(120) + 1 and append(*args))
    services = tables.landed_then_cleaned(spark, SF_DIR).groupBy("service_type").count().collect()
    assert {r[0] for r in services} == {"green", "yellow"}


def test_times_are_stored_in_64_bits_and_older_files_read_along(spark, write_csv, tmp_path, settings):
    early = LINE.replace("2020-03-09 07:05:00", "0001-01-02 03:04:05").replace("2020-03-09 07:21:30", "9999-12-31 23:59:59")
    raw, landed = write_csv("a.csv.gz", LINE, early), str(tmp_path / "landed")
    land_file(spark, raw, schemas.YELLOW, landed)
    (file,) = glob.glob(f"{landed}/*.parquet")
    kinds = {c.name: c.physical_type for c in pq.ParquetFile(file).schema}
    assert kinds["tpep_pickup_datetime"] == kinds["tpep_dropoff_datetime"] == "INT64"
    settings(spark__sql__parquet__outputTimestampType="INT96")
    land_file(spark, raw, schemas.YELLOW, landed, mode="append")
    times = read_parquet(spark, landed).selectExpr("string(tpep_pickup_datetime)", "string(tpep_dropoff_datetime)")
    rows = [("0001-01-02 03:04:05", "9999-12-31 23:59:59"), ("2020-03-09 07:05:00", "2020-03-09 07:21:30")]
    assert sorted(tuple(r) for r in times.collect()) == sorted(rows * 2)
