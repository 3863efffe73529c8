"""Names and types over files, growing tables, repeatable loads."""

from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge import schemas
from tripforge.cli import main
from tripforge.operators import reconcile
from tripforge.operators.repair import repair_types
from tripforge.plans.ingest import LEDGER, append_months, land_months, loaded_months, month_paths, replace_months
from tripforge.sinks.files import append_counted
from tripforge.sources.files import read_text_csv
from tripforge.sources.tables import TableStore


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


KINDS = [reconcile.NOTHING, reconcile.WHOLE, reconcile.NUMBER, reconcile.TIME, reconcile.TEXT]


@given(*[st.sampled_from(KINDS)] * 3)
def test_kinds_are_a_lattice(a, b, c):
    join = reconcile.wider_kind
    assert join(a, a) == a and join(a, b) == join(b, a)
    assert join(join(a, b), c) == join(a, join(b, c))
    assert join(a, reconcile.NOTHING) == a and join(a, reconcile.TEXT) == reconcile.TEXT


def test_kinds_of_columns(spark):
    rows = [
        ("1", "1", "1.5", "x", None, "2021-01-05 10:00:00", " 7 ", "9" * 25, "1"),
        ("-2", "1e3", " 2", "2", "", None, "+3", "1", "2021-01-05 10:00:00"),
        (None, "NaN", None, None, "  ", "2021-01-05", None, None, None),
    ]
    names = ["whole", "number", "mixed", "text", "none", "time", "padded", "long", "both"]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    found = reconcile.column_kinds(df, names)
    assert found == {
        "whole": "whole", "number": "number", "mixed": "number", "text": "text", "none": "nothing",
        "time": "time", "padded": "whole", "long": "number", "both": "text",
    }
    typed = df.select(*[reconcile.typed(F.col(n), k).alias(n) for n, k in found.items()])
    assert [r["padded"] for r in typed.collect()] == [7, 3, None]
    assert typed.schema["number"].dataType == T.DoubleType() and typed.schema["time"].dataType == T.TimestampType()
    assert reconcile.column_kinds(df.limit(0), names) == dict.fromkeys(names, "nothing")


def test_merged_kinds_ignore_case():
    files = [{"Airport_fee": "whole", "x": "nothing"}, {"airport_fee": "number"}, {"X": "time"}, {"AIRPORT_FEE": "nothing"}]
    assert reconcile.merge_kinds(files) == {"Airport_fee": "number", "x": "time"}


def test_names_take_the_layouts_spelling(spark):
    raw = spark.createDataFrame([("11.0", "2021-01-05 10:00:00", "2021-01-05 11:00:00", "2.5", "Y")],
                                "PUlocationID string, LPEP_pickup_datetime string, lpep_Dropoff_datetime string, "
                                "Airport_Fee string, STORE_AND_FWD_FLAG string")
    row = repair_types(raw, schemas.GREEN).first()
    assert row.asDict().keys() == {"PULocationID", "lpep_pickup_datetime", "lpep_dropoff_datetime", "Airport_Fee", "store_and_fwd_flag"}
    assert (row["PULocationID"], row["Airport_Fee"], row["store_and_fwd_flag"]) == (11, 2.5, True)
    with pytest.raises(ValueError, match="lpep_pickup_datetime"):
        repair_types(raw.drop("LPEP_pickup_datetime"), schemas.GREEN)
    with pytest.raises(ValueError, match="differ in case"):
        reconcile.canonical_names(raw.withColumn("x", F.lit(1)).toDF("a", "A", "b", "c", "d", "e"), [])


def test_wider_types_keep_values():
    wider = reconcile.wider_type
    assert wider(T.IntegerType(), T.LongType()) == T.LongType()
    assert wider(T.LongType(), T.DoubleType()) == T.DoubleType()
    assert wider(T.NullType(), T.StringType()) == T.StringType()
    assert wider(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert wider(T.TimestampType(), T.DateType()) == T.TimestampType()
    assert wider(T.StringType(), T.LongType()) is None


def test_a_second_load_brings_a_column(spark, store):
    assert append_counted(spark.createDataFrame([(1, 2.0)], "id int, fare double"), store, "rides") == 1
    more = spark.createDataFrame([(2.5, 7, "late", None)], "Fare double, ID int, note string, extra string")
    assert append_counted(more, store, "rides") == 1
    assert append_counted(spark.createDataFrame([(3,)], "id int"), store, "rides") == 1
    rows = sorted(tuple(r) for r in store.read("rides").collect())
    assert store.read("rides").columns == ["id", "fare", "note", "extra"]
    assert rows == [(1, 2.0, None, None), (3, None, None, None), (7, 2.5, "late", None)]


def test_a_type_that_is_too_narrow_is_an_error_and_changes_nothing(spark, store):
    append_counted(spark.createDataFrame([(1, 2)], "id int, fee long"), store, "rides")
    with pytest.raises(ValueError, match="fee: bigint <- double"):
        append_counted(spark.createDataFrame([(2, 0.5, "x")], "id int, fee double, note string"), store, "rides")
    assert store.read("rides").columns == ["id", "fee"] and store.read("rides").count() == 1


def test_a_catalog_table_grows_too(spark):
    store = TableStore(spark, "default", "catalog")
    append_counted(spark.createDataFrame([(1,)], "id int"), store, "growing_rides")
    append_counted(spark.createDataFrame([("x", 2)], "note string, id int"), store, "growing_rides")
    assert sorted(map(tuple, store.read("growing_rides").collect())) == [(1, None), (2, "x")]
    spark.sql("DROP TABLE growing_rides")


FHV = "{header}\nB1,2021-01-05 10:00:00,2021-01-05 11:00:00,{zone},7,,{fee}\n"


@pytest.fixture
def fhv_months(tmp_path):
    headers = {
        1: ("dispatching_base_num,pickup_datetime,dropoff_datetime,PULocationID,DOLocationID,SR_Flag,fee", "12", "1"),
        3: ("Dispatching_base_num,Pickup_datetime,DropOff_datetime,PUlocationID,DOlocationID,SR_flag,Fee", "13.0", "0.5"),
    }
    for month, (header, zone, fee) in headers.items():
        path = tmp_path / f"raw/fhv/fhv_tripdata_2021-{month:02d}.csv.gz"
        path.mkdir(parents=True)
        (path / "part.csv").write_text(FHV.format(header=header, zone=zone, fee=fee))
    return str(tmp_path / "raw")


def test_fhv_months_are_landed_and_loaded(spark, store, fhv_months, tmp_path, capsys):
    landed = str(tmp_path / "landed")
    main(["land", "--months", "1", "2", "3", "--color", "fhv", "--input", fhv_months, "--output", landed])
    main(["load", "--months", "1", "2", "3", "--color", "fhv", "--input", landed, "--dataset", store.location])
    said = capsys.readouterr().out
    assert "Months without a file: [2]" in said and "Total rows: 2" in said
    rows = sorted((r["PULocationID"], r["fee"], str(r["dropOff_datetime"])) for r in store.read("rides").collect())
    assert rows == [(12, 1.0, "2021-01-05 11:00:00"), (13, 0.5, "2021-01-05 11:00:00")]


def test_a_month_that_is_loaded_again_is_replaced(spark, store, fhv_months, tmp_path):
    landed = str(tmp_path / "landed")
    assert land_months(spark, fhv_months, schemas.FHV, landed, 2021, [1, 2, 3]) == [2]
    first = replace_months(spark, landed, schemas.FHV, 2021, [1, 2, 3], store, "rides")
    assert (first.rows, first.absent) == ({1: 1, 3: 1}, [2])
    # The month comes again, with more rows and a further column.
    (path,) = month_paths(landed, schemas.FHV, 2021, [3], "parquet")
    again = spark.read.parquet(path).withColumn("note", F.lit("new"))
    again.union(again).write.parquet(month_paths(landed, schemas.FHV, 2022, [3], "parquet")[0])
    main(["load", "--replace", "--months", "3", "--year", "2021", "--color", "fhv", "--input", landed, "--dataset", store.location])
    assert replace_months(spark, landed, schemas.FHV, 2022, [3], store, "rides").rows == {3: 2}
    assert replace_months(spark, landed, schemas.FHV, 2022, [3], store, "rides").rows == {3: 2}
    rows = store.read("rides")
    assert sorted((r["year"], r["month"], r["note"]) for r in rows.collect()) == [
        (2021, 1, None), (2021, 3, None), (2022, 3, "new"), (2022, 3, "new")]
    held = {(r["year"], r["month"]): r["rows"] for r in loaded_months(store, "rides").collect()}
    assert held == {(2021, 1): 1, (2021, 3): 1, (2022, 3): 2}
    assert store.read(LEDGER.format(table="rides")).count() == 5
    assert replace_months(spark, landed, schemas.FHV, 2023, [1], store, "rides").absent == [1]
    assert append_months(spark, [str(tmp_path / "nowhere")], store, "rides") == 0


def test_files_with_other_columns_are_read_as_one(spark, tmp_path):
    (tmp_path / "a.csv").write_text("VendorID,Fee\n1,2\n")
    (tmp_path / "b.csv").write_text("fee,vendorid,note\n2.5,2,x\n")
    frames = [read_text_csv(spark, str(tmp_path / f"{n}.csv")) for n in "ab"]
    merged = reconcile.merge_frames(frames)
    assert merged.columns == ["VendorID", "Fee", "note"]
    assert sorted(map(tuple, merged.collect())) == [("1", "2", None), ("2", "2.5", "x")]
