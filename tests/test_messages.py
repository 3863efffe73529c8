from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tripforge import schemas
from tripforge.functions.codes import tip_band
from tripforge.functions.text import parse_timestamp, real_number, whole_number, yes_no
from tripforge.operators.messages import (
    count_messages,
    first_messages,
    parse_delimited,
    parse_json,
    to_delimited_messages,
    to_json_messages,
    to_json_rides,
)
from tripforge.operators.repair import repair_types
from tripforge.streaming.counts import windowed_count

FULL = (
    "2, 2020-03-09 07:05:00, 2020-03-09 07:21:30, 3, 4.25, 1, N, 41, 166, 1, 16.5, 0, 0.5, 3.46, 0, "
    "0.3, 23.26, 2.5"
)
PICKUP = dt.datetime(2020, 3, 9, 7, 5)
# A JSON ride as a producer of the other convention writes it.
ARRAY_TIMES = (
    '{"vendor_id": "2", "tpep_pickup_datetime": ["2020-03-09 07:05:00"], '
    '"tpep_dropoff_datetime": ["2020-03-09 07:21:30"], "passenger_count": 3, '
    '"trip_distance": "4.25", "rate_code_id": 1, "store_and_fwd_flag": "N", '
    '"pu_location_id": 41, "do_location_id": 166, "payment_type": "1", "fare_amount": "16.5", '
    '"extra": "0", "mta_tax": "0.5", "tip_amount": "3.46", "tolls_amount": "0", '
    '"improvement_surcharge": "0.3", "total_amount": "23.26", "congestion_surcharge": "2.5"}'
)


def messages(spark, *values):
    return spark.createDataFrame([("k", v) for v in values], "key string, value string")


def parsed(spark, *values):
    return parse_delimited(messages(spark, *values)).collect()


def test_delimited_message(spark):
    (ride,) = parsed(spark, FULL)
    assert ride["vendor_id"] == 2 and ride["tpep_pickup_datetime"] == PICKUP
    assert ride["trip_distance"] == pytest.approx(4.25)
    assert ride["store_and_fwd_flag"] == "N" and ride["total_amount"] == pytest.approx(23.26)


def test_binary_messages_parse_alike(spark):
    binary = messages(spark, FULL).select(F.col("value").cast("binary"), F.col("key").cast("binary"))
    assert parse_delimited(binary).collect() == parsed(spark, FULL)


def test_damaged_messages_give_nulls(spark):
    short, empty, junk, longer = parsed(
        spark, "1, 2020-03-09 07:05:00", "", FULL.replace(", 41,", ", zone,"), FULL + ", more, still"
    )
    assert short["vendor_id"] == 1 and short["passenger_count"] is None
    assert all(v is None for v in empty)
    assert junk["PULocationID"] is None and junk["DOLocationID"] == 166
    assert longer["congestion_surcharge"] == 2.5


def test_null_fields_do_not_shift_later_ones(spark):
    row = spark.createDataFrame([(5, None, 7)], "a int, b int, c int")
    (message,) = to_delimited_messages(row, "a", ["a", "b", "c"]).collect()
    assert (message["key"], message["value"]) == ("5", "5, , 7")


def test_json_times_in_arrays_or_bare(spark):
    bare = ARRAY_TIMES.replace('["', '"').replace('"]', '"')
    first, second = parse_json(messages(spark, ARRAY_TIMES, bare)).collect()
    assert first == second
    assert first["tpep_pickup_datetime"] == PICKUP
    assert first["trip_distance"] == Decimal("4.25") and first["pu_location_id"] == 41


def test_broken_json_gives_nulls(spark):
    rides = parse_json(messages(spark, '{"vendor_id": "1"', '{"fare_amount": "much"}', "[]")).collect()
    assert len(rides) == 3
    assert rides[1]["fare_amount"] is None and rides[2]["vendor_id"] is None


def test_json_roundtrip_keeps_every_field(spark):
    rides = parse_json(messages(spark, ARRAY_TIMES))
    again = parse_json(to_json_messages(rides, "pu_location_id"))
    assert again.collect() == rides.collect()


def test_json_rides_from_text_columns(spark):
    text = spark.createDataFrame(
        [tuple(FULL.split(", "))], [f"`{n}`".strip("`") for n in schemas.RIDE_SCHEMA.names]
    )
    ride = to_json_rides(text).first()
    assert (ride["trip_distance"], ride["rate_code_id"]) == (Decimal("4.25"), 1)


def test_window_count_messages_name_their_window(spark):
    rides = parse_delimited(messages(spark, FULL, FULL))
    counts = windowed_count(rides, "tpep_pickup_datetime", ["vendor_id"], "10 minutes", "5 minutes")
    sent = {(r["key"], r["value"]) for r in count_messages(counts, ["window", "count"], "vendor_id").collect()}
    assert sent == {
        ("2", "2020-03-09 07:00:00, 2020-03-09 07:10:00, 2"),
        ("2", "2020-03-09 07:05:00, 2020-03-09 07:15:00, 2"),
    }
    assert count_messages(counts, ["count"]).first()["key"] is None


def test_first_messages(spark):
    assert first_messages(messages(spark, *[str(i) for i in range(150)]), 100).count() == 100


@pytest.mark.parametrize(
    "tip,fare,tolls,label",
    [
        (0.0, 10.0, 0.0, "No Tip"),
        (0.5, 9.5, 0.0, "Less than 5%"),
        (0.51, 9.49, 0.0, "5% to 10%"),
        (1.0, 7.0, 2.0, "5% to 10%"),
        (1.5, 8.5, 0.0, "10% to 15%"),
        (2.0, 8.0, 0.0, "15% to 20%"),
        (2.5, 7.5, 0.0, "20% to 25%"),
        (2.51, 7.49, 0.0, "More than 25%"),
        (1.0, -1.0, 0.0, "More than 25%"),
    ],
)
def test_tip_band_edges(spark, tip, fare, tolls, label):
    df = spark.createDataFrame([(tip, fare, tolls)], "tip double, fare double, tolls double")
    assert df.select(tip_band("tip", "fare", "tolls")).first()[0] == label


def test_whole_numbers_and_flags(spark):
    df = spark.createDataFrame([(v,) for v in ["3", "3.0", "3.7", "x", "", None]], "v string")
    assert [r[0] for r in df.select(whole_number(F.col("v"))).collect()] == [3, 3, None, None, None, None]
    flags = spark.createDataFrame([(v,) for v in ["Y", "N", "?", None]], "v string")
    assert [r[0] for r in flags.select(yes_no(F.col("v"))).collect()] == [True, False, None, None]


def test_repair_touches_only_present_columns(spark):
    fhv = spark.createDataFrame(
        [("B1", "2019-01-01 00:30:00", "bad", "5.0")],
        "dispatching_base_num string, pickup_datetime string, dropOff_datetime string, PULocationID string",
    )
    row = repair_types(fhv, schemas.FHV).first()
    assert row.asDict() == {
        "dispatching_base_num": "B1",
        "pickup_datetime": dt.datetime(2019, 1, 1, 0, 30),
        "dropOff_datetime": None,
        "PULocationID": 5,
    }


ODD_TEXTS = [
    "3", "3.0", " 3 ", "\t3.0\n", "3.7", "x", "", None, "1e3", "1.5E1", "+5", "-5.0", "9223372036854775808", "5L",
    "99999999999999999999.0", "1.0d", "0x10", "NaN", " -Infinity", "+inf", "nAn", ".5", "5.", "\u0663", "3\u00a0", "green",
    "2021-01-05 10:00:00", "2021-01-05 10:00:00.5", " 2021-01-05 10:00:00 ", "2021-1-5 1:2:3", "+12345-01-01 00:00:00",
    "12345-01-01 00:00:00", "2021-02-30 10:00:00", "2021-01-05 24:00:00", "2021-01-05T10:00:00Z", "2021", "n", "I",
]


def test_texts_are_cast_only_where_they_may_fit(spark):
    """The guards change no value, and every cast that throws on a misfit is behind one."""
    v = F.col("v")
    number = v.try_cast("decimal(38,10)")
    plain = {
        whole_number: F.coalesce(v.try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint"))),
        parse_timestamp: F.coalesce(F.try_to_timestamp(v, F.lit(schemas.TIMESTAMP_FORMAT)), v.try_cast("timestamp")),
        real_number: v.try_cast("double"),
    }
    df = spark.createDataFrame([(t,) for t in ODD_TEXTS], "v string")
    for guarded, expected in plain.items():
        both = df.select(guarded(v).cast("string"), expected.cast("string")).collect()
        assert [r[0] for r in both] == [r[1] for r in both]
        plan = df.select(guarded(v))._jdf.queryExecution().analyzed().toString().lower()
        assert "rlike" in plan and "case when" in plan


def test_cents_are_those_of_round(spark):
    from checks.streams import _cents

    steps = spark.range(-3000, 3000).select((F.col("id") / 1000).alias("v"))
    floats = steps.select((F.col("v") * 7.3).cast("float").cast("double"))
    odd = spark.createDataFrame([(x,) for x in (float("nan"), float("inf"), -0.0, 1.005, -0.001, 1e300, None)], "v double")
    df = steps.union(floats).union(odd)
    different = ~F.round("v", 2).cast("string").eqNullSafe(_cents(F.col("v")).cast("string"))
    assert df.where(different).count() == 0
