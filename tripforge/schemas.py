"""Column layouts and code lists shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def layout(columns: dict[str, str]) -> T.StructType:
    """Nullable struct type from ``{column: short type name}``."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


# ---------------------------------------------------------------------------
# Input layouts, service names and code lists of the trip data.
# ---------------------------------------------------------------------------

GREEN = "green"
YELLOW = "yellow"
FHV = "fhv"

GREEN_SCHEMA = layout(
    {
        "VendorID": "int",
        "lpep_pickup_datetime": "timestamp",
        "lpep_dropoff_datetime": "timestamp",
        "store_and_fwd_flag": "string",
        "RatecodeID": "int",
        "PULocationID": "int",
        "DOLocationID": "int",
        "passenger_count": "int",
        "trip_distance": "double",
        "fare_amount": "double",
        "extra": "double",
        "mta_tax": "double",
        "tip_amount": "double",
        "tolls_amount": "double",
        "ehail_fee": "double",
        "improvement_surcharge": "double",
        "total_amount": "double",
        "payment_type": "int",
        "trip_type": "int",
        "congestion_surcharge": "double",
    }
)

YELLOW_SCHEMA = layout(
    {
        "VendorID": "int",
        "tpep_pickup_datetime": "timestamp",
        "tpep_dropoff_datetime": "timestamp",
        "passenger_count": "int",
        "trip_distance": "double",
        "RatecodeID": "int",
        "store_and_fwd_flag": "string",
        "PULocationID": "int",
        "DOLocationID": "int",
        "payment_type": "int",
        "fare_amount": "double",
        "extra": "double",
        "mta_tax": "double",
        "tip_amount": "double",
        "tolls_amount": "double",
        "improvement_surcharge": "double",
        "total_amount": "double",
        "congestion_surcharge": "double",
    }
)

FHV_SCHEMA = layout(
    {
        "dispatching_base_num": "string",
        "pickup_datetime": "timestamp",
        "dropOff_datetime": "timestamp",
        "PULocationID": "int",
        "DOLocationID": "int",
        "SR_Flag": "int",
        "Affiliated_base_number": "string",
    }
)

SERVICE_SCHEMAS = {GREEN: GREEN_SCHEMA, YELLOW: YELLOW_SCHEMA, FHV: FHV_SCHEMA}

# Pickup and dropoff column of each service's raw records.
SERVICE_TIMES = {
    GREEN: ("lpep_pickup_datetime", "lpep_dropoff_datetime"),
    YELLOW: ("tpep_pickup_datetime", "tpep_dropoff_datetime"),
    FHV: ("pickup_datetime", "dropOff_datetime"),
}

# The columns every service shares once the times are renamed.
COMMON_COLUMNS = [
    "VendorID",
    "pickup_datetime",
    "dropoff_datetime",
    "store_and_fwd_flag",
    "RatecodeID",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "payment_type",
    "congestion_surcharge",
]

TRIP_COLUMNS = [*COMMON_COLUMNS, "service_type"]

# One ride as carried by a delimited topic message, in message order.
RIDE_SCHEMA = layout(
    {
        "vendor_id": "int",
        "tpep_pickup_datetime": "timestamp",
        "tpep_dropoff_datetime": "timestamp",
        "passenger_count": "int",
        "trip_distance": "float",
        "RatecodeID": "int",
        "store_and_fwd_flag": "string",
        "PULocationID": "int",
        "DOLocationID": "int",
        "payment_type": "int",
        "fare_amount": "float",
        "extra": "float",
        "mta_tax": "float",
        "tip_amount": "float",
        "tolls_amount": "float",
        "improvement_surcharge": "float",
        "total_amount": "float",
        "congestion_surcharge": "float",
    }
)

_MONEY = T.DecimalType(10, 2)

# One ride as carried by a JSON topic message, in message order.
JSON_RIDE_SCHEMA = T.StructType(
    [
        T.StructField("vendor_id", T.StringType()),
        T.StructField("tpep_pickup_datetime", T.TimestampType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", _MONEY),
        T.StructField("rate_code_id", T.IntegerType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("pu_location_id", T.IntegerType()),
        T.StructField("do_location_id", T.IntegerType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("fare_amount", _MONEY),
        T.StructField("extra", _MONEY),
        T.StructField("mta_tax", _MONEY),
        T.StructField("tip_amount", _MONEY),
        T.StructField("tolls_amount", _MONEY),
        T.StructField("improvement_surcharge", _MONEY),
        T.StructField("total_amount", _MONEY),
        T.StructField("congestion_surcharge", _MONEY),
    ]
)

MESSAGE_SCHEMA = layout({"key": "string", "value": "string"})

ZONES_SCHEMA = layout({"LocationID": "int", "Zone": "string", "Borough": "string"})

VENDORS = [1, 2]
RATE_CODES = (1, 6)
PAYMENT_TYPES = (1, 6)
LOCATIONS = (1, 265)

RATE_NAMES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}

PAYMENT_NAMES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}

# Tip share of the bill in percent: upper bound (inclusive) and label of each band.
NO_TIP = "No Tip"
TIP_BANDS = [
    (5, "Less than 5%"),
    (10, "5% to 10%"),
    (15, "10% to 15%"),
    (20, "15% to 20%"),
    (25, "20% to 25%"),
]
TOP_TIP_BAND = "More than 25%"

# Path of one service's month below the landing folder, without extension.
MONTH_FILE = "{service}/{service}_tripdata_{year}-{month:02d}"

MESSAGE_SEPARATOR = ", "
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
