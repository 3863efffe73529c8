"""Sources and sinks: what is written is read back and compared with the source rows."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.batch import REVENUE_SQL, counted, rounded_revenue, total
from checks.fixture import CLEAN_SQL, TRIPS_SQL, raw_as_typed, raw_services, trips
from checks.registry import check
from tripforge import schemas
from tripforge.operators.repair import repair_types
from tripforge.operators.reports import (
    distinct_vendors,
    partition_row_counts,
    vendor_trip_count,
)
from tripforge.operators.revenue import monthly_revenue
from tripforge.operators.unify import unify
from tripforge.plans.batch import ALL_CLEANED, CLEANED, RAW, SERVICES, run_clean, run_revenue
from tripforge.plans.ingest import (
    LEDGER,
    append_months,
    csv_to_parquet,
    land_file,
    land_months,
    loaded_months,
    month_paths,
    replace_months,
)
from tripforge.sinks.files import (
    by_date,
    replace_table,
    write_by_date,
    write_parquet,
    write_single_file,
)
from tripforge.sources.files import external_view, read_csv, read_parquet, read_text_csv
from tripforge.sources.statistics import analyze_partitions, catalogued_row_counts
from tripforge.sources.tables import TableStore
from tripforge.staging import staging_path

_BOTH = (schemas.GREEN, schemas.YELLOW)
# Raw files are read once or twice: the lowest level of gzip writes them in half the time.
_CSV_FILES = {"header": True, "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _csv(spark: SparkSession, sf_dir: str, service: str, by_month: bool = False) -> str:
    """The service's raw trips as gzip CSV files in the shared folder."""
    path = staging_path(spark, f"{service}-csv")
    raw = raw_as_typed(spark, sf_dir, service)
    if by_month:
        pickup = F.col(schemas.SERVICE_TIMES[service][0])
        raw = raw.withColumns(
            {"year": F.date_format(pickup, "yyyy"), "month": F.date_format(pickup, "MM")}
        ).hint("rebalance", "year", "month")
    writer = raw.write.options(**_CSV_FILES)
    writer = writer.option("timestampNTZFormat", schemas.TIMESTAMP_FORMAT)
    (writer.partitionBy("year", "month") if by_month else writer).csv(path)
    return path


def _plain_times(df: DataFrame) -> DataFrame:
    zoned = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


@check("typed_csv_scan", f"WITH {TRIPS_SQL} SELECT * FROM trips")
def typed_csv_scan(spark, sf_dir):
    raw = {
        s: read_csv(spark, _csv(spark, sf_dir, s), schemas.SERVICE_SCHEMAS[s]) for s in _BOTH
    }
    return _plain_times(unify(raw))


@check(
    "csv_months_to_parquet",
    f"""WITH {TRIPS_SQL}
    SELECT *, CAST(year(pickup_datetime) AS INT) AS file_year,
      CAST(month(pickup_datetime) AS INT) AS file_month
    FROM trips""",
)
def csv_months_to_parquet(spark, sf_dir):
    months = {}
    for service in _BOTH:
        base = _csv(spark, sf_dir, service, by_month=True)
        path = staging_path(spark, f"{service}-months")
        pickup = F.year(schemas.SERVICE_TIMES[service][0])
        years = raw_as_typed(spark, sf_dir, service).agg(F.min(pickup), F.max(pickup)).first()
        csv_to_parquet(
            spark, service, base, path, range(years[0], years[1] + 1), prefixes=("year=", "month=")
        )
        months[service] = read_parquet(spark, path)
    parts = [
        _plain_times(_named(df, service)).select(
            *schemas.COMMON_COLUMNS, F.lit(service).alias("service_type"), "file_year", "file_month"
        )
        for service, df in months.items()
    ]
    return parts[0].unionByName(parts[1])


@check("parquet_files_scan", f"WITH {TRIPS_SQL} SELECT * FROM trips")
def parquet_files_scan(spark, sf_dir):
    raw = {}
    for service, df in raw_services(spark, sf_dir).items():
        path = staging_path(spark, f"{service}-parquet")
        write_parquet(df, path, files=4)
        raw[service] = read_parquet(spark, path)
    return unify(raw)


@check(
    "external_view",
    f"""WITH {TRIPS_SQL} SELECT * EXCLUDE service_type FROM trips WHERE service_type = 'yellow'""",
)
def external_view_query(spark, sf_dir):
    path = staging_path(spark, "yellow-years")
    raw = raw_as_typed(spark, sf_dir, schemas.YELLOW)
    years = raw.withColumn("year", F.year("tpep_pickup_datetime")).hint("rebalance", "year")
    years.write.partitionBy("year").parquet(path)
    view = f"external_{path[-12:]}"
    external_view(spark, view, f"{path}/year=19*", f"{path}/year=20*")
    rides = spark.sql(f"SELECT * FROM {view}")
    spark.catalog.dropTempView(view)
    return _named(rides, schemas.YELLOW)


@check(
    "cleaned_tables",
    f"""WITH {CLEAN_SQL}
    SELECT service_type || '_trips_data_cleaned' AS table_name, * FROM clean
    UNION ALL SELECT 'trips_data_cleaned', * FROM clean""",
)
def cleaned_tables(spark, sf_dir):
    store = TableStore(spark, staging_path(spark, "store"))
    store.write_all(
        {RAW.format(service=s): df for s, df in raw_services(spark, sf_dir).items()}
    )
    run_clean(store, "all")
    tables = None
    for name in [*[CLEANED.format(service=s) for s in SERVICES], ALL_CLEANED]:
        part = store.read(name).select(F.lit(name).alias("table_name"), *schemas.TRIP_COLUMNS)
        tables = part if tables is None else tables.unionByName(part)
    return tables


@check(
    "green_cleaned_table",
    f"WITH {CLEAN_SQL} SELECT * FROM clean WHERE service_type = 'green'",
)
def green_cleaned_table(spark, sf_dir):
    store = TableStore(spark, staging_path(spark, "store"))
    store.write(raw_services(spark, sf_dir)[schemas.GREEN], "green_trips_data")
    (written,) = run_clean(store, "green_trips_data")
    return store.read(written)


@check("revenue_single_file", REVENUE_SQL)
def revenue_single_file(spark, sf_dir):
    path = staging_path(spark, "revenue")
    write_single_file(monthly_revenue(trips(spark, sf_dir)), path)
    return rounded_revenue(read_parquet(spark, path))


@check("revenue_table", REVENUE_SQL)
def revenue_table(spark, sf_dir):
    store = TableStore(spark, staging_path(spark, "store"))
    run_revenue(trips(spark, sf_dir), store=store)
    return rounded_revenue(store.read("monthly_revenue"))


@check(
    "replaced_table",
    f"""WITH {TRIPS_SQL}
    SELECT passenger_count, count(*) AS trips FROM trips GROUP BY passenger_count""",
)
def replaced_table(spark, sf_dir):
    path = staging_path(spark, "ctas")
    name = f"riders_{path[-12:]}"
    every = trips(spark, sf_dir)
    replace_table(every.groupBy("VendorID").count(), name, path)
    riders = every.groupBy("passenger_count").agg(counted("trips"))
    replace_table(riders, name, path)
    found = spark.table(name)
    # The table is external and the frame holds its files: nothing is left in the catalog.
    spark.sql(f"DROP TABLE {name}")
    return found


# --- landing and loading ------------------------------------------------------


# Every landed column in its own type: whole numbers as 64 bits, the flag as a boolean.
_WHOLE = ["VendorID", "RatecodeID", "PULocationID", "DOLocationID", "passenger_count", "payment_type"]
_SAME = [c for c in schemas.COMMON_COLUMNS if c not in [*_WHOLE, "store_and_fwd_flag"]]
_REPAIRED_COLUMNS = ", ".join(
    [
        *[f'CAST("{c}" AS BIGINT) AS "{c}"' for c in _WHOLE],
        "store_and_fwd_flag = 'Y' AS store_and_fwd_flag",
        *_SAME,
    ]
)
_GREEN_ONLY = ", CAST(NULL AS DOUBLE) AS ehail_fee, CAST(1 AS INT) AS trip_type"


def _named(df: DataFrame, service: str) -> DataFrame:
    times = schemas.SERVICE_TIMES[service]
    return df.withColumnsRenamed({times[0]: "pickup_datetime", times[1]: "dropoff_datetime"})


@check(
    "landed_and_loaded",
    f"""WITH {TRIPS_SQL} SELECT {_REPAIRED_COLUMNS},
      (SELECT count(*) FROM trips WHERE service_type = 'yellow') AS loaded
    FROM trips WHERE service_type = 'yellow'""",
)
def landed_and_loaded(spark, sf_dir):
    landed = staging_path(spark, "landed")
    land_file(spark, _csv(spark, sf_dir, schemas.YELLOW), schemas.YELLOW, landed)
    store = TableStore(spark, staging_path(spark, "store"))
    loaded = append_months(spark, [landed], store, "rides")
    rides = _plain_times(_named(store.read("rides"), schemas.YELLOW))
    return rides.withColumn("loaded", F.lit(loaded).cast("long"))


def _write_months(spark: SparkSession, sf_dir: str, service: str, base: str) -> None:
    """Odd and even months of trips as two raw files; the second has its columns reversed."""
    text = raw_as_typed(spark, sf_dir, service)
    text = text.withColumns({c: F.col(c).cast("string") for c in schemas.SERVICE_TIMES[service]})
    odd = F.month(schemas.SERVICE_TIMES[service][0]) % 2 == 1
    months = {1: text.where(odd), 2: text.where(~odd).select(*reversed(text.columns))}
    with ThreadPoolExecutor(len(months)) as pool:
        list(pool.map(lambda month: _raw_month(months[month], base, service, month), months))


@check(
    "landed_then_cleaned",
    f"""WITH {CLEAN_SQL} SELECT {_REPAIRED_COLUMNS}, service_type FROM clean""",
)
def landed_then_cleaned(spark, sf_dir):
    """Raw months of both services, landed and loaded side by side and cleaned as the command line does."""
    base, landed = staging_path(spark, "months"), staging_path(spark, "landed")
    store = TableStore(spark, staging_path(spark, "store"))

    def load(service: str) -> None:
        _write_months(spark, sf_dir, service, base)
        land_months(spark, base, service, landed, 2021, [1, 2])
        paths = month_paths(landed, service, 2021, [1, 2], "parquet")
        append_months(spark, paths, store, RAW.format(service=service))

    with ThreadPoolExecutor(len(_BOTH)) as pool:
        list(pool.map(load, _BOTH))
    run_clean(store, "all")
    return _plain_times(store.read(ALL_CLEANED))


def _repair_query(service: str) -> None:
    extra = _GREEN_ONLY if service == schemas.GREEN else ""

    @check(
        f"type_repair_{service}",
        f"WITH {TRIPS_SQL} SELECT {_REPAIRED_COLUMNS} {extra} FROM trips WHERE service_type = '{service}'",
    )
    def query(spark, sf_dir):
        repaired = repair_types(read_text_csv(spark, _csv(spark, sf_dir, service)), service)
        return _plain_times(_named(repaired, service))


_repair_query(schemas.GREEN)
_repair_query(schemas.YELLOW)


@check(
    "type_repair_fhv",
    f"""WITH {TRIPS_SQL}
    SELECT pickup_datetime, dropoff_datetime AS "dropOff_datetime",
      CAST(CASE WHEN NOT isnan(trip_distance) AND trip_distance = floor(trip_distance)
        THEN trip_distance END AS BIGINT)
        AS "PULocationID",
      CAST("DOLocationID" AS BIGINT) AS "DOLocationID"
    FROM trips""",
)
def type_repair_fhv(spark, sf_dir):
    """Whole distances stand in for float-typed ids; a fraction must become null."""
    text = trips(spark, sf_dir).select(
        F.col("pickup_datetime").cast("string"),
        F.col("dropoff_datetime").cast("string").alias("dropOff_datetime"),
        F.col("trip_distance").alias("PULocationID"),
        F.concat("DOLocationID", F.lit(".0")).alias("DOLocationID"),
    )
    return _plain_times(repair_types(text, schemas.FHV))


# --- files and tables whose columns change -----------------------------------------

_ODD = "month(pickup_datetime) % 2 = 1"


def _odd(df: DataFrame) -> DataFrame:
    return df.where(F.month("pickup_datetime") % 2 == 1)


def _even(df: DataFrame) -> DataFrame:
    return df.where(F.month("pickup_datetime") % 2 == 0)


def _raw_month(df: DataFrame, base: str, service: str, month: int) -> None:
    (path,) = month_paths(base, service, 2021, [month], "csv.gz")
    df.write.options(**_CSV_FILES).csv(path)


@check(
    "landed_fhv",
    f"""WITH {TRIPS_SQL}
    SELECT 'B' || "VendorID" AS dispatching_base_num, pickup_datetime,
      dropoff_datetime AS "dropOff_datetime", CAST("PULocationID" AS BIGINT) AS "PULocationID",
      CAST("DOLocationID" AS BIGINT) AS "DOLocationID", CAST(NULL AS BIGINT) AS "SR_Flag",
      CASE WHEN {_ODD} THEN service_type END AS "Affiliated_base_number",
      CASE WHEN {_ODD} THEN CAST(passenger_count AS DOUBLE) ELSE fare_amount END AS airport_fee,
      CASE WHEN {_ODD} THEN CAST("RatecodeID" AS VARCHAR) ELSE service_type END AS wav_request,
      CASE WHEN NOT {_ODD} THEN CAST(payment_type AS BIGINT) END AS zone_class,
      CASE WHEN NOT {_ODD} THEN pickup_datetime END AS request_datetime
    FROM trips""",
)
def landed_fhv(spark, sf_dir):
    """Two spellings of the header over the months, and columns outside the layout that hold more from month to month."""
    rides = trips(spark, sf_dir)
    times = {c: F.col(c).cast("string") for c in ("pickup_datetime", "dropoff_datetime")}
    base, landed = staging_path(spark, "fhv"), staging_path(spark, "fhv-landed")
    one = _odd(rides).select(
        F.concat(F.lit("B"), "VendorID").alias("dispatching_base_num"),
        times["pickup_datetime"].alias("pickup_datetime"),
        times["dropoff_datetime"].alias("dropoff_datetime"),
        F.concat("PULocationID", F.lit(".0")).alias("PULocationID"),
        "DOLocationID",
        F.lit(None).cast("string").alias("SR_Flag"),
        F.col("service_type").alias("Affiliated_base_number"),
        F.col("passenger_count").alias("Airport_fee"),
        F.col("RatecodeID").alias("wav_request"),
    )
    two = _even(rides).select(
        F.col("payment_type").alias("zone_class"),
        F.concat(F.lit("B"), "VendorID").alias("Dispatching_base_num"),
        times["pickup_datetime"].alias("request_datetime"),
        times["pickup_datetime"].alias("Pickup_datetime"),
        times["dropoff_datetime"].alias("DropOff_datetime"),
        F.concat("PULocationID", F.lit(".0")).alias("PUlocationID"),
        F.concat("DOLocationID", F.lit(".0")).alias("DOlocationID"),
        F.lit(None).cast("string").alias("SR_flag"),
        F.col("fare_amount").alias("airport_fee"),
        F.col("service_type").alias("wav_request"),
    )
    for month, rows in ((1, one), (2, two)):
        _raw_month(rows, base, schemas.FHV, month)
    land_months(spark, base, schemas.FHV, landed, 2021, [1, 2, 3])
    store = TableStore(spark, staging_path(spark, "store"))
    append_months(spark, month_paths(landed, schemas.FHV, 2021, [1, 2], "parquet"), store, "fhv_trips_data")
    return _plain_times(store.read("fhv_trips_data")).withColumnRenamed("Airport_fee", "airport_fee")


def _yellow_months(spark: SparkSession, sf_dir: str, landed: str) -> None:
    """Raw yellow months landed: the second has a fee that the first lacks."""
    base = staging_path(spark, "months")
    raw = raw_as_typed(spark, sf_dir, schemas.YELLOW)
    pickup, dropoff = schemas.SERVICE_TIMES[schemas.YELLOW]
    text = raw.withColumns({c: F.col(c).cast("string") for c in (pickup, dropoff)})
    odd = F.month(pickup) % 2 == 1
    fee = (F.col("passenger_count") * 0.25).alias("airport_fee")
    _raw_month(text.where(odd), base, schemas.YELLOW, 1)
    _raw_month(text.where(~odd).select("*", fee), base, schemas.YELLOW, 2)
    land_months(spark, base, schemas.YELLOW, landed, 2021, [1, 2, 3])


_FEE = f"CASE WHEN NOT {_ODD} THEN passenger_count * 0.25::DOUBLE END AS airport_fee"


@check(
    "appended_new_column",
    f"""WITH {TRIPS_SQL} SELECT {_REPAIRED_COLUMNS}, {_FEE}
    FROM trips WHERE service_type = 'yellow'""",
)
def appended_new_column(spark, sf_dir):
    """Two loads; the second brings a column that the table did not have."""
    landed = staging_path(spark, "landed")
    _yellow_months(spark, sf_dir, landed)
    store = TableStore(spark, staging_path(spark, "store"))
    for month in (1, 2):
        paths = month_paths(landed, schemas.YELLOW, 2021, [month], "parquet")
        append_months(spark, paths, store, "rides")
    return _plain_times(_named(store.read("rides"), schemas.YELLOW))


@check(
    "reloaded_month",
    f"""WITH {TRIPS_SQL}, months AS (
      SELECT *, CASE WHEN {_ODD} THEN 1 ELSE 2 END AS file_month FROM trips WHERE service_type = 'yellow'
    )
    SELECT {_REPAIRED_COLUMNS}, {_FEE}, 'yellow' AS service, 2021 AS year, file_month AS month,
      count(*) OVER (PARTITION BY file_month) AS rows, file_month::BIGINT AS loads
    FROM months""",
)
def reloaded_month(spark, sf_dir):
    """A month is loaded twice and replaced, not doubled; the ledger has both loads. A third month has no file."""
    landed = staging_path(spark, "landed")
    _yellow_months(spark, sf_dir, landed)
    store = TableStore(spark, staging_path(spark, "store"))
    for months in ([1, 2, 3], [2]):
        replace_months(spark, landed, schemas.YELLOW, 2021, months, store, "rides")
    key = ["service", "year", "month"]
    loads = store.read(LEDGER.format(table="rides")).groupBy(*key).agg(counted("loads"))
    noted = loaded_months(store, "rides").select(*key, "rows").join(loads, key)
    return _plain_times(_named(store.read("rides"), schemas.YELLOW)).join(F.broadcast(noted), key)


# --- date-partitioned tables ----------------------------------------------------


def _dated(spark: SparkSession, sf_dir: str, cluster_by: tuple[str, ...] = ()) -> DataFrame:
    path = staging_path(spark, "by-date")
    write_by_date(trips(spark, sf_dir), path, "pickup_datetime", cluster_by=cluster_by)
    return read_parquet(spark, path)


@check(
    "partition_row_counts",
    f"""WITH {TRIPS_SQL}
    SELECT 'trips_by_date' AS table_name, CAST(pickup_datetime AS DATE) AS partition_id,
      count(*) AS total_rows
    FROM trips GROUP BY 2""",
)
def partition_row_counts_query(spark, sf_dir):
    return partition_row_counts(_dated(spark, sf_dir), "trips_by_date")


@check(
    "catalogued_row_counts",
    f"""WITH {TRIPS_SQL}
    SELECT 'trips_by_date' AS table_name, CAST(pickup_datetime AS DATE) AS partition_id,
      count(*) AS total_rows
    FROM trips GROUP BY 2""",
)
def catalogued_row_counts_query(spark, sf_dir):
    """The counts that the catalogue holds after a load; reading them opens no data file."""
    path = staging_path(spark, "catalogued")
    name = f"trips_{path[-12:]}"
    arranged = by_date(trips(spark, sf_dir), "pickup_datetime")
    arranged.write.partitionBy("pickup_date").option("path", path).saveAsTable(name)
    analyze_partitions(spark, name)
    counts = catalogued_row_counts(spark, name).withColumn("table_name", F.lit("trips_by_date"))
    spark.sql(f"DROP TABLE {name}")
    return counts


@check(
    "distinct_vendors_in_range",
    f"""WITH {TRIPS_SQL} SELECT DISTINCT "VendorID" FROM trips
    WHERE CAST(pickup_datetime AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-06-30'""",
)
def distinct_vendors_in_range(spark, sf_dir):
    return distinct_vendors(_dated(spark, sf_dir), "1998-06-01", "1998-06-30")


@check(
    "vendor_trip_count",
    f"""WITH {TRIPS_SQL} SELECT count(*) AS trips FROM trips
    WHERE CAST(pickup_datetime AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1999-12-31'
      AND "VendorID" = 1""",
)
def vendor_trip_count_query(spark, sf_dir):
    dated = _dated(spark, sf_dir, cluster_by=("VendorID",))
    return vendor_trip_count(dated, "1998-06-01", "1999-12-31", 1)


@check(
    "clustered_table",
    f"""WITH {TRIPS_SQL}
    SELECT CAST(pickup_datetime AS DATE) AS pickup_date, "VendorID", count(*) AS trips,
      round(sum(total_amount), 2) AS total
    FROM trips GROUP BY 1, 2""",
)
def clustered_table(spark, sf_dir):
    dated = _dated(spark, sf_dir, cluster_by=("VendorID",))
    return dated.groupBy("pickup_date", "VendorID").agg(
        counted("trips"), total("total_amount").alias("total")
    )
