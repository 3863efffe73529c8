"""Clean, star, revenue and report jobs."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge import schemas
from tripforge.operators.dims import DIMENSIONS, KEYS, dim_datetime, dim_trip, grow
from tripforge.operators.fact import fact_table, fact_table_broadcast
from tripforge.operators.quality import clean
from tripforge.operators.reports import analytics_report, overview_report
from tripforge.operators.revenue import monthly_revenue
from tripforge.operators.unify import to_common, unify
from tripforge.sinks.files import append_counted, with_date, write_single_file
from tripforge.sources.files import read_parquet
from tripforge.sources.tables import TableStore
from tripforge.staging import stage

# Table names.
RAW = "{service}_trips_data"
CLEANED = "{service}_trips_data_cleaned"
ALL_CLEANED = "trips_data_cleaned"
FACT = "fact_table"
ZONES = "zones"
SERVICES = [schemas.GREEN, schemas.YELLOW]
CODE_DIMS = ["dim_passenger", "dim_location", "dim_rate", "dim_payment_type"]


def clean_all(raw_by_service: dict[str, DataFrame]) -> DataFrame:
    """Cleaned trips of all services. Copies never span services: the tag differs."""
    return clean(unify(raw_by_service))


def run_clean(store: TableStore, input_table: str, mode: str = "errorifexists") -> list[str]:
    """Clean one service's table, or with ``all...`` both and their union; names written.

    For ``all`` the trips are cleaned once; the tables per service are cut from the result, side by side.
    """
    if input_table.startswith("all"):
        raw = {s: store.read(RAW.format(service=s)) for s in SERVICES}
        # By service, so that each cut below reads its own part only.
        store.write(clean_all(raw), ALL_CLEANED, mode, partition_by="service_type")
        cleaned = store.read(ALL_CLEANED)
        parts = {CLEANED.format(service=s): cleaned.filter(F.col("service_type") == s) for s in SERVICES}
        with ThreadPoolExecutor(len(parts)) as pool:
            list(pool.map(lambda name: store.write(parts[name], name, mode), parts))
        return [*[CLEANED.format(service=s) for s in SERVICES], ALL_CLEANED]
    service = next((s for s in SERVICES if input_table.startswith(s)), None)
    if service is None:
        raise ValueError(f"no service known for table {input_table!r}")
    output = f"{input_table}_cleaned"
    store.write(clean(to_common(store.read(input_table), service)), output, mode)
    return [output]


def build_dims(trips: DataFrame) -> dict[str, DataFrame]:
    """All six dimensions of stored ``trips``, numbered and ready for repeated use.

    Two scans: one for the time pairs and distances, one for the distinct combinations of all codes, which
    the four small dimensions are then cut from. The dimensions are independent Spark jobs, so they are
    submitted side by side. The time pairs are taken from ``dim_trip``, which is narrower than the trips.
    """

    def trip_and_datetime() -> dict[str, DataFrame]:
        moments = dim_trip(trips)
        return {"dim_trip": moments, "dim_datetime": dim_datetime(moments)}

    with ThreadPoolExecutor(len(CODE_DIMS) + 1) as pool:
        large = pool.submit(trip_and_datetime)
        codes = code_combinations(trips)
        small = dict(zip(CODE_DIMS, pool.map(lambda name: DIMENSIONS[name](codes), CODE_DIMS)))
        return {**small, **large.result()}


def code_combinations(trips: DataFrame) -> DataFrame:
    """The distinct combinations of the codes that the small dimensions are keyed by, written."""
    return stage(trips.select(*[k for name in CODE_DIMS for k in KEYS[name][0]]).distinct(), "codes")


def run_grow_dims(trips: DataFrame, target: TableStore) -> dict[str, int]:
    """Add to the stored dimensions what further trips need; rows added to each.

    Stored ids stay, so facts that were written before keep their meaning. Every dimension's new rows are written
    to the shared folder before they are appended to the table that they were told apart from.
    """
    codes = code_combinations(trips)
    added = {}
    for name in DIMENSIONS:
        source = codes if name in CODE_DIMS else trips
        new = stage(grow(name, target.read(name), source), f"{name}-new")
        added[name] = append_counted(new, target, name)
    return added


def run_dims(trips: TableStore, target: TableStore, mode: str = "errorifexists") -> list[str]:
    dims = build_dims(trips.read(ALL_CLEANED))
    target.write_all(dims, mode)
    return list(dims)


def run_fact(
    trips: TableStore, target: TableStore, mode: str = "errorifexists", broadcast: bool = False
) -> list[str]:
    dims = target.read_all(list(DIMENSIONS))
    assemble = fact_table_broadcast if broadcast else fact_table
    target.write(assemble(trips.read(ALL_CLEANED), dims), FACT, mode)
    return [FACT]


def run_revenue(
    trips: DataFrame,
    path: str | None = None,
    store: TableStore | None = None,
    name: str = "monthly_revenue",
) -> None:
    """Monthly revenue to one Parquet file or to a table."""
    revenue = monthly_revenue(trips)
    if path:
        write_single_file(revenue, path)
    if store:
        store.write(revenue, name)


def trips_from_paths(spark: SparkSession, green: str, yellow: str) -> DataFrame:
    """Unified trips from one Parquet path per service."""
    return unify(
        {schemas.GREEN: read_parquet(spark, green), schemas.YELLOW: read_parquet(spark, yellow)}
    )


def run_reports(store: TableStore, output: str, mode: str = "overwrite") -> list[str]:
    """Both report tables, partitioned by pickup date: tables of the store at ``output``."""
    target = TableStore(store.spark, output, store.fmt)
    fact, zones = store.read(FACT), store.read(ZONES)
    dims = store.read_all(list(DIMENSIONS))
    reports = {"overview_report": overview_report, "analytics_report": analytics_report}
    for name, report in reports.items():
        rows = with_date(report(fact, dims, zones), "pickup_datetime")
        target.write(rows, name, mode, partition_by="pickup_date")
    return list(reports)
