"""Quality rules for unified trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge import schemas

# Rule name to the predicate a good trip satisfies.
RULES = {
    "ends_after_start": "dropoff_datetime > pickup_datetime",
    "has_passengers": "passenger_count > 0",
    "known_payment": "payment_type BETWEEN {} AND {}".format(*schemas.PAYMENT_TYPES),
    "known_vendor": f"VendorID IN ({', '.join(map(str, schemas.VENDORS))})",
    "known_pickup_zone": "PULocationID BETWEEN {} AND {}".format(*schemas.LOCATIONS),
    "known_dropoff_zone": "DOLocationID BETWEEN {} AND {}".format(*schemas.LOCATIONS),
    "known_rate": "RatecodeID BETWEEN {} AND {}".format(*schemas.RATE_CODES),
    **{
        f"{amount}_not_negative": f"{amount} >= 0"
        for amount in [
            "fare_amount",
            "total_amount",
            "trip_distance",
            "extra",
            "mta_tax",
            "tip_amount",
            "tolls_amount",
            "improvement_surcharge",
            "congestion_surcharge",
        ]
    },
}
COMPLETE = "complete"


def _complete(df: DataFrame) -> str:
    """No null and no NaN in any column, as predicates a Parquet scan can use."""
    checks = []
    for field in df.schema:
        checks.append(f"`{field.name}` IS NOT NULL")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            checks.append(f"NOT isnan(`{field.name}`)")
    return " AND ".join(checks)


def rules(df: DataFrame) -> dict[str, str]:
    """All rules for ``df``. NaN counts as large in comparisons; ``complete`` rejects it."""
    return {COMPLETE: _complete(df), **RULES}


def keep_good(df: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Trips that satisfy all rules, or the rules named in ``only``."""
    named = rules(df)
    return df.filter(" AND ".join(f"({named[name]})" for name in (only or named)))


def clean(df: DataFrame) -> DataFrame:
    """Good trips, each full-row copy kept once.

    The copies of a row collapse in the map-side half of the aggregation, so a
    row repeated any number of times sends one record per map task to the shuffle.
    """
    return keep_good(df).dropDuplicates()


def reject_counts(df: DataFrame) -> DataFrame:
    """Trips per service that fail each rule; one trip can fail several.

    A null in a comparison fails the rule. One scan, partial aggregation.
    """
    named = rules(df)
    failed = [
        F.expr(f"count_if(NOT coalesce({good}, false))").alias(name) for name, good in named.items()
    ]
    wide = df.groupBy("service_type").agg(*failed)
    return wide.unpivot("service_type", list(named), "rule", "rejected")
