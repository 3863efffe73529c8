"""One layout for every service's trips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge import schemas


def rename_times(raw: DataFrame, service: str) -> DataFrame:
    """Service-specific pickup and dropoff columns under their common names."""
    pickup, dropoff = schemas.SERVICE_TIMES[service]
    return raw.withColumnsRenamed({pickup: "pickup_datetime", dropoff: "dropoff_datetime"})


def to_common(raw: DataFrame, service: str) -> DataFrame:
    """The common columns of one service, tagged with the service name."""
    return rename_times(raw, service).select(
        *schemas.COMMON_COLUMNS, F.lit(service).alias("service_type")
    )


def unify(raw_by_service: dict[str, DataFrame]) -> DataFrame:
    """All services' trips in the common layout; copies are kept."""
    parts = [to_common(raw, service) for service, raw in raw_by_service.items()]
    return reduce(DataFrame.unionByName, parts)
