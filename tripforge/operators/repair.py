"""Type repair for landed records whose columns arrived as text or floats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge import schemas
from tripforge.functions.text import parse_timestamp, whole_number, yes_no
from tripforge.operators.reconcile import canonical_names, column_kinds, typed

# Columns that hold whole numbers in every service's files.
_WHOLE_NUMBERS = [
    "VendorID",
    "passenger_count",
    "RatecodeID",
    "payment_type",
    "PULocationID",
    "DOLocationID",
    "SR_Flag",
]
_FLAG = "store_and_fwd_flag"


def with_layout_names(raw: DataFrame, service: str) -> DataFrame:
    """The columns that the service's layout has in another case, in the layout's spelling."""
    named = canonical_names(raw, schemas.SERVICE_SCHEMAS[service].names)
    missing = [c for c in schemas.SERVICE_TIMES[service] if c not in named.columns]
    if missing:
        raise ValueError(f"the {service} file has no column {missing}")
    return named


def unknown_columns(named: DataFrame, service: str) -> list[str]:
    """Text columns outside the service's layout."""
    known = schemas.SERVICE_SCHEMAS[service].names
    return [f.name for f in named.schema if f.name not in known and isinstance(f.dataType, T.StringType)]


def unknown_kinds(raw: DataFrame, service: str) -> dict[str, str]:
    """What the columns outside the layout hold, by one pass over the file if it has any."""
    named = with_layout_names(raw, service)
    return column_kinds(named, unknown_columns(named, service))


def repair_types(raw: DataFrame, service: str, kinds: dict[str, str] | None = None) -> DataFrame:
    """Timestamps, numbers, nullable integers and booleans; each only where the column exists.

    Names are matched without regard to case. Values that do not fit become null. An unknown flag is null too, not true.
    Text columns outside the layout get the type of ``kinds``, by default what they hold in this file.
    """
    named = with_layout_names(raw, service)
    times = schemas.SERVICE_TIMES[service]
    fixes = {
        field.name: F.col(field.name).try_cast(field.dataType)
        for field in schemas.SERVICE_SCHEMAS[service]
        if field.name in named.columns and field.name not in times
    }
    fixes.update({name: parse_timestamp(F.col(name)) for name in times})
    fixes.update({c: whole_number(F.col(c)) for c in _WHOLE_NUMBERS if c in named.columns})
    if _FLAG in named.columns:
        fixes[_FLAG] = yes_no(F.col(_FLAG))
    unknown = unknown_columns(named, service)
    held = {k.lower(): v for k, v in (column_kinds(named, unknown) if kinds is None else kinds).items()}
    fixes.update({c: typed(F.col(f"`{c}`"), held[c.lower()]) for c in unknown if c.lower() in held})
    return named.withColumns(fixes)
