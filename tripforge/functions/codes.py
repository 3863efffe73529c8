"""Code lists and bands as built-in expressions; unknown codes give null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripforge import schemas


def _lookup(code: str, names: dict[int, str]) -> Column:
    pairs = [F.lit(part) for item in names.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), F.col(code))


def rate_name(code: str) -> Column:
    return _lookup(code, schemas.RATE_NAMES)


def payment_name(code: str) -> Column:
    return _lookup(code, schemas.PAYMENT_NAMES)


def tip_band(tip: str, fare: str, tolls: str) -> Column:
    """Label of the tip's share of fare, tip and tolls.

    The share of a bill that sums to zero is null and so falls in the top band.
    """
    bill = F.col(fare) + F.col(tip) + F.col(tolls)
    percent = F.round(F.try_divide(F.col(tip) * F.lit(100), bill), 2)
    band = F.when(F.col(tip) == 0, schemas.NO_TIP)
    for upper, label in schemas.TIP_BANDS:
        band = band.when(percent <= upper, label)
    return band.otherwise(schemas.TOP_TIP_BAND)
