"""Text to typed values. A value that does not parse gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripforge.schemas import TIMESTAMP_FORMAT


def whole_number(value: Column) -> Column:
    """Nullable 64-bit integer; ``1`` and ``1.0`` pass, a fraction gives null."""
    text = value.cast("string")
    # A cast that fails costs an exception, so what no whole or decimal number holds is not cast.
    whole = F.when(~F.rlike(text, F.lit(r"[.A-Za-z]")), text.try_cast("bigint"))
    number = F.when(~F.rlike(text, F.lit(r"[A-DF-Za-df-z]")), text.try_cast("decimal(38,10)"))
    from_float = F.when(number == F.floor(number), number.try_cast("bigint"))
    return F.coalesce(whole, from_float)


def real_number(value: Column) -> Column:
    """Double from text. Only what may be a number is cast: a cast that fails costs an exception."""
    return F.when(F.rlike(value, F.lit(r"^[\x00-\x20]*[+-]?[0-9.nNiI]")), value.try_cast("double"))


def yes_no(value: Column) -> Column:
    """``Y``/``N`` as boolean; anything else is null."""
    return F.when(value == "Y", True).when(value == "N", False)


def parse_timestamp(value: Column) -> Column:
    """Timestamp from text (a timestamp passes through).

    The cast reads the format too, except for years that it takes for too long; only texts of the format's shape
    that it refuses are parsed by the format, as a parse that fails costs an exception.
    """
    text = value.cast("string")
    shaped = F.rlike(text, F.lit(r"^[+-]?\d{4,}-\d\d-\d\d \d\d:\d\d:\d\d$"))
    return F.coalesce(
        value.try_cast("timestamp"), F.when(shaped, F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT)))
    )


def message_time(value: Column) -> Column:
    """Timestamp from message text, either bare or wrapped in a one-element JSON array."""
    bare = F.btrim(value, F.lit('[]"'))
    return F.try_to_timestamp(bare, F.lit(TIMESTAMP_FORMAT))
