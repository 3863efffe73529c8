"""Topic messages: trips and counts as ``(key, value)`` text, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge import schemas
from tripforge.functions.text import message_time


def _delimited(columns: list[str]) -> Column:
    # concat_ws drops nulls, which would shift every later field.
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.concat_ws(schemas.MESSAGE_SEPARATOR, *texts)


def to_delimited_messages(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One message per row: ``columns`` in order, joined by the separator."""
    return df.select(F.col(key).cast("string").alias("key"), _delimited(columns).alias("value"))


def parse_delimited(messages: DataFrame, schema: T.StructType = schemas.RIDE_SCHEMA) -> DataFrame:
    """Rides from delimited messages, batch or stream.

    Field i of the schema takes token i. A missing token or one that does not
    parse gives null; surplus tokens are ignored.
    """
    tokens = messages.select(
        F.split(F.col("value").cast("string"), schemas.MESSAGE_SEPARATOR).alias("tokens")
    )
    return tokens.select(
        [
            F.get("tokens", F.lit(i)).try_cast(field.dataType).alias(field.name)
            for i, field in enumerate(schema)
        ]
    )


# Names under which JSON rides carry the coded columns.
_JSON_NAMES = {
    "RatecodeID": "rate_code_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
}


def to_json_rides(rides: DataFrame) -> DataFrame:
    """Rides in the columns and types of JSON messages, from typed or text columns."""
    renamed = rides.withColumnsRenamed(_JSON_NAMES)
    columns = []
    for field in schemas.JSON_RIDE_SCHEMA:
        kind = field.dataType
        if isinstance(kind, T.TimestampType):
            kind = T.StringType()
        columns.append(F.col(field.name).try_cast(kind).alias(field.name))
    return renamed.select(columns)


def to_json_messages(df: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """One JSON object per row. Times are plain text and amounts are quoted decimals."""
    fields = []
    for name in columns or df.columns:
        kind = df.schema[name].dataType
        as_text = isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DecimalType))
        fields.append(F.col(name).cast("string").alias(name) if as_text else F.col(name))
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def parse_json(messages: DataFrame, schema: T.StructType = schemas.JSON_RIDE_SCHEMA) -> DataFrame:
    """Rides from JSON messages, batch or stream; what does not parse is null.

    Times are accepted bare or as one-element arrays, numbers bare or quoted.
    """
    as_text = T.StructType([T.StructField(field.name, T.StringType()) for field in schema])
    ride = messages.select(F.from_json(F.col("value").cast("string"), as_text).alias("ride"))

    def typed(field: T.StructField) -> Column:
        text = F.col("ride").getField(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return message_time(text)
        return text.try_cast(field.dataType)

    return ride.select([typed(field).alias(field.name) for field in schema])


def count_messages(
    df: DataFrame, value_columns: list[str], key_column: str | None = None
) -> DataFrame:
    """Aggregate rows as messages. A window column is sent as its start and end."""
    names, flat = [], df
    for name in value_columns:
        if isinstance(df.schema[name].dataType, T.StructType):
            for bound in df.schema[name].dataType.names:
                names.append(f"{name}_{bound}")
                flat = flat.withColumn(names[-1], F.col(name).getField(bound))
        else:
            names.append(name)
    key = F.col(key_column).cast("string") if key_column else F.lit(None).cast("string")
    return flat.select(key.alias("key"), _delimited(names).alias("value"))


def first_messages(messages: DataFrame, n: int) -> DataFrame:
    """The first ``n`` messages of a file, as a publishing sample."""
    return messages.limit(n)
