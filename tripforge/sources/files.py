"""File scans: typed CSV, Parquet, month sweeps, views over several paths."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV with a header and a fixed schema; a field that does not fit is null.

    A header with other names than the schema, or in another order, is an error. A gzip file is one task whatever its size, so land it as Parquet before real work.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    return reader.option("enforceSchema", False).schema(schema).csv(paths)


def read_text_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """CSV with every column as text, named by the header; input for type repair.

    Each path is read by its own header, so files may differ in the order and the set of
    their columns; a column that a file lacks is null there.
    """
    reader = spark.read.option("header", True).option("inferSchema", False)
    frames = [reader.csv(path) for path in ([paths] if isinstance(paths, str) else paths)]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    return whole


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def months_glob(
    base: str,
    years: Iterable[int],
    months: Iterable[int] = range(1, 13),
    prefixes: tuple[str, str] = ("", ""),
) -> str:
    """Glob over ``base/<year>/<month>``, which matches only the months that exist.

    ``prefixes`` go before year and month, for folders such as ``year=2020/month=01``.
    """
    year_part = ",".join(f"{year}" for year in years)
    month_part = ",".join(f"{month:02d}" for month in months)
    return f"{base.rstrip('/')}/{prefixes[0]}{{{year_part}}}/{prefixes[1]}{{{month_part}}}"


def read_months(
    spark: SparkSession,
    base: str,
    schema: T.StructType,
    years: Iterable[int],
    months: Iterable[int] = range(1, 13),
    prefixes: tuple[str, str] = ("", ""),
) -> DataFrame:
    """One scan over all landed months, with ``file_year`` and ``file_month`` from the path.

    A month without files is skipped and later months are still read.
    """
    raw = read_csv(spark, months_glob(base, years, months, prefixes), schema)
    # The place is in the last three names; the search need not go over those before them on every row.
    path = F.substring_index("_metadata.file_path", "/", -3)
    place = r"(\d{4})/[^/\d]*(\d{2})/[^/]*$"
    return raw.select(
        "*",
        F.regexp_extract(path, place, 1).cast("int").alias("file_year"),
        F.regexp_extract(path, place, 2).cast("int").alias("file_month"),
    )


def external_view(spark: SparkSession, name: str, *globs: str) -> DataFrame:
    """Temporary view over the Parquet files of several globs."""
    df = spark.read.parquet(*globs)
    df.createOrReplaceTempView(name)
    return df
