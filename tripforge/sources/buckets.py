"""Catalog tables dealt into buckets by their keys, so that joins on the keys need no exchange.

A bucket is read by one task, and no shuffle is left for the skew-join rule to split. So the rows of hot keys, those with
more rows than a bucket has on average, are kept apart: at most ``buckets`` keys, their rows in a plain companion table
that joins by the ordinary rules. Tables that are to be joined share the set of hot keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.staging import stage

HOT = "_hot"
#: Rows that a key may have whatever the table's size.
HOT_ROWS = 10_000


def hot_keys(df: DataFrame, keys: list[str], buckets: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys with more rows than a bucket has on average, written: fewer than ``buckets`` of them."""
    counts = stage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_")), "key-counts")
    total = counts.agg(F.sum("rows_").alias("n")).first()["n"] or 0
    return stage(counts.where(F.col("rows_") > max(hot_rows, total / buckets)).select(*keys), "hot-keys")


@dataclass(frozen=True)
class BucketStore:
    """Bucketed tables in the session's catalog, named ``prefix`` + name, with their files below ``location``."""

    spark: SparkSession
    location: str
    prefix: str
    buckets: int = 64

    def address(self, name: str) -> str:
        return f"{self.prefix}{name}"

    def write(
        self, df: DataFrame, name: str, keys: list[str], hot: DataFrame | None = None, mode: str = "errorifexists"
    ) -> None:
        """The table by ``keys``, one sorted file for each bucket, and the rows of the ``hot`` keys beside it."""
        rest = df
        apart = df.limit(0)
        if hot is not None and not hot.isEmpty():
            named = F.broadcast(hot.toDF(*[f"hot_{k}" for k in keys]))  # fewer rows than buckets
            same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"hot_{k}")) for k in keys])
            rest, apart = df.join(named, same, "left_anti"), df.join(named, same, "left_semi")
        dealt = rest.repartition(self.buckets, *keys).write.bucketBy(self.buckets, *keys).sortBy(*keys)
        for writer, table in ((dealt, name), (apart.write, name + HOT)):
            path = f"{self.location.rstrip('/')}/{table}"
            writer.mode(mode).format("parquet").option("path", path).saveAsTable(self.address(table))

    def read(self, name: str) -> DataFrame:
        """The bucketed part: all rows but those of hot keys."""
        return self.spark.table(self.address(name))

    def read_hot(self, name: str) -> DataFrame:
        return self.spark.table(self.address(name + HOT))

    def forget(self, *names: str) -> None:
        """Take the tables out of the catalog; their files, and frames already read, stay."""
        for name in names:
            for table in (name, name + HOT):
                self.spark.sql(f"DROP TABLE IF EXISTS {self.address(table)}")
