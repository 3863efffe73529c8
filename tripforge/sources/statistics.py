"""Row counts of partitions from the catalogue, without a look at the data."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Partitions that are asked for at a time.
ASKED = 16


def analyze_partitions(spark: SparkSession, table: str, date_col: str = "pickup_date") -> None:
    """Let the catalogue count the rows of every partition: one job, to be run after a load."""
    spark.sql(f"ANALYZE TABLE {table} PARTITION ({date_col}) COMPUTE STATISTICS")


def _rows_of(spark: SparkSession, table: str, date_col: str, value: str) -> int | None:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({date_col} = '{value}')")
    told = described.where(F.col("col_name") == "Partition Statistics").collect()
    found = re.search(r"(\d+) rows", told[0]["data_type"]) if told else None
    return int(found.group(1)) if found else None


def catalogued_row_counts(spark: SparkSession, table: str, date_col: str = "pickup_date") -> DataFrame:
    """Rows of each date partition as the catalogue has them, largest first.

    A partition that was not analysed has a null count. The answer is as large as the list of partitions, which the
    catalogue keeps in any case; no file of the table is opened.
    """
    listed = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    dates = [None if d == "__HIVE_DEFAULT_PARTITION__" else d for d in listed]
    with ThreadPoolExecutor(ASKED) as pool:
        counts = list(pool.map(lambda d: d and _rows_of(spark, table, date_col, d), dates))
    rows = spark.createDataFrame(list(zip(dates, counts)), "partition_id string, total_rows long")
    return rows.select(
        F.lit(table).alias("table_name"), F.col("partition_id").cast("date").alias("partition_id"), "total_rows"
    ).orderBy(F.desc("total_rows"), "partition_id")
