"""Parquet and table writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tripforge.sources.tables import TableStore
from tripforge.sources.topics import TOPIC_FORMAT
from tripforge.staging import byte_size

#: Bytes of rows, as :func:`byte_size` counts them, that one task writes to a file.
FILE_BYTES = 256 << 20


def write_parquet(
    df: DataFrame,
    path: str,
    files: int | None = None,
    mode: str = "errorifexists",
    compression: str | None = None,
    **options: str,
) -> None:
    """Parquet in ``files`` equal files (round robin, so no key can fill one of them).

    There are more files if one would hold more than ``FILE_BYTES`` of rows, as a task writes each of them.
    """
    if files:
        df = df.repartition(max(files, -(-byte_size(df) // FILE_BYTES)))
    writer = df.write.mode(mode).options(**options)
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)


def write_single_file(df: DataFrame, path: str) -> None:
    """One Parquet file, replacing what was there. For small aggregates only.

    The repartition keeps the aggregation itself parallel; only its result rows
    meet in the one writing task.
    """
    df.repartition(1).write.mode("overwrite").parquet(path)


def with_date(df: DataFrame, ts: str, date_col: str = "pickup_date") -> DataFrame:
    return df.withColumn(date_col, F.to_date(ts))


def by_date(
    df: DataFrame, ts: str, date_col: str = "pickup_date", cluster_by: tuple[str, ...] = ()
) -> DataFrame:
    """Rows arranged for a date-partitioned write.

    REBALANCE brings a date together so that it makes few files, yet lets AQE split
    a date too large for one task. ``cluster_by`` sorts within each file, so that
    row-group statistics skip data for filters on those columns.
    """
    dated = with_date(df, ts, date_col).hint("rebalance", date_col)
    return dated.sortWithinPartitions(date_col, *cluster_by) if cluster_by else dated


def write_by_date(
    df: DataFrame,
    path: str,
    ts: str,
    date_col: str = "pickup_date",
    cluster_by: tuple[str, ...] = (),
    mode: str = "errorifexists",
) -> None:
    arranged = by_date(df, ts, date_col, cluster_by)
    arranged.write.mode(mode).partitionBy(date_col).parquet(path)


def replace_table(
    df: DataFrame, name: str, path: str | None = None, partition_by: str | None = None
) -> None:
    """Create or replace a catalog table from ``df``; external when ``path`` is given."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def append_counted(df: DataFrame, store: TableStore, name: str) -> int:
    """Append to a table and return the rows loaded, counted during the write itself.

    Columns are matched by name without regard to case. The table gets columns that it lacks, and one that its type
    might not hold is an error.
    """
    loaded = Observation()
    observed = df.observe(loaded, F.count(F.lit(1)).alias("rows"))
    store.append(observed, name)
    return loaded.get["rows"]


def publish(messages: DataFrame, servers: str, topic: str, acks: str = "all") -> None:
    """Send ``(key, value)`` rows to a topic, one writer per partition."""
    (
        messages.write.format(TOPIC_FORMAT)
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", acks)
        .option("topic", topic)
        .save()
    )
