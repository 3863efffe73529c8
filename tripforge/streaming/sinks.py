"""Stream sinks. Each returns the started query; each query owns its checkpoint."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tripforge.sources.topics import TOPIC_FORMAT
from tripforge.staging import shared_folder

FIVE_SECONDS = "5 seconds"


def writer(df: DataFrame, mode: str, trigger: str | None, checkpoint: str | None) -> DataStreamWriter:
    """A stream's writer; without an interval it takes what is there, in batches, and stops."""
    out = df.writeStream.outputMode(mode)
    out = out.trigger(processingTime=trigger) if trigger else out.trigger(availableNow=True)
    return out.option("checkpointLocation", checkpoint) if checkpoint else out


def console_sink(
    df: DataFrame,
    checkpoint: str,
    mode: str = "complete",
    trigger: str | None = FIVE_SECONDS,
    rows: int = 20,
) -> StreamingQuery:
    """Print the first rows of each batch; no more than those reach the driver."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"Batch {batch_id}")
        batch.show(rows, truncate=False)

    return writer(df, mode, trigger, checkpoint).foreachBatch(show).start()


def memory_sink(
    df: DataFrame, name: str, query: str, mode: str = "append", checkpoint: str | None = None
) -> tuple[DataFrame, StreamingQuery]:
    """Keep the output in driver memory and query it; for looking at small results.

    ``query`` names the table as ``{table_name}``. The input present at the start is
    processed before the query runs, so the answer is never that of an empty table. The checkpoint is
    in the shared folder; only complete results can be resumed from it, so by default each start has its own.
    """
    place = checkpoint or new_checkpoint(df, f"memory-{name}-{uuid4().hex}")
    out = df.writeStream.outputMode(mode).format("memory").queryName(name)
    running = out.option("checkpointLocation", place).start()
    running.processAllAvailable()
    return df.sparkSession.sql(query.format(table_name=name)), running


def topic_sink(
    messages: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    mode: str = "complete",
    trigger: str | None = FIVE_SECONDS,
) -> StreamingQuery:
    out = writer(messages, mode, trigger, checkpoint).format(TOPIC_FORMAT)
    return out.option("kafka.bootstrap.servers", servers).option("topic", topic).start()


def gather(df: DataFrame, column: str, spread: int) -> DataFrame:
    """Bring each value of ``column`` into at most ``spread`` tasks.

    The salt does not depend on the row, so a hot value, even one of identical rows,
    fills its tasks evenly. The fixed seed makes it repeat when a task is run again.
    """
    return df.repartition(F.col(column), F.floor(F.rand(seed=1) * spread))


def file_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: str | None = "PULocationID",
    trigger: str | None = FIVE_SECONDS,
    mode: str = "append",
    fmt: str = "parquet",
    spread: int = 8,
) -> StreamingQuery:
    """Append rows as files by zone, at most ``spread`` files per zone and batch.

    Without the gathering, a batch would leave one file per zone and task.
    """
    rows = gather(df, partition_by, spread) if partition_by else df
    out = writer(rows, mode, trigger, checkpoint).format(fmt).option("path", path)
    return (out.partitionBy(partition_by) if partition_by else out).start()


def table_sink(
    df: DataFrame,
    table: str,
    checkpoint: str,
    fmt: str | None = None,
    trigger: str | None = FIVE_SECONDS,
    mode: str = "append",
    path: str | None = None,
) -> StreamingQuery:
    """Append to a table: of the catalog, or of the connector ``fmt``."""
    out = writer(df, mode, trigger, checkpoint)
    if fmt:
        return out.format(fmt).option("table", table).start()
    return (out.option("path", path) if path else out).toTable(table, format="parquet")


def snapshot_path(path: str, batch_id: int) -> str:
    """Where :func:`snapshot_sink` keeps the result of a batch: two folders in turn."""
    return f"{path}/slot={batch_id % 2}"


def snapshot_sink(
    df: DataFrame, path: str, checkpoint: str, trigger: str | None = FIVE_SECONDS
) -> StreamingQuery:
    """The whole aggregate after each batch, as Parquet; the last two results are kept.

    A batch that is run again overwrites its own folder and leaves the one before
    readable, so a restart neither doubles nor loses a result.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(snapshot_path(path, batch_id))

    return writer(df, "complete", trigger, checkpoint).foreachBatch(write).start()


def fan_out_sink(
    df: DataFrame, paths: list[str], checkpoint: str, trigger: str | None = FIVE_SECONDS
) -> StreamingQuery:
    """Several file sinks off one read of the source.

    The batch is kept while it is written to each path, in a folder per batch that a
    re-run overwrites.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for path in paths:
                batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return writer(df, "append", trigger, checkpoint).foreachBatch(write).start()


def new_checkpoint(df: DataFrame, name: str) -> str:
    """Checkpoint folder for a named query. Keep the name to resume the query."""
    return f"{shared_folder(df.sparkSession)}/streams/{name}"
