"""Tables that a stream writes batch by batch: exact after restarts, few files, cheap to keep current.

Layout below ``path``: ``batches/batch_id=N`` holds what batch N wrote, ``compacted/run=...`` what a compaction made of
all batches up to one, and ``_runs`` a line for each compaction. A batch that is run again overwrites its own
folder. A compaction is valid from the moment its line is there; readers take the last valid one and the batches after
it, so they never see a row twice or not at all.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripforge.streaming.sinks import FIVE_SECONDS, writer

BATCH = "batch_id"
_RUNS = "run string, last_batch long, rows long"
#: A task sorts its rows by partition before it writes them; so many fit its memory.
ROWS_PER_TASK = 1_000_000


def spread_by_share(df: DataFrame, column: str, tasks: int, rows_per_file: int = 0) -> DataFrame:
    """Rows dealt by ``column`` so that each value fills as many tasks as its share of the rows needs.

    A value gets one salt for each ``rows / tasks`` of its rows (or each ``rows_per_file``, if that is more), so there
    are ``tasks`` files and one for each value at most. There are more tasks if one would get more than
    ``ROWS_PER_TASK`` rows. Values with several salts are fewer than tasks: their table is broadcast. ``df`` is read
    twice.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows_"))
    total = counts.agg(F.sum("rows_").alias("n")).first()["n"] or 0
    tasks = max(tasks, -(-total // ROWS_PER_TASK))
    share = max(total / tasks, rows_per_file, 1)
    hot = counts.where(F.col("rows_") > share).select(
        F.col(column).alias("hot_"), F.ceil(F.col("rows_") / share).cast("int").alias("salts_")
    )
    salted = df.join(F.broadcast(hot), F.col(column).eqNullSafe(F.col("hot_")), "left")
    # The salt does not depend on the row's content: identical rows spread too. The seed makes it repeat in a re-run.
    salt = F.floor(F.rand(seed=1) * F.coalesce("salts_", F.lit(1))).cast("int")
    return salted.withColumn("salt_", salt).repartition(tasks, column, "salt_").drop("hot_", "salts_", "salt_")


@dataclass(frozen=True)
class BatchLog:
    """The table at ``path``, its files by the values of ``partition_by`` if given."""

    spark: SparkSession
    path: str
    partition_by: str | None = None

    @property
    def batches(self) -> str:
        return f"{self.path}/batches"

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """The rows of one batch, in place of what an earlier try of it wrote."""
        kept = batch
        if self.partition_by:
            batch.persist()
            tasks = batch.sparkSession.sparkContext.defaultParallelism
            kept = spread_by_share(batch, self.partition_by, tasks)
        try:
            self._write(kept, f"{self.batches}/{BATCH}={batch_id}")
        finally:
            if self.partition_by:
                batch.unpersist()

    def _write(self, df: DataFrame, folder: str) -> None:
        out = df.write.mode("overwrite")
        (out.partitionBy(self.partition_by) if self.partition_by else out).parquet(folder)

    def last_run(self) -> tuple[str | None, int]:
        """Folder of the last compaction, and the last batch in it (-1 if there is none)."""
        try:
            runs = self.spark.read.schema(_RUNS).json(f"{self.path}/_runs")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None, -1
        last = runs.orderBy(F.desc("last_batch"), "run").head(1)
        return (f"{self.path}/compacted/run={last[0]['run']}", last[0]["last_batch"]) if last else (None, -1)

    def _later(self, after: int) -> DataFrame | None:
        """Rows of the batches after one, with their batch; None before the first batch."""
        try:
            rows = self.spark.read.option("basePath", self.batches).parquet(self.batches)
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None
        return rows.where(F.col(BATCH) > after)

    def versions(self) -> DataFrame | None:
        """All live rows with ``batch_id``; those of a compaction have the number of its last batch."""
        folder, last = self.last_run()
        later = self._later(last)
        if folder is None:
            return later
        old = self.spark.read.parquet(folder).withColumn(BATCH, F.lit(last))
        return old if later is None else old.unionByName(later.withColumn(BATCH, F.col(BATCH).cast("int")))

    def read(self) -> DataFrame:
        """Every row that the stream wrote."""
        found = self.versions()
        if found is None:
            raise ValueError(f"no batch was written to {self.path}")
        return found.drop(BATCH)

    def compact(self, last_batch: int, rows_per_file: int = 1_000_000) -> None:
        """All rows up to a finished batch in files of about ``rows_per_file``, and one for each value at most besides.

        Small files of many batches are packed by their partition's rows. The stream goes on meanwhile.
        """
        folder, before = self.last_run()
        if last_batch <= before:
            return
        rows = self._current().where(F.col(BATCH) <= last_batch).drop(BATCH)
        count = rows.count()
        files = max(1, -(-count // rows_per_file))
        if self.partition_by:
            packed = spread_by_share(rows, self.partition_by, files, rows_per_file)
        else:
            packed = rows.repartition(files)
        run = uuid4().hex
        self._write(packed, f"{self.path}/compacted/run={run}")
        line = self.spark.createDataFrame([(run, last_batch, count)], _RUNS)
        line.coalesce(1).write.mode("append").json(f"{self.path}/_runs")

    def _current(self) -> DataFrame:
        found = self.versions()
        if found is None:
            raise ValueError(f"no batch was written to {self.path}")
        return found


@dataclass(frozen=True)
class KeyedLog(BatchLog):
    """A log of rows by key: the last row of a key counts. A batch writes the keys that changed in it only."""

    keys: tuple[str, ...] = ()

    def _current(self) -> DataFrame:
        rows = super()._current()
        values = [c for c in rows.columns if c not in (*self.keys, BATCH)]
        last = F.max_by(F.struct(*values, BATCH), BATCH).alias("last_")
        return rows.groupBy(*self.keys).agg(last).select(*self.keys, "last_.*")

    def read(self) -> DataFrame:
        """The last row of every key."""
        return self._current().drop(BATCH)


def log_sink(
    df: DataFrame, log: BatchLog, checkpoint: str, trigger: str | None = FIVE_SECONDS, mode: str = "append"
) -> StreamingQuery:
    """Write a stream's batches to a log."""
    return writer(df, mode, trigger, checkpoint).foreachBatch(log.write_batch).start()


def changes_sink(
    df: DataFrame, log: KeyedLog, checkpoint: str, trigger: str | None = FIVE_SECONDS
) -> StreamingQuery:
    """Write an aggregate's changed rows, each batch only those; the log holds the whole aggregate."""
    return log_sink(df, log, checkpoint, trigger, "update")
