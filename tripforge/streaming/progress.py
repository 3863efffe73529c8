"""What each batch of a stream read and rejected, kept as a table."""

from __future__ import annotations

import json
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS_SCHEMA = "query_id string, name string, batch_id long, observed string, metrics map<string, long>"


class ProgressTable(StreamingQueryListener):
    """Listens to the session's streams and writes the observed metrics of each batch below ``path``.

    A batch that is run again writes over its first lines, so each counts once. The folder names the query and the
    batch; a line is a few numbers, whatever the batch holds.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: dict[str, Event] = {}

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self._ended.setdefault(str(event.runId), Event())

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        query, batch = progress["id"], progress["batchId"]
        lines = [
            (query, progress.get("name"), batch, observed, {k: int(v) for k, v in metrics.items()})
            for observed, metrics in progress.get("observedMetrics", {}).items()
        ]
        if lines:
            rows = self.spark.createDataFrame(lines, PROGRESS_SCHEMA).coalesce(1)
            rows.write.mode("overwrite").json(f"{self.path}/query={query}/batch={batch}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), Event()).set()

    def finish(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until a query has ended and its last batch is in the table."""
        query.awaitTermination()
        if not self._ended.setdefault(str(query.runId), Event()).wait(seconds):
            raise TimeoutError(f"no end of query {query.runId} was reported")

    def read(self) -> DataFrame:
        """One row for each batch and observed metric: query_id, name, batch_id, observed, metric, value."""
        lines = self.spark.read.schema(PROGRESS_SCHEMA).json(f"{self.path}/*/*")
        return lines.select("query_id", "name", "batch_id", "observed", F.explode("metrics").alias("metric", "value"))
