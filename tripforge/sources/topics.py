"""Message topics. The connector package comes with spark-submit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripforge.schemas import MESSAGE_SCHEMA

TOPIC_FORMAT = "kafka"


def topic_options(
    servers: str, topic: str, starting: str = "latest", fail_on_loss: bool = False
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_loss).lower(),
    }


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options: str
) -> DataFrame:
    """Topic as a stream; ``starting='earliest'`` replays it from the beginning.

    Cap a batch with ``maxOffsetsPerTrigger`` where the backlog is large.
    """
    reader = spark.readStream.format(TOPIC_FORMAT)
    return reader.options(**topic_options(servers, topic, starting), **options).load()


def read_message_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Stream over a folder of Parquet ``(key, value)`` files.

    With ``files_per_batch`` the files must have been written in the order of event time:
    a watermark that has passed with one batch drops older rows of the next.
    """
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
