"""Session settings the jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings. AQE sizes the reduce side from real shuffle sizes,
# splits hot join keys and rebalanced partitions, and turns a join whose side
# proves small into a broadcast.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Keep small stages parallel: a partitioned write is bound by its files, not its bytes.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A join on more columns than its input is partitioned by keeps that partitioning: the trips
    # meet both of their near-fact-size dimensions after one shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # HotSpot does not compile methods above 8000 bytes of bytecode. Long rule chains and
    # wide aggregates exceed that as one generated method; below it Spark splits the work.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    # Times in 64 bits rather than 96: quicker to write and read, smaller, and with the statistics that scans skip by.
    # A table may hold files of both kinds.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Stream state larger than executor memory belongs in RocksDB.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


# Settings a session must start with. Recording the Python call site of every column
# expression costs milliseconds each and helps only while debugging.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


# A shuffle starts with so many partitions for each core of the cluster, and AQE joins the small ones.
PARTITIONS_PER_CORE = 4
#: Shuffled bytes that one partition should get.
PARTITION_BYTES = 128 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_partitions(spark: SparkSession, input_bytes: int = 0) -> int:
    """Partitions that a shuffle starts with: for the cluster's cores or the job's input, whichever asks for more."""
    by_cores = PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
    return max(by_cores, -(-input_bytes // PARTITION_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))


def size_shuffles(spark: SparkSession, input_bytes: int = 0) -> SparkSession:
    """Let the shuffles of batch jobs start with enough partitions that each fits a task's memory.

    Range partitioning without a number, as that of the surrogate keys, and full-row de-duplication follow it too.
    Streams do not: their state keeps ``spark.sql.shuffle.partitions``.
    """
    spark.conf.set(_INITIAL, str(shuffle_partitions(spark, input_bytes)))
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings on an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tripforge", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the job settings; the master comes from spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **START_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
