"""Dense, reproducible surrogate keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripforge.staging import stage

# monotonically_increasing_id() is documented to hold the partition number in
# the upper bits and the row number within the partition in the lower 33.
_ROW_BITS = 33


def with_surrogate_key(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Number rows 1..n in the order of ``keys``, which must identify a row.

    Equal to ``row_number() OVER (ORDER BY keys)``. The rows are range-partitioned by the whole key, so even a leading value
    shared by most rows is split, sorted, and written once. Each row's id is its place
    in its range plus the rows in earlier ranges. Both are read from the written
    table, so the ids cannot drift between passes. The result is backed by written
    tables and is cheap to use again.
    """
    placed = stage(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id()),
        id_col,
    )
    located = placed.withColumns(
        {
            "_range": F.shiftright("_place", _ROW_BITS),
            "_row": F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: never more than spark.sql.shuffle.partitions.
    offsets = stage(
        located.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")),
        f"{id_col}-offsets",
    )
    return located.join(F.broadcast(offsets), "_range").select(
        *df.columns, (F.col("_before") + F.col("_row") + 1).alias(id_col)
    )


def extend_surrogate_key(stored: DataFrame, df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """The natural keys of ``df`` that ``stored`` lacks, with ids that go on after its largest.

    Stored ids do not change, and old and new ones together are dense again. Only the new keys are sorted and
    numbered. Null keys equal each other. ``stored`` is ``(keys, id_col)`` and has ids 1..n.
    """
    known = stored.select(*[F.col(k).alias(f"known_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"known_{k}")) for k in keys])
    new = df.select(*keys).distinct().join(known, same, "left_anti")
    top = stored.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top")).first()["top"]
    return with_surrogate_key(new, keys, id_col).withColumn(id_col, F.col(id_col) + top)
