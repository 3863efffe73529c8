"""Exact top-k by inner product: a KD-tree for each shard of the vectors, searched best first.

Method: rows are dealt to shards by a hash of id and vector. A task builds a shard's tree: median splits at the widest
side, a tight bounding box for every inner node and leaf, written as one row of arrays. Queries are dealt to blocks of
``QUERY_ROWS``. Within a tree a query starts at the root and always opens the node whose box allows the best
inner product; it ends when no open node can reach its kth score. The kth score is carried from tree to tree.

Trees are dealt to groups, and every block goes to every group of its vectors' length: one job, in which a task holds the
trees of one group and reads one block of queries after another. It returns k rows for each query; of a query's
rows from all groups the best k are kept. Trees are read once, whatever the number of queries.

Exact at any size: no candidate is dropped unless its box cannot reach the kth score; equal scores go to
the smaller id, and a box that can only equal the kth score is still opened. Queries times vectors is the work
asked for; memory follows the block and the group, not the table.

Defined results: vectors that are null, empty, or hold a null or a number that is not finite, take no part, nor
do rows without an id. A query meets the vectors of its own length, each length in trees of its own. A query with fewer
than k candidates returns them all. Rows that repeat an id are candidates each, but not of a query with that id.
Queries are told apart by id and vector: an id with several vectors is asked with each, equal rows are asked once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripforge.llm.batches import bound_batches
from tripforge.staging import broadcast_if_small, stage

#: Rows of a shard on average, vectors of a leaf, queries of a block, and shards that a task holds.
SHARD_ROWS, LEAF_ROWS, QUERY_ROWS, GROUP_SHARDS = 4096, 64, 2048, 32

_PACKED = "width int, part int, ids binary, points binary, low binary, high binary, nodes binary"
_FOUND = "width int, block int, place int, query_id long, vec_id long, score long"


@dataclass
class Tree:
    """Ids and points in leaf order; boxes of all nodes; of each node its two children, or -1 and -1, and its rows."""

    ids: np.ndarray
    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    nodes: np.ndarray  # left, right, first row, last row + 1

    def pack(self) -> list[bytes]:
        return [x.tobytes() for x in (self.ids, self.points, self.low, self.high, self.nodes)]

    @classmethod
    def unpack(cls, width: int, ids: bytes, points: bytes, low: bytes, high: bytes, nodes: bytes) -> Tree:
        sides = (np.frombuffer(x).reshape(-1, width) for x in (points, low, high))
        return cls(np.frombuffer(ids, np.int64), *sides, np.frombuffer(nodes, np.int64).reshape(-1, 4))


def build_tree(ids: np.ndarray, points: np.ndarray, leaf_rows: int) -> Tree:
    """Median splits at the widest side, down to leaves of ``leaf_rows`` or of equal vectors."""
    order, low, high, nodes = np.argsort(ids, kind="stable"), [], [], []
    todo = [(0, len(ids), -1, 0)]
    while todo:
        first, last, parent, side_of = todo.pop()
        rows, number = order[first:last], len(nodes)
        if parent >= 0:
            nodes[parent][side_of] = number
        least, most = points[rows].min(axis=0), points[rows].max(axis=0)
        low.append(least)
        high.append(most)
        nodes.append([-1, -1, first, last])
        side = int(np.argmax(most - least))
        if len(rows) <= leaf_rows or most[side] == least[side]:
            order[first:last] = np.sort(rows)
            continue
        half = len(rows) // 2
        order[first:last] = rows[np.argpartition(points[rows, side], half)]
        todo += [(first + half, last, number, 1), (first, first + half, number, 0)]
    return Tree(ids[order], points[order], np.array(low), np.array(high), np.array(nodes, np.int64))


def search_tree(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, best: list[list], k: int) -> None:
    """Put the tree's rows into ``best``: of each query a heap of (score, -id), k at most."""
    # What a box allows: every side at its better end.
    bounds = np.maximum(queries, 0) @ tree.high.T + np.minimum(queries, 0) @ tree.low.T
    nodes = tree.nodes.tolist()
    for q, (own, query) in enumerate(zip(query_ids.tolist(), queries)):
        heap, bound = best[q], bounds[q].tolist()
        opened = [(-bound[0], 0)]
        while opened:
            reach, number = heapq.heappop(opened)
            if len(heap) == k and -reach < heap[0][0]:
                break
            left, right, first, last = nodes[number]
            if left >= 0:
                for child in (left, right):
                    if len(heap) < k or bound[child] >= heap[0][0]:
                        heapq.heappush(opened, (-bound[child], child))
                continue
            scores = tree.points[first:last] @ query
            near = np.flatnonzero(scores >= heap[0][0]) if len(heap) == k else range(last - first)
            for i in near:
                number = int(tree.ids[first + i])
                if number == own:
                    continue
                entry = (int(scores[i]), -number)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)


def _usable(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    sides = F.col(f"`{vector}`")
    bad = F.exists(sides, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = df.where(F.col(f"`{id_column}`").isNotNull() & sides.isNotNull() & ~bad & (F.size(sides) > 0))
    return usable.select(
        F.size(sides).alias("width"), F.col(f"`{id_column}`").cast("long").alias("id"), sides.cast("array<double>").alias("v")
    )


def _dealt(rows: DataFrame, part_rows: int, name: str) -> tuple[DataFrame, DataFrame]:
    """The rows with a part of their length's, of about ``part_rows`` each; and (width, parts)."""
    counts = rows.groupBy("width").agg(F.count(F.lit(1)).alias("n"))
    parts = stage(counts.select("width", F.ceil(F.col("n") / part_rows).cast("int").alias("parts")), name)
    part = F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int").alias("part")
    return rows.join(broadcast_if_small(parts), "width").select("width", part, "id", "v"), parts


def _arrays(table: pa.Table) -> tuple[int, np.ndarray, np.ndarray]:
    table = table.combine_chunks()
    width = table.column("width")[0].as_py()
    vectors = table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, width)
    return width, table.column("id").to_numpy(), vectors


def _packed(width: int, part: int, values: list[bytes]) -> pa.Table:
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    names = [c.split()[0] for c in _PACKED.split(", ")]
    return pa.table({n: pa.array([v], t) for n, v, t in zip(names, [width, part, *values], kinds)})


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    leaf_rows: int = LEAF_ROWS,
    query_rows: int = QUERY_ROWS,
    group_shards: int = GROUP_SHARDS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its k best rows of ``vectors``.

    Both tables hold whole-number vectors as arrays of numbers; ids are long. A query's own id is no
    candidate.
    """
    spark = vectors.sparkSession

    def plant(table: pa.Table) -> pa.Table:
        width, ids, points = _arrays(table)
        return _packed(width, table.column("part")[0].as_py(), build_tree(ids, points, leaf_rows).pack())

    def bundle(table: pa.Table) -> pa.Table:
        width, ids, points = _arrays(table.sort_by("id"))
        return _packed(width, table.column("part")[0].as_py(), [ids.tobytes(), points.tobytes(), b"", b"", b""])

    dealt, shards = _dealt(bound_batches(_usable(vectors, id_column, vector)), shard_rows, "kd-shards")
    trees = stage(dealt.groupBy("width", "part").applyInArrow(plant, _PACKED), "kd-trees")
    asked, _ = _dealt(_usable(queries, id_column, vector).distinct(), query_rows, "kd-block-counts")
    blocks = stage(asked.groupBy("width", "part").applyInArrow(bundle, _PACKED), "kd-blocks")

    # Groups of a length: few trees each, and as many as there are tasks if the trees are enough.
    tasks = spark.sparkContext.defaultParallelism
    most = F.least("parts", F.greatest(F.lit(tasks), F.ceil(F.col("parts") / group_shards)))
    counted = stage(shards.select("width", most.cast("int").alias("groups")), "kd-groups")
    dealt_to = counted.agg(F.sum("groups").alias("n")).first()["n"] or 1
    groups = broadcast_if_small(counted)
    planted = trees.join(groups, "width").select(F.pmod("part", "groups").alias("group"), F.lit(0).alias("kind"), *trees.columns)
    sent = blocks.join(groups, "width").select(
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), F.lit(1).alias("kind"), *blocks.columns
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, own = None, []
        for batch in batches:
            for group, kind, width, part, ids, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if here != (width, group):
                    here, own = (width, group), []
                if kind == 0:
                    own.append(Tree.unpack(width, ids, *rest))
                    continue
                asked_ids = np.frombuffer(ids, np.int64)
                points = np.frombuffer(rest[0]).reshape(-1, width)
                best: list[list] = [[] for _ in asked_ids]
                for tree in own:
                    search_tree(tree, asked_ids, points, best, k)
                found = [
                    (width, part, place, int(q), -number, score)
                    for place, (q, heap) in enumerate(zip(asked_ids, best))
                    for score, number in heap
                ]
                columns = list(zip(*found)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    names = [c.split()[0] for c in _FOUND.split(", ")]
    kinds = [pa.int32()] * 3 + [pa.int64()] * 3
    # A group's trees come before the blocks that are searched in them, in one task and one after another.
    streamed = planted.union(sent).repartition(dealt_to, "width", "group")
    streamed = streamed.sortWithinPartitions("width", "group", "kind", "part")
    # Rows are few and large: a block or a tree at a time.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    found = stage(streamed.mapInArrow(run, _FOUND), "kd-found")
    bound_batches(found)
    # Of each query, k rows from each group.
    own_query = Window.partitionBy("width", "block", "place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(own_query))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
