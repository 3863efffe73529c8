"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the distributed, centred rows.

Method: the distinct vectors are written as blocks of whole numbers (the fit list, rows A = x - S/n). The
bidiagonalisation alternates the products A v and A'u with full reorthogonalisation of both sides; the SVD of the
small bidiagonal matrix B of A V = U B yields components (right vectors) and deviations (singular values over
sqrt(n)). A left vector is as long as the table, so it is never stored: every u is A w for a vector w of the
vectors' length, a task forms the rows of A y and at once their share of A'(A y), and u's inner products are those
of w with such sums. One step is one job over the blocks; the driver holds matrices of the vectors' length only.

Vectors go in blocks of ``WIDTH`` columns: a single one finds one component only of those with equal variance.
Steps go on until the wanted triples have converged, or all directions are used up.

Defined results: vectors that are null, empty, or hold a null or a number that is not finite give no rows. Vectors of
each length are a space of their own, with its own n, components and error. A repeated vector counts once in the
fit and every row of it is returned; a null id is returned as null. Components without variance
(relative to the largest one, ``RANK_TOLERANCE``) are not numbered, so one distinct vector gives no rows. Numbers beyond
the range of a long become its bounds; a deviation beyond it is null. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripforge.llm.batches import bound_batches
from tripforge.staging import stage

COMPONENTS = 4
#: Vectors that one step multiplies.
WIDTH = 8
#: Distinct vectors in a block, and numbers in one.
BLOCK_ROWS, BLOCK_NUMBERS = 4096, 1 << 20
#: Share of the largest variance under which a direction counts as empty.
RANK_TOLERANCE = 1e-12
CONVERGED = 1e-15

_BLOCKS = "width int, numbers binary, kind string"


@dataclass
class Whitening:
    """What is fitted on the distinct vectors of one length."""

    n: int
    sums: list[int]
    components: np.ndarray  # one column for each component
    variances: np.ndarray
    total_variance: float
    identity_error: float = 0.0

    def mean(self) -> np.ndarray:
        return _quotient(self.sums, self.n)


def _quotient(sums: list[int], n: int) -> np.ndarray:
    return np.array([s / n for s in sums])  # of whole numbers, so rounded once


def whole_vectors(df: DataFrame, keep: list[str], vector: str, scale: float) -> DataFrame:
    """The ``keep`` columns as k0.. and x, floor(scale * entry) as long, of the rows with a usable vector."""
    sides = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists(sides, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    usable = df.where(sides.isNotNull() & (F.size(sides) > 0) & ~bad)
    return usable.select(*kept, F.transform(sides, lambda c: F.floor(c * scale)).alias("x"))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of a batch of vectors, the rows and the numbers of each length."""
    ends = column.offsets.to_numpy()
    numbers = column.values.to_numpy(zero_copy_only=False)
    widths = np.diff(ends)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        yield rows, numbers[ends[rows][:, None] + np.arange(width)]


def fit_list(vectors: DataFrame) -> DataFrame:
    """The distinct vectors, written as blocks of the smallest number type that holds them."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, matrix in _matrices(batch.column(0)):
                width = matrix.shape[1]
                rows = max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // width))
                parts = [matrix[at : at + rows] for at in range(0, len(matrix), rows)]
                kinds = [np.result_type(np.min_scalar_type(p.min()), np.min_scalar_type(p.max())) for p in parts]
                kinds = [k if k.kind in "iu" else np.dtype(np.int64) for k in kinds]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([width] * len(parts), pa.int32()),
                        pa.array([p.astype(k).tobytes() for p, k in zip(parts, kinds)], pa.binary()),
                        pa.array([k.str for k in kinds], pa.string()),
                    ],
                    names=["width", "numbers", "kind"],
                )

    return stage(bound_batches(vectors.select("x").distinct()).mapInArrow(pack, _BLOCKS), "fit-list")


def _read(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for width, numbers, kind in zip(*(c.to_pylist() for c in batch.columns)):
        yield np.frombuffer(numbers, np.dtype(kind)).reshape(-1, width)


def _moments(blocks: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Of each length, the number of vectors and the exact sums of their entries."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], int] = {}
        for batch in batches:
            for block in _read(batch):
                width = block.shape[1]
                small = np.abs(block.astype(float)).max() * len(block) < 2.0**62
                sums = block.sum(axis=0, dtype=np.int64 if small else object)
                for place, value in enumerate([len(block), *sums]):
                    found[width, place] = found.get((width, place), 0) + int(value)
        places = list(found)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([w for w, _ in places], pa.int32()),
                pa.array([p for _, p in places], pa.int32()),
                pa.array([str(found[p]) for p in places], pa.string()),
            ],
            names=["width", "place", "total"],
        )

    parts = bound_batches(blocks).mapInArrow(add, "width int, place int, total string")
    rows = parts.groupBy("width", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    totals: dict[int, dict[int, int]] = {}
    for r in rows:
        totals.setdefault(r["width"], {})[r["place"]] = int(r["total"])
    return {w: (t[0], [t[p] for p in range(1, w + 1)]) for w, t in totals.items()}


def normal_product(blocks: DataFrame, mean: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, float]:
    """A'(A right), and the sum of squares of A; A are the centred rows of the blocks.

    Each task sends one row for each dimension, which Spark adds up.
    """
    width, columns = right.shape

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product, squares = np.zeros((width, columns)), np.zeros(width)
        for batch in batches:
            for block in _read(batch):
                centred = block - mean
                left = centred @ right  # rows of A v
                product += centred.T @ left  # and of A'u
                squares += np.einsum("ij,ij->j", centred, centred)
        parts = [pa.array(np.arange(width, dtype=np.int32)), *map(pa.array, product.T), pa.array(squares)]
        yield pa.RecordBatch.from_arrays(parts, names=names)

    names = ["place", *(f"c{i}" for i in range(columns)), "squares"]
    schema = ", ".join(["place int", *(f"{c} double" for c in names[1:])])
    parts = bound_batches(blocks.where(F.col("width") == width)).mapInArrow(multiply, schema)
    rows = parts.groupBy("place").agg(*[F.sum(c).alias(c) for c in names[1:]]).collect()
    found = np.array([r[1:] for r in sorted(rows)], float).reshape(width, columns + 1)
    return found[:, :-1], float(found[:, -1].sum())


def _orthogonal(block: np.ndarray, against: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """An orthonormal basis of the block without ``against``, and the block's coordinates in it."""
    rest = block
    for _ in range(2):
        rest = rest - against @ (against.T @ rest)
    left, size, _ = np.linalg.svd(rest, full_matrices=False)
    basis = left[:, size > least]
    for _ in range(2):
        basis = np.linalg.qr(basis - against @ (against.T @ basis))[0] if basis.size else basis
    return basis, basis.T @ rest


class Bidiagonal:
    """A V = U B, grown block by block; ``times`` gives A'(A y) for a y of some columns.

    Left vectors are kept as ``w`` (U = A w) and ``m`` (A'U).
    """

    def __init__(self, times, width: int, block: int, seed: int = 20):
        self.times, self.width, self.block = times, width, block
        self.random = np.random.default_rng(seed)
        self.v, self.w, self.m = (np.zeros((width, 0)) for _ in range(3))
        self.b = np.zeros((0, 0))
        self.scale = 0.0

    def _fresh(self, columns: int) -> np.ndarray:
        """New directions, where the recurrence has none to offer or has run out of them."""
        columns = min(columns, self.width - self.v.shape[1])
        drawn = self.random.standard_normal((self.width, columns))
        return _orthogonal(drawn, self.v, 0.0)[0]

    def step(self) -> bool:
        """Add one block of right and of left vectors; false if there is no direction left."""
        done, last = self.v.shape[1], self.m.shape[1]
        new = np.zeros((self.width, 0))
        if last:
            # A'u without the directions known: the next right vectors.
            new, _ = _orthogonal(self.m[:, self.last_left :], self.v, 1e-13 * self.scale)
            new = new[:, : self.width - done]
        if new.shape[1] == 0:
            new = self._fresh(self.block)
        if new.shape[1] == 0:
            return False
        # A v without the left vectors known; B takes what they hold of it.
        y, q = new, self.times(new)
        known = np.zeros((last, new.shape[1]))
        for _ in range(2):
            held = self.w.T @ q
            y, q, known = y - self.w @ held, q - self.m @ held, known + held
        gram = y.T @ q
        size, turn = np.linalg.eigh((gram + gram.T) / 2)
        self.scale = max(self.scale, float(np.sqrt(max(size.max(), 0.0))))
        some = size > RANK_TOLERANCE * self.scale**2
        root = np.sqrt(size[some])
        left = turn[:, some] / root
        grown = np.zeros((last + left.shape[1], done + new.shape[1]))
        grown[:last, :done] = self.b
        grown[:last, done:] = known
        grown[last:, done:] = (turn[:, some] * root).T
        self.b, self.last_left = grown, last
        self.v = np.hstack([self.v, new])
        self.w = np.hstack([self.w, y @ left])
        self.m = np.hstack([self.m, q @ left])
        return True

    def triples(self, k: int) -> tuple[np.ndarray, np.ndarray, float]:
        """The k largest singular values, their right vectors, and how far A'u is from the space."""
        left, size, right = np.linalg.svd(self.b, full_matrices=False)
        k = min(k, int((size > np.sqrt(RANK_TOLERANCE) * max(self.scale, 1e-300)).sum()))
        outside = self.m - self.v @ (self.v.T @ self.m)
        residual = np.linalg.norm(outside @ left[:, :k], axis=0).max(initial=0.0)
        return size[:k], self.v @ right[:k].T, residual


def fit(blocks: DataFrame, n: int, sums: list[int], k: int) -> Whitening:
    """The k components of largest variance of one length of vectors."""
    mean = _quotient(sums, n)
    held = blocks.where(F.col("width") == len(sums))
    squares = 0.0

    def times(right: np.ndarray) -> np.ndarray:
        nonlocal squares
        found, squares = normal_product(held, mean, right)
        return found

    # More rows would tell nothing: n centred vectors have n - 1 directions.
    grown = Bidiagonal(times, len(sums), min(len(sums), max(WIDTH, k)))
    while grown.step():
        size, components, residual = grown.triples(k)
        if grown.v.shape[1] >= 2 * grown.block and len(size) == k and residual <= CONVERGED * grown.scale:
            break
    size, components, _ = grown.triples(k)
    found = Whitening(n, sums, components, size**2 / n, squares / n)
    if len(size):
        spread = components / np.sqrt(found.variances)
        covariance = spread.T @ times(spread) / n
        found.identity_error = float(np.abs(covariance - np.eye(len(size))).max())
    return found


def _deviations(matrix: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exactly."""
    top = 1 << 63
    largest = n * int(max(abs(int(matrix.min())), abs(int(matrix.max())))) + max(map(abs, sums))
    if largest**2 * len(sums) < top:
        apart = matrix * np.int64(n) - np.array(sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    exact = [sum((n * int(x) - s) ** 2 for x, s in zip(row, sums)) for row in matrix.tolist()]
    return [d if d < top else None for d in exact]


def whiten(
    df: DataFrame, keep: list[str], vector: str = "embedding", scale: float = 256.0, k: int = COMPONENTS
) -> DataFrame:
    """The ``keep`` columns of every row with a usable vector, once for each component: component, n,
    deviation, whitened, explained and identity_error."""
    vectors = whole_vectors(df, keep, vector, scale)
    blocks = fit_list(vectors)
    models = {w: fit(blocks, n, sums, k) for w, (n, sums) in _moments(blocks).items()}
    shared = df.sparkSession.sparkContext.broadcast(models)  # of the vectors' length, not the table's
    made = T.StructType(
        [
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    place = len(keep)
    schema = T.StructType([*vectors.schema.fields[:place], *made.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in _matrices(batch.column(place)):
                own = shared.value[matrix.shape[1]]
                found = len(own.variances)
                white = (matrix - own.mean()) @ (own.components / np.sqrt(own.variances))
                taken = batch.take(pa.array(np.repeat(rows, found)))
                explained = own.variances / own.total_variance if found else own.variances
                yield pa.RecordBatch.from_arrays(
                    [
                        *taken.columns[:place],
                        pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), len(rows)), pa.int32()),
                        pa.array(np.full(len(rows) * found, own.n), pa.int64()),
                        pa.array(np.repeat(np.array(_deviations(matrix, own.n, own.sums), object), found), pa.int64()),
                        pa.array(white.ravel(), pa.float64()),
                        pa.array(np.tile(explained, len(rows)), pa.float64()),
                        pa.array(np.full(len(rows) * found, own.identity_error), pa.float64()),
                    ],
                    names=schema.names,
                )

    whitened = bound_batches(vectors).mapInArrow(run, schema)
    return whitened.toDF(*keep, *made.names)
