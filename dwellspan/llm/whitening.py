"""Whitening of embeddings with distributed block matrices (pyspark.mllib).

Entries become whole numbers, floor(64 c) + 1,000,000, so sums and deviations are exact. Rows are indexed into blocks of some
2 MB where they are read, without a shuffle; the blocks of a task are numbered on from those of the tasks before it. Centred,
(n x - S) / n, they are a tall block matrix. Its transpose times itself is the scatter: the middle dimension is cut so that a task
multiplies a few blocks, and products are added up. The matrix that fits the driver, dimensions squared, is decomposed there.
For the projection the same blocks are laid out as a grid about as wide as high, stripe beside stripe, as the grid
partitioner deals out only squarish grids evenly; its product with a block diagonal of whitening matrices projects every row.

Rows whose vector is null, empty, or holds null or non-finite entries are dropped. Vectors of different lengths, and entries beyond
2^52 / 64, raise an error. Components without variance (to rounding) can't be whitened and are left out: a table of one
vector, or of equal vectors, has none and gives no rows, as an empty table does. Repeated rows count and are projected
each; rows without id are kept. A deviation that doesn't fit a long is null. Other columns are ignored."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.mllib.linalg import DenseMatrix, Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwellspan.session import materialise

BLOCK_VALUES = 1 << 18  # entries of a block, 2 MB of doubles
TASK_BLOCKS = 8  # blocks that a task multiplies
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
BLOCK_SCHEMA = "part int, seq bigint, dims int, ids array<bigint>, sums array<bigint>, x binary"
ROW_SCHEMA = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


@dataclass
class Whitening:
    """What was fitted: sums and number of rows, falling eigenvalues, and the unit components as columns."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def matrix(self) -> np.ndarray:
        return self.components / np.sqrt(self.values)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.n * x - self.sums) / self.n


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    scaled = np.floor(vectors.astype(float) * SCALE)
    if len(scaled) and np.abs(scaled).max() >= 1 << 52:
        raise ValueError("an entry is too large to be a whole number of 64ths exactly")
    return scaled.astype(np.int64) + SHIFT


def _pack(x: np.ndarray) -> bytes:
    small = not x.size or np.abs(x).max() < 1 << 31
    return x.astype("<i4" if small else "<i8").tobytes()


def _unpack(data: bytes, rows: int, dims: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{len(data) // (rows * dims)}").reshape(rows, dims).astype(np.int64)


def _valid(batch: pa.RecordBatch) -> tuple[np.ndarray, list, int]:
    """Whole numbers (rows, dims), ids of the rows, and dims (0: no row is left)."""
    ids, column = batch.column(0), batch.column(1)
    lengths = column.value_lengths().fill_null(0).to_numpy()
    entries = column.flatten()  # without the null vectors
    missing, values = entries.is_null().to_numpy(zero_copy_only=False), entries.fill_null(0.0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    good = lengths > 0
    good[owner[missing | ~np.isfinite(values)]] = False
    if not good.any():
        return np.empty((0, 0), np.int64), [], 0
    dims = set(lengths[good].tolist())
    if len(dims) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(dims)}")
    dims = dims.pop()
    return whole_numbers(values[good[owner]].reshape(-1, dims)), ids.filter(pa.array(good)).to_pylist(), dims


def indexed_blocks(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", block_values: int = BLOCK_VALUES) -> DataFrame:
    """The vectors as numbered blocks (number, dims, ids, sums, x): at most `block_values` entries each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, dims, ids, held = TaskContext.get().partitionId(), 0, 0, [], []

        def block(rows: int):
            nonlocal seq, ids, held
            x = np.concatenate(held)
            out = pa.RecordBatch.from_pylist([{
                "part": part, "seq": seq, "dims": dims, "ids": ids[:rows], "sums": x[:rows].sum(axis=0).tolist(), "x": _pack(x[:rows]),
            }], schema=_BLOCK)
            seq, ids, held = seq + 1, ids[rows:], [x[rows:]] if len(x) > rows else []
            return out

        for batch in batches:
            x, names, found = _valid(batch)
            if not found:
                continue
            if dims and found != dims:
                raise ValueError(f"vectors of different lengths: {sorted({found, dims})}")
            dims = found
            held.append(x)
            ids += names
            full = max(1, block_values // dims)
            while len(ids) >= full:
                yield block(full)
        if ids:
            yield block(len(ids))

    rows = vectors.select(F.col(vec_id).cast("bigint"), F.col(vector).cast("array<double>"))
    made = materialise(rows.mapInArrow(run, BLOCK_SCHEMA), "blocks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task that read the table
    parts = made.groupBy("part").agg(F.count("*").alias("held"))
    starts = parts.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    numbered = made.join(starts, "part").select((F.col("start") + F.col("seq")).alias("number"), "dims", "ids", "sums", "x")
    return materialise(numbered, "blocks")


_BLOCK = pa.schema(
    [
        ("part", pa.int32()), ("seq", pa.int64()), ("dims", pa.int32()), ("ids", pa.list_(pa.int64())),
        ("sums", pa.list_(pa.int64())), ("x", pa.binary()),
    ]
)


def _dense(values: np.ndarray, rows: int) -> DenseMatrix:
    """A full block; rows of zeros fill it up, which add nothing to products."""
    full = np.zeros((rows, values.shape[1]))
    full[: len(values)] = values
    return DenseMatrix(rows, values.shape[1], full.ravel(order="F"))


def _gram(blocks: RDD, count: int, rows: int, cols: int) -> np.ndarray:
    """Transpose times matrix of the tall matrix that is made of (number, centred values)."""
    tall = BlockMatrix(blocks.map(lambda b: ((b[0], 0), _dense(b[1], rows))), rows, cols, count * rows, cols)
    splits = max(1, -(-count // TASK_BLOCKS))
    # the call with a number of splits of the middle dimension is public in Scala; the Python method has no such argument
    wrapper, right = tall.transpose()._java_matrix_wrapper, tall._java_matrix_wrapper._java_model
    gram = BlockMatrix(wrapper.call("multiply", right, splits), cols, cols).toLocalMatrix().toArray()
    return (gram + gram.T) / 2


def _size(blocks: DataFrame) -> tuple[int, int, int]:
    """Number of blocks, rows and dimensions."""
    seen = blocks.agg(
        F.count("*").alias("blocks"), F.sum(F.size("ids")).alias("rows"), F.min("dims").alias("least"), F.max("dims").alias("dims")
    ).first()
    if seen["least"] != seen["dims"]:
        raise ValueError(f"vectors of different lengths: {seen['least']} to {seen['dims']}")
    return seen["blocks"], seen["rows"] or 0, seen["dims"] or 0


def _raw(blocks: DataFrame) -> RDD:
    return blocks.select("number", F.size("ids").alias("rows"), "dims", "x").rdd.map(
        lambda r: (r["number"], _unpack(r["x"], r["rows"], r["dims"]))
    )


def fit_whitening(blocks: DataFrame, components: int = COMPONENTS, block_values: int = BLOCK_VALUES) -> Whitening | None:
    """None if there is nothing to fit."""
    count, n, dims = _size(blocks)
    if not n:
        return None
    sums = blocks.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).orderBy("pos").collect()
    fitted = Whitening(n, np.array([r["s"] for r in sums], np.int64), np.empty(0), np.empty((dims, 0)), 0.0)
    covariance = _gram(_raw(blocks).mapValues(fitted.centred), count, max(1, block_values // dims), dims) / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(components, int((values > dims * np.finfo(float).eps * max(values[0], 0.0)).sum()) if values[0] > 0 else 0)
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(dims)] < 0, -1.0, 1.0)
    fitted.values, fitted.components, fitted.trace = values[:kept], vectors[:, :kept], float(np.trace(covariance))
    return fitted


def project(blocks: DataFrame, fitted: Whitening, block_values: int = BLOCK_VALUES) -> DataFrame:
    """(number, z): the whitened rows of each block as little-endian doubles, row by row."""
    spark, (count, _, dims) = blocks.sparkSession, _size(blocks)
    rows, kept = max(1, block_values // dims), fitted.matrix.shape[1]
    wide = int(np.ceil(np.sqrt(count)))
    high = -(-count // wide)
    placed = _raw(blocks).map(lambda b: ((b[0] // wide, b[0] % wide), _dense(fitted.centred(b[1]), rows)))
    grid = BlockMatrix(placed, rows, dims, high * rows, wide * dims)
    whitener = Matrices.dense(dims, kept, fitted.matrix.ravel(order="F").tolist())
    diagonal = spark.sparkContext.parallelize(range(wide), min(wide, 64)).map(lambda i: ((i, i), whitener))
    product = grid.multiply(BlockMatrix(diagonal, dims, kept, wide * dims, wide * kept))

    def packed(block):
        (i, j), z = block
        return i * wide + j, np.ascontiguousarray(z.toArray()).astype("<f8").tobytes()

    return spark.createDataFrame(product.blocks.map(packed), "number bigint, z binary")


def identity_error(projected: DataFrame, n: int, kept: int, rows: int) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity. `projected`: (number, z, ids)."""
    z = projected.select("number", "z", F.size("ids").alias("rows")).rdd.map(
        lambda r: (r["number"], np.frombuffer(r["z"], "<f8").reshape(-1, kept)[: r["rows"]])
    )
    mean = z.map(lambda b: b[1].sum(axis=0)).treeReduce(np.add) / n
    gram = _gram(z.mapValues(lambda v: v - mean), projected.count(), rows, kept)
    return float(np.abs(gram / n - np.eye(kept)).max())


def _long_rows(fitted: Whitening, kept: int, error: float) -> Callable:
    fields = pa.schema([
        ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()),
        ("explained", pa.float64()), ("identity_error", pa.float64()),
    ])
    explained = fitted.values / fitted.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, dims, x, z in zip(*(batch.column(i) for i in range(4))):
                ids = ids.as_py()
                rows = len(ids)
                away = fitted.n * _unpack(x.as_py(), rows, dims.as_py()) - fitted.sums
                fits = (away.astype(float) ** 2).sum(axis=1) < (1 << 63) * 0.999
                deviation = pa.array((away**2).sum(axis=1), mask=~fits)
                at = pa.array(np.repeat(np.arange(rows), kept))
                z = np.frombuffer(z.as_py(), "<f8").reshape(-1, kept)[:rows]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()).take(at), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * kept, fitted.n)), deviation.take(at), pa.array(z.ravel()),
                    pa.array(np.tile(explained, rows)), pa.array(np.full(rows * kept, error)),
                ], schema=fields)

    return run


def whiten(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, block_values: int = BLOCK_VALUES
) -> DataFrame:
    """A row for each vector and component: the whitened coordinate, the component's share of the variance, the exact deviation
    of the vector, and how far the covariance of the whole result is from the identity."""
    blocks = indexed_blocks(vectors, vec_id, vector, block_values)
    fitted = fit_whitening(blocks, components, block_values)
    if fitted is None or not len(fitted.values):
        return vectors.sparkSession.createDataFrame([], ROW_SCHEMA)
    kept = len(fitted.values)
    projected = materialise(blocks.join(project(blocks, fitted, block_values), "number"), "whitened")
    error = identity_error(projected, fitted.n, kept, max(1, block_values // len(fitted.sums)))
    return projected.select("ids", "dims", "x", "z").mapInArrow(_long_rows(fitted, kept, error), ROW_SCHEMA)
