"""What the vector operators share: whole vectors in Arrow blocks, fixed-point components, exact integer products."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of the largest matrix of doubles that is worked on at once.
BLOCK_BYTES = 8 << 20
#: Whole numbers below this are exact as doubles.
EXACT = 2.0**53


def vector_rows(frame: DataFrame, vector_col: str, **columns: str) -> DataFrame:
    """Only the columns that an operator reads, under its own names, so that no other column can clash."""
    kept = [F.col(c).alias(name) for name, c in columns.items()]
    return frame.select(*kept, F.col(vector_col).cast("array<double>").alias("vector"))


def blocks(batch: pa.RecordBatch, length: int, scale: float, limit: float) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows whose vector has `length` components, none null or not finite, in pieces of at most BLOCK_BYTES, each with
    the matrix of floor(scale * component). A scaled component of `limit` or more counts as not finite."""
    sizes = pc.fill_null(pc.list_value_length(batch.column("vector")), -1)
    rows = batch.filter(pc.equal(sizes, length))
    step = max(1, BLOCK_BYTES // (8 * length))
    for at in range(0, rows.num_rows, step):
        piece = rows.slice(at, step)
        values = piece.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
        with np.errstate(invalid="ignore", over="ignore"):
            matrix = np.floor(scale * values.reshape(-1, length))
            good = (np.abs(matrix) < limit).all(axis=1)
        if good.all():
            yield piece, matrix
        elif good.any():
            yield piece.filter(pa.array(good)), matrix[good]


def lengths(batch: pa.RecordBatch) -> list[int]:
    """The lengths that vectors of the batch have, but for 0."""
    return [n for n in pc.unique(pc.list_value_length(batch.column("vector"))).to_pylist() if n]


def map_vectors(
    rows: DataFrame, length: int, scale: float, limit: float, schema: str, work: Callable[[pa.RecordBatch, np.ndarray], list]
) -> DataFrame:
    """`work` makes the columns of `schema` from the kept rows and their matrix, block by block."""
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, matrix in blocks(batch, length, scale, limit):
                yield pa.RecordBatch.from_arrays(work(piece, matrix), names)

    return rows.mapInArrow(run, schema)


def common_length(rows: DataFrame, scale: float, limit: float) -> int:
    """The length of most vectors that can be kept (of as many, the larger); 0 where there are none.
    Vectors of another length can't be compared, and take no part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for batch in batches:
            for length in lengths(batch):
                found[length] = found.get(length, 0) + sum(len(m) for _, m in blocks(batch, length, scale, limit))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], ["length", "n"]
        )

    counts = rows.select("vector").mapInArrow(run, "length int, n long").where("n > 0")
    most = counts.groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    return most.length if most else 0


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b for matrices of whole numbers held as doubles: int64, or Python's integers where these could overflow."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < EXACT:
        return (a @ b).astype(np.int64)
    kind = np.int64 if most < 2.0**62 else object
    return whole(a, kind) @ whole(b, kind)


def whole(a: np.ndarray, kind: type = np.int64) -> np.ndarray:
    if kind is object:
        return np.array([[int(v) for v in row] for row in a], dtype=object).reshape(a.shape)
    return a.astype(kind)


def packed(matrix: np.ndarray) -> pa.Array:
    """Rows of whole numbers as binary values: 32-bit integers, or doubles where these don't hold them."""
    kind = "<i4" if not matrix.size or np.abs(matrix).max() < 2.0**31 else "<f8"
    data, width = matrix.astype(kind), matrix.shape[1] * int(kind[-1])
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(matrix), [None, pa.py_buffer(data.tobytes())]).cast(
        pa.binary()
    )


def unpacked(column: pa.Array | pa.ChunkedArray, length: int) -> np.ndarray:
    """The matrix of doubles that `packed` stored, whichever width each row has."""
    out = np.empty((len(column), length))
    for at, value in enumerate(column.to_pylist()):
        out[at] = np.frombuffer(value, "<i4" if len(value) == 4 * length else "<f8")
    return out
