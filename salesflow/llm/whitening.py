"""Embedding whitening by mixed-precision refinement of a distributed covariance.

Components become whole numbers x = floor(64 c) + 1000000, so counts, sums and the matrix of products are exact sums of
integers: the same whatever the number of tasks, their order or a lost executor. Products are taken of x less the whole
part of the mean, which the remainder then corrects, so the covariance is that of centred values without rounding.
The eigenvectors start in single precision and are corrected by Ogita and Aishima's iterations of matrix products
(`refined_eigen`) in extended precision; eigenvalues too close to tell apart are solved as a block of their own.

Null vectors, vectors with a null or non-finite component, and vectors of another length than most take no part (nor do
components beyond 2^40 / 64 in size). Repeated rows count each; null and repeated ids stay rows of their own; other
columns are not read. A direction without variance (eigenvalue 0 but for rounding) can't be whitened: its `whitened` is
null, and it is left out of `identity_error`. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage
from .vectors import blocks, exact_product, lengths, map_vectors, vector_rows, whole

SCALE, OFFSET, LIMIT = 64.0, 1_000_000, 2.0**40
#: Iterations after which refinement gives up; from single precision it takes three to six.
ROUNDS = 40
#: A variance below this part of the whole is rounding.
NOTHING = 1e-13
NUMBER = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Whitening:
    """What is fitted: `sums` and `n` are exact, columns of `components` are unit eigenvectors by falling eigenvalue."""

    n: int
    length: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def middle(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], float)

    @property
    def rest(self) -> np.ndarray:
        """n times what the whole part of the mean lacks."""
        return np.array([s % self.n for s in self.sums], float)

    @property
    def projection(self) -> np.ndarray:
        """The directions that vary, divided by their deviation."""
        kept = self.values > NOTHING * self.trace
        return self.components[:, kept] / np.sqrt(self.values[kept])


def numbers(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], NUMBER)


def exact_sums(rows: DataFrame) -> tuple[int, int, list[int]]:
    """Rows, length and sums by position, of the vectors of the commonest length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for length in lengths(batch):
                for _, matrix in blocks(batch, length, SCALE, LIMIT):
                    n, total = found.get(length, (0, 0))
                    found[length] = [n + len(matrix), total + (matrix.astype(np.int64) + OFFSET).sum(axis=0).astype(object)]
        for length, (n, total) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([length] * length, pa.int32()), pa.array(range(length), pa.int32()),
                 pa.array([n] * length, pa.int64()), numbers(total)], ["length", "place", "n", "total"]
            )

    sums = rows.select("vector").mapInArrow(run, "length int, place int, n long, total decimal(38,0)")
    sums = cut_lineage(sums.groupBy("length", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    most = sums.where("place = 0").orderBy(F.desc("n"), F.desc("length")).first()
    if not most:
        return 0, 0, []
    found = sums.where(F.col("length") == most.length).orderBy("place").collect()
    return most.n, most.length, [int(r.total) for r in found]


def exact_products(rows: DataFrame, length: int, middle: np.ndarray) -> list[list[int]]:
    """Sums of products of x less `middle`, for every two positions: each task adds up its own rows, and Spark the tasks."""
    upper = np.triu_indices(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, matrix in blocks(batch, length, SCALE, LIMIT):
                away = matrix + OFFSET - middle
                made = exact_product(away.T, away)[upper].astype(object)
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), numbers(total)], ["a", "b", "total"]
            )

    products = rows.select("vector").mapInArrow(run, "a int, b int, total decimal(38,0)")
    out = [[0] * length for _ in range(length)]
    for r in products.groupBy("a", "b").agg(F.sum("total").alias("total")).collect():
        out[r.a][r.b] = out[r.b][r.a] = int(r.total)
    return out


def covariance(n: int, sums: list[int], products: list[list[int]]) -> np.ndarray:
    """The covariance with divisor n, in extended precision, from exact numbers."""
    rest, length = [s % n for s in sums], len(sums)
    out = np.empty((length, length), np.longdouble)
    for a in range(length):
        for b in range(a, length):
            value = Fraction(n * products[a][b] - rest[a] * rest[b], n * n)
            near = float(value)
            out[a, b] = out[b, a] = np.longdouble(near) + np.longdouble(float(value - Fraction(near)))
    return out


def runs(values: np.ndarray, width: float) -> Iterator[slice]:
    """Runs of two or more neighbours, among sorted values, that lie within `width` of each other."""
    at = 0
    for end in range(1, len(values) + 1):
        if end == len(values) or abs(values[end] - values[end - 1]) > width:
            if end - at > 1:
                yield slice(at, end)
            at = end


def refined_eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns, largest entry positive) of a symmetric matrix.

    Starts from the eigenvectors in single precision. Each iteration takes R = I - X'X and S = X'AX and corrects X by
    X E, where E is (S + R diag(e)) / (e_j - e_i) for values that can be told apart at the present error, and R / 2 for
    the others; the error squares each time. E and its transpose add up to R, which is kept so whatever rounding does to
    the quotients: X stays orthonormal then. Values within that error form a block: with X orthonormal, X'(A - m)X over
    the block, m its mean, is solved on its own, which turns the block's vectors into their own directions.
    """
    size = len(matrix)
    top = float(np.abs(matrix).max()) if size else 0.0
    if not top:
        return np.zeros(size), np.eye(size)
    a = np.asarray(matrix, np.longdouble) / np.longdouble(top)
    norm, eye = np.sqrt((a * a).sum()), np.eye(size, dtype=np.longdouble)
    enough = 8 * size * max(np.finfo(np.longdouble).eps, 1e-19)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    for _ in range(ROUNDS):
        r, s = eye - x.T @ x, x.T @ (a @ x)
        e = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-e, kind="stable")
        x, e, r, s = x[:, order], e[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
        off = s - np.diag(np.diag(s))
        if np.abs(off).max() <= enough * norm and np.abs(r).max() <= enough:
            break
        width = enough**0.5 * norm + 2 * (np.sqrt(((s - np.diag(e)) ** 2).sum()) + norm * np.sqrt((r * r).sum()))
        gap = e[None, :] - e[:, None]
        apart = np.abs(gap) > width
        turn = np.where(apart, (s + r * e[None, :]) / np.where(apart, gap, 1), 0)
        x = x + x @ ((turn - turn.T) / 2 + r / 2)
        for block in runs(e, float(width)):
            part = x[:, block]
            inner = part.T @ (a @ part) - e[block].mean() * (part.T @ part)
            high = float(np.abs(inner).max())
            if np.abs(inner - np.diag(np.diag(inner))).max() > enough * norm / 2:
                x[:, block] = part @ np.linalg.eigh(-(inner + inner.T).astype(np.float64) / high)[1].astype(np.longdouble)
    else:
        raise ArithmeticError("the eigenvectors of the covariance did not settle")
    x = x / np.sqrt((x * x).sum(axis=0))
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(size)] < 0, -1, 1)
    return (e * np.longdouble(top)).astype(np.float64), x.astype(np.float64)


def projected(model: Whitening, matrix: np.ndarray) -> np.ndarray:
    return (matrix + OFFSET - model.middle - model.rest / model.n) @ model.projection


def distance_from_identity(rows: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened vectors' own covariance less the identity, measured over all of them."""
    size = model.projection.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for batch in batches:
            for _, matrix in blocks(batch, model.length, SCALE, LIMIT):
                y = projected(model, matrix)
                total += np.vstack([y.T @ y, y.sum(axis=0)])
        a, b = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(a.ravel(), pa.int32()), pa.array(b.ravel(), pa.int32()), pa.array(total.ravel())], ["a", "b", "total"])

    if not size:
        return 0.0
    out = np.zeros((size + 1, size))
    made = rows.select("vector").mapInArrow(run, "a int, b int, total double").groupBy("a", "b").agg(F.sum("total").alias("total"))
    for r in made.collect():
        out[r.a, r.b] = r.total / model.n
    return float(np.abs(out[:-1] - np.outer(out[-1], out[-1]) - np.eye(size)).max())


def fit_whitening(rows: DataFrame, components: int) -> Whitening | None:
    """Two passes for exact sums and products, refinement on the driver (a matrix of length x length), and one pass that
    measures the result. None where no vector can be kept."""
    n, length, sums = exact_sums(rows)
    if not n:
        return None
    middle = np.array([s // n for s in sums], float)
    matrix = covariance(n, sums, exact_products(rows, length, middle))
    values, vectors = refined_eigen(matrix)
    kept = slice(0, components)
    model = Whitening(n, length, sums, vectors[:, kept], values[kept], float(np.trace(matrix)))
    return Whitening(n, length, sums, model.components, model.values, model.trace, distance_from_identity(rows, model))


def whiten(
    frame: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row for each vector kept: its id, `n`, `deviation` (exact, as a decimal: a sum of squares of n x - S),
    `whitened` and `explained` (an entry for each component) and `identity_error`."""
    rows = vector_rows(frame, vector_col, id=id_col)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, deviation decimal(38,0), whitened array<double>"
    model = fit_whitening(rows, components)
    if model is None:
        out, n, explained, error = frame.sparkSession.createDataFrame([], schema), 0, [], 0.0
    else:
        n, error = model.n, model.identity_error
        explained = [float(v / model.trace) if model.trace else 0.0 for v in model.values]
        width, rest = len(model.values), model.rest

        def work(piece: pa.RecordBatch, matrix: np.ndarray) -> list:
            away = matrix + OFFSET - model.middle
            most = n * float(np.abs(away).max()) + n
            if most * most * model.length < 2.0**62:
                spread = ((n * away.astype(np.int64) - rest.astype(np.int64)) ** 2).sum(axis=1)
                spread = pa.array(spread, pa.int64()).cast(NUMBER)
            else:
                spread = numbers(((n * whole(away, object) - whole(rest[None], object)) ** 2).sum(axis=1))
            white = np.full((len(matrix), width), np.nan)
            white[:, model.values > NOTHING * model.trace] = projected(model, matrix)
            flat = pa.array(white.ravel(), mask=np.isnan(white).ravel())
            ends = pa.array(np.arange(len(matrix) + 1) * width, pa.int32())
            return [piece.column("id"), spread, pa.ListArray.from_arrays(ends, flat)]

        out = map_vectors(rows, model.length, SCALE, LIMIT, schema, work)
    return out.select(
        F.col("id").alias(id_col), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.lit(explained).cast("array<double>").alias("explained"), F.lit(error).alias("identity_error"),
    )


def whitened_components(frame: DataFrame, components: int = 32) -> DataFrame:
    """A row for each vector and component, as the registered query returns them."""
    wide = whiten(frame, components)
    pairs = F.arrays_zip("whitened", "explained")
    return wide.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error", F.posexplode(pairs)).select(
        "vec_id", (F.col("pos") + 1).cast("int").alias("component"), "n", "deviation", "col.whitened", "col.explained", "identity_error"
    )
