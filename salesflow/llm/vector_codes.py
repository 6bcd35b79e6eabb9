"""Vector code compression: product codes by rounds of nearest entries and means, with norm-of-sum bounds.

Vectors are cut into equal parts; each part position has a codebook, and a vector's code names the nearest entry of each.
Components are whole numbers floor(256 c), so distances, sums and means (rounded down) are exact, and the result does not
depend on how Spark divides the rows. The codebooks of all rounds are kept. Every part of a vector carries an upper bound
(distance to its entry) and a lower bound (to any other entry), each stamped with the round in which it was measured. In a
later round a bound is widened by how far the entry now lies from where it was at the stamp: the norm of the sum of its
moves, which is never more than the sum of their norms. Where the bounds still part, the entry stays without a look at the
others; else the distance to the own entry is measured anew, and only if that isn't enough all entries are scanned.

Null vectors, vectors with a null or non-finite component, and vectors of another length than most take no part (nor do
components beyond 2^27 / 256). The codebooks start from the rows of least id (null ids last, of equal ids the least bytes);
with fewer rows than entries they are that much smaller. Repeated rows count each; null and repeated ids stay rows of
their own; other columns are not read. An empty table gives an empty result. A length that the number of parts does not
divide raises ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage
from .vectors import common_length, exact_product, map_vectors, packed, unpacked, vector_rows, whole

SCALE, LIMIT = 256.0, 2.0**27
#: What rounding may take from a distance, as a part of it.
SLACK = 1e-9


def square_distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-numbered rows to every entry."""
    products = exact_product(x, book.T)
    kind = products.dtype.type if products.dtype != object else object
    if 4 * (float(np.abs(x).max(initial=0)) + float(np.abs(book).max(initial=0))) ** 2 * x.shape[1] >= 2.0**62:
        kind = object
    x, book = whole(x, kind), whole(book, kind)
    return (x * x).sum(axis=1)[:, None] - 2 * products + (book * book).sum(axis=1)[None, :]


def own_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one entry each."""
    away = x - entries
    kind = np.int64 if float(np.abs(away).max(initial=0)) ** 2 * x.shape[1] < 2.0**62 else object
    away = whole(away, kind)
    return (away * away).sum(axis=1)


def root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


class Bounds:
    """The state of one part position over a block of rows: entry, two bounds and their stamps."""

    def __init__(self, code: np.ndarray, upper: np.ndarray, lower: np.ndarray, upper_at: np.ndarray, lower_at: np.ndarray):
        self.code, self.upper, self.lower, self.upper_at, self.lower_at = code, upper, lower, upper_at, lower_at

    @classmethod
    def unknown(cls, n: int) -> Bounds:
        stamp = np.zeros(n, np.uint8)
        return cls(np.zeros(n, np.uint8), np.full(n, np.inf), np.full(n, -np.inf), stamp, stamp.copy())

    def renew(self, x: np.ndarray, books: list[np.ndarray]) -> tuple[int, int]:
        """Entries as of the last of `books` (one for each round so far); the numbers of rows measured anew and scanned."""
        now = len(books) - 1
        moved = np.array([np.sqrt(((books[now] - old) ** 2).sum(axis=1)) for old in books]) * (1 + SLACK)
        first = moved.argmax(axis=1)
        rest = moved.copy()
        rest[np.arange(now + 1), first] = 0
        others = np.where(first[self.lower_at] == self.code, rest.max(axis=1)[self.lower_at], moved.max(axis=1)[self.lower_at])
        lower = self.lower - others
        upper = self.upper + moved[self.upper_at, self.code]
        open_ = np.flatnonzero(~(upper * (1 + SLACK) < lower * (1 - SLACK)))
        self.upper[open_] = root(own_distances(x[open_], books[now][self.code[open_]]))
        self.upper_at[open_] = now
        scan = open_[~(self.upper[open_] * (1 + SLACK) < lower[open_] * (1 - SLACK))]
        if scan.size:
            squares = square_distances(x[scan], books[now])
            best = squares.argmin(axis=1)
            at = np.arange(len(scan))
            self.code[scan], self.upper[scan] = best, root(squares[at, best])
            near = root(squares)
            near[at, best] = np.inf
            self.lower[scan] = near.min(axis=1)
            self.upper_at[scan] = self.lower_at[scan] = now
        return open_.size, scan.size


STATE = "vector binary, code binary, upper binary, lower binary, upper_at binary, lower_at binary"
KINDS = {"code": "u1", "upper": "<f8", "lower": "<f8", "upper_at": "u1", "lower_at": "u1"}


def bytes_rows(matrix: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(matrix)
    width = data.shape[1] * data.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(data), [None, pa.py_buffer(data.tobytes())]).cast(pa.binary())


def state_columns(x: np.ndarray, found: list[Bounds]) -> list[pa.Array]:
    return [packed(x), *(bytes_rows(np.stack([getattr(b, k) for b in found], axis=1).astype(kind)) for k, kind in KINDS.items())]


def read_state(batch: pa.RecordBatch, length: int, parts: int) -> tuple[np.ndarray, list[Bounds]]:
    table = {}
    for k, kind in KINDS.items():
        table[k] = np.frombuffer(b"".join(batch.column(k).to_pylist()), kind).reshape(-1, parts).copy()
    return unpacked(batch.column("vector"), length), [Bounds(*(table[k][:, p].copy() for k in KINDS)) for p in range(parts)]


def renewed(x: np.ndarray, found: list[Bounds], history: list[np.ndarray]) -> np.ndarray:
    """Renews every part's bounds; the exact error of each row, summed over parts."""
    parts = len(found)
    error = 0
    for p, (piece, bounds) in enumerate(zip(np.split(x, parts, axis=1), found, strict=True)):
        books = [h[p] for h in history]
        bounds.renew(piece, books)
        error = error + own_distances(piece, books[-1][bounds.code])
    return error


def means(state: DataFrame, length: int, parts: int, book: np.ndarray) -> np.ndarray:
    """The next codebooks: floor of sum over count of every entry's parts; an entry without any stays. Tasks add up their
    own rows first, so what is shuffled is one row for each task, entry and component."""
    entries, width = book.shape[1], length // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            if batch.num_rows:
                x, found = read_state(batch, length, parts)
                for p, (piece, bounds) in enumerate(zip(np.split(x.astype(np.int64), parts, axis=1), found, strict=True)):
                    np.add.at(count[p], bounds.code, 1)
                    np.add.at(total[p], bounds.code, piece)
        part, entry, place = (a.ravel() for a in np.indices(total.shape))
        n = np.repeat(count.ravel(), width)
        used = n > 0
        columns = [pa.array(a[used], pa.int32()) for a in (part, entry, place)]
        sums = pa.array(total.ravel()[used], pa.int64()).cast(pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([*columns, pa.array(n[used]), sums], ["part", "entry", "place", "n", "total"])

    made = state.select("vector", *KINDS).mapInArrow(run, "part int, entry int, place int, n long, total decimal(38,0)")
    out = book.copy()
    for r in made.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        out[r.part, r.entry, r.place] = int(r.total) // int(r.n)
    return out


def first_books(rows: DataFrame, length: int, parts: int, entries: int) -> np.ndarray:
    """The parts of the rows of least id."""
    vectors = map_vectors(rows, length, SCALE, LIMIT, f"id {kind_of(rows, 'id')}, vector binary", lambda piece, x: [piece.column("id"), packed(x)])
    found = vectors.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()
    x = unpacked(pa.array([bytes(r.vector) for r in found], pa.binary()), length)
    return np.stack(np.split(x, parts, axis=1))


def kind_of(rows: DataFrame, column: str) -> str:
    return rows.schema[column].dataType.simpleString()


def compress(
    frame: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """(codes, codebooks): a row (id, label, `code` of one byte a part, `error`: exact squared distance) for each vector
    kept, and the last codebooks by part, entry and component. At most 256 entries. Each round writes its state (vectors,
    codes and bounds) once to the shared checkpoint folder, from which lost tasks are made again."""
    if not 1 <= entries <= 256 or not 0 <= rounds < 255:
        raise ValueError("entries must be 1 to 256, rounds 0 to 254")
    rows = vector_rows(frame, vector_col, id=id_col, label=label_col)
    own = f"id {kind_of(rows, 'id')}, label {kind_of(rows, 'label')}"
    length = common_length(rows, SCALE, LIMIT)
    if length % parts:
        raise ValueError(f"vectors of {length} components can't be cut into {parts} equal parts")
    if not length:
        return frame.sparkSession.createDataFrame([], f"{own}, code binary, error long"), np.zeros((parts, 0, 0))
    history = [first_books(rows, length, parts, entries)]

    def begin(books: list[np.ndarray], schema: str, out) -> DataFrame:
        def work(piece: pa.RecordBatch, x: np.ndarray) -> list:
            found = [Bounds.unknown(len(x)) for _ in range(parts)]
            error = renewed(x, found, books)
            return [piece.column("id"), piece.column("label"), *out(x, found, error)]

        return map_vectors(rows, length, SCALE, LIMIT, schema, work)

    def go_on(state: DataFrame, books: list[np.ndarray], schema: str, out) -> DataFrame:
        names = [f.split()[0] for f in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x, found = read_state(batch, length, parts)
                    error = renewed(x, found, books)
                    yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), *out(x, found, error)], names)

        return state.mapInArrow(run, schema)

    def codes(x: np.ndarray, found: list[Bounds], error: np.ndarray) -> list[pa.Array]:
        return [bytes_rows(np.stack([b.code for b in found], axis=1)), pa.array([int(e) for e in error], pa.int64())]

    def states(x: np.ndarray, found: list[Bounds], error: np.ndarray) -> list[pa.Array]:
        return state_columns(x, found)

    state = None
    for turn in range(rounds + 1):
        last = turn == rounds
        schema, out = (f"{own}, code binary, error long", codes) if last else (f"{own}, {STATE}", states)
        made = begin(list(history), schema, out) if state is None else go_on(state, list(history), schema, out)
        state = cut_lineage(made)
        if not last:
            history.append(means(state, length, parts, history[-1]))
    return state, history[-1]


def compressed_codes(frame: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """The codes as the registered query returns them. Errors are added up for each label before they meet the rows again,
    so a label that many rows share is one row of the smaller side, and Spark may split its share of the larger."""
    codes, books = compress(frame, parts, entries, rounds)
    digest = hashlib.sha256(",".join(str(int(v)) for v in books.ravel()).encode()).hexdigest()
    sums = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
