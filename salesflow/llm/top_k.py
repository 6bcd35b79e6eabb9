"""Exact top-k search by inner product, as a Voronoi join of queries and data.

Pivots (fitted on a bounded sample) cut the space into cells; every row of either side belongs to the cell of its nearest
pivot. Summaries of the cells (how far their rows lie from the pivot, and the k + 1 nearest of the data) give each query
cell i, with pivot p and radius U, a score that k + 1 rows reach for any of its queries q, whatever the direction:

    <q, s> >= <p, p_j> - U |p_j| - (|p| + U) |s - p_j|      for a row s of data cell j

and each row s a score that no query of the cell passes: <q, s> <= <p, s> + U |s|. A row is sent to a group of query cells
only if it can reach the score of one of them. The search in a group is a product of exact whole numbers over the cells
that the row may serve. Query cells are packed into groups of at most GROUP_BYTES, larger ones cut, and the rows of a group
are dealt to slices of about SLICE_BYTES by a hash of their place, not of their value: a cell, a value or an id that holds
a third of all rows is spread like any other. The k best of each slice meet in one ranking by query.

Components become whole numbers floor(1024 c) and scores are exact. Null vectors, vectors with a null or non-finite
component, and vectors of another length than most take no part (nor do components beyond 2^28 / 1024; a score beyond 64
bits raises OverflowError). A query's own row is never its result, but other rows of equal id or vector are. Ties go to
the smaller id, null ids last. Repeated query rows are queries each. Other columns are not read; an empty table, or one
without queries, gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage
from .vectors import BLOCK_BYTES, common_length, exact_product, map_vectors, packed, unpacked

SCALE, LIMIT = 1024.0, 2.0**28
#: Rows of the sample on which pivots are fitted, and their number.
SAMPLE, PIVOTS = 4096, 64
#: Bytes of the queries of a group, and of the rows of a slice.
GROUP_BYTES, SLICE_BYTES = 16 << 20, 32 << 20
#: What rounding may take from a bound, as a part of the terms that it is made of.
SLACK = 1e-9


def fit_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Pivots from a sample: rows each farthest from the ones before, then a few rounds of means."""
    chosen = [int((sample**2).sum(axis=1).argmax())]
    away = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < count and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    pivots = sample[chosen].astype(float)
    for _ in range(5):
        cell, _ = nearest(sample, pivots)
        for c in np.unique(cell):
            pivots[c] = sample[cell == c].mean(axis=0)
    return pivots


def nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each row, and its distance to the cell's pivot."""
    cell = ((pivots**2).sum(axis=1) - 2 * (x @ pivots.T)).argmin(axis=1)
    return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))


@dataclass(frozen=True)
class Cells:
    """The query cells: pivots, radii, the score that k rows reach for each of their queries, and their groups."""

    pivots: np.ndarray
    radius: np.ndarray
    reached: np.ndarray
    groups: list[list[int]]

    def serves(self, x: np.ndarray, cells: np.ndarray | list[int]) -> np.ndarray:
        """Whether each row may be among the best of a query of each of the cells."""
        p, r = self.pivots[cells], self.radius[cells]
        size = np.sqrt((x * x).sum(axis=1))
        most = x @ p.T + size[:, None] * r
        slack = SLACK * size[:, None] * (np.sqrt((p * p).sum(axis=1)) + r) + 1
        return most + slack >= self.reached[cells]


def cell_bounds(pivots: np.ndarray, radius: np.ndarray, near: list[list[float]], wanted: int) -> np.ndarray:
    """For each query cell the score that `wanted` rows reach, from the distances of each data cell's nearest rows."""
    data = [(j, t) for j, found in enumerate(near) for t in found]
    if len(data) < wanted:
        return np.full(len(pivots), -np.inf)
    of, t = np.array([j for j, _ in data]), np.array([t for _, t in data])
    size = np.sqrt((pivots**2).sum(axis=1))
    between = pivots @ pivots.T
    spread = size[:, None] + radius[:, None]
    scores = between[:, of] - radius[:, None] * size[of] - spread * t
    slack = SLACK * (np.abs(between[:, of]) + radius[:, None] * size[of] + spread * t) + 1
    return np.partition(scores - slack, -wanted, axis=1)[:, -wanted]


def packed_groups(pivots: np.ndarray, counts: np.ndarray, most: int) -> list[list[int]]:
    """Query cells in groups of at most `most` queries, neighbours together; a cell with more is a group of its own."""
    left, groups = set(np.flatnonzero(counts).tolist()), []
    while left:
        at = max(left, key=lambda c: (counts[c], -c))
        group, n = [at], counts[at]
        left.discard(at)
        for c in sorted(left, key=lambda c: (float(((pivots[c] - pivots[at]) ** 2).sum()), c)):
            if n + counts[c] <= most:
                group.append(c)
                n += counts[c]
                left.discard(c)
        groups.append(group)
    return groups


def best_in_slice(queries: pa.Table, rows: pa.Table, cells: Cells, length: int, k: int) -> pa.Table:
    """The k best rows of a slice for each query; rows are looked at only by the cells that they may serve."""
    order = pc.sort_indices(rows, [("id", "ascending"), ("place", "ascending")])
    rows = rows.take(order)
    x, ids, places = unpacked(rows.column("vector"), length), rows.column("id"), rows.column("place").to_numpy()
    cell = queries.column("cell").to_numpy()
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for c in np.unique(cell):
        open_ = np.flatnonzero(cells.serves(x, [c])[:, 0])
        own = np.flatnonzero(cell == c)
        step = max(1, BLOCK_BYTES // (8 * max(1, len(open_))))
        for at in range(0, len(own) if len(open_) else 0, step):
            part = own[at : at + step]
            q = unpacked(queries.column("vector").take(pa.array(part)), length)
            scores = exact_product(q, x[open_].T)
            place = queries.column("place").to_numpy()[part]
            for i, line in enumerate(scores):
                there = np.flatnonzero(places[open_] != place[i])
                line = line[there]
                if len(line) > k:
                    bar = np.partition(line, -k)[-k] if line.dtype != object else sorted(line)[-k]
                    keep = np.flatnonzero(line >= bar)
                    there, line = there[keep], line[keep]
                best = np.array(sorted(range(len(line)), key=lambda j: -line[j])[:k], int)
                out.append((np.full(len(best), part[i]), open_[there[best]], line[best]))
    if not out:
        return pa.table({n: pa.array([], t) for n, t in (("query", pa.int64()), ("query_id", queries.schema.field("id").type), ("id", ids.type), ("place", pa.int64()), ("score", pa.int64()))})
    of, at, score = (np.concatenate(a) for a in zip(*out, strict=True))
    return pa.table({
        "query": queries.column("place").take(pa.array(of)), "query_id": queries.column("id").take(pa.array(of)),
        "id": ids.take(pa.array(at)), "place": pa.array(places[at]), "score": pa.array([int(s) for s in score], pa.int64()),
    })


def top_k(
    frame: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    pivots: int = PIVOTS,
    group_bytes: int = GROUP_BYTES,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """(query_id, rank, id, score): the k highest inner products of each row for which `is_query` holds with any other row."""
    spark = frame.sparkSession
    marked = frame.select(
        F.col(id_col).alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    kind = marked.schema["id"].dataType.simpleString()
    nothing = spark.createDataFrame([], f"query_id {kind}, rank int, id {kind}, score long")
    length = common_length(marked, SCALE, LIMIT)
    if not length:
        return nothing
    keys = F.xxhash64(F.col("id"), F.col("vector"))
    sampled = marked.withColumn("key", keys).orderBy("key").select("id", "query", "vector").limit(SAMPLE)
    sample = map_vectors(sampled, length, SCALE, LIMIT, "vector binary", lambda piece, x: [packed(x)]).collect()
    if not sample:  # none of the sampled rows can be kept: any point will do as the only pivot
        points = np.zeros((1, length))
    else:
        points = fit_pivots(unpacked(pa.array([bytes(r.vector) for r in sample], pa.binary()), length), pivots)

    def place_in_cells(piece: pa.RecordBatch, x: np.ndarray) -> list:
        cell, away = nearest(x, points)
        return [piece.column("id"), piece.column("query"), packed(x), pa.array(cell, pa.int32()), pa.array(away)]

    rows = map_vectors(marked, length, SCALE, LIMIT, f"id {kind}, query boolean, vector binary, cell int, away double", place_in_cells)
    rows = cut_lineage(rows.withColumn("place", F.monotonically_increasing_id()))  # written, so places stay as they are

    counts, radius = np.zeros(len(points), np.int64), np.zeros(len(points))
    for r in rows.where("query").groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("away")).collect():
        counts[r.cell], radius[r.cell] = r.n, r.away * (1 + SLACK)
    if not counts.any():
        return nothing
    nearest_rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("cell").orderBy("away", "place")))
    near: list[list[float]] = [[] for _ in points]
    for r in nearest_rows.where(F.col("r") <= k + 1).select("cell", "away").collect():
        near[r.cell].append(r.away * (1 + SLACK))
    most = max(1, group_bytes // (8 * length))
    groups = packed_groups(points, counts, most)
    cells = Cells(points, radius, cell_bounds(points, radius, near, k + 1), groups)

    # A group with more queries than fit is cut by place into numbered shares, which get the same rows.
    shares = [-(-int(counts[g].sum()) // most) for g in groups]
    first = np.cumsum([0, *shares])
    home = {c: g for g, group in enumerate(groups) for c in group}
    total = rows.count()
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")) // int(first[-1]), -(-total * 8 * length // slice_bytes), 1)

    def route(piece: pa.RecordBatch) -> pa.RecordBatch:
        x = unpacked(piece.column("vector"), length)
        sent = [np.flatnonzero(cells.serves(x, group).any(axis=1)) for group in groups]
        at = np.concatenate([np.tile(s, shares[g]) for g, s in enumerate(sent)])
        to = np.concatenate([np.repeat(np.arange(first[g], first[g + 1]), len(s)) for g, s in enumerate(sent)])
        kept = piece.select(["id", "vector", "place"]).take(pa.array(at))
        return pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), *kept.columns], ["part", "id", "vector", "place"])

    routed = rows.select("id", "vector", "place").mapInArrow(lambda batches: (route(b) for b in batches if b.num_rows), f"part int, id {kind}, vector binary, place long")
    routed = routed.withColumn("slice", F.pmod(F.xxhash64("place"), F.lit(slices)).cast("int"))
    group_of = F.element_at(F.create_map(*(F.lit(v) for c, g in home.items() for v in (int(c), int(g)))), F.col("cell"))
    starts, widths = F.array(*(F.lit(int(v)) for v in first)), F.array(*(F.lit(int(v)) for v in shares))
    asked = rows.where("query").withColumn("g", group_of).select(
        (starts[F.col("g")] + F.pmod(F.xxhash64("place"), widths[F.col("g")])).cast("int").alias("part"), "id", "vector", "place", "cell",
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
    )

    def solve(queries: pa.Table, found: pa.Table) -> pa.Table:
        return best_in_slice(queries, found, cells, length, k)

    keys = ("part", "slice")
    best = asked.groupBy(*keys).cogroup(routed.groupBy(*keys)).applyInArrow(
        solve, f"query long, query_id {kind}, id {kind}, place long, score long"
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"), "place")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def top_hundredth(frame: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """The registered query's rows: queries are the rows whose vec_id is divisible by `every`."""
    found = top_k(frame, F.pmod(F.col("vec_id"), F.lit(every)) == 0, k)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
