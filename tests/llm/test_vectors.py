"""Operators 11 to 13 against brute force, on the given vectors and on rows that are hard to take."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesflow.llm import top_k, vector_codes, whitening
from salesflow.llm.queries import QUERIES
from salesflow.llm.vectors import exact_product, packed, unpacked

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, code string, n long, place int"


def rows_of(spark, vectors, ids=None, labels=None, partitions=3):
    n = len(vectors)
    ids = list(range(n)) if ids is None else ids
    made = [
        (ids[i], None if v is None else [None if c is None else float(c) for c in v], labels[i] if labels else i % 3, "x", 7, 1)
        for i, v in enumerate(vectors)
    ]
    return spark.createDataFrame(made, SCHEMA).repartition(partitions)


NAN, INF = float("nan"), float("inf")
BAD = [None, [None] * 16, [NAN] * 16, [1.0] * 15 + [None], [INF] + [0.0] * 15, [], [1.0] * 8, [3.0e38] * 16]


def hard(spark):
    """Bad vectors, repeated rows, equal vectors under different ids, equal and null ids, a hot vector and a hot label."""
    r = np.random.default_rng(5)
    good = [*r.normal(size=(150, 16)), *([np.ones(16) / 4] * 60)]
    vectors = [*BAD, *good, good[0], good[0], good[1], -good[2]]
    ids = [*range(-8, 0), *range(len(good)), 0, 0, None, None]
    labels = [None if i % 7 == 0 else 1 for i in range(len(vectors))]
    return rows_of(spark, vectors, ids, labels)


def fixed(frame, scale, length):
    """(id, label, ints) of the rows to keep, in Python's integers."""
    out = []
    for r in frame.collect():
        v = r.embedding
        if v is not None and len(v) == length and all(c is not None and math.isfinite(c) and abs(c) < 1e6 for c in v):
            out.append((r.vec_id, r.label, [math.floor(scale * c) for c in v]))
    return out


def least_first(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


# --- compression ---


def codes_by_hand(rows, parts=16, entries=64, rounds=2):
    width = len(rows[0][2]) // parts
    cut = [[tuple(x[p * width : (p + 1) * width]) for p in range(parts)] for _, _, x in rows]
    seeds = [c for _, c in sorted(zip(rows, cut, strict=True), key=lambda z: (z[0][0] is None, z[0][0] or 0, np.array(z[0][2], "<i4").tobytes()))][:entries]
    books = [[s[p] for s in seeds] for p in range(parts)]

    def square(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assign():
        return [[min(range(len(books[p])), key=lambda e: (square(c[p], books[p][e]), e)) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found, strict=True) if f[p] == e]
                if own:
                    books[p][e] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    found = assign()
    error = [sum(square(c[p], books[p][f[p]]) for p in range(parts)) for c, f in zip(cut, found, strict=True)]
    text = ",".join(str(v) for book in books for entry in book for v in entry)
    label = {}
    for (_, of, _), e in zip(rows, error, strict=True):
        label[of] = label.get(of, 0) + e
    return sorted(
        ((i, bytes(f).hex(), e, label[of], hashlib.sha256(text.encode()).hexdigest()) for (i, of, _), f, e in zip(rows, found, error, strict=True)), key=str
    )


COLUMNS = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_codes_of_hard_rows_equal_brute_force(spark):
    got = vector_codes.compressed_codes(hard(spark))
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == codes_by_hand(fixed(hard(spark), 256, 16))


def test_codes_with_fewer_rows_than_entries_and_other_shapes(spark):
    r = np.random.default_rng(2)
    frame = rows_of(spark, r.normal(size=(9, 6)))
    for parts, entries, rounds in ((2, 64, 2), (3, 4, 5), (6, 1, 1), (1, 3, 0)):
        got = vector_codes.compressed_codes(frame, parts, entries, rounds).collect()
        assert sorted((tuple(x) for x in got), key=str) == codes_by_hand(fixed(frame, 256, 6), parts, entries, rounds)


def test_codes_do_not_depend_on_the_division_of_rows(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    a, b = (sorted(tuple(r) for r in vector_codes.compressed_codes(frame.repartition(n)).collect()) for n in (1, 7))
    assert a == b


def test_codes_of_large_components_are_exact(spark):
    frame = rows_of(spark, np.random.default_rng(4).normal(size=(80, 16)) * 60_000)
    got = vector_codes.compressed_codes(frame, 4, 8, 2).collect()
    assert sorted((tuple(x) for x in got), key=str) == codes_by_hand(fixed(frame, 256, 16), 4, 8, 2)


def test_codes_refuse_a_length_that_the_parts_do_not_divide(spark):
    with pytest.raises(ValueError, match="cut into 16"):
        vector_codes.compress(rows_of(spark, [[1.0] * 10]))


def test_bounds_by_the_norm_of_the_sum_hold_and_are_tighter():
    """Against drifts added up round by round: the net move is never longer, and an entry that comes back has none."""
    r = np.random.default_rng(8)
    x = np.floor(r.normal(size=(2000, 4)) * 100)
    books = [np.floor(r.normal(size=(32, 4)) * 100)]
    for step in (30, 8, -8, 3, 0):
        books.append(books[-1] + step)
    state, scans = vector_codes.Bounds.unknown(len(x)), []
    for now in range(1, len(books) + 1):
        scans.append(state.renew(x, books[:now])[1])
        exact = ((x[:, None, :] - books[now - 1][None]) ** 2).sum(axis=2)
        assert (state.code == exact.argmin(axis=1)).all()
    assert scans[0] == len(x)  # nothing is known at first
    assert scans[-1] < len(x) / 4  # nothing has moved since: scans are for ties and rows between two entries
    net = [np.sqrt(((books[-1] - b) ** 2).sum(axis=1)) for b in books]
    added = [sum(np.sqrt(((books[i + 1] - books[i]) ** 2).sum(axis=1)) for i in range(at, len(books) - 1)) for at in range(len(books))]
    assert all((n <= a + 1e-9).all() for n, a in zip(net, added, strict=True)) and (net[1] < added[1] / 3).all()


# --- search ---


def top_by_hand(rows, k=10, every=100):
    out = []
    for at, (i, _, q) in enumerate(rows):
        if i is not None and i % every == 0:
            scored = [(sum(a * b for a, b in zip(q, x, strict=True)), j) for n, (j, _, x) in enumerate(rows) if n != at]
            scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
            out += [(i, rank, j, score) for rank, (score, j) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("group", "piece"), [(top_k.GROUP_BYTES, top_k.SLICE_BYTES), (16 * 8 * 2, 2000)])
def test_search_of_hard_rows_equals_brute_force(spark, group, piece):
    found = top_k.top_k(hard(spark), F.col("vec_id") % 5 == 0, 10, group_bytes=group, slice_bytes=piece, pivots=12)
    got = sorted(((r.query_id, r["rank"], r.id, r.score) for r in found.collect()), key=str)
    assert got == top_by_hand(fixed(hard(spark), 1024, 16), every=5)


def test_search_with_fewer_rows_than_results_and_other_ids(spark):
    frame = rows_of(spark, np.eye(4), ids=[0, 100, 200, 3])
    assert sorted((tuple(r) for r in top_k.top_hundredth(frame).collect()), key=str) == top_by_hand(fixed(frame, 1024, 4))
    named = frame.select(F.concat(F.lit("v"), "vec_id").alias("name"), "embedding")
    assert top_k.top_k(named, F.col("name") == "v3", 2, id_col="name").count() == 2
    assert top_k.top_hundredth(rows_of(spark, np.eye(4), ids=[1, 2, 3, 4])).count() == 0


def test_search_of_large_components_is_exact(spark):
    frame = rows_of(spark, np.random.default_rng(3).normal(size=(60, 4)) * 50_000, ids=[10 * i for i in range(60)])
    assert sorted((tuple(r) for r in top_k.top_hundredth(frame).collect()), key=str) == top_by_hand(fixed(frame, 1024, 4))


def test_search_sends_rows_only_where_they_may_count():
    """Clusters far apart: bounds are never passed, and few rows are sent to cells of other clusters."""
    r = np.random.default_rng(6)
    centres = r.normal(size=(12, 16)) * 4000
    data = np.floor(np.concatenate([c + r.normal(size=(80, 16)) * 60 for c in centres]))
    queries = data[::20]
    pivots = top_k.fit_pivots(data[::3], 12)
    (qc, qa), (dc, da) = top_k.nearest(queries, pivots), top_k.nearest(data, pivots)
    radius = np.array([qa[qc == c].max(initial=0) for c in range(12)])
    near = [sorted(da[dc == c])[:11] for c in range(12)]
    reached = top_k.cell_bounds(pivots, radius, near, 11)
    cells = top_k.Cells(pivots, radius, reached, [[c] for c in range(12)])
    sent = cells.serves(data, list(range(12)))
    scores = queries @ data.T
    for i, line in enumerate(scores):
        assert np.sort(line)[-11] >= reached[qc[i]]  # so many rows do reach the bound
        assert sent[np.argsort(-line)[:11], qc[i]].all()  # and none of the best is held back
    assert sent.mean() < 0.35


def test_query_cells_are_packed_and_large_ones_stand_alone():
    groups = top_k.packed_groups(np.arange(6.0)[:, None], np.array([5, 3, 0, 2, 90, 1]), 10)
    assert sorted(c for g in groups for c in g) == [0, 1, 3, 4, 5] and [4] in groups
    assert all(sum([5, 3, 0, 2, 90, 1][c] for c in g) <= 10 for g in groups if g != [4])


# --- whitening ---


def check_whitening(got, rows, components=32):
    """Against exact covariances in fractions and eigenvalues in double precision."""
    x = [[c + 1_000_000 for c in v] for _, _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(v[i] for v in x) for i in range(d)]
    away = [[n * v[i] - sums[i] for i in range(d)] for v in x]
    wide = np.array([[float(a) / n for a in v] for v in away])
    v = np.array([[float(Fraction(sum(a[i] * a[j] for a in away), n**3)) for j in range(d)] for i in range(d)])
    values = np.linalg.eigvalsh(v)[::-1]
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, []).append(r)
    assert sorted(by_id, key=str) == sorted({i for i, _, _ in rows}, key=str)
    assert len(got) == n * min(components, d)
    deviations = {}
    for (i, _, _), a in zip(rows, away, strict=True):
        deviations.setdefault(i, []).append(sum(c * c for c in a))
    white = []
    for i, found in by_id.items():
        assert sorted(r.deviation for r in found if r.component == 1) == sorted(deviations[i])
        for r in found:
            assert r.n == n and r.identity_error <= 1e-4
            assert abs(r.explained - values[r.component - 1] / values.sum()) <= 1e-6 * r.explained + 1e-15
    if len(by_id) == n:
        order = {i: k for k, (i, _, _) in enumerate(rows)}
        white = np.full((n, min(components, d)), np.nan)
        for r in got:
            white[order[r.vec_id], r.component - 1] = np.nan if r.whitened is None else r.whitened
        kept = ~np.isnan(white).any(axis=0)
        w = white[:, kept]
        assert kept.sum() == (values[: white.shape[1]] > 1e-9 * values.sum()).sum()
        assert np.abs(w.T @ w / n - np.eye(w.shape[1])).max() < 1e-9
        # whitened columns are x-S/n on an eigenvector: their products with x give V u / sqrt(e), at right angles
        u = wide.T @ w / n / np.sqrt(values[: white.shape[1]][kept])
        assert np.abs(v @ u - u * values[: white.shape[1]][kept]).max() < 1e-9 * values[0]
    return white


def test_whitening_equals_exact_covariances(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    check_whitening(whitening.whitened_components(frame).collect(), fixed(frame, 64, 64))


def test_whitening_of_hard_rows(spark):
    check_whitening(whitening.whitened_components(hard(spark)).collect(), fixed(hard(spark), 64, 16))


def test_whitening_of_equal_variances_and_of_none(spark):
    cross = [[s * (i == j) for j in range(5)] for i in range(5) for s in (1.0, -1.0)]
    check_whitening(whitening.whitened_components(rows_of(spark, cross)).collect(), fixed(rows_of(spark, cross), 64, 5))
    flat = [[i % 3 * 1.0, 2.0, i * 0.5] for i in range(12)]
    got = whitening.whitened_components(rows_of(spark, flat)).collect()
    check_whitening(got, fixed(rows_of(spark, flat), 64, 3))
    assert {r.whitened for r in got if r.component == 3} == {None}
    one = whitening.whitened_components(rows_of(spark, [[1.0, 2.0]])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 1, 0, None, 0.0), (2, 1, 0, None, 0.0)]


def test_whitening_is_the_same_for_any_division_of_rows(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    key = ["vec_id", "component", "n", "deviation", "whitened", "explained"]
    a, b = (sorted(tuple(r) for r in whitening.whitened_components(frame.repartition(n)).select(key).collect()) for n in (1, 5))
    assert a == b


def test_deviations_beyond_64_bits_stay_exact(spark):
    frame = rows_of(spark, [[1e9, -1e9], [-1e9, 5e8], [3.0, 2e9]])
    rows = [[math.floor(64 * np.float32(c)) for c in v] for v in ([1e9, -1e9], [-1e9, 5e8], [3.0, 2e9])]
    sums = [sum(c) for c in zip(*rows, strict=True)]
    want = sorted(sum((3 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in rows)
    assert sorted(int(r.deviation) for r in whitening.whiten(frame).collect()) == want and max(want) > 2**62


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 30), np.r_[np.ones(12), 2 * np.ones(12)], np.r_[1 + 1e-9 * np.arange(20), 5.0, 5.0],
    np.r_[1 + 1e-12 * np.arange(10), 3 + 1e-7 * np.arange(10)], np.logspace(-10, 3, 24), np.r_[np.zeros(10), np.linspace(1, 2, 10)],
])
def test_refinement_with_clustered_values(values):
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(len(values),) * 2))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    e, x = whitening.refined_eigen(a)
    top = np.abs(a).max()
    assert (np.diff(e) <= 0).all() and np.abs(np.sort(values)[::-1] - e).max() < 1e-13 * max(top, values.max())
    assert np.abs(a @ x - x * e).max() < 4e-15 * max(top, 1) and np.abs(x.T @ x - np.eye(len(a))).max() < 2e-15


def test_single_precision_alone_would_not_do():
    a = np.cov(np.random.default_rng(2).normal(size=(40, 200)))
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    _, x = whitening.refined_eigen(a)
    off = [np.abs(y.T @ a @ y - np.diag(np.diag(y.T @ a @ y))).max() for y in (rough, x)]
    assert off[0] > 1e-8 and off[1] < 1e-14


# --- all three ---


def test_empty_tables_and_tables_of_bad_rows(spark):
    for frame in (spark.createDataFrame([], SCHEMA), rows_of(spark, [None, [], [NAN, 1.0]], ids=[0, 100, 200])):
        assert vector_codes.compressed_codes(frame).collect() == []
        assert top_k.top_hundredth(frame).collect() == []
        assert whitening.whitened_components(frame).collect() == []


def test_whole_numbers_survive_packing_and_products():
    small, large = np.array([[1.0, -(2.0**31) + 1]]), np.array([[2.0**40, -5.0]])
    for m in (small, large):
        assert (unpacked(packed(m), 2) == m).all()
    assert exact_product(large, large.T)[0, 0] == 2**80 + 25


def test_queries_return_the_columns_agreed(spark):
    kinds = {
        "op11_vector_codes": [("vec_id", "bigint"), ("code", "string"), ("error", "bigint"), ("label_error", "bigint"), ("codebooks_sha256", "string")],
        "op12_top_k": [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")],
        "op13_whitening": [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")],
    }
    for name, kind in kinds.items():
        assert QUERIES[name](spark, SF).dtypes == kind
