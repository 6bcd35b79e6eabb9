"""Operators 4 and 8 against brute force, also where their divisions are made very small."""

import random

import numpy as np
import pytest
import xxhash

from salesflow.llm import common, repeats, simhash
from salesflow.llm.queries import QUERIES

from . import helpers

SF = "/root/testdata/sf0.001"


def passages(seed):
    random_ = random.Random(seed)
    base = ["".join(random_.choice("ab \n") for _ in range(200)) for _ in range(5)] + ["x" * 300, "ab" * 100]
    text = lambda: "".join(random_.choice(base)[random_.randint(0, 100) :][: random_.randint(20, 150)] for _ in range(random_.randint(0, 6)))
    return [(i, text()) for i in range(120)] + [(3, "x" * 120), (None, "x" * 200), (200, None), (201, ""), (202, "é" * 80), (203, "é" * 81)]


@pytest.mark.parametrize("bucket", [24 << 20, 8000])
def test_repeats_equal_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(repeats, "BUCKET_BYTES", bucket)
    documents = passages(7)
    frame = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    assert helpers.rows(repeats.without_repeats(frame)) == helpers.repeats(documents)


@pytest.mark.parametrize("hot, piece", [(0, 1024), (300, 7), (4000, 40)])
def test_hot_minimizers_and_small_chunks(monkeypatch, hot, piece):
    """The steps of the operator by hand, with limits that only workers would see otherwise."""
    monkeypatch.setattr(repeats, "HOT_BYTES", hot)
    monkeypatch.setattr(repeats, "PIECE", piece)
    monkeypatch.setattr(repeats, "INDEX_BYTES", 500)
    monkeypatch.setattr(repeats, "BLOCK", 64)
    documents, buckets = passages(8), 3
    blobs = {}
    for c in range(0, len(documents), 9):
        part = documents[c : c + 9]
        texts = [(t or "").encode() for _, t in part]
        ids = np.array([0 if i is None else i for i, _ in part], np.int64)
        known = np.array([i is not None for i, _ in part])
        blobs[c] = repeats.pack(ids, known, np.array([len(t) for t in texts], np.int64), np.frombuffer(b"".join(texts), np.uint8))
    sent, replies, answers = {}, {}, {}
    for c, blob in blobs.items():
        for b, _, data in repeats.hashes_by_bucket(c, blob, buckets):
            sent.setdefault(b, []).append((b, c, data))
    for b, rows in sent.items():
        for c, _, data in repeats.find_repeated(b, rows):
            replies.setdefault(c, []).append((b, data))
    chosen = {c: repeats.Selected(repeats.Chunk(blob), replies.get(c, []), buckets) for c, blob in blobs.items()}
    for b in range(buckets):
        rows = []
        for c, x in chosen.items():
            at = np.flatnonzero(x.bucket == b)
            if len(at):
                rows.append((b, c, repeats.pack_strings([x.strings[i] for i in at], x.low[at], x.least[at], x.most[at])))
        for c, data in repeats.bucket_answers(b, rows) if rows else ():
            answers.setdefault(c, []).append(data)
    got = []
    for c, blob in blobs.items():
        here = repeats.Chunk(blob)
        got += np.split(repeats.removed_bytes(here, chosen[c], answers.get(c, [])), here.ends[:-1])
    expected = {(i, sha): n for i, _, n, _, sha in helpers.repeats(documents)}
    for (i, t), gone in zip(documents, got):
        kept = bytes(b for b, x in zip((t or "").encode(), gone) if not x)
        assert expected[i, helpers.sha(kept)] == gone.sum()


def slow_least(strings, least, p, s):
    return min((d for d, t in zip(least, strings) if s[p : p + 50] in t), default=repeats.NONE)


def test_index_orders_windows_by_least_document():
    strings = [b"a" * 60, b"b" + b"a" * 55, b"c" * 50 + b"a" * 50, b"cc" + b"a" * 52]
    least = np.array([1, 4, 6, 9])
    docs = repeats.RunLengthIndex(strings, least, others=False).match(strings, own=True)
    assert docs.tolist() == [slow_least(strings, least, p, s) for s in strings for p in range(len(s) - 49)]


def pieces(seed, n):
    """Strings of few letters, periodic ones, and mosaics of a few passages with single bytes changed."""
    random_ = random.Random(seed)
    base = [bytes(random.Random(i).choice(b"ab\x00\xff") for _ in range(140)) for i in range(4)] + [b"-" * 140, b"-=" * 70]
    out = []
    for _ in range(n):
        text = bytearray(b"".join(random_.choice(base)[random_.randint(0, 60) :][: random_.randint(30, 140)] for _ in range(3)))
        for _ in range(random_.randint(0, 2)):
            text[random_.randrange(len(text))] = random_.randrange(256)
        out.append(bytes(text[: random_.randint(50, max(50, len(text)))]).ljust(50, b"."))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_matching_statistics_of_other_strings(seed):
    """Strings that the index lacks, in whole or in part, with bytes it has never seen."""
    strings, others = pieces(seed, 30), pieces(seed + 100, 30) + pieces(seed, 5) + [b"Q" * 70]
    least = np.sort(np.array([random.Random(seed + i).randint(0, 40) for i in range(30)]))
    docs = repeats.RunLengthIndex(strings, least).match(others)
    assert docs.tolist() == [slow_least(strings, least, p, s) for s in others for p in range(len(s) - 49)]
    assert 0 < np.count_nonzero(docs == repeats.NONE) < len(docs)


@pytest.mark.parametrize("size", [100, 700, 1 << 20])
def test_batches_equal_one_index(monkeypatch, size):
    monkeypatch.setattr(repeats, "INDEX_BYTES", size)
    strings = pieces(7, 60)
    least = np.sort(np.array([random.Random(i).randint(0, 50) for i in range(60)]))
    got = repeats.least_documents(strings, least)
    assert [x.tolist() for x in got] == [[slow_least(strings, least, p, s) for p in range(len(s) - 49)] for s in strings]


def test_index_keeps_runs_only():
    """300 overlapping parts of a passage and 20 copies with a byte changed: the index follows the changes, not the text."""
    random_ = random.Random(3)
    passage = bytes(random_.randrange(97, 123) for _ in range(600))
    strings = [passage[:i] + b"#" + passage[i + 1 :] for i in range(0, 600, 30)] + [passage[a : a + 300] for a in range(300)]
    made = repeats.RunLengthIndex(strings, np.arange(len(strings)), others=False)
    held = [x for x in vars(made).values() if isinstance(x, np.ndarray)]
    assert max(len(x) for x in held) < made.n / 4


def test_long_periodic_texts_are_cut(spark):
    """Rulers of 200 KB in several documents: equal parts are sent once, and the result is as by brute force."""
    documents = [(i, "x" * i + "-" * 200_000 + "=-" * 3000) for i in range(4)] + [(9, "-" * 49)]
    got = {r.doc_id: r for r in repeats.without_repeats(spark.createDataFrame(documents, "doc_id long, text string")).collect()}
    assert [got[i].n_removed for i in (0, 1, 2, 3, 9)] == [0, 206_000, 206_001, 206_002, 0]
    here = repeats.Chunk(repeats.pack(np.array([1]), np.array([True]), np.array([200_000]), np.frombuffer(b"-" * 200_000, np.uint8)))
    assert here.fragments()[1].max() == repeats.PIECE


def test_ids_that_are_no_numbers_are_refused(spark):
    with pytest.raises(TypeError, match="whole numbers"):
        repeats.without_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_repeats_query(spark):
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert helpers.rows(QUERIES["op4_repeated_passages"](spark, SF)) == helpers.repeats(documents)


def test_repeats_edges(spark):
    got = helpers.rows(repeats.without_repeats(helpers.edges(spark)))
    assert got == helpers.repeats([(i, t) for i, t, *_ in helpers.EDGES])
    assert repeats.without_repeats(helpers.empty(spark)).count() == 0
    kept = repeats.without_repeats(helpers.edges(spark), texts=True).where("doc_id = 6").first()
    assert bytes(kept.kept).decode() == "é😀的" * 100


def slow_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in ("", "One", "One two", "a B c", "É é A a " * 9, "x y z w " * 50, "a b c\x0bd"):
        assert simhash.fingerprint(text, 3) % 2**64 == slow_fingerprint(text)


@pytest.mark.parametrize("bucket", [4096, 24])
def test_groups_equal_brute_force(spark, monkeypatch, bucket):
    """Also with chains, dense clusters and buckets that have to be refined."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    if bucket < 4096:
        monkeypatch.setattr(simhash, "plan", lambda *_: [(list(range(b, b + 16)), 0) for b in range(0, 64, 16)])
    random_ = random.Random(9)
    values = [0, 2**64 - 1]
    for _ in range(12):
        value = random_.getrandbits(64)
        for _ in range(random_.randint(1, 8)):
            values.append(value)
            for _ in range(random_.randint(1, 3)):
                value ^= 1 << random_.randrange(64)
    shared = [random_.getrandbits(48) << 16 | 0x1234 for _ in range(30)]  # one large bucket, to be refined
    values += shared + [v ^ (1 << random_.randrange(16, 64)) ^ (1 << random_.randrange(16, 64)) for v in shared]
    values = list(dict.fromkeys(values))
    signed = [(v - 2**64 if v >> 63 else v,) for v in values]
    distinct = spark.createDataFrame(signed, "fp long")
    root = {r.node: r.root for r in common.components(simhash.links(distinct, 3)).collect()}
    expected = helpers.components(len(values), lambda i: [j for j in range(i + 1, len(values)) if (values[i] ^ values[j]).bit_count() <= 3])
    groups = {}
    for i, (v,) in enumerate(signed):
        assert groups.setdefault(expected[i], root.get(v, v)) == root.get(v, v)
    assert len(set(groups.values())) == len(groups)


def test_unequal_thresholds_find_every_pair(spark, monkeypatch):
    """Thresholds other than zero, on either side of the pigeonhole sum."""
    random_ = random.Random(10)
    values = [random_.getrandbits(64) for _ in range(40)]
    for v in list(values):
        for b in random_.sample(range(64), 3):
            v ^= 1 << b
        values.append(v)
    distinct = spark.createDataFrame([(v - 2**64 if v >> 63 else v,) for v in values], "fp long")
    bits = list(range(64))
    for groups in ([(bits[:32], 1), (bits[32:], 1)], [(bits[:20], -1), (bits[20:40], 0), (bits[40:], 2)], [(bits[:8], 0), (bits[8:36], 1), (bits[36:], 0)]):
        monkeypatch.setattr(simhash, "plan", lambda *_, g=groups: g)
        assert len({frozenset(r) for r in simhash.links(distinct, 3).collect()}) >= 40


def test_allotment_is_the_least_cost():
    costs = [{-1: 0.0, 0: 5.0, 1: 9.0}, {-1: 0.0, 0: 1.0, 1: 100.0}, {-1: 0.0, 0: 50.0, 1: 51.0}]
    assert simhash.allot(costs, 0) == (10.0, [1, 0, -1])


def test_simhash_query(spark):
    found = QUERIES["op8_simhash"](spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(int(r.fingerprint, 16) == slow_fingerprint(docs[r.doc_id]) and len(r.fingerprint) == 16 for r in found)
    expected = helpers.simhash_components([r.doc_id for r in found], [int(r.fingerprint, 16) for r in found])
    assert [r.component_id for r in found] == expected


def test_simhash_edges(spark):
    found = simhash.near_duplicates(helpers.edges(spark)).collect()
    assert len(found) == len(helpers.EDGES)
    expected = helpers.simhash_components([r.doc_id for r in found], [int(r.fingerprint, 16) for r in found])
    assert [r.component_id for r in found] == expected
    assert simhash.near_duplicates(helpers.empty(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    chain = spark.range(60).selectExpr("(id * 5) % 61 AS a", "((id + 1) * 5) % 61 AS b")
    assert helpers.rows(common.components(chain)) == sorted(((i, 0) for i in range(61)), key=str)


def test_keep_one(spark):
    docs = spark.createDataFrame([(1, "a", 2), (1, "a", 1), (2, "b", 1), (None, "c", 1), (None, "c", 1), (3, "d", 1)], "doc_id long, _id string, n int")
    ids = spark.createDataFrame([(1,), (1,), (2,)], "doc_id long")
    assert helpers.rows(common.keep_one(docs, ids, "doc_id")) == [(1, "a", 1), (2, "b", 1), (None, "c", 1), (None, "c", 1)]
