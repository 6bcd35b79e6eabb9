"""Operator 4, removal of repeated passages with a run-length index.

A byte goes if some `span`-byte string around it also starts in a document with a smaller id. The work is divided so
that equal strings always meet, and whole documents never do:

1. Documents are packed into chunks of a few megabytes, which are written once.
2. Each `span`-byte window has a minimizer, the least hash of the K-byte strings in it; windows in a row that share
   it form a fragment. Chunks send the hashes they have to buckets (each once), which send back those that more than
   one document has. Most text ends here.
3. Chunks send the fragments of repeated minimizers, each distinct one once, with its least document, to buckets. A
   bucket takes its fragments in batches, those of earlier documents first. Each batch gets a run-compressed
   Burrows-Wheeler transform with sampled run ends. The fragments of a batch are streamed from their ends through the
   indexes of the batches before, and through its own: the matching statistics (how many bytes from here match, up to
   `span`, and where) give the least document of each window. Only fragments with a window that no earlier batch has
   are indexed, and of an index only what is proportional to its runs is kept. Fragments that are alone with their
   minimizer need no index. A minimizer with more than HOT_BYTES of fragments is not one group: its fragments are cut
   into their windows, which meet by a hash of all their bytes instead.
4. The windows with an earlier document come back to the chunks, which mark the bytes.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NullType

from .common import cut_lineage, id_and_text, sha256

SPAN = 50
K = 20
#: Bytes of text in a chunk, and of the text whose hashes and fragments a bucket gets on average.
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 24 << 20
#: Bytes of fragments that one index covers, and that are streamed at once.
INDEX_BYTES = 1 << 20
#: Windows of a fragment; longer ones (rulers, padding, other periodic text) are cut, so that their parts can be equal.
PIECE = 1024
#: Bytes of fragments that may meet by one minimizer, and the unit in which chunks count them.
HOT_BYTES = 8 << 20
UNIT = 64
#: Bytes whose windows are hashed at once.
BLOCK = 1 << 16
#: Of zstd, for everything that is written or shuffled.
LEVEL = 5
LOW = np.uint64((1 << 40) - 1)
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

NONE = np.iinfo(np.int64).max

Rows = Iterator[tuple]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays and their sizes, compressed."""
    sizes = np.array([len(arrays), *(x.nbytes for x in arrays)], np.int64)
    return zstandard.ZstdCompressor(LEVEL).compress(b"".join([sizes.tobytes(), *(x.tobytes() for x in arrays)]))


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(data, np.int64, 1 + len(kinds))[1:].tolist()
    at, out = 8 * (1 + len(kinds)), []
    for size, kind in zip(sizes, kinds):
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def narrow(hashes: np.ndarray) -> np.ndarray:
    """The low 40 bits of each: all first bytes, then all second ones, and so on, which compresses better in order."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].T).ravel()


def widen(data: np.ndarray) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = data.reshape(5, -1).T
    return out.view("<u8").ravel()


def emit(rows: Rows, names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Record batches of at most a few megabytes of blobs (the last field)."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1]) if isinstance(row[-1], bytes) else 100
        if size > 1 << 24:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*held), types)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*held), types)], names)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Rows:
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def by_key(frame: DataFrame, key: str, then: str, work: Callable[[object, Rows], Rows], schema: str, types: list[pa.DataType]) -> DataFrame:
    """`work` of each key and its rows, ordered by `then`; keys stream through a task one by one."""
    names = [x.split()[0] for x in schema.split(", ")]
    first = frame.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = itertools.groupby(rows_of(batches), key=lambda r: r[first])
        yield from emit((row for k, rows in groups for row in work(k, rows)), names, types)

    return frame.repartition(key).sortWithinPartitions(key, then).mapInArrow(run, schema)


def pack_chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(chunk, n_bytes, blob): the ids, which ids there are, the sizes and the bytes of some documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), itertools.count()

        def rows() -> Rows:
            ids, texts, size = [], [], 0
            for i, text in rows_of(batches):
                ids.append(i)
                texts.append(text.encode())
                size += len(texts[-1]) + 16
                if size >= CHUNK_BYTES:
                    yield row(ids, texts, size)
                    ids, texts, size = [], [], 0
            if ids:
                yield row(ids, texts, size)

        def row(ids: list, texts: list[bytes], size: int) -> tuple:
            known = np.array([i is not None for i in ids])
            numbers = np.array([0 if i is None else i for i in ids], np.int64)
            lengths = np.array([len(x) for x in texts], np.int64)
            return f"{part}-{next(count)}", size, pack(numbers, known, lengths, np.frombuffer(b"".join(texts), np.uint8))

        yield from emit(rows(), ["chunk", "n_bytes", "blob"], [pa.string(), pa.int64(), pa.binary()])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "chunk string, n_bytes long, blob binary")


class Chunk:
    """The documents of a chunk and their fragments: start, number of windows, minimizer and document of each."""

    def __init__(self, blob: bytes):
        self.ids, self.known, self.lengths, self.data = unpack(blob, "i8", "?", "i8", "u1")
        self.ends = np.cumsum(self.lengths)
        self.begins = self.ends - self.lengths

    def fragments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n = len(self.data) - SPAN + 1
        none = np.zeros(0, np.int64)
        if n <= 0:
            return none, none, none.astype(np.uint64), none
        least = minimizers(self.data)
        change = np.zeros(len(self.data) + 1, np.int32)
        whole = self.known & (self.lengths >= SPAN)
        np.add.at(change, self.begins[whole], 1)
        np.add.at(change, self.ends[whole] - SPAN + 1, -1)
        inside = np.cumsum(change)[:n] > 0
        first = inside.copy()
        first[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
        starts = np.flatnonzero(first)
        stops = np.flatnonzero(inside & np.append(first[1:] | ~inside[1:], True)) + 1
        parts = -(-(stops - starts) // PIECE)
        starts, stops = np.repeat(starts, parts), np.repeat(stops, parts)
        starts = starts + PIECE * (np.arange(len(starts)) - np.repeat(np.cumsum(parts) - parts, parts))
        stops = np.minimum(stops, starts + PIECE)
        return starts, stops - starts, least[starts], np.searchsorted(self.ends, starts, side="right")


def minimizers(data: np.ndarray) -> np.ndarray:
    """The least hash of a K-byte string in each SPAN-byte window, block by block."""
    n = len(data) - SPAN + 1
    return np.concatenate([_minimizers(data[at : min(at + BLOCK, n) + SPAN - 1]) for at in range(0, n, BLOCK)])


def _minimizers(data: np.ndarray) -> np.ndarray:
    """Hashes are built by doubling, and so are the least ones of a window."""
    sums, size, parts = {1: data.astype(np.uint64) + np.uint64(1)}, 1, []
    while 2 * size <= K:
        last = sums[size]
        sums[2 * size] = (last[:-size] * A) ^ ((last[size:] + B) * B)
        sums[2 * size] ^= sums[2 * size] >> np.uint64(31)
        size *= 2
    left, at = K, 0
    while left:
        size = 1 << (left.bit_length() - 1)
        parts.append((sums[size], at))
        at, left = at + size, left - size
    n = len(data) - K + 1
    mixed = np.zeros(n, np.uint64)
    for part, shift in parts:
        mixed = (mixed + part[shift : shift + n]) * A
        mixed ^= mixed >> np.uint64(29)
    width, reach = SPAN - K + 1, 1
    while 2 * reach <= width:
        mixed = np.minimum(mixed[:-reach], mixed[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(mixed[:-rest], mixed[rest:]) if rest else mixed


def split_hash(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64), hashes & LOW


def hashes_by_bucket(chunk: str, blob: bytes, buckets: int) -> Rows:
    """(bucket, chunk, blob): the minimizers of a chunk, whether more than one of its documents has them, and the
    bytes of their fragments in units (equal fragments, told apart by size and sum, count once)."""
    here = Chunk(blob)
    starts, sizes, least, doc = here.fragments()
    bucket, low = split_hash(least, buckets)
    sums = np.append(0, np.cumsum(here.data, dtype=np.int64))
    kind = (sums[starts + sizes + SPAN - 1] - sums[starts]) * (2 * PIECE) + sizes
    order = np.lexsort((kind, low, bucket))
    bucket, low, ids, kind = bucket[order], low[order], here.ids[doc[order]], kind[order]
    other = (bucket[1:] != bucket[:-1]) | (low[1:] != low[:-1])
    new = np.flatnonzero(np.append(True, other)[: len(low)])
    if not len(new):
        return
    several = np.minimum.reduceat(ids, new) != np.maximum.reduceat(ids, new)
    held = np.where(np.append(True, other | (kind[1:] != kind[:-1])), sizes[order] + SPAN - 1, 0)
    units = np.minimum(-(-np.add.reduceat(held, new) // UNIT), 65_535).astype(np.uint16)
    bucket, low = bucket[new], low[new]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(low)]):
        yield int(bucket[a]), chunk, pack(narrow(low[a:b]), np.packbits(several[a:b]), units[a:b])


def find_repeated(bucket: int, rows: Rows) -> Rows:
    """(chunk, bucket, blob): of what the chunks sent, what more than one document has, and what is hot."""
    chunks, lows, flags, counts = [], [], [], []
    for _, chunk, blob in rows:
        low, several, units = unpack(blob, "u1", "u1", "u2")
        chunks.append(chunk)
        counts.append(units)
        lows.append(widen(low))
        flags.append(np.unpackbits(several, count=len(lows[-1])).astype(bool))
    every = np.concatenate(lows)
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    group = np.cumsum(new) - 1
    twice = (np.bincount(group) > 1) | (np.bincount(group, weights=np.concatenate(flags)[order]) > 0)
    many = np.bincount(group, weights=np.concatenate(counts)[order]) * UNIT > HOT_BYTES
    again, hot = np.empty(len(every), bool), np.empty(len(every), bool)
    again[order], hot[order] = twice[group], many[group]
    at = 0
    for chunk, low in zip(chunks, lows):
        kept = np.flatnonzero(again[at : at + len(low)])
        if len(kept):
            yield chunk, bucket, pack(narrow(low[kept]), np.packbits(hot[at + kept]))
        at += len(low)


def repeated_hashes(chunks: DataFrame, buckets: int) -> DataFrame:
    """(chunk, bucket, blob): minimizers of a chunk that more than one document has."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for chunk, blob in rows_of(batches) for row in hashes_by_bucket(chunk, blob, buckets))
        yield from emit(rows, ["bucket", "chunk", "blob"], [pa.int64(), pa.string(), pa.binary()])

    sent = chunks.select("chunk", "blob").mapInArrow(send, "bucket long, chunk string, blob binary")
    return by_key(sent, "bucket", "chunk", find_repeated, "chunk string, bucket long, blob binary", [pa.string(), pa.int64(), pa.binary()])


class Selected:
    """The fragments of a chunk whose minimizers are repeated, and which distinct string each one is."""

    def __init__(self, here: Chunk, hashes: list[tuple[int, bytes]], buckets: int):
        starts, sizes, least, doc = here.fragments()
        bucket, low = split_hash(least, buckets)
        key = (bucket.astype(np.uint64) << np.uint64(40)) | low
        wanted, hot = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
        for b, blob in hashes:
            lows, many = unpack(blob, "u1", "u1")
            wanted.append((np.uint64(b) << np.uint64(40)) | widen(lows))
            hot.append(np.unpackbits(many, count=len(wanted[-1])).astype(bool))
        wanted, hot = np.concatenate(wanted), np.concatenate(hot)
        data = here.data.tobytes()
        keep = np.flatnonzero(np.isin(key, wanted[~hot]))
        cut = np.flatnonzero(np.isin(key, wanted[hot]))
        # windows of hot minimizers, each by itself
        n = sizes[cut]
        single = np.repeat(starts[cut] - np.cumsum(n) + n, n) + np.arange(n.sum())
        own = np.array([xxhash.xxh64_intdigest(data[a : a + SPAN]) for a in single.tolist()], np.uint64)
        own_bucket, own_low = split_hash(own, buckets)
        join = lambda some, more: np.concatenate([some[keep], more])
        self.starts, self.sizes = join(starts, single), join(sizes, np.ones(len(single), np.int64))
        self.doc, bucket, low = join(doc, np.repeat(doc[cut], n)), join(bucket, own_bucket), join(low, own_low)
        number: dict[bytes, int] = {}
        ends = (self.starts + self.sizes + SPAN - 1).tolist()
        self.which = np.fromiter(
            (number.setdefault(data[a:b], len(number)) for a, b in zip(self.starts.tolist(), ends)), np.int64, len(ends))
        self.strings = list(number)
        first = np.full(len(number), len(ends), np.int64)
        np.minimum.at(first, self.which, np.arange(len(ends)))
        self.bucket, self.low = bucket[first], low[first]
        ids = here.ids[self.doc]
        self.least, self.most = np.full(len(number), np.iinfo(np.int64).max), np.full(len(number), np.iinfo(np.int64).min)
        np.minimum.at(self.least, self.which, ids)
        np.maximum.at(self.most, self.which, ids)


class RunLengthIndex:
    """The run-compressed transform of strings, given in the order of their least documents.

    Rows are all suffixes, by their first SPAN bytes and then by place; a row's character is the byte before its
    suffix. An interval is the rows that agree in their first SPAN bytes, and a run is successive rows of an interval
    with one character. Rows of one character keep their order, up to intervals, when that byte is put in front of them.
    Kept are, for each run, its character, start, length and the row it leads to; for each interval the sample at the
    end of its first run, which is the least document that has the window, and the number of bytes that it shares
    with the interval before (`others`: needed for strings that are not in the index); and one row for each string.
    """

    def __init__(self, strings: list[bytes], least: np.ndarray, others: bool = True):
        sizes = np.array([len(x) for x in strings], np.int64)
        text = np.zeros(int(sizes.sum()) + len(strings) + 1, np.int64)  # 0 stands between strings
        joined = np.frombuffer(b"".join(strings), np.uint8)
        place = np.arange(len(joined)) + np.repeat(np.arange(len(strings)) + 1, sizes)
        text[place] = joined.astype(np.int64) + 1
        self.n = n = len(text)
        ahead = lambda x, by: np.append(x[by:], np.zeros(min(by, n), x.dtype))
        key = np.zeros(n, np.int64)
        for j in range(7):
            key = key * 257 + ahead(text, j)
        for more in (7, 14, 22):  # ranks by the first 7, 14 and 28 bytes, then by all 50
            rank = np.unique(key, return_inverse=True)[1]
            key = rank * np.int64(n) + ahead(rank, more)
        rows = np.argsort(key, kind="stable")
        ordered = key[rows]
        head = np.append(True, ordered[1:] != ordered[:-1])
        self.heads = np.flatnonzero(head)
        owner = np.append(np.repeat(np.arange(len(strings)), sizes + 1), len(strings) - 1)
        self.sample = least[owner[rows[self.heads]]]
        row_of = np.empty(n, np.int64)
        row_of[rows] = np.arange(n)
        self.entry = row_of[np.cumsum(sizes + 1) - SPAN]  # of each string's last window
        before = text[rows - 1]  # a place before the first one reads the last separator
        runs = np.flatnonzero(head | np.append(True, before[1:] != before[:-1]))
        symbol, length = before[runs], np.diff(np.append(runs, n))
        by_symbol = np.argsort(symbol, kind="stable")
        self.symbol, self.start, self.length = symbol[by_symbol], runs[by_symbol], length[by_symbol]
        self.interval = (np.cumsum(head) - 1)[self.start]
        self.keys = self.symbol * n + self.start
        self.target = np.cumsum(self.length) - self.length
        self.shared = [_shared(text, rows[self.heads])] if others else []
        while self.shared and len(self.shared[-1]) > 1 << (len(self.shared) - 1):
            last, by = self.shared[-1], 1 << (len(self.shared) - 1)
            self.shared.append(np.minimum(last[:-by], last[by:]))

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many first bytes two intervals share: the least that neighbours from one to the other share."""
        low, high = np.minimum(a, b), np.maximum(a, b)
        out = np.full(len(a), SPAN, np.int64)
        for i in np.flatnonzero(low < high).tolist() if len(a) < 8 else ():
            level = int(high[i] - low[i]).bit_length() - 1
            out[i] = min(self.shared[level][low[i] + 1], self.shared[level][high[i] + 1 - (1 << level)])
        if len(a) >= 8:
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            for k in np.unique(level[low < high]).tolist():
                at = np.flatnonzero((level == k) & (low < high))
                out[at] = np.minimum(self.shared[k][low[at] + 1], self.shared[k][high[at] + 1 - (1 << k)])
        return out

    def step(self, rows: np.ndarray, length: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and lengths of the matches with a byte more to the left.

        A row whose character is another byte gives way to the end of the next run of this byte, above or below,
        whichever shares more with it.
        """
        run = np.searchsorted(self.keys, symbols * self.n + rows, side="right") - 1
        at = np.maximum(run, 0)
        above = (run >= 0) & (self.symbol[at] == symbols)
        within = rows - self.start[at]
        out, length = self.target[at] + within, length.copy()
        lost = np.flatnonzero(~above | (within >= self.length[at]))
        if len(lost):
            row, up = rows[lost], at[lost]
            down = np.minimum(run[lost] + 1, len(self.keys) - 1)
            mine = np.searchsorted(self.heads, row, side="right") - 1
            same_up, same_down = above[lost], (self.symbol[down] == symbols[lost]) & (self.start[down] > row)
            if self.shared:
                up_shares = np.where(same_up, self.agree(self.interval[up], mine), -1)
                down_shares = np.where(same_down, self.agree(self.interval[down], mine), -1)
            else:  # the byte comes within the interval
                up_shares = np.where(same_up & (self.interval[up] == mine), SPAN, -1)
                down_shares = np.where(same_down & (self.interval[down] == mine), SPAN, -1)
            best = np.maximum(up_shares, down_shares)
            out[lost] = np.where(up_shares >= down_shares, self.target[up] + self.length[up] - 1, self.target[down])
            length[lost] = np.minimum(length[lost], best)  # -1: no such byte
            out[lost[best < 0]] = 0
        return out, np.minimum(length + 1, SPAN)

    def match(self, strings: list[bytes], own: bool = False) -> np.ndarray:
        """The least document of every window of the strings, one after the other; NONE for windows the index lacks.

        All strings are streamed at once, each from its end. `own`: these are the strings of the index.
        """
        sizes = np.array([len(x) for x in strings], np.int64)
        data = np.frombuffer(b"".join(strings), np.uint8)
        windows, begins = sizes - SPAN + 1, np.cumsum(sizes) - sizes
        offsets = np.cumsum(windows) - windows
        out = np.full(int(windows.sum()), NONE)
        left = windows if own else sizes
        order = np.argsort(-left, kind="stable")
        alive = np.searchsorted(-left[order], -np.arange(1, left.max() + 1), side="right")
        left, windows, begins, offsets = left[order], windows[order], begins[order], offsets[order]
        rows = self.entry[order] if own else np.zeros(len(order), np.int64)
        length = np.full(len(order), SPAN if own else 0)
        for k, m in enumerate(alive.tolist()):
            place, rows, length = left[:m] - 1 - k, rows[:m], length[:m]
            if k or not own:
                rows, length = self.step(rows, length, data[begins[:m] + place].astype(np.int64) + 1)
            full = np.flatnonzero(length == SPAN)
            out[offsets[full] + place[full]] = self.sample[np.searchsorted(self.heads, rows[full], side="right") - 1]
        return out


def _shared(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many of their first SPAN bytes successive suffixes share; 0 for the first."""
    out = np.zeros(len(places), np.uint8)
    going = np.arange(1, len(places))
    for j in range(SPAN):
        one, two = places[going - 1] + j, places[going] + j
        inside = (one < len(text)) & (two < len(text))
        going, one, two = going[inside], one[inside], two[inside]
        going = going[text[one] == text[two]]
        out[going] += 1
    return out


def least_documents(strings: list[bytes], least: np.ndarray) -> list[np.ndarray]:
    """Of each string, in order of their least documents, the least document of each window."""
    out, earlier = [], []
    sizes = np.array([len(x) for x in strings], np.int64)
    batch = (np.cumsum(sizes) - 1) // (2 * INDEX_BYTES)
    cuts = [*np.flatnonzero(np.append(True, batch[1:] != batch[:-1])).tolist(), len(strings)]
    for a, b in itertools.pairwise(cuts):
        windows = sizes[a:b] - SPAN + 1
        begins = np.cumsum(windows) - windows
        found = np.full(int(windows.sum()), NONE)
        for index in earlier:
            found = np.minimum(found, index.match(strings[a:b]))
        new = np.maximum.reduceat(found, begins) == NONE
        if new.any():
            fresh = [x for x, is_new in zip(strings[a:b], new.tolist()) if is_new]
            index = RunLengthIndex(fresh, least[a:b][new], others=b < len(strings))
            at = np.repeat(new, windows)
            found[at] = np.minimum(found[at], index.match(fresh, own=True))
            earlier.append(index)
        out += np.split(found, begins[1:])
    return out


def bucket_answers(bucket: int, rows: Rows) -> Rows:
    """(chunk, blob): stretches of windows (string, first, number, least document) that an earlier document has."""
    number: dict[bytes, int] = {}
    low_of: list[int] = []
    chunks, which, mosts, least = [], [], [], np.zeros(0, np.int64)
    for _, chunk, blob in rows:
        strings, low, lows, most = unpack_strings(blob)
        here = np.fromiter((number.setdefault(x, len(number)) for x in strings), np.int64, len(strings))
        fresh = len(number) - len(low_of)
        if fresh:
            least = np.append(least, np.full(fresh, np.iinfo(np.int64).max))
            added = np.zeros(fresh, np.uint64)
            added[here[here >= len(low_of)] - len(low_of)] = low[here >= len(low_of)]
            low_of.extend(added.tolist())
        np.minimum.at(least, here, lows)
        chunks.append(chunk)
        which.append(here)
        mosts.append(most)
    strings = list(number)
    sizes = np.array([len(x) - SPAN + 1 for x in strings], np.int64)
    lows = np.array(low_of, np.uint64)
    # strings by minimizer, and within one by least document
    order = np.lexsort((least, lows))
    group = np.append(0, np.cumsum(lows[order][1:] != lows[order][:-1]))
    alone = np.bincount(group)[group] == 1
    found: dict[int, np.ndarray] = {}
    held, size = [], 0

    def index() -> None:
        by = sorted(held, key=lambda i: least[i])
        found.update(zip(by, least_documents([strings[i] for i in by], least[by])))

    last = -1
    for i, g, single in zip(order.tolist(), group.tolist(), alone.tolist()):
        if single:
            continue
        if size >= INDEX_BYTES and g != last:
            index()
            held, size = [], 0
        held.append(i)
        size += len(strings[i])
        last = g
    if held:
        index()
    # runs of windows of one least document
    first, length, doc, begin = [], [], [], np.zeros(len(strings) + 1, np.int64)
    for i in range(len(strings)):
        docs = found.get(i)
        if docs is None or docs[0] == docs[-1] and (docs == docs[0]).all():
            cuts, values = [0], [int(least[i] if docs is None else docs[0])]
        else:
            cuts = np.flatnonzero(np.append(True, docs[1:] != docs[:-1])).tolist()
            values = docs[cuts].tolist()
        first += cuts
        length += [b - a for a, b in zip(cuts, [*cuts[1:], int(sizes[i])])]
        doc += values
        begin[i + 1] = len(first)
    first, length, doc = np.array(first, np.int64), np.array(length, np.int64), np.array(doc, np.int64)
    for chunk, here, most in zip(chunks, which, mosts):
        count = begin[here + 1] - begin[here]
        at = np.repeat(begin[here] - np.cumsum(count) + count, count) + np.arange(count.sum())
        string = np.repeat(np.arange(len(here)), count)
        keep = doc[at] < most[string]
        if keep.any():
            at, string = at[keep], string[keep]
            yield chunk, pack(np.array([bucket]), string, first[at], length[at], doc[at])


def pack_strings(strings: list[bytes], low: np.ndarray, least: np.ndarray, most: np.ndarray) -> bytes:
    sizes = np.array([len(x) for x in strings], np.int32)
    return pack(sizes, low, least, most, np.frombuffer(b"".join(strings), np.uint8))


def unpack_strings(blob: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    sizes, low, least, most, data = unpack(blob, "i4", "u8", "i8", "i8", "u1")
    data, ends = data.tobytes(), np.cumsum(sizes)
    return [data[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist())], low, least, most


def with_chunks(chunks: DataFrame, *parts: DataFrame) -> DataFrame:
    """(chunk, kind, bucket, blob): a chunk's documents (kind 0) and what has come for it."""
    every = chunks.select("chunk", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("bucket"), "blob")
    for kind, part in enumerate(parts, 1):
        bucket = F.col("bucket") if "bucket" in part.columns else F.lit(-1).cast("long")
        every = every.unionByName(part.select("chunk", F.lit(kind).alias("kind"), bucket.alias("bucket"), "blob"))
    return every


def fragments(chunks: DataFrame, hashes: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, blob): the distinct fragments of repeated minimizers of each chunk, by bucket."""

    def work(chunk: str, rows: Rows) -> Rows:
        rows = iter(rows)
        here = Chunk(next(rows)[3])
        chosen = Selected(here, [(r[2], r[3]) for r in rows], buckets)
        for bucket in np.unique(chosen.bucket).tolist():
            at = np.flatnonzero(chosen.bucket == bucket)
            yield bucket, chunk, pack_strings([chosen.strings[i] for i in at], chosen.low[at], chosen.least[at], chosen.most[at])

    types = [pa.int64(), pa.string(), pa.binary()]
    return by_key(with_chunks(chunks, hashes), "chunk", "kind", work, "bucket long, chunk string, blob binary", types)


def removed_bytes(here: Chunk, chosen: Selected, answers: list[bytes]) -> np.ndarray:
    """Which bytes of a chunk's documents go."""
    change = np.zeros(len(here.data) + 1, np.int64)
    by_string = np.argsort(chosen.which, kind="stable")
    count = np.bincount(chosen.which, minlength=len(chosen.strings))
    begin = np.cumsum(count) - count
    for blob in answers:
        bucket, string, first, length, doc = unpack(blob, *["i8"] * 5)
        string = np.flatnonzero(chosen.bucket == bucket[0])[string]
        n = count[string]
        answer = np.repeat(np.arange(len(string)), n)
        place = by_string[np.repeat(begin[string] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        hit = doc[answer] < here.ids[chosen.doc[place]]
        answer, place = answer[hit], place[hit]
        start = chosen.starts[place] + first[answer]
        np.add.at(change, start, 1)
        np.add.at(change, start + length[answer] + SPAN - 1, -1)
    return np.cumsum(change)[:-1] > 0


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """Removes passages that a document with a smaller id has; one row per input row.

    Columns: the id, n_bytes, n_removed, n_spans (runs of removed bytes within the document) and kept_sha256; with
    `texts` also kept, the bytes that stay. Texts shorter than the span, null and empty ones stay whole. Rows with a
    null id neither lose nor remove anything; rows of equal ids don't remove each other's passages; other columns
    are not read, so their names can't clash. Ids are whole numbers (or all null): a column of another type is refused
    with a TypeError, since its order would not be that of the numbers.
    """
    id_type = docs.schema[id_col].dataType
    if not isinstance(id_type, (IntegralType, NullType)):
        raise TypeError(f"{id_col} has to hold whole numbers, not {id_type.simpleString()}")
    chunks = cut_lineage(pack_chunks(docs.withColumn(id_col, F.col(id_col).cast("long")), id_col, text_col))
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    hashes = cut_lineage(repeated_hashes(chunks, buckets))
    sent = fragments(chunks, hashes, buckets)
    answers = by_key(sent, "bucket", "chunk", bucket_answers, "chunk string, blob binary", [pa.string(), pa.binary()])

    def finish(chunk: str, rows: Rows) -> Rows:
        rows = list(rows)
        here = Chunk(rows[0][3])
        chosen = Selected(here, [(r[2], r[3]) for r in rows if r[1] == 1], buckets)
        gone = removed_bytes(here, chosen, [r[3] for r in rows if r[1] == 2])
        for i, (a, b) in enumerate(zip(here.begins.tolist(), here.ends.tolist())):
            mask = gone[a:b]
            kept = here.data[a:b][~mask].tobytes()
            spans = int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(len(mask) > 0 and mask[0])
            row = (int(here.ids[i]) if here.known[i] else None, b - a, int(mask.sum()), spans, sha256(kept))
            yield (*row, kept) if texts else row

    schema = f"{id_col} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * texts
    return by_key(with_chunks(chunks, hashes, answers), "chunk", "kind", finish, schema, types)
