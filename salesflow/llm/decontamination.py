"""Operator 1, benchmark decontamination by random-walk embedding, bit sampling and exact edit verification.

A benchmark item leaks into a document if some stretch of the document is within (1 - similarity) * n word edits of
the item's n words. Words are compared without case and outer punctuation; in scripts without spaces between
words, each character is a word. Items of fewer than MIN_WORDS words are looked up as they are.

Windows that start at a word of the benchmark and are as long as the items of one length class are walked as in the
CGK embedding: a pointer reads a word, and a random bit of the step and the word says whether it moves on. Strings
a few edits apart give walks that meet again and again, so the embedded strings differ in few places. Some sampled
places of the walk make a key; windows and items of equal key, in any of REPEATS walks, are candidates. Candidates
are verified by the exact edit distance of the item to the best stretch around the window.

An edit that takes the first words of an item away, or many edits at one place, would leave the walks of whole items
nowhere to meet. So items are also walked from places further in, up to the start of the longer of the two parts that
one run of edits leaves, and half of the walks sample places within such a part only.

Walks drift apart as edits add up, so items of more than PIECE words are cut into consecutive pieces of about equal
length, and the pieces are walked. Within the allowed edits of an item one piece at least has no more edits a word
than the whole item, so that the piece is within its own allowed edits; the whole item is verified around it.

Two bounds without loss keep this cheap. Each edit takes at most two of an item's n - 1 word pairs away, so a window that
holds, with the words before it that a walk from further in passes over, fewer pairs of the benchmark than n - 1 less
twice the allowed edits is not walked; and a candidate
that holds fewer of the item's words than n less the allowed edits is not aligned. Items are worked on in blocks of BLOCK, each one pass over the documents, so what is broadcast is bounded.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import filter_texts, id_and_text

#: Items with fewer words are not walked, but found where they stand unchanged.
MIN_WORDS = 5
SIMILARITY = 0.8
#: Walks, and sampled places of each: over 0.95 of random items edited up to the limit are found (tests).
REPEATS, PLACES = 16, 3
#: Parts of a piece between the places from which it is walked, and how far in the last of them may lie.
STARTS, INSIDE = 10, 0.6
#: The most words that are walked as one piece.
PIECE = 40
#: Items of one pass, and the most bytes of their texts.
BLOCK, BLOCK_BYTES = 2000, 8 << 20
#: The longest item of a length class over the shortest one.
CLASS_RATIO = 1.3
SEED = 20240607
#: Places of the table that marks the benchmark's word pairs; two pairs in one place only weaken the bound.
PAIR_BITS = 22
#: Words whose numbers a worker remembers, and words that it walks over at once.
MEMO = 500_000
GROUP = 1 << 21
#: Characters of scripts without spaces between words: Thai, Lao, Burmese, Khmer, kana and Han.
UNSPACED = (
    "\u0e00-\u0e4e\u0e80-\u0ece\u0edc-\u0eff\u1000-\u103f\u1050-\u108f\u1780-\u17d3\u3005-\u3007\u3041-\u30ff\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
MARKS = "".join(c for c in map(chr, [*range(0xE00, 0x10A0), *range(0x1780, 0x17D4), 0x3099, 0x309A]) if unicodedata.category(c)[0] == "M")
ANY_UNSPACED = re.compile(f"[{UNSPACED}]")
WORD = re.compile(f"[{UNSPACED}][{MARKS}]*|[^\\s{UNSPACED}]+")
SPACED_WORD = re.compile(r"\S+")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def normal(word: str) -> str:
    if word.isalpha() or len(word) > 1 and word[0].isalpha() and ANY_UNSPACED.match(word):
        return word.lower()
    return EDGES.sub("", word.lower())


def is_unspaced(text: str) -> bool:
    return not text.isascii() and ANY_UNSPACED.search(text) is not None


def raw_words(text: str) -> list[str]:
    return WORD.findall(text) if is_unspaced(text) else text.split()


def item_words(text: str) -> list[str]:
    return [x for x in map(normal, raw_words(text)) if x]


class Numbers(dict):
    """Numbers of raw words: from 1 for words of the benchmark, 0 for others, -1 for bare punctuation."""

    def __init__(self, words: dict[str, int]):
        super().__init__()
        self.words = words

    def __missing__(self, raw: str) -> int:
        word = normal(raw)
        found = self.words.get(word, 0) if word else -1
        if len(self) >= MEMO:
            self.clear()
        self[raw] = found
        return found


@dataclass
class LengthClass:
    shortest: int
    longest: int
    pieces: list[int]
    places: np.ndarray = None  # by repeat, the sampled steps in order
    tables: list = field(default_factory=list)  # by repeat: first symbols, sorted keys, their pieces and how far in they start


def step_bits(multipliers: np.ndarray, step: int, symbols: np.ndarray) -> np.ndarray:
    """A random bit for a step and each symbol (multiply-shift hashing)."""
    return ((symbols + 2).astype(np.uint64) * multipliers[step] >> np.uint64(63)).astype(np.int64)


def walk(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, multipliers: np.ndarray, places: np.ndarray, first: np.ndarray | None):
    """Keys of the sampled places of each walk, and which walks they are of: with `first`, only those whose first
    sampled symbol is in it."""
    at, key = starts.copy(), np.zeros(len(starts), np.uint64)
    alive = np.arange(len(starts))
    wanted = set(places.tolist())
    for step in range(int(places[-1]) + 1):
        inside = at < ends
        symbol = np.where(inside, ids[np.minimum(at, len(ids) - 1)], -2)
        if step in wanted:
            if first is not None and step == places[0]:
                keep = first[symbol + 2]
                at, key, ends, symbol, alive = at[keep], key[keep], ends[keep], symbol[keep], alive[keep]
            key = (key ^ (symbol + 3).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        at += step_bits(multipliers, step, symbol)
    return key, alive


def piece_cuts(n: int) -> np.ndarray:
    """Where the pieces of an item of n words start, and n; short items have none."""
    if n < MIN_WORDS:
        return np.zeros(1, np.int64)
    parts = -(-n // PIECE)
    return np.arange(parts + 1) * n // parts


def inner_starts(n: int) -> np.ndarray:
    """From how far in a piece of n words is walked."""
    return np.arange(0, int(INSIDE * n) + 1, max(1, n // STARTS))


def pair_places(ids: np.ndarray) -> np.ndarray:
    """Where each pair of neighbours is marked."""
    mixed = ids[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + ids[1:].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


@dataclass
class Index:
    """The walks of one block of items."""

    numbers: dict[str, int]
    item_ids: list
    items: list[np.ndarray]
    owners: np.ndarray  # by piece, its item
    offsets: np.ndarray  # by piece, its first word in the item
    sizes: np.ndarray  # by piece, its words
    classes: list[LengthClass]
    multipliers: np.ndarray
    similarity: float
    pairs: np.ndarray
    counts: list[Counter]
    short: dict[int, tuple[list[np.ndarray], list[list[int]]]]  # by length: codes of each word, items of the last

    def allowed(self, n: int) -> int:
        return math.floor((1 - self.similarity) * n + 1e-9)

    @classmethod
    def of(cls, items: list[tuple[object, list[str]]], similarity: float) -> Index:
        numbers: dict[str, int] = {}
        coded = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], np.int64) for _, words in items]
        random = np.random.default_rng(SEED)
        cuts = [piece_cuts(len(x)) for x in coded]
        owners = np.repeat(np.arange(len(coded)), [len(x) - 1 for x in cuts])
        inside = np.concatenate([np.zeros(0, np.int64), *(x[:-1] for x in cuts)])
        sizes = np.concatenate([np.zeros(0, np.int64), *map(np.diff, cuts)])
        classes: list[LengthClass] = []
        for i in np.argsort(sizes, kind="stable").tolist():
            n = int(sizes[i])
            if not classes or n > classes[-1].shortest * CLASS_RATIO:
                classes.append(LengthClass(n, n, []))
            classes[-1].longest = n
            classes[-1].pieces.append(i)
        steps = max((int(1.5 * c.shortest) + 2 for c in classes), default=0)
        multipliers = random.integers(0, 1 << 63, (REPEATS, max(steps, 1)), np.uint64) * np.uint64(2) + np.uint64(1)
        pairs = np.zeros(1 << PAIR_BITS, bool)
        for x in coded:
            if len(x) >= MIN_WORDS:
                pairs[pair_places(x)] = True
        short = {}
        for n in range(1, MIN_WORDS):
            mine = [i for i, x in enumerate(coded) if len(x) == n]
            if not mine:
                continue
            state, levels = np.zeros(len(mine), np.int64), []
            for j in range(n):
                codes, state = np.unique(state * (len(numbers) + 1) + [coded[i][j] for i in mine], return_inverse=True)
                levels.append(codes)
            short[n] = levels, [[i for i, x in zip(mine, state.tolist()) if x == k] for k in range(len(levels[-1]))]
        counts = [Counter(x.tolist()) for x in coded]
        made = cls(numbers, [i for i, _ in items], coded, owners, inside, sizes, classes, multipliers, similarity, pairs, counts, short)
        flat = np.concatenate([*coded, np.zeros(1, np.int64)]) if coded else np.zeros(1, np.int64)
        offsets = np.cumsum([0, *map(len, coded)])
        for c in classes:
            # a step passes over half a word on average
            reach = [max(int(x * c.shortest), PLACES) for x in (1.5, 2 * (1 - INSIDE))]
            c.places = np.array([np.sort(random.choice(reach[r % 2], PLACES, replace=False)) for r in range(REPEATS)])
            inner = [inner_starts(int(sizes[i])) for i in c.pieces]
            walked, inner = np.repeat(c.pieces, [len(x) for x in inner]), np.concatenate(inner)
            starts = offsets[owners[walked]] + inside[walked]
            starts, ends = starts + inner, starts + sizes[walked]
            for r in range(REPEATS):
                first = np.zeros(len(numbers) + 3, bool)
                first[made._symbols(flat, starts, ends, r, int(c.places[r][0])) + 2] = True
                keys, _ = walk(flat, starts, ends, multipliers[r], c.places[r], None)
                by = np.argsort(keys, kind="stable")
                c.tables.append((first, keys[by], walked[by], inner[by]))
        return made

    def _symbols(self, ids, starts, ends, r, place) -> np.ndarray:
        at = starts.copy()
        for step in range(place + 1):
            symbol = np.where(at < ends, ids[np.minimum(at, len(ids) - 1)], -2)
            at += step_bits(self.multipliers[r], step, symbol)
        return symbol

    def candidates(self, ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(starts, pieces, how far in) of windows and pieces that share a key; `begins` and `ends` are those of each
        word's document."""
        common = np.append(self.pairs[pair_places(ids)], False)
        common &= (ids > 0) & (np.arange(1, len(ids) + 1) < ends)
        common = np.concatenate([[0], np.cumsum(common)])
        for c in self.classes:
            size = c.longest + self.allowed(c.longest)
            least = min(n - 1 - 2 * self.allowed(n) for n in set(self.sizes[c.pieces].tolist()))
            starts = np.flatnonzero(ids > 0)
            stops = np.minimum(starts + size, ends[starts])
            back = np.maximum(starts - int(INSIDE * c.longest) - self.allowed(c.longest), begins[starts])
            starts = starts[common[stops - 1] - common[back] >= least]
            if not len(starts):
                continue
            for r, (first, keys, pieces, inner) in enumerate(c.tables):
                key, alive = walk(ids, starts, ends[starts], self.multipliers[r], c.places[r], first)
                low, high = np.searchsorted(keys, key), np.searchsorted(keys, key, side="right")
                hit = np.flatnonzero(high > low)
                count = (high - low)[hit]
                if len(hit):
                    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    at = np.repeat(low[hit], count) + nth
                    yield np.repeat(starts[alive[hit]], count), pieces[at], inner[at]

    def short_items(self, ids: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, item, start) of the first place of each short item in each document."""
        for n, (levels, items) in self.short.items():
            at = np.flatnonzero(ids > 0)
            at = at[at + n <= ends[at]]
            state = np.zeros(len(at), np.int64)
            for j, codes in enumerate(levels):
                code = state * (len(self.numbers) + 1) + ids[at + j]
                place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                same = codes[place] == code
                at, state = at[same], place[same]
            _, first = np.unique(owner[at] * len(items) + state, return_index=True)
            for x in first.tolist():
                for i in items[state[x]]:
                    yield int(owner[at[x]]), i, int(at[x])


def best_stretch(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the stretch of `words` nearest to the item: the first to end of the nearest ones, and
    of those that end there the shortest one."""
    m = len(words)
    places = np.arange(m + 1)
    # rows of the alignment table; each cell carries its edits and, to break ties, minus the stretch's start
    scale = m + 2
    row = 0 * places * scale + (m - places)
    for i, x in enumerate(item):
        cost = np.where(words == x, 0, scale)
        new = row + scale
        new[1:] = np.minimum(new[1:], row[:-1] + cost)
        row = np.minimum.accumulate(new - places * scale) + places * scale
    edits = row // scale
    end = int(edits.argmin())
    return int(edits[end]), m - int(row[end] % scale), end


def regions(
    seen: dict[tuple[int, int], int], index: Index, owner: np.ndarray, ends: np.ndarray, sizes: np.ndarray
) -> Iterator[tuple[int, int, int, int]]:
    """(item, a word of the document, begin, stop) of what is to be aligned, for candidates: by item and the place where
    it would start, a word of the window. Candidates of an item that start close to each other are one region."""
    last = None  # item, document, its word, least and greatest start of the item
    for (i, start), at in sorted(seen.items()):
        k = index.allowed(len(index.items[i]))
        if last and last[:2] == (i, int(owner[at])) and start - last[4] <= k:
            last = (*last[:4], start)
            continue
        if last:
            yield around(last, index, owner, ends, sizes)
        last = (i, int(owner[at]), at, start, start)
    if last:
        yield around(last, index, owner, ends, sizes)


def around(found: tuple[int, int, int, int, int], index: Index, owner: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> tuple[int, int, int, int]:
    i, _, at, least, greatest = found
    n, k = len(index.items[i]), index.allowed(len(index.items[i]))
    # a piece may be shifted by the edits before it, and its window by the edits within it
    begin = max(int(ends[at]) - int(sizes[owner[at]]), least - 2 * k)
    return i, at, begin, min(int(ends[at]), greatest + n + 3 * k)


def find_leaks(texts: list[str], index: Index, numbers: Numbers) -> list[tuple[int, int, int, int, int]]:
    """(text, item, edits, start, end) of each text and item: the best stretch within the allowed edits, in code
    points of the text."""
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    group: list[tuple[int, np.ndarray, np.ndarray]] = []
    held = 0

    def flush() -> None:
        if not group:
            return
        ids = np.concatenate([x for _, x, _ in group])
        sizes = np.array([len(x) for _, x, _ in group])
        ends = np.repeat(np.cumsum(sizes), sizes)
        owner = np.repeat(np.arange(len(group)), sizes)
        seen: dict[tuple[int, int], int] = {}
        for starts, pieces, inner in index.candidates(ids, ends - sizes[owner], ends):
            i, offset = index.owners[pieces], index.offsets[pieces] + inner
            seen.update(zip(zip(i.tolist(), (starts - offset).tolist()), starts.tolist()))
        covered: dict[int, int] = {}
        for i, at, begin, stop in regions(seen, index, owner, ends, sizes):
            if covered.get(i, -1) >= at:
                continue
            item, k = index.items[i], index.allowed(len(index.items[i]))
            g = int(owner[at])
            first = int(ends[at]) - len(group[g][1])
            region = ids[begin:stop]
            # words in common, each as often as both have it
            if sum((Counter(region.tolist()) & index.counts[i]).values()) < len(item) - k:
                continue
            edits, a, b = best_stretch(item, region)
            if edits > k:
                continue
            a, b = (x + begin - first for x in (a, b))
            key = (g, i)
            if key not in found_here or (edits, a) < found_here[key][:2]:
                found_here[key] = (edits, a, b)
            if edits == 0 and len(item) <= PIECE:
                covered[i] = at + len(item) - 1
        for g, i, at in index.short_items(ids, ends, owner):
            a = at - int(ends[at]) + len(group[g][1])
            found_here[g, i] = (0, a, a + len(index.items[i]))
        for (g, i), (edits, a, b) in found_here.items():
            text, _, places = group[g]
            found[text, i] = (edits, int(places[a]), int(places[b - 1]))
        found_here.clear()

    found_here: dict[tuple[int, int], tuple[int, int, int]] = {}
    for t, text in enumerate(texts):
        raw = raw_words(text)
        ids = np.fromiter(map(numbers.__getitem__, raw), np.int64, len(raw))
        places = np.flatnonzero(ids >= 0)
        if len(places):
            group.append((t, ids[places], places))
            held += len(places)
        if held >= GROUP:
            flush()
            group, held = [], 0
    flush()
    out = []
    spans: dict[int, list[tuple[int, int]]] = {}
    for (t, i), (edits, a, b) in sorted(found.items()):
        if t not in spans:
            spans[t] = [m.span() for m in (WORD if is_unspaced(texts[t]) else SPACED_WORD).finditer(texts[t])]
        out.append((t, i, edits, spans[t][a][0], spans[t][b][1]))
    return out


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[object, list[str]]]]:
    """The benchmark's items that have words, block by block through the driver."""
    block, size = [], 0
    for row in id_and_text(benchmark, id_col, text_col).toLocalIterator():
        words = item_words(row[1])
        if words:
            block.append((row[0], words))
            size += len(row[1])
        if len(block) >= BLOCK or size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def benchmark_leaks(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The benchmark items that each document holds, one row per row of documents, row of items and best stretch.

    Columns: the id, the item's id, edits (words), n_words (of the item), similarity (1 - edits / n_words) and the
    stretch's start and end in code points of the text. Of equally near stretches the first is returned. Null and
    empty texts hold no item; items without words are left out; an empty benchmark gives no rows;
    null and repeated ids stay rows of their own; other columns are not read, so their names can't clash.
    """
    pairs = id_and_text(docs, id_col, text_col)
    kinds = pairs.schema[0].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"`{id_col}` {kinds[0]}, `{item_col}` {kinds[1]}, edits int, n_words int, similarity double, start int, end int"
    found = None
    for block in item_blocks(benchmark, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            index = Index.of(block, similarity)
            numbers = Numbers(index.numbers)
            for batch in batches:
                leaks = find_leaks(batch.column(1).to_pylist(), index, numbers)
                if leaks:
                    texts, items, edits, starts, ends = map(list, zip(*leaks))
                    n = [len(index.items[i]) for i in items]
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(texts)), pa.array([index.item_ids[i] for i in items]),
                        pa.array(edits, pa.int32()), pa.array(n, pa.int32()), pa.array([1 - e / x for e, x in zip(edits, n)]),
                        pa.array(starts, pa.int32()), pa.array(ends, pa.int32()),
                    ], [id_col, item_col, "edits", "n_words", "similarity", "start", "end"])

        here = pairs.mapInArrow(run, schema)
        found = here if found is None else found.unionByName(here)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The rows, with all their columns, whose text holds no benchmark item."""
    for block in item_blocks(benchmark, item_col, item_text_col):

        def prepare(block=block):
            index = Index.of(block, similarity)
            numbers = Numbers(index.numbers)

            def work(texts: list[str]) -> list[bool]:
                leaky = {x[0] for x in find_leaks(texts, index, numbers)}
                return [i not in leaky for i in range(len(texts))]

            return work

        docs = filter_texts(docs, text_col, prepare)
    return docs
