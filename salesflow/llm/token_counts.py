"""Operator 2, token counts by compiled finite-state transducers.

Two deterministic machines count the tokens of a byte-level BPE vocabulary without building any token.

* The splitter reads characters and finds where matches of the vocabulary's pattern start. Its texts are cut into
  chunks; each chunk is first turned into a state map (the state after it, for each state before it), the maps are
  composed by a parallel prefix scan, and then all chunks run at once from their true states.
* The counter reads the bytes of one match. A state holds, for each place where a token could still start, the
  vocabulary prefix read since, the token that ends there and how many tokens lead to it, less the least of these
  counts; a transition emits by how much that least count grows. Transitions are compiled when first taken, and the
  whole table is dropped when it reaches its bound, as lazily compiled automata do, so memory is bounded. A match of more
  than LONG bytes is cut into chunks, whose state maps are computed together and composed.

Both run over all chunks, and all matches, of a batch at once (numpy).
"""

from __future__ import annotations

import functools
import json

import numpy as np
import regex
from pyspark.sql import DataFrame

from .bpe import Vocabulary
from .common import map_texts, segments

# States of the splitter: nothing before; in letters, numbers, other signs; after a space, after other white space;
# after an apostrophe that starts a match, and then r, v or l; after a whole contraction.
START, LETTER, NUMBER, OTHER, SPACE, WHITE, APOSTROPHE, AP_R, AP_V, AP_L, CONTRACTED = range(11)
STATES = 11
# Classes of characters: letters, numbers, space, other white space, other signs, apostrophe, and the letters that
# contractions are made of ('s 't 're 've 'm 'll 'd).
C_LETTER, C_NUMBER, C_SPACE, C_WHITE, C_OTHER, C_QUOTE, C_R, C_V, C_L, C_E, C_STMD = range(11)
CLASSES = 11
CHUNK = 256
#: Matches of more bytes are counted by chunks, with at most so many states guessed for the start of each.
LONG, ENTRIES = 1024, 32
#: States that the counter's table holds at most, and characters that are worked on at once.
MAX_STATES = 200_000
GROUP = 1 << 21
#: Below a vocabulary prefix with at most so many tokens, previous tokens that allow the same ones count as one.
FEW = 16
#: Spreads keys over the table of transitions (the golden ratio of 64 bits, odd).
SPREAD = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def class_table() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, C_OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\p{L}+", C_LETTER), (r"\p{N}+", C_NUMBER), (r"\s+", C_WHITE)):
        for m in regex.finditer(pattern, every):
            table[[ord(c) for c in m[0]]] = kind
    for chars, kind in ((" ", C_SPACE), ("'", C_QUOTE), ("r", C_R), ("v", C_V), ("l", C_L), ("e", C_E), ("stmd", C_STMD)):
        table[[ord(c) for c in chars]] = kind
    return table


def step(state: int, kind: int) -> tuple[int, bool]:
    """The next state of the splitter, and whether a match starts before the character. Two cases wait for what
    follows: a start before r, v or l after an apostrophe, and one before the last white space of a run."""
    letter = kind in (C_LETTER, C_R, C_V, C_L, C_E, C_STMD)
    if kind in (C_SPACE, C_WHITE):
        return (SPACE if kind == C_SPACE else WHITE), state not in (SPACE, WHITE)
    if state == APOSTROPHE and kind in (C_STMD, C_R, C_V, C_L):
        return {C_STMD: CONTRACTED, C_R: AP_R, C_V: AP_V, C_L: AP_L}[kind], False
    if (state, kind) in ((AP_R, C_E), (AP_V, C_E), (AP_L, C_L)):
        return CONTRACTED, False
    into = LETTER if letter else NUMBER if kind == C_NUMBER else OTHER
    before = {AP_R: LETTER, AP_V: LETTER, AP_L: LETTER, APOSTROPHE: OTHER}.get(state, state)
    if kind == C_QUOTE and before not in (SPACE, OTHER):
        return APOSTROPHE, True
    return into, before not in (SPACE, into)


@functools.cache
def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Flat tables by class * STATES + state. Classes from CLASSES on are those of a text's first character."""
    nexts, starts = np.zeros((2 * CLASSES, STATES), np.uint8), np.zeros((2 * CLASSES, STATES), bool)
    for kind in range(CLASSES):
        for state in range(STATES):
            nexts[kind, state], starts[kind, state] = step(state, kind)
            nexts[kind + CLASSES, state], starts[kind + CLASSES, state] = step(START, kind)
    return nexts.ravel(), starts.ravel()


def states_after(kinds: np.ndarray) -> np.ndarray:
    """The splitter's state after each character, by composing the state maps of chunks."""
    nexts, n = splitter()[0], len(kinds)
    chunks = -(-n // CHUNK)
    grid = np.zeros(chunks * CHUNK, np.intp)
    grid[:n] = kinds.astype(np.intp) * STATES
    grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T)
    maps = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (chunks, STATES))
    for k in range(CHUNK):
        maps = nexts[grid[k][:, None] + maps]
        if k % 16 == 15 and maps.shape[1] > 1 and (maps == maps[:, :1]).all():
            maps = maps[:, :1]  # every chunk has forgotten the state before it
    maps = np.array(np.broadcast_to(maps, (chunks, STATES)))
    reach = 1
    while reach < chunks:  # inclusive prefix scan: maps[i] becomes the map of chunks 0 to i
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), 1)
        reach *= 2
    state = np.zeros(chunks, np.uint8)
    state[1:] = maps[:-1, START]
    out = np.empty((CHUNK, chunks), np.uint8)
    for k in range(CHUNK):
        state = out[k] = nexts[grid[k] + state]
    return out.T.ravel()[:n]


def match_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a match of the pattern starts at each code point; `first` marks the first one of each text."""
    kinds = class_table()[points]
    white = (kinds == C_SPACE) | (kinds == C_WHITE)
    kinds[first] += CLASSES
    after = states_after(kinds)
    before = np.empty_like(after)
    before[0], before[1:] = START, after[:-1]
    starts = splitter()[1][kinds.astype(np.intp) * STATES + before]
    ends_text = np.append(first[1:], True)
    waits = np.flatnonzero((after >= AP_R) & (after <= AP_L))
    follows = np.minimum(waits + 1, len(after) - 1)
    starts[waits] = ends_text[waits] | (after[follows] != CONTRACTED)
    # the last white space before a sign leaves its run
    starts[:-1] |= white[:-1] & ~white[1:] & ~ends_text[:-1]
    return starts


class Counter:
    """The lazily compiled transducer from the bytes of a match to its number of tokens."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.child: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        self.tokens_below: dict[int, list[int] | None] = {}
        for i, data in enumerate(vocabulary.token_bytes):
            if data and vocabulary.merge(data) == [i]:
                node = 0
                for b in data:
                    if b not in self.child[node]:
                        self.child[node][b] = len(self.child)
                        self.child.append({})
                        self.token.append(-1)
                    node = self.child[node][b]
                self.token[node] = i
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self.final = np.zeros(1024, np.int32)
        # transitions by open addressing: key = state * 256 + byte, in `slots`; -1 is free
        self.bits, self.used = 16, 0
        self._table(self.bits)
        self.merged: dict[tuple[int, int], int | None] = {}
        self.same: dict[tuple, int] = {}
        self.state(((0, -1, 0),))

    def _table(self, bits: int) -> None:
        self.bits, size = bits, 1 << bits
        self.keys, self.next, self.emit = np.full(size, -1, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or the free one where it belongs."""
        mask = (1 << self.bits) - 1
        at = ((keys.astype(np.uint64) * SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)
        held = self.keys[at]
        rest = np.flatnonzero((held != keys) & (held >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & mask
            held = self.keys[at[rest]]
            rest = rest[(held != keys[rest]) & (held >= 0)]
        return at

    def state(self, items: tuple) -> int:
        found = self.ids.get(items)
        if found is None:
            found = self.ids[items] = len(self.states)
            self.states.append(items)
            if found == len(self.final):
                self.final = np.concatenate([self.final, np.zeros_like(self.final)])
            self.final[found] = next(count for node, _, count in items if node == 0)
        return found

    def below(self, node: int) -> list[int] | None:
        """The tokens strictly below a node, or None if there are more than FEW."""
        if node not in self.tokens_below:
            found, rest = [], [*self.child[node].values()]
            while rest and len(found) <= FEW:
                at = rest.pop()
                if self.token[at] >= 0:
                    found.append(self.token[at])
                rest.extend(self.child[at].values())
            self.tokens_below[node] = found if len(found) <= FEW else None
        return self.tokens_below[node]

    def last(self, node: int, last: int) -> int | None:
        """One token for all those that the same tokens below a node may follow; None if none may."""
        tokens = self.below(node)
        if tokens is None or last < 0:
            return last
        if (node, last) not in self.merged:
            fit = tuple(x for x in tokens if self.vocabulary.pair_ok(last, x))
            self.merged[node, last] = self.same.setdefault((node, fit), last) if fit else None
        return self.merged[node, last]

    def compile(self, state: int, byte: int) -> None:
        made, new = [], None
        for node, last, count in self.states[state]:
            below = self.child[node].get(byte)
            if below is not None:
                token = self.token[below]
                if token >= 0 and (last < 0 or self.vocabulary.pair_ok(last, token)):
                    new = (0, token, count + 1)
                if self.child[below] and (kept := self.last(below, last)) is not None:
                    made.append((below, kept, count))
        made.append(new)
        least = min(count for *_, count in made)
        into = self.state(tuple(sorted((node, last, count - least) for node, last, count in made)))
        if 2 * self.used >= 1 << self.bits:
            keys, nexts, emits = self.keys, self.next, self.emit
            self._table(self.bits + 1)
            held = np.flatnonzero(keys >= 0).tolist()
            for i in held:
                self._put(int(keys[i]), int(nexts[i]), int(emits[i]))
        self.used += 1
        self._put(state << 8 | byte, into, least)

    def _put(self, key: int, into: int, least: int) -> None:
        at, mask = (key * int(SPREAD) & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits), (1 << self.bits) - 1
        while self.keys[at] >= 0:
            at = (at + 1) & mask
        self.keys[at], self.next[at], self.emit[at] = key, into, least

    def taken(self, keys: np.ndarray) -> np.ndarray:
        """The slots of transitions (state * 256 + byte), compiled where they are new."""
        slot = self.slots(keys)
        lacking = keys[self.keys[slot] < 0]
        if len(lacking):
            for x in np.unique(lacking).tolist():
                self.compile(x >> 8, x & 255)
            slot = self.slots(keys)
        return slot

    def count(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of each data[start : start + size]: short matches all step together, long ones by their chunks."""
        if len(self.states) > MAX_STATES:
            self.reset()
        order = np.argsort(-sizes, kind="stable")
        n_long = int(np.searchsorted(-sizes[order], -LONG, side="left"))
        out = np.empty(len(sizes), np.int64)
        short = order[n_long:]
        at, sizes_ = starts[short], sizes[short]
        alive = np.searchsorted(-sizes_, -np.arange(1, int(sizes_[0]) + 1 if len(sizes_) else 1), side="right")
        state, total = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for k, m in enumerate(alive):
            slot = self.taken((state[:m] << 8) + data[at[:m] + k])
            total[:m] += self.emit[slot]
            state[:m] = self.next[slot]
        out[short] = total + self.final[state]
        for i in order[:n_long].tolist():
            out[i] = self.count_long(data[starts[i] : starts[i] + sizes[i]])
        return out

    def state_maps(self, chunks: list[bytes], entries: list[int]) -> list[tuple[int, int]]:
        """(state after, tokens emitted) of each chunk entered in a state: all chunks step together."""
        rows = np.frombuffer(b"".join(chunks), np.uint8).reshape(len(chunks), -1).T.astype(np.int64)
        state, total = np.array(entries, np.int64), np.zeros(len(chunks), np.int64)
        for column in rows:
            slot = self.taken((state << 8) + column)
            total += self.emit[slot]
            state = self.next[slot].astype(np.int64)
        return list(zip(state.tolist(), total.tolist(), strict=True))

    def count_long(self, data: np.ndarray) -> int:
        """Tokens of one long match. Its chunks are turned into state maps, all at once, for the states in which the chunk
        before can end as far as is known; the maps are then composed from the left. Most chunks end in the same state
        whatever they were entered in, so two or three rounds do; equal chunks share their maps, as in runs of one sign."""
        whole = len(data) // CHUNK * CHUNK
        chunks = [data[i : i + CHUNK].tobytes() for i in range(0, whole, CHUNK)]
        maps: dict[bytes, dict[int, tuple[int, int]]] = {c: {} for c in chunks}
        at = state = total = 0
        wanted = {(c, 0) for c in maps}
        while at < len(chunks):
            if len(self.states) > MAX_STATES:
                items = self.states[state]
                self.reset()
                state, maps = self.state(items), {c: {} for c in maps}
                wanted = set()
            pairs = sorted(wanted | {(chunks[at], state)})
            for (chunk, entry), found in zip(pairs, self.state_maps(*map(list, zip(*pairs, strict=True))), strict=True):
                maps[chunk][entry] = found
            while at < len(chunks) and state in maps[chunks[at]]:
                state, emitted = maps[chunks[at]][state]
                total, at = total + emitted, at + 1
            wanted = {
                (after, exit_)
                for before, after in zip(chunks[at:], chunks[at + 1 :])
                for exit_, _ in maps[before].values()
                if exit_ not in maps[after] and len(maps[after]) < ENTRIES
            }
        for byte in data[whole:].tolist():
            slot = self.taken(np.array([(state << 8) + byte], np.int64))
            state, total = int(self.next[slot[0]]), total + int(self.emit[slot[0]])
        return total + int(self.final[state])


@functools.cache
def machines(path: str) -> tuple[Counter, regex.Pattern | None]:
    """One for each worker process, kept between its tasks; and a pattern of the added tokens."""
    with open(path, encoding="utf-8") as file:
        added = [x["content"] for x in json.load(file)["added_tokens"]]
    special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
    return Counter(Vocabulary.from_json(path)), special


def pieces(text: str, special: regex.Pattern | None) -> tuple[list[str], int]:
    """The stretches of a text that are counted each by itself, and the number of added tokens between them."""
    parts = special.split(text) if special else [text]
    return [x for part in parts for x in segments(part) if x], len(parts) - 1


def count_tokens(texts: list[str], path: str) -> list[int]:
    counter, special = machines(path)
    totals = np.zeros(len(texts), np.int64)
    group: list[tuple[int, str]] = []
    held = 0

    def flush() -> None:
        if not group:
            return
        joined = "".join(x for _, x in group)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        lengths = np.array([len(x) for _, x in group])
        first = np.zeros(len(points), bool)
        first[np.cumsum(lengths) - lengths] = True
        at = np.flatnonzero(match_starts(points, first))
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        byte_at = np.cumsum(width) - width
        data = np.frombuffer(joined.encode(), np.uint8)
        starts = byte_at[at]
        counts = counter.count(data, starts, np.diff(np.append(starts, len(data))))
        owner = np.repeat(np.array([i for i, _ in group]), lengths)[at]
        totals[:] += np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)

    for i, text in enumerate(texts):
        parts, between = pieces(text, special)
        totals[i] += between
        for part in parts:
            group.append((i, part))
            held += len(part)
            if held >= GROUP:
                flush()
                group, held = [], 0
    flush()
    return totals.tolist()


def token_counts(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text under a byte-level BPE tokenizer file (.json), one row per input row.

    Columns: the id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit). Added tokens such as
    <|endoftext|> count as one where a text holds them, as the library does. Null and empty texts have 0 bytes and
    0 tokens; null and repeated ids stay rows of their own; other columns are not read, so their names can't clash.
    `path` has to be readable by the executors.
    """

    def prepare():
        def work(texts: list[str]) -> dict:
            counts = count_tokens(texts, path)
            return {"n_bytes": [len(x.encode()) for x in texts], "n_tokens": counts, "over_limit": [x > limit for x in counts]}

        return work

    return map_texts(docs, id_col, text_col, "n_bytes long, n_tokens long, over_limit boolean", prepare)
