"""Merge rules of byte-pair vocabularies, for the operators that count, encode and decode tokens.

The merge process joins, again and again, the leftmost adjacent pair of the least rank. Two facts about it carry
the operators built on this module. A sequence of tokens is the result of the process for its bytes if and only
if each two neighbours are: until a pair is joined across a boundary, the process inside is the same as for the
neighbours alone, and such a join would also happen there. So whether neighbours may stand together (`pair_ok`) is
all that has to be known about a boundary.
"""

from __future__ import annotations

import base64
import heapq
import json

BIG = 1 << 60
#: Up to this many tokens the least rank is found by looking at all pairs; beyond, with a heap.
SMALL = 64
#: Remembered pairs; beyond this many they are forgotten and worked out again.
MEMO = 1 << 18


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in .json vocabularies: a byte that prints stands for itself,
    the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """`token_bytes` by id, `single` (the id of each byte) and the rule for joining two neighbours."""

    def __init__(self, token_bytes: dict[int, bytes]):
        self.token_bytes = [token_bytes.get(i, b"") for i in range(max(token_bytes) + 1)]
        self.ids = {b: i for i, b in token_bytes.items()}
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.rules: dict[tuple[int, int], tuple[int, int]] | None = None
        self.joins: dict[tuple[int, int], tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    @classmethod
    def from_ranks(cls, path: str) -> Vocabulary:
        """A rank file: any two neighbours join if their bytes are a token; its id is the rank."""
        with open(path, "rb") as file:
            return cls({int(rank): base64.b64decode(token) for token, rank in (line.split() for line in file if line.strip())})

    @classmethod
    def from_json(cls, path: str) -> Vocabulary:
        """A tokenizer file with a list of merges, by rank."""
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        alphabet = byte_alphabet()
        made = cls({i: bytes(alphabet[c] for c in token) for token, i in model["vocab"].items() if all(c in alphabet for c in token)})
        ids = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        made.rules = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        return made

    def join(self, a: int, b: int) -> tuple[int, int] | None:
        """(rank, id) of two neighbours joined, or None."""
        if self.rules is not None:
            return self.rules.get((a, b))
        found = self.joins.get((a, b), 0)
        if found == 0:
            token = self.ids.get(self.token_bytes[a] + self.token_bytes[b])
            found = None if token is None else (token, token)
            if len(self.joins) >= MEMO:
                self.joins.clear()
            self.joins[a, b] = found
        return found

    def merge(self, data: bytes) -> list[int]:
        """The merge process over some bytes."""
        ids = [self.single[b] for b in data]
        return self._merge_long(ids) if len(ids) > SMALL else self._merge_short(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        join = self.join
        found = [join(a, b) for a, b in zip(ids, ids[1:])]
        while True:
            least, at = BIG, -1
            for i, x in enumerate(found):
                if x is not None and x[0] < least:
                    least, at = x[0], i
            if at < 0:
                return ids
            ids[at : at + 2] = [found[at][1]]
            del found[at]
            if at < len(found):
                found[at] = join(ids[at], ids[at + 1])
            if at:
                found[at - 1] = join(ids[at - 1], ids[at])

    def _merge_long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(x[0], i, ids[i], ids[i + 1], x[1]) for i in range(n - 1) if (x := self.join(ids[i], ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, token = heapq.heappop(heap)
            j = after[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = token, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
                if x := self.join(token, ids[after[i]]):
                    heapq.heappush(heap, (x[0], i, token, ids[after[i]], x[1]))
            if before[i] >= 0 and (x := self.join(ids[before[i]], token)):
                heapq.heappush(heap, (x[0], before[i], ids[before[i]], token, x[1]))
        return [x for x in ids if x >= 0]

    def pair_ok(self, a: int, b: int) -> bool:
        """Whether a and b can be neighbours in the result of the merge process."""
        found = self.pairs.get((a, b))
        if found is None:
            found = self.merge(self.token_bytes[a] + self.token_bytes[b]) == [a, b]
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            self.pairs[a, b] = found
        return found
